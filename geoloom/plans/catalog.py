"""Registered queries over the given tables, and the DuckDB SQL for the same rows.

Incidents are not among the given tables, so queries derive them: events with a place computed from
the user, responses and payloads built from rows, calendars from order dates. All of it grows with
the tables.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as c
from ..functions import grid, hashing, names, polygons, solar
from ..operators import asof, census, dedup, enrich, incidents, lighting, manifest, quality, skew, spatial, weather
from ..sources import readers, sinks
from ..streaming import ingest, upsert
from . import gold
from .registry import ntz, oracle_sql, queries, query, table

__all__ = ["oracle_sql", "queries"]

# --- names, hashes, contract


@query(
    """SELECT c_custkey::VARCHAR AS c_custkey, c_name, sha256(to_json(struct_pack(
    c_acctbal := c_acctbal::VARCHAR, c_custkey := c_custkey::VARCHAR, c_mktsegment := c_mktsegment, c_name := c_name, c_nationkey := c_nationkey::VARCHAR))::VARCHAR) AS source_row_hash,
    'customers' AS source_system FROM customer"""
)
def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer")
    raw = raw.select(*(F.col(n).cast("string").alias(n.replace("c_", "C ")) for n in raw.columns))
    return hashing.with_ingestion_metadata(names.with_snake_names(raw), "customers").select("c_custkey", "c_name", "source_row_hash", "source_system")


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    def one(name: str, key: str, mapping: dict[str, Column | str]) -> DataFrame:
        df = table(spark, sf_dir, name)
        df = df.withColumns({"source_file": F.lit(name), "source_row_hash": F.sha2(F.col(key).cast("string"), 256)})
        return incidents.on_contract(df, {"source_record_id": key, **mapping}, source=name)

    customers = one("customer", "c_custkey", {"offense_name": "c_name", "offense_code": "c_mktsegment", "offense_count": "c_nationkey", "latitude": "c_acctbal"})
    suppliers = one("supplier", "s_suppkey", {"offense_name": "s_name", "offense_count": "s_nationkey", "latitude": "s_acctbal"})
    parts = one("part", "p_partkey", {"offense_name": "p_name", "offense_code": "p_brand", "offense_description": "p_type", "offense_count": F.col("p_size"), "longitude": "p_retailprice"})
    return incidents.assert_contract(customers.unionByName(suppliers).unionByName(parts))


_CANONICAL_SQL = """
  SELECT 'customer' AS source_city, c_custkey::VARCHAR AS source_record_id, c_mktsegment AS offense_code, c_name AS offense_name, NULL::VARCHAR AS offense_description, c_nationkey::BIGINT AS offense_count, c_acctbal AS latitude, NULL::DOUBLE AS longitude, sha256(c_custkey::VARCHAR) AS source_row_hash FROM customer
  UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, NULL, s_name, NULL, s_nationkey, s_acctbal, NULL, sha256(s_suppkey::VARCHAR) FROM supplier
  UNION ALL SELECT 'part', p_partkey::VARCHAR, p_brand, p_name, p_type, p_size, NULL, p_retailprice, sha256(p_partkey::VARCHAR) FROM part"""


@query(_CANONICAL_SQL)
def canonical_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir).select("source_city", "source_record_id", "offense_code", "offense_name", "offense_description", "offense_count", "latitude", "longitude", "source_row_hash")


def _incident_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    city = F.element_at(F.array(*map(F.lit, ["dallas", " Fort_Worth ", "houston", "austin"])), (n % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        city.alias("source_city"),
        F.when(n % 10 != 0, F.concat(F.lit(" "), n.cast("string"))).alias("source_incident_id"),
        F.when(n % 7 != 0, F.col("user_id").cast("string")).alias("source_record_id"),
        F.col("event_type").alias("offense_code"),
        F.when(n % 3 != 0, F.sha2(n.cast("string"), 256)).alias("source_row_hash"),
    )


@query(
    """WITH k AS (SELECT event_id, ['dallas', 'fort_worth', 'houston', 'austin'][(event_id % 4 + 1)::INTEGER] AS city,
    CASE WHEN event_id % 10 <> 0 THEN event_id::VARCHAR END AS i, CASE WHEN event_id % 7 <> 0 THEN user_id::VARCHAR END AS r, event_type AS o, CASE WHEN event_id % 3 <> 0 THEN sha256(event_id::VARCHAR) END AS h FROM events)
    SELECT event_id, CASE WHEN city = 'dallas' AND i IS NOT NULL AND r IS NOT NULL AND o IS NOT NULL THEN sha256(concat_ws('||', city, i, r, o))
    WHEN city = 'fort_worth' AND r IS NOT NULL THEN sha256(concat_ws('||', city, r)) WHEN h IS NOT NULL THEN sha256(concat_ws('||', city, h)) END AS incident_id FROM k"""
)
def stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.with_incident_id(_incident_keys(spark, sf_dir)).select("event_id", "incident_id")


# --- safe parsing


@query(
    """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE WHEN event_id >= 5000 THEN make_timestamp((event_id - 5000) * 1000000) END AS from_millis,
    trim(concat_ws(' ', event_type, CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR END)) AS words,
    date_trunc('second', ts) AS parsed, CASE WHEN event_id % 25 < 24 THEN date_trunc('day', ts) + to_hours(event_id % 25) END AS at_hour,
    date_trunc('minute', ts) AS at_minute, 29 + (user_id * 37 % 1000) / 250.0 AS latitude, -98 + (user_id * 91 % 1000) / 250.0 AS longitude FROM events"""
)
def safe_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _located(spark, sf_dir)
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    place = F.concat(F.lit("BLOCK 5 ("), F.col("latitude").cast("string"), F.lit(", "), F.col("longitude").cast("string"), F.lit(")"))
    return events.select(
        "event_id",
        c.safe_cast(F.get_json_object("props", "$.k"), "int").alias("k"),
        ntz(c.from_millis(((F.col("event_id") - 5000) * 1000).cast("string"))).alias("from_millis"),
        c.joined_words("event_type", F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string"))).alias("words"),
        ntz(c.parsed_timestamp(F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(text, F.lit(".0000000"))))).alias("parsed"),
        ntz(c.date_and_hour(F.date_format("ts", "M/d/yyyy"), F.col("event_id") % 25)).alias("at_hour"),
        ntz(c.date_and_time(text, F.date_format("ts", "HH:mm"))).alias("at_minute"),
        c.coordinate(place, 1).alias("latitude"),
        c.coordinate(place, 2).alias("longitude"),
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 10 = 1 THEN user_id END AS z, CASE event_id % 10 WHEN 0 THEN 'broken {' || event_id WHEN 1 THEN NULL WHEN 2 THEN '{"z":"no"}'
    ELSE '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS _rescued_data FROM events"""
)
def rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown fields, a field of another type, lines that are no object, and lines that fit."""
    n = F.col("event_id") % 10
    line = F.when(n == 0, F.concat(F.lit("broken {"), F.col("event_id"))).when(n == 1, F.to_json(F.struct(F.col("user_id").alias("z")))).when(n == 2, '{"z": "no"}').otherwise(F.col("props"))
    return readers.rescued(table(spark, sf_dir, "events").select("event_id", line.alias("value")), T.StructType([T.StructField("z", T.LongType())]))


# --- deduplication


@query(
    """WITH u AS (SELECT event_id, user_id, ts, value FROM events UNION ALL SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 1 HOUR END, value FROM events)
    SELECT event_id, user_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r FROM u) WHERE r = 1"""
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    shifted = events.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("interval 1 hour")))
    return dedup.one_per_key(events.unionByName(shifted), ["user_id"], ["ts", "event_id", "fingerprint"])


@query("SELECT l_partkey, l_suppkey, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").dropDuplicates()


# --- upserts


def _order_changes(orders: DataFrame) -> DataFrame:
    changed = orders.filter("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X"))
    added = orders.filter("o_orderkey % 7 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    return changed.unionByName(added)


_CHANGES = "SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_orderkey + 10000000, o_orderstatus FROM orders WHERE o_orderkey % 7 = 0"


@query(f"WITH ch AS ({_CHANGES}) SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch) UNION ALL SELECT * FROM ch")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return upsert.upserted(orders, _order_changes(orders), ["o_orderkey"])


@query(f"WITH ch AS ({_CHANGES}) SELECT o_orderkey, o_orderstatus FROM ch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sinks.new_rows(_order_changes(orders), orders, ["o_orderkey"])


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey")
def change_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return sinks.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# --- weather and census


def _responses(events: DataFrame) -> DataFrame:
    """One archive response per user: JSON text with parallel arrays, some of them broken."""
    pair = F.struct(F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("event_id"), F.when(F.col("event_id") % 11 == 0, "bad").otherwise(F.col("event_id").cast("string")).alias("v"))
    users = events.groupBy("user_id").agg(F.sort_array(F.collect_list(pair)).alias("p"))
    times = F.when(F.col("user_id") % 13 == 0, F.array().cast("array<string>")).otherwise(F.col("p.time"))
    hourly = F.to_json(F.struct(times.alias("time"), F.col("p.v").alias("temperature_2m")))
    return users.select(
        *(F.lit(v).alias(n) for n, v in (("provider", "open_meteo"), ("model", "era5"), ("timezone", "GMT"), ("source_file", "f"), ("source_row_hash", "h"))),
        F.sha2(F.col("user_id").cast("string"), 256).alias("request_id"),
        F.col("user_id").cast("string").alias("weather_query_cell_id"),
        F.lit("6").alias("h3_resolution"),
        *(F.lit(1.5).alias(n) for n in ("query_latitude", "query_longitude", "grid_latitude", "grid_longitude", "grid_elevation")),
        F.lit(0).alias("utc_offset_seconds"),
        F.current_timestamp().alias("ingested_at"),
        F.when(F.col("user_id") % 17 == 0, "{broken").otherwise(hourly).alias("hourly"),
        F.lit('{"time": "iso8601", "temperature_2m": "C"}').alias("hourly_units"),
        F.array(F.lit("temperature_2m")).alias("hourly_variables"),
        "user_id",
    )


@query(
    """SELECT user_id AS weather_query_cell_id, 6 AS h3_resolution, date_trunc('hour', ts) AS weather_timestamp, date_trunc('day', ts)::DATE AS weather_date,
    CASE WHEN event_id % 11 <> 0 THEN event_id::DOUBLE END AS temperature_2m_c, 'C' AS temperature_unit FROM events WHERE user_id % 13 <> 0 AND user_id % 17 <> 0"""
)
def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather.hourly_weather(_responses(table(spark, sf_dir, "events")))
    return rows.select("weather_query_cell_id", "h3_resolution", ntz("weather_timestamp").alias("weather_timestamp"), "weather_date", "temperature_2m_c", "temperature_unit")


@query(
    """SELECT user_id, CASE WHEN user_id % 17 = 0 THEN ['parses', 'has_time', 'has_variables'] ELSE ['has_time', 'has_variables'] END AS failed_checks
    FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 17 = 0 OR user_id % 13 = 0"""
)
def invalid_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.valid_responses(_responses(table(spark, sf_dir, "events")))[1].select("user_id", "failed_checks")


def _census_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    values = {code: F.when((key + i) % 9 == 0, census.SENTINELS[i % 6]).otherwise(((key * (i + 3)) % 1000).cast("string")) for i, code in enumerate(census.RENAMES)}
    values["b01002_001e"] = F.when(key % 4 == 0, "130.5").otherwise(((key % 100) + 0.5).cast("string"))
    values["b25001_001e"] = F.when(key % 6 == 0, "0").when(key % 6 == 1, "x").otherwise("800")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 50 != 0, F.lpad(key.cast("string"), 11, "0")).alias("geoid"),
        F.col("c_name").alias("name"),
        *(F.lit(x).alias(n) for n, x in (("state", "48"), ("county", "113"), ("tract", "1"), ("geography_type", "tract"), ("source_file", "f"), ("acs_vintage", "2022"), ("period_start_year", "2018"), ("period_end_year", "2022"))),
        F.current_timestamp().alias("ingested_at"),
        *(v.alias(n) for n, v in values.items()),
    )


def _raw_value(code: str) -> str:
    i = list(census.RENAMES).index(code)
    return f"CASE WHEN (c_custkey + {i}) % 9 <> 0 THEN (c_custkey * {i + 3}) % 1000 END"


@query(
    f"""WITH v AS (SELECT c_custkey, lpad(c_custkey::VARCHAR, 11, '0') AS geoid, {_raw_value("b01003_001e")} AS population, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 100 + 0.5 END::DOUBLE AS median_age,
    {_raw_value("b17001_001e")} AS u, {_raw_value("b17001_002e")} AS b, {_raw_value("b25002_003e")} AS vacant, CASE WHEN c_custkey % 6 = 0 THEN 0 WHEN c_custkey % 6 = 1 THEN NULL ELSE 800 END AS units FROM customer WHERE c_custkey % 50 <> 0)
    SELECT geoid, 2022 AS acs_vintage, population, median_age, CASE WHEN u > 0 THEN b / u::DOUBLE END AS poverty_rate, CASE WHEN units > 0 THEN vacant / units::DOUBLE END AS vacancy_rate FROM v"""
)
def census_tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.census_tracts(_census_raw(spark, sf_dir)).select("geoid", "acs_vintage", "population", "median_age", "poverty_rate", "vacancy_rate")


@query(
    """SELECT n_regionkey::INTEGER + 2010 AS acs_vintage, n_name AS name, n_nationkey::VARCHAR || '_' || n_regionkey::VARCHAR || '_1' AS geoid,
    n_regionkey::INTEGER + 2006 AS period_start_year FROM nation"""
)
def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda n: F.col(n).cast("string")
    row = F.array("n_name", text("n_nationkey"), F.concat(F.lit("_"), text("n_regionkey"), F.lit("_")), F.lit("1"))
    header = F.array(*map(F.lit, ["NAME", "state", "county", "tract"]))
    landed = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(row).alias("rows"))
    landed = landed.select((F.col("n_regionkey") + 2010).cast("int").alias("acs_vintage"), F.to_json(F.concat(F.array(header), F.col("rows"))).alias("payload"))
    records, _ = census.payload_records(landed)
    return records.select("acs_vintage", F.col("record")["NAME"].alias("name"), "geoid", "period_start_year")


# --- grid and polygons


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a place on a lattice of 1/250 degree, computed from the user."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").withColumns({"latitude": 29 + (user * 37 % 1000) / F.lit(250.0), "longitude": -98 + (user * 91 % 1000) / F.lit(250.0), "occurred_at": F.col("ts").cast("timestamp")})


_LOCATED = "SELECT *, 29 + (user_id * 37 % 1000) / 250.0 AS latitude, -98 + (user_id * 91 % 1000) / 250.0 AS longitude FROM events"


def _cell_sql(resolution: int) -> str:
    step = repr(grid.step_degrees(resolution))
    return f"""SELECT *, (({resolution}::BIGINT << {grid.ROW_BITS}) | cell_row) << {grid.COLUMN_BITS} | least(floor((longitude + 180) / 360 * across)::BIGINT, across - 1) AS weather_query_cell_id,
    least(cell_row * {step} + {step} / 2 - 90, 90) AS query_latitude, (least(floor((longitude + 180) / 360 * across)::BIGINT, across - 1) + 0.5) * 360 / across - 180 AS query_longitude
    FROM (SELECT *, greatest(1, round(360 * cos(radians(least(cell_row * {step} + {step} / 2 - 90, 90))) / {step}))::BIGINT AS across
    FROM (SELECT *, floor((latitude + 90) / {step})::BIGINT AS cell_row FROM ({_LOCATED})))"""


_CELLS = _cell_sql(6)


@query(f"SELECT event_id, weather_query_cell_id FROM ({_CELLS})")
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.with_cell(_located(spark, sf_dir)).select("event_id", "weather_query_cell_id")


@query(f"SELECT DISTINCT weather_query_cell_id, round(query_latitude, 9) AS query_latitude, round(query_longitude, 9) AS query_longitude FROM ({_CELLS})")
def cell_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = grid.with_cell(_located(spark, sf_dir)).select("weather_query_cell_id").distinct()
    return grid.with_center(cells).select("weather_query_cell_id", F.round("query_latitude", 9).alias("query_latitude"), F.round("query_longitude", 9).alias("query_longitude"))


def _boundaries(spark: SparkSession, sf_dir: str, year: int = 2020) -> DataFrame:
    """A rectangle of 0.8 by 1 degrees per nation, side by side; the last ones hold no point."""
    key = F.col("n_nationkey")
    x, y = -98 + (key % 5) * F.lit(0.8), 29 + F.floor(key / 5) * F.lit(1.0)
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("string"), (y + dy).cast("string"))
    ring = F.concat_ws(", ", corner(0, 0), corner(0.8, 0), corner(0.8, 1), corner(0, 1), corner(0, 0))
    shapes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("geoid"), polygons.rings_from_wkt(F.concat(F.lit("POLYGON (("), ring, F.lit("))"))).alias("rings"))
    return shapes.withColumns({"boundary_vintage": F.lit(year), "srid": F.lit(4326)}).withColumns(polygons.bounds(F.col("rings")))


_MAPPED = """
  WITH p AS (SELECT DISTINCT latitude, longitude FROM (%s)),
  b AS (SELECT n_nationkey::VARCHAR AS geoid, -98 + (n_nationkey %% 5) * 0.8::DOUBLE AS x0, -98 + (n_nationkey %% 5) * 0.8::DOUBLE + 0.8::DOUBLE AS x1, 29 + (n_nationkey // 5) AS y0, 30 + (n_nationkey // 5) AS y1 FROM nation),
  m AS (SELECT latitude, longitude, count(DISTINCT geoid) FILTER (WHERE longitude > x0 AND longitude < x1 AND latitude > y0 AND latitude < y1) AS insides,
        min(geoid) FILTER (WHERE longitude > x0 AND longitude < x1 AND latitude > y0 AND latitude < y1) AS inside, count(DISTINCT geoid) AS covers, min(geoid) AS cover
        FROM p JOIN b ON longitude BETWEEN x0 AND x1 AND latitude BETWEEN y0 AND y1 GROUP BY ALL)
  SELECT 2020 AS tiger_line_year, latitude, longitude, CASE WHEN insides = 1 THEN inside WHEN covers = 1 THEN cover END AS tract_geoid FROM p LEFT JOIN m USING (latitude, longitude)""" % _LOCATED


@query(_MAPPED)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spatial.unique_locations(_located(spark, sf_dir).withColumn("tiger_line_year", F.lit(2020)))
    return spatial.map_locations(points, _boundaries(spark, sf_dir))


@query("SELECT DISTINCT year(o_orderdate)::INTEGER AS tiger_line_year FROM orders WHERE year(o_orderdate) % 2 = 1")
def missing_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("tiger_line_year"))
    have = years.filter("tiger_line_year % 2 = 0").withColumnRenamed("tiger_line_year", "boundary_vintage")
    return spatial.missing_vintages(years, have)


# --- requests

_CUTOFF = dt.date(2024, 1, 20)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.request_manifest(_located(spark, sf_dir), model=" ERA5 ", hourly_variables=["temperature_2m", " rain ", "rain", ""], cutoff=_CUTOFF)


_MANIFEST = f"""SELECT sha256(concat_ws('|', 'open_meteo', 'era5', weather_query_cell_id::VARCHAR, make_date(y, 1, 1)::VARCHAR, least(make_date(y, 12, 31), DATE '{_CUTOFF}')::VARCHAR, 'rain,temperature_2m', 'GMT', 'nearest', '6')) AS request_id,
  weather_query_cell_id, make_date(y, 1, 1) AS start_date, least(make_date(y, 12, 31), DATE '{_CUTOFF}') AS end_date, ['rain', 'temperature_2m'] AS hourly_variables, event_count
  FROM (SELECT weather_query_cell_id, year(ts)::INTEGER AS y, count(*) AS event_count FROM ({_CELLS}) WHERE ts::DATE <= DATE '{_CUTOFF}' GROUP BY ALL)"""


@query(_MANIFEST)
def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).select("request_id", "weather_query_cell_id", "start_date", "end_date", "hourly_variables", "event_count")


@query(f"SELECT request_id, event_count FROM ({_MANIFEST}) WHERE event_count % 3 <> 0")
def pending_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _manifest(spark, sf_dir)
    return manifest.pending_requests(asked, asked.filter("event_count % 3 = 0")).select("request_id", "event_count")


def _broken_at(n: Column, breaks: dict[str, list[Column]]) -> dict[str, Column]:
    """Columns with one value broken per row, in turn by the number n; the others stay."""
    turns = [(name, value) for name, values in breaks.items() for value in values]
    out: dict[str, Column] = {}
    for i, (name, value) in enumerate(turns):
        out[name] = F.when(n % (len(turns) + 1) == i, value).otherwise(out.get(name, F.col(name)))
    return out


_REQUEST_BREAKS = ("request_id_not_empty", "provider_known", "model_known", "resolution_range", "location_valid", "dates_in_order", "timezone_not_empty", "cell_selection_known", "variables_not_empty", "variables_unique")
_REQUEST_NUMBER = "(weather_query_cell_id + event_count)"


@query(
    f"""SELECT weather_query_cell_id, year(start_date)::INTEGER AS year, [{list(_REQUEST_BREAKS)!r}[({_REQUEST_NUMBER} % 11 + 1)::INTEGER]] AS failed_checks FROM ({_MANIFEST}) WHERE {_REQUEST_NUMBER} % 11 < 10"""
)
def invalid_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every predicate of a request is broken on a share of the rows, and on no other."""
    breaks = {
        "request_id": [F.lit("  ")],
        "provider": [F.lit("other")],
        "model": [F.lit("era6")],
        "h3_resolution": [F.lit(16)],
        "query_latitude": [F.lit(91.0)],
        "end_date": [F.date_sub("start_date", 1)],
        "timezone": [F.lit("")],
        "cell_selection": [F.lit("lake")],
        "hourly_variables": [F.array(F.lit("rain"), F.lit(" ")), F.array(F.lit("rain"), F.lit("rain"))],
    }
    asked = _manifest(spark, sf_dir).withColumns(_broken_at(F.col("weather_query_cell_id") + F.col("event_count"), breaks))
    return quality.split_valid(asked, manifest.manifest_checks())[1].select("weather_query_cell_id", F.year("start_date").alias("year"), "failed_checks")


# --- light

_KEYS = f"SELECT DISTINCT weather_query_cell_id, date_trunc('hour', ts) AS solar_timestamp_hour, query_latitude, query_longitude FROM ({_CELLS})"


@query(f"SELECT weather_query_cell_id, solar_timestamp_hour FROM ({_KEYS})")
def lighting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = lighting.lighting_keys(grid.with_cell(_located(spark, sf_dir)))
    return keys.select("weather_query_cell_id", ntz("solar_timestamp_hour").alias("solar_timestamp_hour"))


@query(f"SELECT weather_query_cell_id, solar_timestamp_hour FROM ({_KEYS}) WHERE hour(solar_timestamp_hour) >= 6")
def missing_lighting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = lighting.lighting_keys(grid.with_cell(_located(spark, sf_dir)))
    return lighting.missing_keys(keys, keys.filter(F.hour("solar_timestamp_hour") < 6)).select("weather_query_cell_id", ntz("solar_timestamp_hour").alias("solar_timestamp_hour"))


def _wrap(x: str, full: str) -> str:
    return f"(({x}) - {full} * floor(({x}) / {full}))"


_SOLAR = f"""
  WITH k AS ({_KEYS}),
  a AS (SELECT *, (epoch(solar_timestamp_hour) - {solar.J2000_SECONDS}) / 86400.0 AS d FROM k),
  b AS (SELECT *, {_wrap("280.460 + 0.9856474 * d", "360.0")} AS l, radians({_wrap("357.528 + 0.9856003 * d", "360.0")}) AS g, radians(23.439 - 0.0000004 * d) AS ob FROM a),
  e AS (SELECT *, radians({_wrap("l + 1.915 * sin(g) + 0.020 * sin(2 * g)", "360.0")}) AS ec FROM b),
  f AS (SELECT *, atan2(cos(ob) * sin(ec), cos(ec)) AS ra, asin(sin(ob) * sin(ec)) AS de,
        {_wrap("6.697375 + 0.0657098242 * d + " + _wrap("d + 0.5", "1.0") + " * 24.0", "24.0")} AS st, radians(query_latitude) AS la FROM e),
  h AS (SELECT *, radians(st * 15.0 + query_longitude) - ra AS ha FROM f),
  s AS (SELECT weather_query_cell_id, solar_timestamp_hour, degrees(asin(sin(de) * sin(la) + cos(de) * cos(la) * cos(ha))) AS el,
        {_wrap("degrees(atan2(-cos(de) * sin(ha), sin(de) * cos(la) - cos(de) * sin(la) * cos(ha)))", "360.0")} AS az FROM h)"""
_CLASS = "CASE WHEN el >= 0 THEN 'daylight' WHEN el >= -6 THEN 'civil_twilight' WHEN el >= -12 THEN 'nautical_twilight' WHEN el >= -18 THEN 'astronomical_twilight' ELSE 'night' END"


@query(_SOLAR + " SELECT weather_query_cell_id, solar_timestamp_hour, round(el, 5) AS elevation, round(az, 5) AS azimuth FROM s")
def solar_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    lit = lighting.lighting_conditions(lighting.lighting_keys(grid.with_cell(_located(spark, sf_dir))))
    return lit.select("weather_query_cell_id", ntz("solar_timestamp_hour").alias("solar_timestamp_hour"), F.round("solar_elevation_deg", 5).alias("elevation"), F.round("solar_azimuth_deg", 5).alias("azimuth"))


@query(_SOLAR + f" SELECT {_CLASS} AS lighting_condition, el >= 0 AS is_daylight, count(*) AS hours FROM s GROUP BY ALL")
def lighting_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    lit = lighting.lighting_conditions(lighting.lighting_keys(grid.with_cell(_located(spark, sf_dir))))
    return lit.groupBy("lighting_condition", "is_daylight").agg(F.count(F.lit(1)).alias("hours"))


# --- calendars, as-of joins, enrichment


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release per year of orders, forty days after the year's first order."""
    orders = table(spark, sf_dir, "orders")
    years = orders.groupBy(F.year("o_orderdate").alias("acs_vintage")).agg(F.date_add(F.min(F.to_date("o_orderdate")), 40).alias("acs_release_date"))
    return years.withColumns({"tiger_line_year": F.col("acs_vintage"), "tract_definition_vintage": F.col("acs_vintage").cast("string")})


_RANGES = """WITH y AS (SELECT year(o_orderdate)::INTEGER AS acs_vintage, (min(o_orderdate::DATE) + 40)::DATE AS acs_release_date FROM orders GROUP BY 1),
  r AS (SELECT *, (acs_release_date + 1)::DATE AS eligible_start_date, lead(acs_release_date) OVER (ORDER BY acs_release_date) AS eligible_end_date FROM y)"""


@query(_RANGES + " SELECT * FROM r")
def calendar_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.calendar_ranges(_calendar(spark, sf_dir)).drop("tiger_line_year", "tract_definition_vintage")


@query(_RANGES + " SELECT o_orderkey, acs_vintage AS selected_acs_vintage, acs_release_date AS selected_acs_release_date FROM orders LEFT JOIN r ON o_orderdate::DATE BETWEEN eligible_start_date AND coalesce(eligible_end_date, DATE '9999-01-01')")
def asof_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("occurred_date"))
    return asof.attach_vintage(orders, asof.calendar_ranges(_calendar(spark, sf_dir))).select("o_orderkey", "selected_acs_vintage", "selected_acs_release_date")


@query(
    """SELECT l_orderkey, l_linenumber, p_brand, p_size, part_found, s_name FROM lineitem
    LEFT JOIN (SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 3 <> 0) ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey CROSS JOIN LATERAL (SELECT p_partkey IS NOT NULL AS part_found)"""
)
def enrich_with_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0")
    out = enrich.enrich(lines, parts, {"l_partkey": "p_partkey"}, {"p_brand": "p_brand", "p_size": "p_size"}, flag="part_found", name="parts")
    out = enrich.enrich(out, table(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "s_name"}, flag=None, name="suppliers", hot=skew.hot_slots(lines, ["l_suppkey"]))
    return out.drop("l_partkey", "l_suppkey")


def _weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An observation per cell and hour in which a user of even number had an event."""
    seen = grid.with_cell(_located(spark, sf_dir)).filter("user_id % 2 = 0").groupBy("weather_query_cell_id", F.date_trunc("hour", F.col("occurred_at")).alias("weather_timestamp")).agg(F.count(F.lit(1)).cast("double").alias("temperature_2m_c"))
    fixed = {"provider": F.lit("open_meteo"), "model": F.lit("era5"), "h3_resolution": F.lit(6), "request_id": F.lit("r"), "source_row_hash": F.lit("h"), "grid_elevation": F.lit(10.0), "weather_date": F.to_date("weather_timestamp")}
    return seen.withColumns(fixed)


_WEATHER = f"SELECT weather_query_cell_id, date_trunc('hour', ts) AS h, count(*)::DOUBLE AS t FROM ({_CELLS}) WHERE user_id % 2 = 0 GROUP BY ALL"


@query(f"SELECT weather_query_cell_id, h AS weather_timestamp, t AS temperature_2m_c FROM ({_WEATHER}) WHERE h::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND weather_query_cell_id IN (SELECT weather_query_cell_id FROM ({_CELLS}) WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-12')")
def lookup_bounds_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = grid.with_cell(c.with_time_grains(_located(spark, sf_dir))).filter("occurred_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
    found = enrich.weather_lookup(events, _weather_table(spark, sf_dir), provider="open_meteo", model="era5", resolution=6)
    return found.select("weather_query_cell_id", ntz("weather_timestamp").alias("weather_timestamp"), "temperature_2m_c")


def _event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two releases: before all events, and in their middle."""
    days = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")).alias("first"))
    rows = days.select(F.explode(F.array(F.struct(F.lit(2021).alias("v"), F.date_sub("first", 300).alias("d")), F.struct(F.lit(2022).alias("v"), F.date_add("first", 14).alias("d")))).alias("r"))
    return rows.select(F.col("r.v").alias("acs_vintage"), F.col("r.d").alias("acs_release_date"), F.lit(2020).alias("tiger_line_year"), F.lit("2020").alias("tract_definition_vintage"))


def _census_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    years = nation.select(F.col("n_nationkey").cast("string").alias("geoid"), F.explode(F.array(F.lit(2021), F.lit(2022))).alias("acs_vintage"), F.col("n_name").alias("geography_name"), F.col("n_nationkey").cast("long").alias("population"), F.col("n_regionkey").cast("double").alias("median_household_income"))
    return years.filter("population % 4 <> 1").withColumns({a: F.lit(None).cast("double") for a in enrich.CENSUS_ATTRIBUTES if a not in years.columns})


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = grid.with_cell(_located(spark, sf_dir)).withColumn("incident_id", F.col("event_id").cast("string"))
    calendar = _event_calendar(spark, sf_dir)
    lit = lighting.lighting_conditions(lighting.lighting_keys(events).filter(F.hour("solar_timestamp_hour") % 3 != 0))
    mapped = spatial.map_locations(gold.located_events(events, calendar), _boundaries(spark, sf_dir))
    return gold.feature_rows(events, calendar=calendar, location_map=mapped, census=_census_table(spark, sf_dir), weather=_weather_table(spark, sf_dir), lighting_table=lit, provider="open_meteo", model="era5")


_FEATURES = f"""
  WITH m AS ({_MAPPED}), w AS ({_WEATHER}), s AS (SELECT weather_query_cell_id, solar_timestamp_hour, {_CLASS} AS lighting_condition FROM ({_SOLAR} SELECT * FROM s)),
  d AS (SELECT min(ts::DATE) AS first FROM events),
  v AS (SELECT c.*, CASE WHEN ts::DATE > first + 14 THEN 2022 ELSE 2021 END AS selected_acs_vintage FROM ({_CELLS}) c, d),
  n AS (SELECT n_nationkey::VARCHAR AS geoid, n_name, n_regionkey::DOUBLE AS income FROM nation WHERE n_nationkey % 4 <> 1),
  f AS (SELECT event_id::VARCHAR AS incident_id, selected_acs_vintage, tract_geoid, n_name AS geography_name, income AS median_household_income, n.geoid IS NOT NULL AS socioeconomic_match_found,
        t AS temperature_2m_c, w.h IS NOT NULL AS weather_match_found, lighting_condition, lighting_condition IS NOT NULL AS lighting_match_found
        FROM v LEFT JOIN m ON v.latitude = m.latitude AND v.longitude = m.longitude LEFT JOIN n ON n.geoid = tract_geoid
        LEFT JOIN w ON w.weather_query_cell_id = v.weather_query_cell_id AND w.h = date_trunc('hour', ts)
        LEFT JOIN s ON s.weather_query_cell_id = v.weather_query_cell_id AND s.solar_timestamp_hour = date_trunc('hour', ts) AND hour(ts) % 3 <> 0)"""


@query(_FEATURES + " SELECT * FROM f")
def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select("incident_id", "selected_acs_vintage", "tract_geoid", "geography_name", "median_household_income", "socioeconomic_match_found", "temperature_2m_c", "weather_match_found", "lighting_condition", "lighting_match_found")


@query(
    _FEATURES
    + """ SELECT count(*) AS row_count, count(selected_acs_vintage) AS selected_vintage_count, count(tract_geoid) AS tract_count, count(*) FILTER (WHERE socioeconomic_match_found) AS socioeconomic_count,
    count(median_household_income) AS median_household_income_count, count(*) FILTER (WHERE weather_match_found) AS weather_count, count(temperature_2m_c) AS temperature_count, count(*) FILTER (WHERE lighting_match_found) AS lighting_count,
    round(count(tract_geoid) / count(*), 8) AS tract_rate, round(count(*) FILTER (WHERE socioeconomic_match_found) / count(*), 8) AS socioeconomic_rate,
    round(count(*) FILTER (WHERE weather_match_found) / count(*), 8) AS weather_rate, round(count(*) FILTER (WHERE lighting_match_found) / count(*), 8) AS lighting_rate FROM f"""
)
def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.coverage(_features(spark, sf_dir))


# --- quality


def _failures(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """check_name, failed, checked: the one-pass aggregation as rows."""
    counted = quality.count_failures(df, checks)
    pairs = F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failed")) for n in checks))
    return counted.select(F.explode(pairs).alias("x"), "checked").select("x.check_name", "x.failed", "checked")


def _failures_sql(source: str, checks: dict[str, str]) -> str:
    pairs = ", ".join(f"['{n}', (count(*) FILTER (WHERE NOT coalesce({p}, false)))::VARCHAR]" for n, p in checks.items())
    return f"SELECT x[1] AS check_name, x[2]::BIGINT AS failed, checked FROM (SELECT unnest([{pairs}]) AS x, count(*) AS checked FROM ({source}))"


@query(
    _failures_sql(
        f"SELECT * FROM ({_LOCATED}) JOIN (SELECT event_id AS e, ['dallas', 'fort_worth', 'houston', 'austin'][(event_id % 4 + 1)::INTEGER] AS city, CASE WHEN event_id % 3 <> 0 THEN 'h' END AS h FROM events) ON e = event_id",
        {"id_not_null": "event_id % 5 <> 0", "known_source": "city <> 'austin' AND city <> 'fort_worth'", "row_hash_not_empty": "h IS NOT NULL", "coordinates_valid": "latitude < 32.5"},
    )
)
def quality_report_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _incident_keys(spark, sf_dir)
    placed = _located(spark, sf_dir).select("event_id", F.when(F.col("latitude") < 32.5, F.col("latitude")).alias("latitude"), "longitude")
    rows = keys.join(placed, "event_id").withColumn("incident_id", F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("string")))
    return _failures(rows, quality.incident_checks())


@query(
    _failures_sql(
        f"SELECT * FROM ({_WEATHER})",
        {n: f"hour(h) % 6 <> {i}" for i, n in enumerate(("keys_not_null", "on_the_hour", "provider_allowed", "model_allowed", "resolution_allowed"))} | {"temperature_plausible": "t * 40 <= 70"},
    )
)
def quality_report_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _weather_table(spark, sf_dir).withColumns({"temperature_2m_c": F.col("temperature_2m_c") * 40, "__hour": F.hour("weather_timestamp")})
    breaks = {"weather_query_cell_id": [F.lit(None)], "weather_timestamp": [F.col("weather_timestamp") + F.expr("interval 1 second")], "provider": [F.lit("x")], "model": [F.lit(None)], "h3_resolution": [F.lit(5)]}
    rows = rows.withColumns(_broken_at(F.col("__hour"), breaks))
    return _failures(rows, quality.weather_checks(providers=["open_meteo"], models=["era5"], resolutions=[6]))


def _estimate(name: str) -> str:
    if name == "housing_units":
        return "CASE WHEN c_custkey % 6 = 0 THEN 0 WHEN c_custkey % 6 > 1 THEN 800 END"
    return _raw_value(next(code for code, n in census.RENAMES.items() if n == name))


@query(
    _failures_sql(
        "SELECT * FROM customer WHERE c_custkey % 50 <> 0",
        {"keys_not_null": "c_custkey % 4 <> 0", "geoid_format": "c_custkey % 4 > 1", "vintage_plausible": "c_custkey % 4 <> 2"}
        | {f"{rate}_valid": f"coalesce(({_estimate(b)}) <= 0 OR ({_estimate(a)}) <= ({_estimate(b)}), true)" for rate, (a, b) in census.RATES.items()},
    )
)
def quality_report_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracts = census.census_tracts(_census_raw(spark, sf_dir)).withColumn("__key", F.col("geoid").cast("long"))
    breaks = {"geoid": [F.lit(None), F.concat(F.lit("0"), F.col("geoid"))], "acs_vintage": [F.lit(1990)]}
    return _failures(tracts.withColumns(_broken_at(F.col("__key"), breaks)), quality.census_checks())


_LIGHTING_BREAKS = ("keys_not_null", "active_version", "on_the_hour", "elevation_range", "apparent_elevation_range", "zenith_range", "azimuth_range", "class_consistent", "daylight_consistent", "model_version_not_empty")


@query(_failures_sql(f"{_SOLAR} SELECT * FROM s", {n: f"weather_query_cell_id % 11 <> {i}" + (" AND NOT (weather_query_cell_id % 11 = 3 AND el < 0)" if n in ("class_consistent", "daylight_consistent") else "") for i, n in enumerate(_LIGHTING_BREAKS)}))
def quality_report_lighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every predicate is broken on a share of the rows. An elevation of 95 is daylight, so at night
    its class and flag are wrong as well."""
    lit = lighting.lighting_conditions(lighting.lighting_keys(grid.with_cell(_located(spark, sf_dir)))).withColumn("__cell", F.col("weather_query_cell_id"))
    breaks = {
        "weather_query_cell_id": [F.lit(None)],
        "lighting_definition_version": [F.lit("v0")],
        "solar_timestamp_hour": [F.col("solar_timestamp_hour") + F.expr("interval 1 minute")],
        "solar_elevation_deg": [F.lit(95.0)],
        "apparent_solar_elevation_deg": [F.lit(92.0)],
        "solar_zenith_deg": [F.lit(float("nan"))],
        "solar_azimuth_deg": [F.lit(None)],
        "lighting_condition": [F.lit("dim")],
        "is_daylight": [~F.col("is_daylight")],
        "solar_model_version": [F.lit(" ")],
    }
    return _failures(lit.withColumns(_broken_at(F.col("__cell"), breaks)), quality.lighting_checks(version=lighting.DEFINITION_VERSION))


@query(
    _failures_sql(
        f"{_FEATURES} SELECT *, incident_id::BIGINT AS n FROM f",
        {"id_not_null": "n % 6 <> 0", "flags_not_null": "n % 6 <> 1", "no_leakage": "n % 6 <> 2", "weather_lineage": "NOT weather_match_found OR n % 6 <> 3", "lighting_lineage": "NOT lighting_match_found OR n % 6 <> 4", "tract_coverage": "tract_geoid IS NOT NULL", "socioeconomic_coverage": "socioeconomic_match_found AND n % 6 <> 1", "weather_coverage": "weather_match_found", "lighting_coverage": "lighting_match_found"},
    )
)
def quality_report_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every predicate is broken on a share of the rows; a row without a flag is not covered either."""
    coverages = {n: p for n, (p, _) in quality.feature_coverages({}).items()}
    rows = _features(spark, sf_dir).withColumn("__id", F.col("event_id"))
    breaks = {
        "incident_id": [F.lit(None)],
        "socioeconomic_match_found": [F.lit(None)],
        "selected_acs_release_date": [F.col("occurred_date")],
        "weather_source_row_hash": [F.lit(None)],
        "lighting_solar_model_version": [F.lit(None)],
    }
    return _failures(rows.withColumns(_broken_at(F.col("__id"), breaks)), {**quality.feature_checks(), **coverages})


@query(
    """SELECT o_orderkey, list_filter([CASE WHEN NOT o_totalprice > 100000 THEN 'price_high' END, CASE WHEN o_orderstatus <> 'F' THEN 'finished' END, CASE WHEN o_orderkey % 10 = 0 THEN 'key' END], lambda x: x IS NOT NULL) AS failed_checks
    FROM orders WHERE NOT o_totalprice > 100000 OR o_orderstatus <> 'F' OR o_orderkey % 10 = 0"""
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"price_high": F.col("o_totalprice") > 100000, "finished": F.col("o_orderstatus") == "F", "key": F.when(F.col("o_orderkey") % 10 != 0, F.lit(True))}
    return quality.split_valid(table(spark, sf_dir, "orders"), checks)[1].select("o_orderkey", "failed_checks")


# --- panels and windows


@query(
    f"""WITH x AS (SELECT weather_query_cell_id, time_bucket(INTERVAL 1 DAY, ts) AS w, count(*) AS n FROM ({_CELLS}) GROUP BY ALL),
    g AS (SELECT * FROM (SELECT DISTINCT weather_query_cell_id FROM x), (SELECT unnest(generate_series(min(w), max(w), INTERVAL 1 DAY)) AS w FROM x))
    SELECT weather_query_cell_id, w::TIMESTAMP AS window_start, coalesce(n, 0) AS event_count, CASE WHEN w < DATE '2024-01-20' THEN 'train' WHEN w < DATE '2024-01-25' THEN 'validation' ELSE 'test' END AS split
    FROM g LEFT JOIN x USING (weather_query_cell_id, w)"""
)
def count_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = gold.count_panel(grid.with_cell(_located(spark, sf_dir)), size="1 day", validate_from="2024-01-20", test_from="2024-01-25")
    return panel.withColumn("window_start", ntz("window_start"))


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type, count(*) AS count FROM events GROUP BY ALL")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ingest.windowed_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), at="ts", size="6 hours", late="1 hour", keys=("event_type",))
    return counts.withColumn("window_start", ntz("window_start"))


from . import catalog_files, catalog_tables, catalog_time  # noqa: E402, F401  register their queries, which build on those above
