"""Registered queries over raw sources, files that are written and read back, streams and jobs.

Raw rows are derived from the given tables in the form in which sources deliver them, written to the
shared folder where an operator reads files, and taken through the same jobs as real ones.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import grid, names
from ..operators import asof, dedup, incidents, lighting, quality, spatial
from ..sources import boundaries, readers, sinks
from ..sources.published import read_published
from ..sources.scratch import discard, fresh_path, written
from ..streaming import ingest
from . import catalog as base
from . import gold, jobs
from .registry import ntz, query, table

# --- the three sources


def _text(at: Column, pattern: str) -> Column:
    return F.date_format(at, pattern)


def _raw_dallas(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, kind, ts = F.col("event_id"), F.col("event_type"), F.col("ts")
    place = F.concat(F.lit("BLOCK 5\n("), F.col("latitude").cast("string"), F.lit(", "), F.col("longitude").cast("string"), F.lit(")"))
    made = {
        "service_number_id": n.cast("string"),
        "incident_number_w_year": F.concat(F.lit("I"), n),
        "nibrs_code": F.when(n % 9 != 0, kind),
        "nibrs_crime": F.when(n % 3 == 0, kind),
        "ucr_offense_name": F.when(n % 3 == 1, F.concat(F.lit("u "), kind)),
        "type_of_incident": F.concat(F.lit("t "), kind),
        "ucr_offense_description": F.when(n % 2 == 0, "d"),
        "date1_of_occurrence": _text(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "time1_of_occurrence": F.when(n % 8 == 0, "noon").otherwise(_text(ts, "HH:mm")),
        "date_of_report": F.concat(_text(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000")),
        "update_date": F.when(n % 5 != 0, _text(ts + F.expr("interval 1 day"), "yyyy-MM-dd HH:mm:ss")).otherwise("x"),
        "location1": F.when(n % 7 != 0, place).otherwise("nowhere"),
        "incident_address": F.concat(F.lit("a"), F.col("user_id")),
        "x_coordinate": F.col("value").cast("string"),
        "source_row_hash": F.sha2(n.cast("string"), 256),
        **{name: F.lit(name) for name in ("city", "state", "zip_code", "beat", "type_location", "source_file")},
        "y_cordinate": F.lit("?"),
    }
    return base._located(spark, sf_dir).select(*(v.alias(k) for k, v in made.items()))


def _raw_fort_worth(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    made = {
        "case_no_offense": F.when(n % 4 != 0, F.concat(F.lit("C"), n)),
        "objectid": n,
        "case_no": F.concat(F.lit("N"), F.col("user_id")),
        "offense": F.col("event_type"),
        "nature_of_call": F.concat(F.lit("call "), F.col("event_type")),
        "offense_desc": F.lit(None).cast("string"),
        "from_date": F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        "reported_date": F.when(n % 6 == 0, -5).otherwise(F.unix_millis(F.col("ts").cast("timestamp")) + 1000),
        "lastupdated": F.when(n % 5 == 0, "soon").otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string")),
        "address": F.when(n % 2 == 0, F.concat(F.lit("a"), F.col("user_id"))),
        "block_address": F.concat(F.lit("b"), F.col("user_id")),
        "latitude": F.col("latitude").cast("string"),
        "longitude": F.col("longitude"),
        "alternate_latitude": F.lit("1.5"),
        "alternate_longitude": F.lit("west"),
        "x_coordinate": F.col("value"),
        "y_coordinate": F.lit(None).cast("double"),
        "source_row_hash": F.sha2(n.cast("string"), 256),
        **{name: F.lit(name) for name in ("city", "state", "beat", "locationtypedescription", "source_file")},
    }
    return base._located(spark, sf_dir).select(*(v.alias(k) for k, v in made.items()))


def _raw_houston(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    made = {
        "incident": n.cast("string"),
        "rmsoccurrencedate": _text(F.col("ts"), "M/d/yyyy"),
        "rmsoccurrencehour": (n % 25).cast("string"),
        "nibrsclass": F.col("event_type"),
        "nibrsdescription": F.concat(F.lit("n "), F.col("event_type")),
        "offensecount": F.when(n % 10 == 0, "many").otherwise((n % 10).cast("string")),
        "streetno": F.when(n % 2 == 0, F.col("user_id").cast("string")),
        "streetname": F.lit(" MAIN  EAST"),
        "streettype": F.lit("ST"),
        "suffix": F.when(n % 3 == 0, ""),
        "maplatitude": F.col("latitude").cast("string"),
        "maplongitude": F.when(n % 4 != 0, F.col("longitude").cast("string")),
        "source_row_hash": F.sha2(n.cast("string"), 256),
        **{name: F.lit(name) for name in ("city", "zipcode", "beat", "premise", "source_file")},
    }
    return base._located(spark, sf_dir).select(*(v.alias(k) for k, v in made.items()))


_SHOWN = ("source_city", "source_record_id", "source_incident_id", "offense_code", "offense_name", "offense_description", "offense_count", "address", "state", "premise_type", "latitude", "longitude", "alternate_latitude", "alternate_longitude", "source_x_coordinate", "source_y_coordinate", "source_row_hash")


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*_SHOWN, *(ntz(t).alias(t) for t in ("occurred_at", "reported_at", "updated_at")))


_DALLAS = f"""SELECT 'dallas' AS source_city, event_id::VARCHAR AS source_record_id, 'I' || event_id AS source_incident_id, CASE WHEN event_id % 9 <> 0 THEN event_type END AS offense_code,
  CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'u ' || event_type ELSE 't ' || event_type END AS offense_name, CASE WHEN event_id % 2 = 0 THEN 'd' ELSE 't ' || event_type END AS offense_description,
  1::BIGINT AS offense_count, 'a' || user_id AS address, 'state' AS state, 'type_location' AS premise_type, CASE WHEN event_id % 7 <> 0 THEN latitude END AS latitude, CASE WHEN event_id % 7 <> 0 THEN longitude END AS longitude,
  NULL::DOUBLE AS alternate_latitude, NULL::DOUBLE AS alternate_longitude, value AS source_x_coordinate, NULL::DOUBLE AS source_y_coordinate, sha256(event_id::VARCHAR) AS source_row_hash,
  CASE WHEN event_id % 8 <> 0 THEN date_trunc('minute', ts) END AS occurred_at, date_trunc('second', ts) AS reported_at, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) + INTERVAL 1 DAY END AS updated_at FROM ({base._LOCATED})"""
_FORT_WORTH = f"""SELECT 'fort_worth' AS source_city, CASE WHEN event_id % 4 <> 0 THEN 'C' || event_id ELSE event_id::VARCHAR END AS source_record_id, 'N' || user_id AS source_incident_id, event_type AS offense_code,
  'call ' || event_type AS offense_name, NULL::VARCHAR AS offense_description, 1::BIGINT AS offense_count, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END || user_id AS address, 'state' AS state, 'locationtypedescription' AS premise_type,
  latitude, longitude, 1.5::DOUBLE AS alternate_latitude, NULL::DOUBLE AS alternate_longitude, value AS source_x_coordinate, NULL::DOUBLE AS source_y_coordinate, sha256(event_id::VARCHAR) AS source_row_hash,
  date_trunc('millisecond', ts) AS occurred_at, CASE WHEN event_id % 6 <> 0 THEN date_trunc('millisecond', ts) + INTERVAL 1 SECOND END AS reported_at, CASE WHEN event_id % 5 <> 0 THEN date_trunc('millisecond', ts) END AS updated_at FROM ({base._LOCATED})"""
_HOUSTON = f"""SELECT 'houston' AS source_city, sha256(event_id::VARCHAR) AS source_record_id, event_id::VARCHAR AS source_incident_id, event_type AS offense_code, 'n ' || event_type AS offense_name, 'n ' || event_type AS offense_description,
  CASE WHEN event_id % 10 <> 0 THEN event_id % 10 END AS offense_count, CASE WHEN event_id % 2 = 0 THEN user_id || ' ' ELSE '' END || 'MAIN EAST ST' AS address, 'TX' AS state, 'premise' AS premise_type, latitude,
  CASE WHEN event_id % 4 <> 0 THEN longitude END AS longitude, NULL::DOUBLE AS alternate_latitude, NULL::DOUBLE AS alternate_longitude, NULL::DOUBLE AS source_x_coordinate, NULL::DOUBLE AS source_y_coordinate, sha256(event_id::VARCHAR) AS source_row_hash,
  CASE WHEN event_id % 25 < 24 THEN date_trunc('day', ts) + to_hours(event_id % 25) END AS occurred_at, NULL::TIMESTAMP AS reported_at, NULL::TIMESTAMP AS updated_at FROM ({base._LOCATED})"""


@query(_DALLAS)
def map_dallas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(incidents.dallas(_raw_dallas(spark, sf_dir)))


@query(_FORT_WORTH)
def map_fort_worth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(incidents.fort_worth(_raw_fort_worth(spark, sf_dir)))


@query(_HOUSTON)
def map_houston(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(incidents.houston(_raw_houston(spark, sf_dir)))


_IDENTIFIED = f"""SELECT *, sha256(source_city || '||' || CASE WHEN source_city = 'dallas' AND offense_code IS NOT NULL THEN concat_ws('||', source_incident_id, source_record_id, offense_code)
  WHEN source_city = 'fort_worth' THEN source_record_id ELSE source_row_hash END) AS incident_id FROM ({_DALLAS} UNION ALL {_FORT_WORTH} UNION ALL {_HOUSTON})"""


@query(f"SELECT incident_id, source_city, source_record_id, CASE WHEN source_city = 'dallas' THEN TIMESTAMP '2031-01-01' ELSE updated_at END AS updated_at, latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 IS TRUE AS placed FROM ({_IDENTIFIED})")
def incidents_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the three sources, ids, the newest of two deliveries, and cells."""
    dallas = _raw_dallas(spark, sf_dir)
    later = dallas.withColumn("update_date", F.lit("2031-01-01 00:00:00"))
    raw = {"dallas": later.unionByName(dallas), "fort_worth": _raw_fort_worth(spark, sf_dir), "houston": _raw_houston(spark, sf_dir)}
    clean = jobs.clean_incidents(raw)
    return clean.select("incident_id", "source_city", "source_record_id", ntz("updated_at").alias("updated_at"), F.col("weather_query_cell_id").isNotNull().alias("placed"))


# --- names, predicates, ties


@query("SELECT c_custkey AS a_b, c_nationkey AS a_b_2, c_name AS a_b_3, c_acctbal AS latitude, c_acctbal + 1 AS alternate_latitude, c_mktsegment AS column_1st FROM customer")
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that collide, a pair that must be kept apart, and a name that begins with a digit."""
    raw = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_acctbal", F.col("c_acctbal") + 1, "c_mktsegment")
    return names.with_snake_names(raw.toDF("A b", "a-B", "a_b", "latitude", "_latitude", "1st"), names.PAIRED_COORDINATES)


@query(
    """WITH r AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'nan'::DOUBLE ELSE (user_id % 250 - 125)::DOUBLE END AS lat, CASE WHEN event_id % 10 = 0 THEN NULL ELSE (user_id % 500 - 250)::DOUBLE END AS lon,
    CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) WHEN event_id % 3 = 1 THEN ts END AS seen FROM events)
    SELECT event_id, lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND abs(lat) <= 90 AND abs(lon) <= 180 AS valid, (lat IS NULL AND lon IS NULL) OR (lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND abs(lat) <= 90 AND abs(lon) <= 180) AS null_or_valid,
    seen = date_trunc('hour', seen) AS whole_hour, seen IS NOT NULL AS timed, event_id % 5 <> 0 AND event_id % 3 <> 2 AS identified, seen::DATE AS occurred_date, date_trunc('hour', seen) AS occurred_at_hour FROM r"""
)
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location, hour, identity and time predicates on rows that break each of them."""
    n, user = F.col("event_id"), F.col("user_id")
    at = F.when(n % 3 == 0, F.date_trunc("hour", "ts")).when(n % 3 == 1, F.col("ts")).cast("timestamp")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(n % 5 == 0, None).when(n % 5 == 1, float("nan")).otherwise((user % 250 - 125).cast("double")).alias("latitude"),
        F.when(n % 10 != 0, (user % 500 - 250).cast("double")).alias("longitude"),
        at.alias("occurred_at"),
        F.when(n % 5 != 0, "x").alias("source_city"),
        F.when(n % 3 != 2, "h").alias("source_row_hash"),
    )
    checks = {"valid": c.valid_location(), "null_or_valid": c.null_or_valid_location(), "whole_hour": c.on_the_hour("occurred_at"), "timed": c.has_time(), "identified": c.has_source_identity()}
    return c.with_time_grains(rows).select("event_id", *(p.alias(k) for k, p in checks.items()), "occurred_date", ntz("occurred_at_hour").alias("occurred_at_hour"))


@query(
    """SELECT user_id, event_type, month, note FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY month DESC, sha256(to_json(struct_pack(event_type := event_type, month := month, note := note, user_id := user_id))::VARCHAR) DESC) AS r
    FROM (SELECT user_id, event_type, strftime(ts, '%Y-%m') AS month, event_id::VARCHAR AS note FROM events)) WHERE r = 1"""
)
def fingerprint_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows of a user tie on the month, so the fingerprint decides."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM").alias("month"), F.col("event_id").cast("string").alias("note"))
    return dedup.one_per_key(rows, ["user_id"], ["month", "fingerprint"])


@query(
    """SELECT 'weather' AS kind, user_id AS key, date_trunc('day', ts)::DATE::VARCHAR AS part, max(event_id) AS event_id FROM events GROUP BY ALL
    UNION ALL SELECT 'census', user_id, (event_id % 3)::VARCHAR, max(event_id) FROM events GROUP BY ALL"""
)
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest weather row per cell and time, and the newest census row per tract and vintage."""
    events = table(spark, sf_dir, "events").withColumns({"bronze_ingested_at": F.timestamp_seconds("event_id"), "silver_processed_at": F.current_timestamp(), "source_row_hash": F.lit("h"), "source_file": F.lit("f")})
    hours = events.withColumns({"provider": F.lit("p"), "model": F.lit("m"), "weather_query_cell_id": F.col("user_id"), "weather_timestamp": F.date_trunc("day", "ts")})
    tracts = events.withColumns({"geoid": F.col("user_id").cast("string"), "acs_vintage": (F.col("event_id") % 3).cast("int")})
    weather = dedup.latest_weather(hours).select(F.lit("weather").alias("kind"), F.col("user_id").alias("key"), F.to_date("weather_timestamp").cast("string").alias("part"), "event_id")
    return weather.unionByName(dedup.latest_census(tracts).select(F.lit("census").alias("kind"), F.col("user_id").alias("key"), F.col("acs_vintage").cast("string").alias("part"), "event_id"))


# --- files read back


@query(
    "SELECT source, event_id::VARCHAR AS event_id, CASE WHEN source = 'dallas' THEN 'say \"' || event_type || '\",' || chr(10) || 'user ' || user_id ELSE 'say \"' || event_type || '\", user ' || user_id END AS note, true AS named FROM events, (VALUES ('dallas'), ('houston'), ('fort_worth'), ('weather'), ('acs')) s(source)"
)
def sources_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted CSV with line breaks, plain CSV and JSON lines, written and read by source name."""
    events = table(spark, sf_dir, "events")
    note = lambda gap: F.concat(F.lit('say "'), "event_type", F.lit(f'",{gap}user '), "user_id")
    rows = events.select(F.col("event_id").cast("string").alias("event_id"), note(" ").alias("note"))
    lines, plain, quoted = (fresh_path(spark, n) for n in ("raw-json", "raw-csv", "raw-quoted"))
    rows.write.json(lines)
    rows.write.options(header=True).csv(plain)
    events.select(F.col("event_id").cast("string").alias("event_id"), note("\n").alias("note")).write.options(header=True, quoteAll=True, escape='"').csv(quoted)
    out = None
    for source, path in (("dallas", quoted), ("houston", plain), ("fort_worth", lines), ("weather", lines), ("acs", lines)):
        one = readers.read_source(spark, source, path).select(F.lit(source).alias("source"), "event_id", "note", F.contains(F.col("source_file"), F.lit(path.rsplit("/", 1)[1])).alias("named"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id END AS k, CASE WHEN event_id % 2 = 0 THEN NULL WHEN event_id % 3 = 0 THEN '{"k":"bad","extra":"' || user_id || '"}' ELSE '{"extra":"' || user_id || '"}' END AS _rescued_data FROM events"""
)
def stream_with_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files drained in two portions and once more without new ones; the schema is that of the first."""
    events = table(spark, sf_dir, "events")
    landing, target, checkpoint, schema = (fresh_path(spark, n) for n in ("landing", "drained", "checkpoint", "schema"))

    def drain() -> None:
        ingest.drain_to(readers.read_source(spark, "weather", landing, streaming=True, schema_path=schema), target, checkpoint)

    events.filter("event_id % 2 = 0").select("event_id", F.col("user_id").alias("k")).write.json(landing)
    drain()
    events.filter("event_id % 2 = 1").select("event_id", F.when(F.col("event_id") % 3 == 0, "bad").alias("k"), F.col("user_id").alias("extra")).write.mode("append").json(landing)
    drain()
    drain()
    return spark.read.parquet(target).select("event_id", "k", readers.RESCUED)


@query("SELECT user_id AS weather_query_cell_id, seen AS weather_timestamp, CASE WHEN n % 11 <> 0 THEN n::DOUBLE + CASE WHEN user_id % 2 = 0 THEN 1100000 ELSE 0 END END AS temperature_2m_c FROM (SELECT user_id, date_trunc('hour', ts) AS seen, min(event_id) AS n FROM events GROUP BY ALL) WHERE user_id % 13 <> 0 AND user_id % 17 <> 0")
def weather_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses as a stream of table files, upserted; a second delivery replaces half of the users."""
    hours = table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("hour", F.col("ts")).alias("ts")).agg(F.min("event_id").alias("event_id"))
    bronze, log, checkpoint = (fresh_path(spark, n) for n in ("bronze", "change-log", "checkpoint"))
    base._responses(hours).write.parquet(bronze)
    schema = spark.read.parquet(bronze).schema
    jobs.upsert_weather(spark, bronze, schema, log=log, checkpoint=checkpoint)
    warmer = hours.filter("user_id % 2 = 0").withColumn("event_id", F.col("event_id") + 1_100_000)
    base._responses(warmer).write.mode("append").parquet(bronze)
    state = jobs.upsert_weather(spark, bronze, schema, log=log, checkpoint=checkpoint)
    return state.select("weather_query_cell_id", ntz("weather_timestamp").alias("weather_timestamp"), "temperature_2m_c")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'first' WHEN o_orderkey % 3 = 0 THEN 'second' ELSE 'third' END AS came, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS first_count, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0) AS second_count FROM orders")
def sinks_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made if it is missing, overwritten, added to by new keys alone, and completed."""
    path = fresh_path(spark, "sink")
    orders = lambda rows, came: table(spark, sf_dir, "orders").filter(rows).select("o_orderkey", F.lit(came).alias("came"))
    sinks.ensure_table(spark, path, "o_orderkey long, came string")
    first = sinks.write_batch(orders("o_orderkey % 2 = 0", "first"), path)
    sinks.ensure_table(spark, path, "o_orderkey long, came string")
    second = sinks.insert_only(orders("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0", "second"), path, ["o_orderkey"])
    done = sinks.rebuild_or_add(spark, path, lambda _: orders("true", "third"), keys=["o_orderkey"])
    if done != "added" or sinks.insert_only(orders("true", "fourth"), path, ["o_orderkey"]):
        raise ValueError("a table that is there was not added to by new keys alone")
    return spark.read.parquet(path).withColumns({"first_count": F.lit(first).cast("long"), "second_count": F.lit(second).cast("long")})


# --- boundaries and maps


def _wkt(spark: SparkSession, sf_dir: str, shift: float) -> DataFrame:
    key = F.col("n_nationkey")
    x, y = -98 + (key % 5) * F.lit(0.8) + F.lit(shift), 29 + F.floor(key / 5) * F.lit(1.0)
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("string"), (y + dy).cast("string"))
    hole = F.concat(F.lit(", ("), F.concat_ws(", ", corner(0.3, 0.3), corner(0.5, 0.3), corner(0.5, 0.6), corner(0.3, 0.6), corner(0.3, 0.3)), F.lit(")"))
    ring = F.concat_ws(", ", corner(0, 0), corner(0.8, 0), corner(0.8, 1), corner(0.4, 0.7), corner(0, 1), corner(0, 0))
    wkt = F.concat(F.lit("POLYGON (("), ring, F.lit(")"), F.when(key % 2 == 0, hole).otherwise(""), F.lit(")"))
    return table(spark, sf_dir, "nation").select(key.cast("string").alias("geoid"), wkt.alias("wkt"), F.lit(4326).alias("srid"))


_SHAPES = """SELECT v AS boundary_vintage, n_nationkey::VARCHAR AS geoid, -98 + (n_nationkey % 5) * 0.8::DOUBLE + s::DOUBLE AS x, (29 + n_nationkey // 5)::DOUBLE AS y, n_nationkey % 2 = 0 AS holed FROM nation, (VALUES (2019, 0.4), (2020, 0.0)) t(v, s)"""


@query(f"SELECT boundary_vintage, geoid, round(x, 6) AS min_x, round(x + 0.8, 6) AS max_x, y AS min_y, y + 1 AS max_y, CASE WHEN holed THEN 2 ELSE 1 END AS n_rings FROM ({_SHAPES})")
def boundaries_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "boundaries")
    boundaries.write_boundaries(boundaries.boundary_table({2019: _wkt(spark, sf_dir, 0.4), 2020: _wkt(spark, sf_dir, 0.0)}), path)
    back = spark.read.parquet(path)
    return back.select("boundary_vintage", "geoid", F.round("min_x", 6).alias("min_x"), F.round("max_x", 6).alias("max_x"), "min_y", "max_y", F.size("rings").alias("n_rings"))


_INSIDE = "longitude > x AND longitude < x + 0.8 AND latitude > y AND latitude < y + 1 - 0.75 * (0.4 - abs(longitude - x - 0.4)) AND NOT (holed AND longitude >= x + 0.3 AND longitude <= x + 0.5 AND latitude >= y + 0.3 AND latitude <= y + 0.6)"


@query(
    f"""WITH p AS (SELECT DISTINCT latitude + 0.0011 AS latitude, longitude + 0.0013 AS longitude, CASE WHEN user_id % 3 = 0 THEN 2019 ELSE 2020 END AS tiger_line_year FROM ({base._LOCATED}))
    SELECT tiger_line_year, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, (SELECT min(geoid) FROM ({_SHAPES}) WHERE boundary_vintage = tiger_line_year AND {_INSIDE}) AS tract_geoid FROM p"""
)
def location_map_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concave shapes with holes in two vintages; half of the points are mapped first, the rest added."""
    year = F.when(F.col("user_id") % 3 == 0, 2019).otherwise(2020)
    events = base._located(spark, sf_dir).withColumns({"tiger_line_year": year, "latitude": F.col("latitude") + 0.0011, "longitude": F.col("longitude") + 0.0013})
    shapes = boundaries.boundary_table({2019: _wkt(spark, sf_dir, 0.4), 2020: _wkt(spark, sf_dir, 0.0)})
    path = fresh_path(spark, "location-map")
    spatial.materialize_location_map(spark, spatial.unique_locations(events.filter("user_id % 2 = 0")), shapes, path)
    mapped = spatial.materialize_location_map(spark, spatial.unique_locations(events), shapes, path)
    return mapped.select("tiger_line_year", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "tract_geoid")


@query(
    f"""WITH p AS (SELECT DISTINCT latitude, longitude FROM ({base._LOCATED})), b AS (SELECT n_nationkey::VARCHAR AS geoid, -98 + (n_nationkey % 5) * 0.4::DOUBLE AS x, 29 + n_nationkey // 5 AS y FROM nation)
    SELECT latitude, longitude, geoid, longitude > x AND longitude < x + 0.75::DOUBLE AND latitude > y AND latitude < y + 1 AS interior FROM p JOIN b ON longitude BETWEEN x AND x + 0.75::DOUBLE AND latitude BETWEEN y AND y + 1"""
)
def overlapping_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All polygons around each point where polygons overlap: what an ambiguous match rests on."""
    key = F.col("n_nationkey")
    x, y = -98 + (key % 5) * F.lit(0.4), 29 + F.floor(key / 5) * F.lit(1.0)
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("string"), (y + dy).cast("string"))
    ring = F.concat_ws(", ", corner(0, 0), corner(0.75, 0), corner(0.75, 1), corner(0, 1), corner(0, 0))
    shapes = boundaries.boundary_table({2020: table(spark, sf_dir, "nation").select(key.cast("string").alias("geoid"), F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("wkt"), F.lit(4326).alias("srid"))})
    points = spatial.unique_locations(base._located(spark, sf_dir).withColumn("tiger_line_year", F.lit(2020)))
    return spatial.candidates(points, shapes).select("latitude", "longitude", "geoid", "interior")


@query(f"{base._SOLAR} SELECT weather_query_cell_id, solar_timestamp_hour, {base._CLASS} AS lighting_condition FROM s")
def lighting_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light of the hours before noon first, then what the table lacks."""
    events, path = grid.with_cell(base._located(spark, sf_dir)), fresh_path(spark, "lighting")
    lighting.materialize_lighting(spark, events.filter("hour(occurred_at) < 12"), path)
    lighting.materialize_lighting(spark, events, path).or_raise()
    return spark.read.parquet(path).select("weather_query_cell_id", ntz("solar_timestamp_hour").alias("solar_timestamp_hour"), "lighting_condition")


# --- reports of jobs


def _report_rows(spark: SparkSession, part: str, report: quality.Report) -> DataFrame:
    rows = [(part, x.name, x.blocking, x.passed, x.failed, x.checked, x.metric, len(x.examples)) for x in report.checks]
    return spark.createDataFrame(rows, "part string, check_name string, blocking boolean, passed boolean, failed long, checked long, metric double, examples int")


_REPORTED = f"""SELECT CASE WHEN k % 50 <> 0 THEN source_record_id END AS id, source_city, latitude AS lat, CASE WHEN k % 3 = 0 THEN latitude ELSE longitude END AS lon, source_row_hash AS h FROM (SELECT *, source_record_id::BIGINT AS k FROM ({base._CANONICAL_SQL}))"""


def _report_sql(part: str, checks: dict[str, str]) -> str:
    rows = [f"SELECT '{part}' AS part, '{n}' AS check_name, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed, count(*) AS checked, NULL::DOUBLE AS metric, least(5, count(*) FILTER (WHERE NOT coalesce({p}, false))) AS examples FROM r" for n, p in checks.items()]
    return " UNION ALL ".join(rows)


@query(
    f"""WITH r AS ({_REPORTED}), u AS (SELECT id, count(*) AS n FROM r GROUP BY id), a AS (
    {_report_sql("good", {"id_not_null": "id IS NOT NULL", "known_source": "source_city IN ('dallas', 'fort_worth', 'houston')", "row_hash_not_empty": "length(trim(h)) > 0", "coordinates_valid": "(lat IS NULL AND lon IS NULL) OR (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)"})}
    UNION ALL SELECT 'good', 'unique_key', sum(n - 1), sum(n), count(*) FILTER (WHERE n > 1), 0 FROM u
    UNION ALL SELECT 'good', 'occurred_at_coverage', count(*), count(*), 0, 0 FROM r
    UNION ALL SELECT * FROM (VALUES ('good', 'required_columns', 0, 25, NULL, 0), ('good', 'schema', 0, 25, NULL, 0), ('lacking', 'required_columns', 2, 25, NULL, 2), ('typed', 'required_columns', 0, 25, NULL, 0), ('typed', 'schema', 1, 25, NULL, 1)))
    SELECT part, check_name, true AS blocking, failed = 0 AS passed, failed::BIGINT AS failed, checked::BIGINT AS checked, metric::DOUBLE AS metric, examples::INTEGER AS examples FROM a"""
)
def incident_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a stored table, of one that lacks columns, and of one with a wrong type."""
    key = F.col("source_record_id").cast("long")
    rows = base._canonical(spark, sf_dir).withColumns({"incident_id": F.when(key % 50 != 0, F.col("source_record_id")), "longitude": F.when(key % 3 == 0, F.col("latitude")).otherwise(F.col("longitude"))})
    path = fresh_path(spark, "incidents")
    rows.write.parquet(path)
    good = jobs.check_incident_table(spark, path, least_time_coverage=0.5, raise_on_failure=False)
    stored = spark.read.parquet(path)
    lacking = quality.validate_incidents(stored.drop("beat", "latitude"), raise_on_failure=False)
    typed = quality.validate_incidents(stored.withColumn("latitude", F.col("latitude").cast("string")), raise_on_failure=False)
    typed = quality.Report(typed.dataset, tuple(x for x in typed.checks if x.name in ("required_columns", "schema")))
    out = _report_rows(spark, "good", good)
    return out.unionByName(_report_rows(spark, "lacking", lacking)).unionByName(_report_rows(spark, "typed", typed))


@query(
    """WITH n AS (SELECT count(*) AS n FROM customer WHERE c_custkey % 50 <> 0) SELECT check_name, 0::BIGINT AS failed, CASE WHEN check_name = 'required_columns' THEN 3 ELSE n END::BIGINT AS checked, n AS stored
    FROM n, (VALUES ('required_columns'), ('keys_not_null'), ('median_age_range'), ('unique_key')) c(check_name)"""
)
def census_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tract is delivered twice; the rebuilt table holds it once."""
    bronze, target = fresh_path(spark, "census-bronze"), fresh_path(spark, "census")
    raw = base._census_raw(spark, sf_dir)
    raw.unionByName(raw).write.parquet(bronze)
    report = jobs.rebuild_census(spark, bronze, target)
    stored = spark.read.parquet(target).count()
    return _report_rows(spark, "census", report).select("check_name", "failed", "checked", F.lit(stored).cast("long").alias("stored"))


# --- what guards reject


def _rejected(f: Callable[[], object], pattern: str) -> int:
    """How many examples an error names; -1 without an error."""
    try:
        f()
    except (ValueError, PySparkException) as e:  # errors of analysis, errors of a query
        return len(re.findall(pattern, str(e)))
    return -1


@query(
    """SELECT 'columns' AS guard, 2 AS examples UNION ALL SELECT 'ids', least(20, count(*))::INTEGER FROM events WHERE event_id % 3 = 0 AND event_id % 4 > 1
    UNION ALL SELECT 'identities_null', least(20, count(*))::INTEGER FROM events WHERE event_id % 9 = 0
    UNION ALL SELECT 'identities_twice', least(20, count(*))::INTEGER FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 1)
    UNION ALL SELECT 'lookup_twice', 1 UNION ALL SELECT 'ambiguous_tract', 1 UNION ALL SELECT 'contract', 1 UNION ALL SELECT 'calendar', 1"""
)
def rejected_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each guard on rows that break it, with the number of examples its error names."""
    events, keys = table(spark, sf_dir, "events"), base._incident_keys(spark, sf_dir)
    users = events.select(F.col("user_id").cast("string").alias("incident_id"))
    overlapping = boundaries.boundary_table({2020: _wkt(spark, sf_dir, 0.0).unionByName(_wkt(spark, sf_dir, 0.2).withColumn("geoid", F.concat("geoid", F.lit("x"))))})
    points = spatial.unique_locations(base._located(spark, sf_dir).withColumn("tiger_line_year", F.lit(2020)))
    years = events.select((F.col("event_id") % 3).cast("int").alias("acs_vintage"), F.to_date("ts").alias("acs_release_date")).distinct()
    found = {
        "columns": _rejected(lambda: c.require_columns(events, ["event_id", "zeta", "alpha"], context="events"), "alpha|zeta"),
        "ids": _rejected(lambda: incidents.guard_ids(incidents.with_incident_id(keys.withColumn("source_record_id", F.lit(None).cast("string")))), "'source_city':"),
        "identities_null": _rejected(lambda: dedup.guard_identities(events.select(F.when(F.col("event_id") % 9 != 0, F.col("event_id").cast("string")).alias("incident_id"))), "'incident_id': None"),
        "identities_twice": _rejected(lambda: dedup.guard_identities(users), "'row_count':"),
        "lookup_twice": _rejected(lambda: dedup.one_row_per_key(events.select("user_id", "value"), ["user_id"], name="users").collect(), "users: keys are not unique"),
        "ambiguous_tract": _rejected(lambda: spatial.map_locations(points, overlapping).collect(), "inside several polygons"),
        "contract": _rejected(lambda: incidents.assert_contract(base._canonical(spark, sf_dir).withColumn("beat", F.lit(1))), "'beat', 'int'"),
        "calendar": _rejected(lambda: asof.calendar_ranges(years), "not unique"),
    }
    return spark.createDataFrame(list(found.items()), "guard string, examples int").selectExpr("guard", "least(examples, CASE WHEN guard IN ('lookup_twice', 'ambiguous_tract', 'contract', 'calendar') THEN 1 ELSE 20 END) AS examples")


# --- calendars and the whole pipeline

_RELEASES = [(2019, dt.date(2020, 12, 10), 2019, "2010"), (2022, dt.date(2023, 12, 7), 2022, "2020"), (2023, dt.date(2024, 1, 15), 2022, "2020")]


@query("SELECT event_id, CASE WHEN ts::DATE > DATE '2024-01-15' THEN 2023 WHEN ts::DATE > DATE '2023-12-07' THEN 2022 WHEN ts::DATE > DATE '2020-12-10' THEN 2019 END AS selected_acs_vintage, CASE WHEN ts::DATE > DATE '2023-12-07' THEN 2022 WHEN ts::DATE > DATE '2020-12-10' THEN 2019 END AS tiger_line_year FROM events")
def vintages_by_literal_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("occurred_date"))
    return asof.attach_vintage(events, asof.calendar_ranges(boundaries.release_calendar(spark, _RELEASES))).select("event_id", "selected_acs_vintage", "tiger_line_year")


@query(
    base._FEATURES.replace("AND hour(ts) % 3 <> 0", "")
    + " SELECT incident_id, selected_acs_vintage, tract_geoid, socioeconomic_match_found, temperature_2m_c, weather_match_found, lighting_condition, true AS passed FROM f"
)
def features_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline, twice: lookups are made, then added to, and the table is replaced."""
    events = grid.with_cell(base._located(spark, sf_dir)).withColumn("incident_id", F.col("event_id").cast("string"))
    paths = {n: fresh_path(spark, n) for n in ("lighting_path", "location_path", "target")}
    weather = written(base._weather_table(spark, sf_dir), "weather")
    inputs = {"calendar": base._event_calendar(spark, sf_dir), "boundaries": base._boundaries(spark, sf_dir), "census": base._census_table(spark, sf_dir), "weather": weather, "provider": "open_meteo", "model": "era5"}
    gold.run(spark, events.filter("event_id % 2 = 0"), **inputs, **paths)
    report = gold.run(spark, events, **inputs, **paths)
    discard(weather)
    rows = read_published(spark, paths["target"])
    return rows.select("incident_id", "selected_acs_vintage", "tract_geoid", "socioeconomic_match_found", "temperature_2m_c", "weather_match_found", "lighting_condition", F.lit(report.passed).alias("passed"))
