"""The feature pipeline end to end, the count panel, and the registered queries against their SQL."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from geoloom.functions.grid import with_cell
from geoloom.operators import lighting, quality
from geoloom.plans import catalog, gold
from geoloom.sources.published import read_published

from .test_operators import CALENDAR

T = dt.datetime


def test_feature_pipeline(spark, tmp_path):
    incidents = with_cell(spark.createDataFrame([("i1", T(2021, 5, 1, 18, 20), 1.0, 1.0), ("i2", T(2023, 1, 1, 3), 1.0, 3.0), ("i3", T(2019, 1, 1), 1.0, 1.0), ("i4", None, None, None)], "incident_id string, occurred_at timestamp, latitude double, longitude double"))
    from geoloom.sources.boundaries import boundary_table

    from .test_operators import SQUARES

    calendar = spark.createDataFrame(CALENDAR, "acs_vintage int, acs_release_date date, tiger_line_year int, tract_definition_vintage string")
    shapes = spark.createDataFrame([(*s, 4326) for s in SQUARES], "geoid string, wkt string, srid int")
    boundaries = boundary_table({2019: shapes, 2020: shapes})
    census = spark.createDataFrame([("a", 2019)], "geoid string, acs_vintage int").withColumns({a: F.lit(None).cast("double") for a in gold.enrich.CENSUS_ATTRIBUTES})
    weather = incidents.filter("incident_id = 'i1'").select("weather_query_cell_id", F.lit("2021-05-01 18:00:00").cast("timestamp").alias("weather_timestamp"), F.lit("p").alias("provider"), F.lit("m").alias("model"), F.lit(6).alias("h3_resolution"), F.lit("r").alias("request_id"), F.lit("h").alias("source_row_hash"), F.lit(9.5).alias("temperature_2m_c"), F.lit(1.0).alias("grid_elevation"), F.lit("2021-05-01").cast("date").alias("weather_date"))
    paths = {n: str(tmp_path / n) for n in ("lighting_path", "location_path", "target")}
    inputs = {"calendar": calendar, "boundaries": boundaries, "census": census, "weather": weather, "provider": "p", "model": "m"}
    report = gold.run(spark, incidents, **inputs, **paths)
    assert report.passed
    rows = {r.incident_id: r for r in read_published(spark, paths["target"]).collect()}
    one, two, three, four = (rows[f"i{i}"] for i in range(1, 5))
    assert (one.selected_acs_vintage, one.tract_geoid, one.socioeconomic_match_found, one.temperature_2m_c, one.lighting_match_found) == (2019, "a", True, 9.5, True)
    assert (two.selected_acs_vintage, two.tract_geoid, two.socioeconomic_match_found, two.weather_match_found) == (2021, "b", False, False)
    assert three.selected_acs_vintage is None and three.tract_geoid is None and three.lighting_match_found
    assert (four.lighting_match_found, four.weather_match_found, four.selected_acs_vintage) == (False, False, None)
    again = gold.run(spark, incidents, **inputs, **paths)
    assert again.passed and read_published(spark, paths["target"]).count() == 4
    with pytest.raises(quality.QualityError, match="weather_coverage"):
        gold.run(spark, incidents, **inputs, **paths, least={"weather_coverage": 0.9})
    assert read_published(spark, paths["target"]).count() == 4

    built = read_published(spark, paths["target"])
    check = lambda df, n=4: {x.name for x in quality.validate_features(df, source_count=n, raise_on_failure=False).checks if not x.passed}
    lit = F.lit
    assert check(built) == set() and check(built, 5) == {"as_many_rows_as_source"}
    assert check(built.withColumn("selected_acs_release_date", F.col("occurred_date"))) >= {"no_leakage"}
    assert check(built.withColumn("weather_request_id", lit(None).cast("string"))) == {"weather_lineage"}
    assert check(built.withColumn("lighting_solar_model_version", lit(None).cast("string"))) == {"lighting_lineage"}
    assert check(built.withColumn("weather_match_found", lit(None).cast("boolean"))) >= {"flags_not_null"}
    assert check(built.unionByName(built)) == {"unique_key", "as_many_rows_as_source", "no_multiplication"}
    assert check(built.drop("tract_geoid")) == {"required_columns"}
    assert lighting.KEYS[0] in spark.read.parquet(paths["lighting_path"]).columns


def test_incidents_are_read_a_fixed_few_times(spark, tmp_path, sf_dir):
    """By both guards of the ids, for what is asked for, and for the rows."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    events = catalog._located(spark, sf_dir).select(F.col("event_id").cast("string").alias("incident_id"), "occurred_at", "latitude", "longitude")
    incidents = events.mapInArrow(counted, events.schema)
    inputs = {"calendar": catalog._event_calendar(spark, sf_dir), "boundaries": catalog._boundaries(spark, sf_dir), "census": catalog._census_table(spark, sf_dir), "weather": catalog._weather_table(spark, sf_dir), "provider": "open_meteo", "model": "era5"}
    report = gold.run(spark, incidents, **inputs, **{n: str(tmp_path / n) for n in ("lighting_path", "location_path", "target")})
    n = events.count()
    assert report.passed and read.value <= 4 * n
    found = {x.name: x for x in report.checks}
    assert found["as_many_rows_as_source"].checked == found["no_multiplication"].checked == n


def test_count_panel(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1, 5)), (1, T(2024, 1, 1, 6)), (2, T(2024, 1, 3)), (None, T(2024, 1, 9)), (3, None)], "weather_query_cell_id long, occurred_at timestamp")
    rows = {(r.weather_query_cell_id, r.window_start.day): (r.event_count, r.split) for r in gold.count_panel(df, size="1 day", validate_from="2024-01-02", test_from="2024-01-03").collect()}
    assert rows == {(1, 1): (2, "train"), (1, 2): (0, "validation"), (1, 3): (0, "test"), (2, 1): (0, "train"), (2, 2): (0, "validation"), (2, 3): (1, "test")}
    assert gold.count_panel(df.limit(0), size="1 day", validate_from="2024-01-02", test_from="2024-01-03").count() == 0


def plain(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr([plain(x) for x in v]) if isinstance(v, (list, tuple)) else repr(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        con.sql(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    sql = duck.sql(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    got = df.select(*columns).collect()
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in sql) and got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
