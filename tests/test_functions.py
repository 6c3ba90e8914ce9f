"""Names, hashes, safe parsing, grid, sun and polygons."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from geoloom.functions import columns as c
from geoloom.functions import grid, hashing, names, polygons, solar


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Call (911) Problem", "call_911_problem"), ("123 field", "column_123_field"), ("", "unnamed_column"), ("﻿Id", "id"), ("a\xa0b", "a_b"), ("Crème brûlée", "cre_me_bru_le_e"), ("__x__", "x"), ("!!!", "unnamed_column")],
)
def test_snake_case(raw, want):
    assert names.snake_case(raw) == want


def test_collisions_and_overrides():
    assert names.snake_names(["A b", "a_b", "A-B", "a_b_2"]) == ["a_b", "a_b_2", "a_b_3", "a_b_2_2"]
    assert names.snake_names(["Latitude", "_latitude"], names.PAIRED_COORDINATES) == ["latitude", "alternate_latitude"]
    assert names.snake_names(["x"], {"x": "New Name"}) == ["new_name"]


def test_rename(spark):
    assert names.with_snake_names(spark.createDataFrame([(1, 2)], ["A b", "A.b"])).columns == ["a_b", "a_b_2"]


def hashes(df):
    return sorted(r[0] for r in df.select(hashing.content_hash(df)).collect())


def test_content_hash(spark):
    df = spark.createDataFrame([("a", None, "f1"), ("b", 2, "f2")], "x string, y int, source_file string")
    assert hashes(df) == hashes(df.select("source_file", "y", "x")) == hashes(df.withColumn("source_file", F.lit("other"))) == hashes(df.repartition(3))
    assert hashes(df) != hashes(df.withColumn("z", F.lit(None).cast("int"))) and hashes(df) != hashes(df.withColumn("x", F.upper("x")))
    with pytest.raises(ValueError):
        hashing.content_hash(df.select("source_file"))
    out = hashing.with_ingestion_metadata(df, "s")
    assert out.columns[-3:] == ["source_row_hash", "source_system", "ingested_at"]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_safe_parsing(spark):
    t = dt.datetime
    lit = F.lit
    assert value(spark, c.safe_cast(lit("x"), "int")) is None
    assert value(spark, c.from_millis(lit("1000"))) == t(1970, 1, 1, 0, 0, 1)
    assert value(spark, c.from_millis(lit("-1"))) is None and value(spark, c.from_millis(lit("no"))) is None
    assert value(spark, c.joined_words(lit(" 1 "), lit(None), lit("Main"), lit("St "))) == "1 Main St"
    assert value(spark, c.joined_words(lit(None).cast("string"))) == ""
    for text in ("2022-05-29 01:02:03.1234567", "2022-05-29 01:02:03.123456", "2022-05-29 01:02:03"):
        assert value(spark, c.parsed_timestamp(lit(text))).replace(microsecond=0) == t(2022, 5, 29, 1, 2, 3)
    assert value(spark, c.parsed_timestamp(lit("29.5.2022"))) is None
    assert value(spark, c.date_and_time(lit("2022-05-29 00:00:00.0000000"), lit("05:11"))) == t(2022, 5, 29, 5, 11)
    assert value(spark, c.date_and_time(lit(None).cast("string"), lit("05:11"))) is None
    assert value(spark, c.date_and_hour(lit("1/2/2022"), lit("7"))) == t(2022, 1, 2, 7)
    assert value(spark, c.date_and_hour(lit("1/2/2022"), lit("24"))) is None
    assert value(spark, c.coordinate(lit("X ST (32.877, -96.75812)"), 2)) == -96.75812
    assert value(spark, c.coordinate(lit("none"), 1)) is None
    assert value(spark, c.safe_rate(lit(1), lit(0))) is None and value(spark, c.safe_rate(lit(1), lit(4))) == 0.25


@pytest.mark.parametrize(("lat", "lon", "want"), [(1.0, 2.0, True), (None, 2.0, False), (float("nan"), 1.0, False), (90.0, 180.0, True), (90.1, 0.0, False), (0.0, -180.1, False)])
def test_valid_location(spark, lat, lon, want):
    x = lambda v: F.lit(v).cast("double")
    assert value(spark, c.valid_location(x(lat), x(lon))) is want
    assert value(spark, c.null_or_valid_location(F.lit(None).cast("double"), F.lit(None).cast("double"))) is True


def test_required_columns(spark):
    with pytest.raises(ValueError, match="here: missing columns a, z"):
        c.require_columns(spark.range(1), ["z", "id", "a"], context="here")


@pytest.mark.parametrize("resolution", [0, 3, 6, 11, 15])
def test_cells_are_invertible(spark, resolution):
    points = [(lat + 0.0, lon + 0.0) for lat in (-90, -89.9, -33.3, 0, 32.7767, 89.99, 90) for lon in (-180, -96.797, 0, 179.999, 180)]
    df = grid.with_cell(spark.createDataFrame([*points, (None, 1.0), (float("nan"), 1.0), (91.0, 0.0)], "latitude double, longitude double"), resolution=resolution)
    rows = df.collect()
    assert sum(r.weather_query_cell_id is None for r in rows) == 3
    back = grid.with_cell(grid.with_center(df), resolution=resolution, latitude="query_latitude", longitude="query_longitude", output="again").collect()
    assert len(back) == len(points) and all(r.again == r.weather_query_cell_id for r in back)
    step = grid.step_degrees(resolution)
    assert all(abs(r.latitude - r.query_latitude) <= step / 2 + 1e-9 for r in back)


@pytest.mark.parametrize("bad", [-1, 16, True, 2.0])
def test_bad_resolution(spark, bad):
    with pytest.raises(ValueError):
        grid.with_cell(spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double"), resolution=bad)


def test_malformed_cells_are_dropped(spark):
    assert grid.with_center(spark.createDataFrame([(None,), (-1,), (1 << 62,)], "weather_query_cell_id long")).count() == 0


def test_sun_over_a_known_place(spark):
    rows = [(dt.datetime(2024, 6, 21, 18), 32.7767, -96.797), (dt.datetime(2024, 6, 21, 6), 32.7767, -96.797)]
    df = solar.with_solar_angles(spark.createDataFrame(rows, "t timestamp, lat double, lon double"), at="t", latitude="lat", longitude="lon")
    day, night = df.orderBy(F.desc("t")).collect()
    assert abs(day.solar_elevation_deg - 78.666651) < 0.05 and abs(day.solar_azimuth_deg - 143.662815) < 0.05
    assert abs(night.solar_elevation_deg + 33.361827) < 0.05 and abs(night.solar_azimuth_deg - 352.016209) < 0.05
    assert day.solar_zenith_deg == 90 - day.solar_elevation_deg and 0 < day.apparent_solar_elevation_deg - day.solar_elevation_deg < 0.02
    assert df.columns == ["t", "lat", "lon", "solar_elevation_deg", "apparent_solar_elevation_deg", "solar_zenith_deg", "solar_azimuth_deg"]


@pytest.mark.parametrize(
    ("elevation", "want"),
    [(0.0, "daylight"), (-0.01, "civil_twilight"), (-6.0, "civil_twilight"), (-6.01, "nautical_twilight"), (-12.0, "nautical_twilight"), (-12.01, "astronomical_twilight"), (-18.0, "astronomical_twilight"), (-18.01, "night"), (float("nan"), None), (None, None)],
)
def test_lighting_edges(spark, elevation, want):
    assert value(spark, solar.lighting_class(F.lit(elevation).cast("double"))) == want


def test_polygon_with_a_hole_like_ray_casting(spark):
    wkt = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1)), ((5 0, 7 0, 6 2, 5 0)))"
    points = [(0.5, 0.5), (1.5, 1.5), (1.0, 1.5), (0.0, 3.0), (4.0, 4.0), (4.5, 1.0), (6.0, 1.0), (6.0, 2.0), (9.0, 9.0)]
    df = spark.createDataFrame(points, "x double, y double").withColumn("rings", polygons.rings_from_wkt(F.lit(wkt)))
    got = [(r.i and not r.b, r.b) for r in df.select(polygons.crosses_odd(F.col("rings"), F.col("x"), F.col("y")).alias("i"), polygons.on_border(F.col("rings"), F.col("x"), F.col("y")).alias("b")).collect()]
    assert got == [(True, False), (False, False), (False, True), (False, True), (False, True), (False, False), (True, False), (False, True), (False, False)]
    box = df.select(*(v.alias(n) for n, v in polygons.bounds(F.col("rings")).items())).first()
    assert tuple(box) == (0, 7, 0, 4)
    assert value(spark, polygons.rings_from_wkt(F.lit("POINT (1 2)"))) is None
    assert math.isclose(grid.step_degrees(6), 0.05)
