"""Incidents, deduplication, weather, census, spatial mapping, requests, light, calendars, quality."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from geoloom.operators import asof, census, dedup, enrich, incidents, lighting, manifest, quality, spatial, weather
from geoloom.sources.boundaries import boundary_table

T, D = dt.datetime, dt.date


# --- incidents

HOUSTON = "incident string, rmsoccurrencedate string, rmsoccurrencehour string, nibrsclass string, nibrsdescription string, offensecount string, beat string, premise string, streetno string, streetname string, streettype string, suffix string, city string, zipcode string, maplongitude string, maplatitude string, source_file string, source_row_hash string"
FORT_WORTH = "case_no_offense string, objectid long, case_no string, offense string, nature_of_call string, offense_desc string, from_date long, reported_date long, lastupdated long, address string, block_address string, city string, state string, beat string, locationtypedescription string, latitude double, longitude double, alternate_latitude double, alternate_longitude double, x_coordinate double, y_coordinate double, source_file string, source_row_hash string"
DALLAS = "service_number_id string, incident_number_w_year string, nibrs_code string, nibrs_crime string, ucr_offense_name string, type_of_incident string, ucr_offense_description string, date1_of_occurrence string, time1_of_occurrence string, date_of_report string, update_date string, incident_address string, city string, state string, zip_code string, beat string, type_location string, location1 string, x_coordinate string, y_cordinate string, source_file string, source_row_hash string"


@pytest.fixture
def raw(spark):
    return {
        "houston": spark.createDataFrame([("1", "1/2/2022", "7", "13A", "Assault", "2", "b", "home", " 5", "MAIN", None, "", "HOUSTON", "NULL", "NULL", "29.5", "f", "h1")], HOUSTON),
        "fort_worth": spark.createDataFrame([(None, 9, "c", "o", "n", "d", 1000, -5, None, None, "block", "FW", "TX", "b", "l", 32.0, -97.0, 1.0, 2.0, None, None, "f", "h2")], FORT_WORTH),
        "dallas": spark.createDataFrame([("r", "i", "c", None, None, "type", None, "2022-05-29 00:00:00.0000000", "05:11", "2022-05-30 01:00:00.0000000", "bad", "a", "D", "TX", "75", "b", "l", "x (32.8, -96.7)", "1.5", "no", "f", "h3")], DALLAS).withColumn("extra", F.lit(1)),
    }


def test_sources_on_the_contract(raw):
    df = incidents.union_incidents(raw)
    rows = {r.source_city: r for r in df.collect()}
    h, f, d = rows["houston"], rows["fort_worth"], rows["dallas"]
    assert (h.source_record_id, h.occurred_at, h.offense_count, h.address, h.postal_code, h.longitude, h.state) == ("h1", T(2022, 1, 2, 7), 2, "5 MAIN", "NULL", None, "TX")
    assert (f.source_record_id, f.occurred_at, f.reported_at, f.address, f.alternate_longitude, f.offense_count) == ("9", T(1970, 1, 1, 0, 0, 1), None, "block", 2.0, 1)
    assert (d.offense_name, d.offense_description, d.occurred_at, d.updated_at, d.latitude, d.source_y_coordinate) == ("type", "type", T(2022, 5, 29, 5, 11), None, 32.8, None)
    assert df.columns == list(incidents.CONTRACT)


def test_contract_errors(raw):
    with pytest.raises(ValueError, match="missing columns incident"):
        incidents.houston(raw["houston"].drop("incident"))
    with pytest.raises(ValueError, match="missing columns location1"):
        incidents.dallas(raw["dallas"].drop("location1"))
    good = incidents.union_incidents(raw)
    for bad in (good.drop("beat"), good.withColumn("beat", F.lit(1)), good.select(*reversed(good.columns))):
        with pytest.raises(ValueError):
            incidents.assert_contract(bad)


def test_stable_ids(spark, raw):
    rows = [("dallas", "i", " r ", "c", "h"), ("dallas", "i", None, "c", "h"), (" Fort_Worth", None, "r", None, "h"), ("houston", "i", "r", "c", "h"), ("austin", None, None, None, "h"), ("fort_worth", "i", None, "c", None)]
    df = spark.createDataFrame(rows, "source_city string, source_incident_id string, source_record_id string, offense_code string, source_row_hash string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = [r.incident_id for r in incidents.with_incident_id(df).collect()]
    assert got == [sha("dallas||i||r||c"), sha("dallas||h"), sha("fort_worth||r"), sha("houston||h"), sha("austin||h"), None]
    with pytest.raises(ValueError, match="rows without incident_id"):
        incidents.guard_ids(incidents.with_incident_id(df))
    assert incidents.guard_ids(incidents.with_incident_id(incidents.union_incidents(raw))).count() == 3


def test_latest_incident_wins_in_any_order(spark, raw):
    base = incidents.with_incident_id(incidents.union_incidents(raw))
    newer = base.withColumn("updated_at", F.lit("2023-01-01").cast("timestamp")).withColumn("address", F.lit("new"))
    both = base.unionByName(newer).unionByName(base)
    once, again = dedup.latest_incidents(both), dedup.latest_incidents(both.repartition(3))
    assert {r.address for r in once.collect()} == {"new"} and once.exceptAll(again).isEmpty() and once.count() == 3
    assert dedup.latest_incidents(base.limit(0)).columns == base.columns
    tied = base.withColumn("beat", F.lit("z")).unionByName(base)
    assert dedup.latest_incidents(tied).exceptAll(dedup.latest_incidents(tied.repartition(4))).isEmpty()


def test_key_guards(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, incident_id string")
    assert dedup.guard_unique(df, ["k", "incident_id"], name="t") is df
    with pytest.raises(ValueError, match="t: keys k are not unique.*'row_count': 2"):
        dedup.guard_unique(df, ["k"], name="t")
    assert dedup.guard_identities(df).count() == 3
    with pytest.raises(ValueError, match="without"):
        dedup.guard_identities(df.withColumn("incident_id", F.when(F.col("k") == 2, "x")))


# --- weather and census


def response(spark, hourly, **more):
    values = {"provider": "p", "model": "m", "request_id": "r", "weather_query_cell_id": "5", "h3_resolution": "6", "query_latitude": 1.0, "query_longitude": 2.0, "grid_latitude": 1.0, "grid_longitude": 2.0, "grid_elevation": 3.0, "hourly_units": '{"time": "iso", "temperature_2m": "C"}', "timezone": "GMT", "utc_offset_seconds": 0, "source_file": "f", "source_row_hash": "h", **more}
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.withColumn("ingested_at", F.current_timestamp()).withColumn("hourly", hourly)


def test_malformed_hours(spark):
    text = '{"time": ["2024-01-01T00:00", "bad", "2024-01-01T01:30"], "temperature_2m": ["x", 1.0, 2.0]}'
    (row,) = weather.hourly_weather(response(spark, F.lit(text))).collect()
    assert (row.weather_query_cell_id, row.weather_timestamp, row.weather_date, row.temperature_2m_c, row.temperature_unit) == (5, T(2024, 1, 1), D(2024, 1, 1), None, "C")
    assert tuple(weather.hourly_weather(response(spark, F.lit(text))).columns) == weather.HOURLY_COLUMNS


@pytest.mark.parametrize("text", ['{"time": ["2024-01-01T00:00"], "temperature_2m": []}', '{"time": [], "temperature_2m": []}', "{broken", "{}"])
def test_unequal_or_broken_arrays_are_left_out(spark, text):
    assert weather.hourly_weather(response(spark, F.lit(text))).count() == 0


def test_hours_from_a_struct_and_other_types(spark):
    hourly = F.struct(F.array(F.lit("2024-01-01T00:00")).alias("time"), F.array(F.lit(1.5)).alias("temperature_2m"))
    (row,) = weather.hourly_weather(response(spark, hourly)).collect()
    assert row.temperature_2m_c == 1.5
    with pytest.raises(TypeError):
        weather.hourly_weather(response(spark, F.lit(1)))
    assert weather.hourly_weather(response(spark, hourly).withColumn("provider", F.lit(None).cast("string"))).count() == 0
    twice = weather.hourly_weather(response(spark, hourly)).unionByName(weather.hourly_weather(response(spark, hourly)).withColumn("bronze_ingested_at", F.lit("2030-01-01").cast("timestamp")))
    assert [r.bronze_ingested_at.year for r in dedup.latest_weather(twice).collect()] == [2030]


def test_response_checks(spark):
    rows = [('{"time": ["a"], "t": [1]}', ["t"], False), ('{"time": ["a"], "t": []}', ["t"], False), ('{"time": ["a"]}', ["t"], False), ("x", ["t"], False), ('{"time": ["a"], "t": [1]}', ["t"], True)]
    valid, invalid = weather.valid_responses(spark.createDataFrame(rows, "hourly string, hourly_variables array<string>, error boolean"))
    assert valid.count() == 1 and invalid.count() == 4
    assert ["no_error"] in [r.failed_checks for r in invalid.collect()]


def census_raw(spark, **values):
    base = {code: "10" for code in census.RENAMES} | {"b01002_001e": "30.5", "geoid": "48113000100", "name": "n", "state": "48", "county": "113", "tract": "1", "acs_vintage": "2022", "period_start_year": "2018", "period_end_year": "2022", "geography_type": "tract", "source_file": "f"} | values
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base)).withColumn("ingested_at", F.current_timestamp())


def test_census_cleaning(spark):
    (r,) = census.census_tracts(census_raw(spark, b01003_001e="-666666666", b01003_001m="-5", b01002_001e="130", b19013_001e="x", b25001_001e="0", b17001_001e="20", b17001_002e="5", b25003_001e="2104.0")).collect()
    assert (r.population, r.population_moe, r.median_age, r.median_household_income, r.vacancy_rate, r.poverty_rate, r.renter_occupied_rate) == (None, None, None, None, None, 0.25, None)
    assert r.acs_vintage == 2022 and len(r) == 45
    assert census.census_tracts(census_raw(spark, geoid=None)).count() == 0 == census.census_tracts(census_raw(spark, acs_vintage="x")).count()
    with pytest.raises(ValueError, match="missing columns"):
        census.rename_variables(spark.range(1))
    both = census.census_tracts(census_raw(spark)).unionByName(census.census_tracts(census_raw(spark, name="z")).withColumn("bronze_ingested_at", F.lit("2000-01-01").cast("timestamp")))
    assert [r.geography_name for r in dedup.latest_census(both).collect()] == ["n"]


def test_payloads(spark):
    rows = [('[["NAME","state","county","tract"],["a","48","113","000100"],["short","48"]]', 2022), ("broken", 2021), ('[["NAME"]]', 2020)]
    records, invalid = census.payload_records(spark.createDataFrame(rows, "payload string, acs_vintage int"))
    (r,) = records.collect()
    assert (r.geoid, r.record["NAME"], r.period_start_year, r.period_end_year) == ("48113000100", "a", 2018, 2022)
    assert invalid.count() == 3


def test_a_header_that_repeats_a_name_is_invalid(spark):
    rows = [('[["NAME", "state", "state"], ["a", "1", "2"]]', 2020), ('[["NAME", "state"], ["a", "1"]]', 2020)]
    records, invalid = census.payload_records(spark.createDataFrame(rows, "payload string, acs_vintage int"))
    assert records.count() == 1 and [r.failed_checks for r in invalid.collect()] == [["names_once"]]


def test_a_coverage_that_is_met_counts_no_failures(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    met, missed = (quality.check_rows(df, {}, dataset="t", coverages={"c": (F.col("x").isNotNull(), least)})[0] for least in (0.5, 0.6))
    assert (met.passed, met.failed, met.metric) == (True, 0, 0.5) and (missed.passed, missed.failed) == (False, 1)


# --- polygons and calendars

SQUARES = [("a", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), ("b", "POLYGON ((2 0, 4 0, 4 2, 2 2, 2 0))"), ("c", "POLYGON ((10 10, 11 10, 10.5 11, 10 10))")]


@pytest.fixture
def shapes(spark):
    return boundary_table({2020: spark.createDataFrame([(*s, 4326) for s in SQUARES], "geoid string, wkt string, srid int")})


def places(spark, points):
    return spark.createDataFrame([(2020, float(y), float(x)) for x, y in points], "tiger_line_year int, latitude double, longitude double")


def test_points_in_polygons(spark, shapes):
    want = {(1, 1): "a", (3, 1): "b", (2, 1): None, (0, 1): "a", (4, 2): "b", (5, 5): None, (10.5, 10.5): "c", (10.5, 11): "c", (10.1, 10.9): None, (-5, -5): None}
    got = {(r.longitude, r.latitude): r.tract_geoid for r in spatial.map_locations(places(spark, want), shapes).collect()}
    assert got == {(float(x), float(y)): v for (x, y), v in want.items()}


def test_overlapping_polygons_are_an_error(spark, shapes):
    overlap = boundary_table({2020: spark.createDataFrame([(*s, 4326) for s in [*SQUARES, ("d", SQUARES[0][1])]], "geoid string, wkt string, srid int")})
    with pytest.raises(Exception, match="several polygons"):
        spatial.map_locations(places(spark, [(1, 1)]), overlap).collect()


def test_location_map_is_incremental(spark, shapes, tmp_path):
    path = str(tmp_path / "map")
    first = spatial.materialize_location_map(spark, places(spark, [(1, 1), (9, 9)]), shapes, path)
    assert first.count() == 2
    both = spatial.materialize_location_map(spark, places(spark, [(1, 1), (3, 1)]), shapes, path)
    assert {(r.longitude, r.tract_geoid) for r in both.collect()} == {(1.0, "a"), (9.0, None), (3.0, "b")}
    assert spatial.materialize_location_map(spark, places(spark, [(3, 1)]), shapes, path, rebuild=True).count() == 1


def test_unique_locations(spark):
    df = spark.createDataFrame([(2020, 1.0, 2.0), (2020, 1.0, 2.0), (None, 1.0, 2.0), (2020, None, 1.0), (2020, float("nan"), 1.0), (2020, 91.0, 1.0)], "tiger_line_year int, latitude double, longitude double")
    assert spatial.unique_locations(df).count() == 1


CALENDAR = [(2019, D(2020, 12, 10), 2019, "x"), (2020, D(2022, 3, 17), 2020, "x"), (2021, D(2022, 12, 8), 2020, "x")]


@pytest.fixture
def calendar(spark):
    return spark.createDataFrame(CALENDAR, "acs_vintage int, acs_release_date date, tiger_line_year int, tract_definition_vintage string")


def test_calendar_ranges(spark, calendar):
    rows = {r.acs_vintage: (r.eligible_start_date, r.eligible_end_date) for r in asof.calendar_ranges(calendar).collect()}
    assert rows == {2019: (D(2020, 12, 11), D(2022, 3, 17)), 2020: (D(2022, 3, 18), D(2022, 12, 8)), 2021: (D(2022, 12, 9), None)}
    bad = [[(2019, None, 1, "x")], [CALENDAR[0], CALENDAR[0]], [(2019, D(2021, 1, 1), 1, "x"), (2020, D(2020, 1, 1), 1, "x")], [(2019, D(2021, 1, 1), 1, "x"), (2020, D(2021, 1, 1), 1, "x")]]
    for rows in bad:
        with pytest.raises(ValueError):
            asof.calendar_ranges(spark.createDataFrame(rows, calendar.schema))


def test_release_day_belongs_to_the_vintage_before(spark, calendar):
    days = [D(2020, 12, 10), D(2020, 12, 11), D(2022, 3, 17), D(2022, 3, 18), D(2030, 1, 1), None]
    events = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, occurred_date date")
    out = asof.attach_vintage(events, asof.calendar_ranges(calendar))
    assert [r.selected_acs_vintage for r in out.orderBy("i").collect()] == [None, 2019, 2019, 2020, 2021, None]
    assert asof.attach_vintage(events.limit(0), asof.calendar_ranges(calendar)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_boundary_checks(spark, calendar, shapes):
    with pytest.raises(ValueError, match=r"\[2019\]"):
        spatial.validate_boundaries(calendar, shapes)
    spatial.validate_boundaries(calendar.filter("tiger_line_year = 2020"), shapes)
    with pytest.raises(ValueError, match="not unique"):
        spatial.validate_boundaries(calendar.filter("tiger_line_year = 2020"), shapes.unionByName(shapes))


# --- enrichment


def test_enrich(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    lookup = spark.createDataFrame([(1, None), (3, "q")], "id int, a string")
    out = {r.v: (r.b, r.found) for r in enrich.enrich(df, lookup, {"k": "id"}, {"a": "b"}, flag="found", name="t").collect()}
    assert out == {"x": (None, True), "y": (None, False), "z": (None, False)}
    with pytest.raises(Exception, match="t: keys are not unique"):
        enrich.enrich(df, lookup.unionByName(lookup), {"k": "id"}, {"a": "b"}, flag=None, name="t").collect()


def test_weather_lookup_needs_a_date(spark):
    schema = "weather_query_cell_id long, weather_timestamp timestamp, provider string, model string, h3_resolution int, request_id string, source_row_hash string, temperature_2m_c double, grid_elevation double, weather_date date"
    weather = spark.createDataFrame([(1, T(2024, 1, d), "p", "m", 6, "r", "h", float(d), 1.0, D(2024, 1, d)) for d in (1, 2, 3)] + [(2, T(2024, 1, 2), "p", "m", 6, "r", "h", 9.0, 1.0, D(2024, 1, 2))], schema)
    found = lambda rows: enrich.weather_lookup(spark.createDataFrame(rows, "weather_query_cell_id long, occurred_date date"), weather, provider="p", model="m", resolution=6)
    assert {r.temperature_2m_c for r in found([(1, D(2024, 1, 2)), (1, D(2024, 1, 3)), (None, None)]).collect()} == {2.0, 3.0}
    with pytest.raises(Exception, match="no event has a date"):
        found([(1, None)]).collect()


def test_calendar_is_bounded(spark, calendar, monkeypatch):
    monkeypatch.setattr(asof, "MOST_RELEASES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        asof.calendar_ranges(calendar)


def test_coverage(spark):
    schema = "selected_acs_vintage int, tract_geoid string, socioeconomic_match_found boolean, median_household_income double, weather_match_found boolean, temperature_2m_c double, lighting_match_found boolean"
    row = enrich.coverage(spark.createDataFrame([(1, "a", True, None, True, 1.0, False), (None, None, False, None, True, None, True), (1, "b", True, 2.0, False, None, True)], schema)).first()
    assert row.asDict() == {"row_count": 3, "selected_vintage_count": 2, "tract_count": 2, "socioeconomic_count": 2, "median_household_income_count": 1, "weather_count": 2, "temperature_count": 1, "lighting_count": 2, "tract_rate": 0.66666667, "socioeconomic_rate": 0.66666667, "weather_rate": 0.66666667, "lighting_rate": 0.66666667}
    empty = enrich.coverage(spark.createDataFrame([], schema)).first()
    assert empty.row_count == 0 and empty.tract_rate is None


# --- requests and light


def events(spark, rows):
    return spark.createDataFrame(rows, "latitude double, longitude double, occurred_at timestamp")


def test_manifest(spark):
    df = events(spark, [(32.7, -96.8, T(2023, 5, 1)), (32.7, -96.8, T(2023, 6, 1)), (32.7, -96.8, T(2024, 1, 2)), (32.7, -96.8, T(2024, 3, 2)), (None, -96.8, T(2023, 5, 1)), (32.7, -96.8, T(1939, 1, 1)), (95.0, 0.0, T(2023, 1, 1))])
    rows = manifest.request_manifest(df, model="ERA5", hourly_variables=["b", " a", "a"], cutoff=D(2024, 2, 1)).orderBy("start_date").collect()
    assert [(r.start_date, r.end_date, r.event_count, r.hourly_variables) for r in rows] == [(D(2023, 1, 1), D(2023, 12, 31), 2, ["a", "b"]), (D(2024, 1, 1), D(2024, 2, 1), 1, ["a", "b"])]
    text = "|".join(["open_meteo", "era5", str(rows[0].weather_query_cell_id), "2023-01-01", "2023-12-31", "a,b", "GMT", "nearest", "6"])
    assert rows[0].request_id == hashlib.sha256(text.encode()).hexdigest()
    made = manifest.request_manifest(df, model="era5", hourly_variables=["a"], cutoff=D(2024, 2, 1))
    assert manifest.pending_requests(made, made.limit(1)).count() == 1
    assert quality.split_valid(made, manifest.manifest_checks())[1].count() == 0
    assert quality.split_valid(made.withColumn("hourly_variables", F.array(F.lit("a"), F.lit("a"))), manifest.manifest_checks())[1].first().failed_checks == ["variables_unique"]
    for bad in ({"model": "x"}, {"hourly_variables": [" "]}, {"resolution": 99}):
        with pytest.raises(ValueError):
            manifest.request_manifest(df, **{"model": "era5", "hourly_variables": ["a"], **bad})


def test_lighting_is_incremental_and_checked(spark, tmp_path):
    path = str(tmp_path / "light")
    df = spark.createDataFrame([(604, T(2024, 6, 21, 18, 5))], "x int, occurred_at timestamp").withColumns({"latitude": F.lit(32.7767), "longitude": F.lit(-96.797)})
    from geoloom.functions.grid import with_cell

    first = with_cell(df)
    more = first.unionByName(first.withColumn("occurred_at", F.lit("2024-06-21 06:00:00").cast("timestamp"))).unionByName(first.withColumn("weather_query_cell_id", F.lit(None).cast("long")))
    assert lighting.materialize_lighting(spark, first, path).passed
    assert lighting.materialize_lighting(spark, more, path).passed and lighting.materialize_lighting(spark, more, path).passed
    rows = {r.lighting_condition: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"daylight", "night"} and rows["daylight"].is_daylight and rows["daylight"].solar_timestamp_hour == T(2024, 6, 21, 18)
    assert lighting.missing_keys(lighting.lighting_keys(more), spark.read.parquet(path)).count() == 0
    plan = lighting.lighting_conditions(lighting.lighting_keys(more))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


# --- quality


def test_checks_count_null_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    (check, cover) = quality.check_rows(df, {"positive": F.col("x") > 0}, dataset="d", coverages={"given": (F.col("x").isNotNull(), 0.7)})
    assert (check.passed, check.failed, check.checked, len(check.examples)) == (False, 2, 3, 2)
    assert (cover.passed, round(cover.metric, 3)) == (False, 0.667)
    unique = quality.check_unique(df.unionByName(df).unionByName(df.filter("x = 1")), ["x"], dataset="d")
    assert (unique.passed, unique.failed, unique.metric) == (False, 4, 3.0)
    assert quality.check_rows(df.limit(0), {}, dataset="d", coverages={"c": (F.lit(True), 0.0)})[0].metric == 0.0
    with pytest.raises(ValueError):
        quality.check_rows(df, {}, dataset="d", coverages={"c": (F.lit(True), 1.5)})


def test_report_model(spark):
    good, bad = quality.Check("d", "a", True, 0, 1), quality.Check("d", "b", False, 1, 1)
    warning = quality.Check("d", "w", False, 1, 2, blocking=False)
    report = quality.Report("d", (good, warning))
    assert report.passed and report.or_raise() is report and report.warnings == (warning,)
    failed = quality.Report("d", (good, bad))
    with pytest.raises(quality.QualityError, match="b failed for 1 of 1"):
        failed.or_raise()
    assert failed.as_dict()["passed"] is False and failed.as_frame(spark).count() == 2
    for wrong in (lambda: quality.Check("", "a", True, 0, 0), lambda: quality.Check("d", "a", True, 2, 1), lambda: quality.Report("e", (good,))):
        with pytest.raises(ValueError):
            wrong()


def failures(report):
    return {x.name for x in report.checks if not x.passed}


def test_incident_validator(spark, raw):
    good = incidents.with_incident_id(incidents.union_incidents(raw)).withColumn("longitude", F.lit(-96.0))
    assert quality.validate_incidents(good, least_time_coverage=1.0).passed
    options = {"raise_on_failure": False}
    lit = F.lit
    for change, name in [
        ({"incident_id": lit(None).cast("string")}, "id_not_null"),
        ({"source_city": lit("x")}, "known_source"),
        ({"source_row_hash": lit(" ")}, "row_hash_not_empty"),
        ({"latitude": lit(95.0)}, "coordinates_valid"),
        ({"incident_id": lit("same")}, "unique_key"),
        ({"beat": lit(1)}, "schema"),
    ]:
        assert name in failures(quality.validate_incidents(good.withColumns(change), **options)), name
    assert failures(quality.validate_incidents(good.drop("beat"), **options)) == {"required_columns"}
    assert "occurred_at_coverage" in failures(quality.validate_incidents(good.withColumn("occurred_at", lit(None).cast("timestamp")), least_time_coverage=0.5, **options))
    with pytest.raises(quality.QualityError):
        quality.validate_incidents(good.withColumn("source_city", lit("x")))


def test_weather_census_and_lighting_validators(spark):
    lit = F.lit
    w = spark.createDataFrame([(1, T(2024, 1, 1), "p", "m", 6, 1.0)], "weather_query_cell_id long, weather_timestamp timestamp, provider string, model string, h3_resolution int, temperature_2m_c double")
    check = lambda df: failures(quality.validate_weather(df, providers=["p"], models=["m"], resolutions=[6], raise_on_failure=False))
    assert check(w) == set()
    for change, name in [({"weather_query_cell_id": lit(None).cast("long")}, "keys_not_null"), ({"weather_timestamp": lit("2024-01-01 00:30:00").cast("timestamp")}, "on_the_hour"), ({"provider": lit("q")}, "provider_allowed"), ({"model": lit("q")}, "model_allowed"), ({"h3_resolution": lit(5)}, "resolution_allowed"), ({"temperature_2m_c": lit(71.0)}, "temperature_plausible"), ({"temperature_2m_c": lit(float("nan"))}, "temperature_plausible")]:
        assert check(w.withColumns(change)) == {name}
    assert check(w.unionByName(w)) == {"unique_key"}
    a = spark.createDataFrame([("48113000100", 2022)], "geoid string, acs_vintage int").withColumns({r: lit(0.5) for r in quality.CENSUS_RATES})
    check = lambda df: failures(quality.validate_census(df, raise_on_failure=False))
    assert check(a) == set() == check(a.withColumn("poverty_rate", lit(None).cast("double")))
    for change, name in [({"geoid": lit("1")}, "geoid_format"), ({"acs_vintage": lit(1999)}, "vintage_plausible"), *(({r: lit(1.5)}, f"{r}_valid") for r in quality.CENSUS_RATES)]:
        assert check(a.withColumns(change)) == {name}
    keys = spark.createDataFrame([(1 << 54, T(2024, 1, 1))], "weather_query_cell_id long, occurred_at timestamp")
    from geoloom.functions.grid import with_cell

    placed = with_cell(keys.withColumns({"latitude": lit(32.0), "longitude": lit(-97.0)}))
    light = lighting.lighting_conditions(lighting.lighting_keys(placed))
    check = lambda df: failures(quality.validate_lighting(df, version=lighting.DEFINITION_VERSION, raise_on_failure=False))
    assert check(light) == set()
    for change, name in [({"lighting_definition_version": lit("v0")}, "active_version"), ({"solar_zenith_deg": lit(181.0)}, "zenith_range"), ({"solar_azimuth_deg": lit(float("nan"))}, "azimuth_range"), ({"lighting_condition": lit("x")}, "class_consistent"), ({"is_daylight": ~F.col("is_daylight")}, "daylight_consistent"), ({"solar_model_version": lit(" ")}, "model_version_not_empty"), ({"apparent_solar_elevation_deg": lit(99.0)}, "apparent_elevation_range")]:
        assert name in check(light.withColumns(change)), name


def test_quarantine_loses_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    valid, invalid = quality.split_valid(df, {"x": F.col("x") > 0, "y": F.col("y").isNotNull()})
    assert valid.count() == 1 and {tuple(r.failed_checks) for r in invalid.collect()} == {("x",), ("y",)} and valid.columns == df.columns
