"""From raw files to cleaned tables."""

import json

import pytest
from pyspark.sql import functions as F

from geoloom.operators import census, quality
from geoloom.plans import jobs

from .test_operators import census_raw, response

HEADER = "Incident,RMSOccurrenceDate,RMSOccurrenceHour,NIBRSClass,NIBRSDescription,OffenseCount,Beat,Premise,StreetNo,StreetName,StreetType,Suffix,City,ZIPCode,MapLongitude,MapLatitude\n"
ROW = "1,1/2/2022,7,13A,Assault,1,b,home,5,MAIN,ST,,HOUSTON,77001,-95.3,29.7\n"


def test_incidents_from_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEADER + ROW + ROW + ROW.replace("home", "street"))
    bronze = str(tmp_path / "bronze")
    assert jobs.ingest_batch(spark, "houston", str(tmp_path / "in"), bronze) == 3
    raw = spark.read.parquet(bronze)
    assert raw.select("source_row_hash").distinct().count() == 2 and "rmsoccurrencedate" in raw.columns and raw.first().source_system == "houston"
    from geoloom.operators.incidents import TO_CANONICAL

    assert TO_CANONICAL["houston"](raw).count() == 3
    clean = jobs.clean_incidents({"houston": raw})
    assert clean.count() == 2 and clean.filter("weather_query_cell_id IS NULL").count() == 0
    assert clean.exceptAll(jobs.clean_incidents({"houston": raw.unionByName(raw)})).isEmpty()
    clean.write.parquet(str(tmp_path / "clean"))
    assert jobs.check_incident_table(spark, str(tmp_path / "clean"), least_time_coverage=1.0).passed


def test_weather_stream_to_state(spark, tmp_path):
    landing, bronze, log = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "log")
    landing.mkdir()
    text = '{"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, 2.5]}'
    one = response(spark, F.lit(text)).drop("ingested_at", "source_row_hash", "source_file").toJSON().first()
    (landing / "1.json").write_text(one + "\n")

    def state():
        jobs.ingest_stream(spark, "weather", str(landing), bronze, checkpoint=str(tmp_path / "c1"), schema_path=str(tmp_path / "schema"))
        return {r.weather_timestamp.hour: r.temperature_2m_c for r in jobs.upsert_weather(spark, bronze, spark.read.parquet(bronze).schema, log=log, checkpoint=str(tmp_path / "c2")).collect()}

    assert state() == {0: 1.5, 1: 2.5}
    (landing / "2.json").write_text(json.dumps({**json.loads(one), "hourly": text.replace("2.5", "9.5"), "extra": 1}) + "\n")
    assert state() == {0: 1.5, 1: 9.5} == state()


def test_census_full_equals_incremental(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    rows = census_raw(spark, geoid="48113000100").unionByName(census_raw(spark, geoid="48113000200"))
    rows.unionByName(rows).write.parquet(bronze)
    assert jobs.rebuild_census(spark, bronze, str(tmp_path / "full")).passed
    state = jobs.upsert_census(spark, bronze, spark.read.parquet(bronze).schema, log=str(tmp_path / "log"), checkpoint=str(tmp_path / "c"))
    columns = ["geoid", "acs_vintage", *census.RATES]
    full = spark.read.parquet(str(tmp_path / "full"))
    assert full.count() == 2 and full.select(*columns).exceptAll(state.select(*columns)).isEmpty() and state.count() == 2
    with pytest.raises(quality.QualityError, match="median_age_range"):
        quality.validate_rebuilt_census(full.withColumn("median_age", F.lit(130.0)))
