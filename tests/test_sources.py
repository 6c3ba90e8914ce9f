"""Readers, rescue, sinks, streams and upserts."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.operators.dedup import one_per_key
from geoloom.sources import boundaries, readers, scratch, sinks
from geoloom.streaming import ingest, upsert


def test_quoted_and_plain_csv(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.csv").write_text('Id,Text\n1,"two\nlines, ""quoted"""\n2,x\n')
    (tmp_path / "skip.txt").write_text("no")
    rows = readers.read_source(spark, "dallas", str(tmp_path)).orderBy("Id").collect()
    assert rows[0].Text == 'two\nlines, "quoted"' and rows[0].source_file.endswith("sub/a.csv") and rows[0].Id == "1"
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.csv").write_text("Id,Text\n1,NULL\n,\n")
    rows = readers.read_source(spark, "houston", str(tmp_path / "b")).collect()
    assert [(r.Id, r.Text) for r in rows] == [("1", "NULL"), (None, None)]


def test_json_lines_and_unknown_source(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1, "b": {"c": [1.5]}}\n{"a": 2}\n')
    df = readers.read_source(spark, "fort_worth", str(tmp_path))
    assert sorted((r.a, r.b) for r in df.collect())[1] == (2, None)
    with pytest.raises(ValueError, match="known: "):
        readers.read_source(spark, "nowhere", str(tmp_path))


def test_rescue(spark):
    schema = T.StructType.fromDDL("a int, b string")
    lines = ['{"a": 1, "b": "x"}', '{"a": "no", "b": "y", "c": {"d": 1}}', "broken", '{"b": null}']
    rows = readers.rescued(spark.createDataFrame([(x,) for x in lines], "value string"), schema).collect()
    assert (rows[0].a, rows[0].b, rows[0]._rescued_data) == (1, "x", None)
    assert rows[1].a is None and rows[1].b == "y" and json.loads(rows[1]._rescued_data) == {"a": "no", "c": '{"d":1}'}
    assert rows[2]._rescued_data == "broken" and (rows[2].a, rows[2].b) == (None, None)
    assert (rows[3].a, rows[3].b, rows[3]._rescued_data) == (None, None, None)


def test_batch_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not sinks.path_exists(spark, path)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert sinks.write_batch(df, path) == 2 and sinks.write_batch(df.withColumn("w", F.lit(1)), path, mode="append") == 4
    assert sinks.write_batch(df, path) == 2 and spark.read.parquet(path).columns == ["k", "v"]
    with pytest.raises(ValueError):
        sinks.write_batch(df, path, mode="ignore")
    assert sinks.insert_only(spark.createDataFrame([(2, "new"), (3, "c"), (3, "c")], "k long, v string"), path, ["k"]) == 1
    assert sinks.insert_only(spark.createDataFrame([(2, "new"), (3, "c")], "k long, v string"), path, ["k"]) == 0
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    sinks.ensure_table(spark, str(tmp_path / "e"), "k long")
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0


def test_rebuild_or_add(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build(existing):
        calls.append(existing is None)
        return spark.range(3 if existing is None else 5)

    done = [sinks.rebuild_or_add(spark, path, build, keys=["id"], rebuild=r) for r in (False, False, True)]
    assert done == ["rebuilt", "added", "rebuilt"] and calls == [True, False, True]
    assert spark.read.parquet(path).count() == 3


def test_stream_with_pinned_schema_drains_once(spark, tmp_path):
    landing, out, check, pinned = (str(tmp_path / n) for n in ("in", "out", "check", "schema"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"k": 1, "v": "a"}\n')

    def drain():
        stream = readers.read_source(spark, "weather", landing, streaming=True, schema_path=pinned)
        ingest.drain_to(stream, out, check)
        return spark.read.parquet(out)

    assert drain().count() == 1
    (tmp_path / "in" / "2.json").write_text('{"k": 2, "v": "b", "new": true}\n')
    assert drain().count() == 2 and drain().count() == 2
    late = drain().filter("k = 2").first()
    assert json.loads(late._rescued_data) == {"new": "true"} and late.source_file.endswith("2.json")


def test_upserts_survive_replay(spark, tmp_path):
    landing, log = tmp_path / "in", str(tmp_path / "log")
    landing.mkdir()
    schema = T.StructType.fromDDL("id long, value string")
    newest = lambda df: one_per_key(df, ["id"], ["value"])

    def drain(check):
        upsert.drain_upserts(spark.readStream.schema(schema).json(str(landing)), log=log, checkpoint=str(tmp_path / check), deduplicate=newest)
        return {(r.id, r.value) for r in upsert.current(spark, log, ["id"]).collect()}

    (landing / "1.json").write_text('{"id": 1, "value": "a"}\n{"id": 1, "value": "b"}\n{"id": 2, "value": "c"}\n')
    assert drain("c1") == {(1, "b"), (2, "c")}
    (landing / "2.json").write_text('{"id": 2, "value": "a"}\n{"id": 3, "value": "d"}\n')
    assert drain("c1") == {(1, "b"), (2, "a"), (3, "d")} == drain("c1")
    replayed = drain("lost")
    assert {k for k, _ in replayed} == {1, 2, 3} and len(replayed) == 3
    upsert.upsert_batch(spark.createDataFrame([], schema), 9, log=log, deduplicate=newest)
    assert len(upsert.current(spark, log, ["id"]).collect()) == 3


def test_a_compacted_log_keeps_its_state(spark, tmp_path):
    log, newest = str(tmp_path / "log"), lambda df: one_per_key(df, ["id"], ["value"])
    batch = lambda n: spark.createDataFrame([(i, f"{n}") for i in range(n % 3, 20, 3)] + [(100 + n, "own")], "id long, value string")

    def state():
        return {(r.id, r.value) for r in upsert.current(spark, log, ["id"]).collect()}

    for n in range(6):
        upsert.upsert_batch(batch(n), n, log=log, deduplicate=newest)
    before = state()
    assert upsert.compact(spark, log, ["id"], keep=8) == 0 and upsert.compact(spark, log, ["id"], keep=3) == 4
    assert state() == before and upsert.batches(spark, log) == [4, 5]
    upsert.upsert_batch(batch(5), 5, log=log, deduplicate=newest)  # the last batch is replayed
    assert state() == before
    for n in range(6, 9):
        upsert.upsert_batch(batch(n), n, log=log, deduplicate=newest)
    before = state()
    assert upsert.compact(spark, log, ["id"], keep=3) == 3 and state() == before and len(before) == 29


def test_windowed_counts_on_a_stream(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "1.json").write_text('{"t": "2024-01-01T00:10:00Z"}\n{"t": "2024-01-01T00:50:00Z"}\n{"t": "2024-01-01T09:00:00Z"}\n')
    stream = spark.readStream.schema("t timestamp").json(str(landing))
    ingest.drain_to(ingest.windowed_counts(stream, at="t", size="1 hour", late="10 minutes"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert [r["count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]


def test_table_stream(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "t"))
    ingest.drain_to(ingest.stream_table(spark, str(tmp_path / "t"), df.schema), str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_boundary_table(spark, tmp_path):
    shapes = spark.createDataFrame([("1", "POLYGON ((0 0, 1 0, 1 1, 0 0))", 4326)], "geoid string, wkt string, srid int")
    table = boundaries.boundary_table({2020: shapes, 2010: shapes})
    assert {(r.boundary_vintage, r.max_x) for r in table.collect()} == {(2010, 1.0), (2020, 1.0)}
    boundaries.write_boundaries(table, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).filter("boundary_vintage = 2010").count() == 1
    for bad in (shapes.withColumn("srid", F.lit(3857)), shapes.withColumn("wkt", F.lit("POINT (0 0)"))):
        with pytest.raises(ValueError, match="4326"):
            boundaries.boundary_table({2020: bad})
    assert boundaries.release_calendar(spark, [(2019, None, 2019, "x")]).columns == ["acs_vintage", "acs_release_date", "tiger_line_year", "tract_definition_vintage"]
