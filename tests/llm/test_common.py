"""The filter before shuffles, grouped streams, written tables, and components around a hub."""

from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from geoloom.llm import components
from geoloom.llm.common import LEAST_SLOTS, MOST_SLOTS, discard, each_group, may_hold, slots_for, written


def test_bit_map_lets_every_key_through(spark):
    rows = spark.range(2000).select("id", (F.col("id") % 7).cast("int").alias("part"), F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("name"))
    keys = rows.filter("id % 100 = 3 OR id = 10").select("part", "name")
    passed = {r.id for r in rows.filter(may_hold(keys)("part", "name")).collect()}
    wanted = {i for i in range(2000) if i % 100 == 3 or i == 10}
    assert wanted <= passed and len(passed) < len(wanted) + 300  # null names of one part are one key
    crowded = {r.id for r in rows.filter(may_hold(keys, slots=64)("part", "name")).collect()}
    assert wanted <= crowded
    assert rows.filter(may_hold(keys.limit(0))("part", "name")).count() == 0


def test_bit_maps_grow_with_their_keys():
    assert slots_for(0) == slots_for(1) == LEAST_SLOTS and slots_for(10**10) == MOST_SLOTS
    assert all(8 * n <= slots_for(n) < 16 * n for n in (10_000, 1 << 20, (1 << 20) + 1, 15_000_000))


def test_the_largest_bit_map_tells_millions_of_keys_apart(spark):
    keys = spark.range(0, 12_000_000, 1, 8).select(F.col("id").alias("key"))
    others = spark.range(1 << 40, (1 << 40) + 100_000).withColumnRenamed("id", "key")
    test = may_hold(keys, slots_for(12_000_000))
    assert slots_for(12_000_000) == MOST_SLOTS and others.filter(test("key")).count() < 100_000 / 8
    assert keys.filter("key % 1000 = 1").filter(test("key")).count() == 12_000


def test_groups_over_batches():
    rows = [(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, 2, "d"), (2, 2, "e"), (2, 2, "f"), (3, 1, "g")]
    make = lambda part: pa.record_batch({"x": [r[0] for r in part], "y": [r[1] for r in part], "v": [r[2] for r in part]})
    for cut in range(1, len(rows)):
        batches = [make(rows[:cut]), make(rows[cut:]).slice(0, 0), make(rows[cut:])]
        assert ["".join(t["v"].to_pylist()) for t in each_group(iter(batches), ["x", "y"])] == ["ab", "c", "def", "g"]


def test_discarded_tables_are_gone(spark):
    table = written(spark.range(3), "t")
    folder = Path(table.written_to.removeprefix("file://"))
    assert table.count() == 3 and folder.exists()
    discard(table)
    assert not folder.exists()


def test_a_hub_is_joined_from_written_minima(spark, monkeypatch):
    """Minima are written before they are joined, so the join has two plain exchanges to split."""
    names, plain = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: (names.append(name), plain(df, name))[1])
    links = [(0, i) for i in range(1, 3000)] + [(i, i + 3000) for i in range(0, 3000, 3)]
    found = {r.node: r.label for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(found.values()) == {0} and len(found) == 4000 and "least" in names
    names.clear()
    stars = components.connected_components(spark.createDataFrame([(5, 1), (6, 1), (9, 2), (2, 2)], "a long, b long"))
    assert {(r.node, r.label) for r in stars.collect()} == {(1, 1), (5, 1), (6, 1), (2, 2), (9, 2)} and "least" not in names
