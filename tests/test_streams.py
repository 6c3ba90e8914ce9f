"""Streams over several micro-batches: series, gaps by timers, and requests with deadlines."""

import datetime as dt
import time
import types

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from geoloom.operators import trailing
from geoloom.plans.catalog_time import rocksdb_state
from geoloom.streaming import gaps, ingest, requests

T = dt.datetime


class Feed:
    """A folder of Parquet files that grows, and a stream over it that is drained step by step."""

    def __init__(self, spark, tmp_path, schema, name="in"):
        self.spark, self.path, self.schema = spark, str(tmp_path / name), schema
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return ingest.stream_table(self.spark, self.path, self.spark.createDataFrame([], self.schema).schema)


def drained(spark, tmp_path, stream):
    """Everything given out so far, as sorted rows."""
    out = str(tmp_path / "out")
    ingest.drain_to(stream, out, str(tmp_path / "checkpoint"))
    return sorted((tuple(r) for r in spark.read.schema(stream.schema).parquet(out).collect()), key=repr)


def test_sessions_merge_over_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, "k int, at timestamp")
    step = lambda: drained(spark, tmp_path, trailing.event_sessions(feed.stream(), by=["k"], at="at", gap="30 minutes", late="2 hours"))
    feed.add([(1, T(2024, 1, 1, 10)), (2, T(2024, 1, 1, 10)), (None, T(2024, 1, 1, 10))])
    assert step() == []
    feed.add([(1, T(2024, 1, 1, 11)), (1, T(2024, 1, 1, 10, 29)), (1, T(2024, 1, 1, 10, 40))])  # late rows join what was two series
    assert step() == []
    feed.add([(3, T(2024, 1, 2))])
    done = step()
    feed.add([(1, T(2024, 1, 1, 12)), (4, T(2024, 1, 3))])  # far too late
    assert step()[: len(done)] == done == [(1, T(2024, 1, 1, 10), T(2024, 1, 1, 11, 30), 4), (2, T(2024, 1, 1, 10), T(2024, 1, 1, 10, 30), 1)]


HOURS = [
    [("a", T(2024, 1, 1, 3, 10)), ("a", T(2024, 1, 1, 1, 5)), ("b", T(2024, 1, 1, 1)), ("a", T(2024, 1, 1, 3, 50))],
    [("a", T(2024, 1, 1, 6, 30)), ("b", T(2024, 1, 1, 7)), (None, T(2024, 1, 1, 7)), ("b", None)],
    [("a", T(2024, 1, 1, 8, 1)), ("a", T(2024, 1, 1, 7, 59))],  # late, but in time
    [("b", T(2024, 1, 1, 23)), ("a", T(2024, 1, 1, 22))],  # both were given up by then
    [("c", T(2024, 1, 2, 12))],
]


def test_gaps_by_timers_equal_the_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, "k string, at timestamp")
    more = {"by": "k", "at": "at", "expire_hours": 5, "late": "2 hours"}
    seen, before = [], []
    with rocksdb_state(spark):
        for rows in HOURS:
            feed.add(rows)
            seen += rows
            stream = gaps.stream_missing_hours(feed.stream(), **more)
            now = drained(spark, tmp_path, stream)
            assert now == drained(spark, tmp_path, stream)  # a replay adds nothing
            batch = gaps.missing_hours(spark.createDataFrame(seen, "k string, at timestamp"), **more)
            assert set(now) >= set(before)
            assert now == sorted((tuple(r) for r in batch.collect()), key=repr)
            before = now
        feed.add([("a", T(2024, 1, 1, 4)), ("d", T(2024, 1, 2, 12, 30))])  # later than the watermark: left out
        assert drained(spark, tmp_path, gaps.stream_missing_hours(feed.stream(), **more)) == now
    hours = {k: sorted(t.hour for key, t in now if key == k and t.day == 1) for k in "ab"}
    assert hours == {"a": [2, 4, 5, 9, 10, 11, 12, 13, 23], "b": [2, 3, 4, 5, 6, 8, 9, 10, 11, 12]}


class _Counted:
    """A handle with one value of state; counts what goes to the JVM and back."""

    def __init__(self):
        self.value, self.timers, self.messages = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.messages += 1
        return self.value

    def update(self, value):
        self.messages, self.value = self.messages + 1, value

    def clear(self):
        self.messages, self.value = self.messages + 1, None

    def registerTimer(self, at):
        self.messages += 1
        self.timers.append(at)


def test_gaps_cost_no_message_per_key_or_hour():
    h, n = gaps.HOUR_MS, 300
    handle, now = _Counted(), types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 201 * h)
    made = gaps._Gaps("k", LongType(), 3)
    made.init(handle)
    rows = pd.DataFrame([(k, hour * h + k) for k in range(n) for hour in range(k % 2, 200, 2)], columns=["observed_key", "observed_ms"])
    assert not list(made.handleInputRows((0,), iter([rows[1::2], rows[::2]]), now))
    assert handle.timers == [h] and handle.messages <= 3
    (spans,) = made.handleExpiredTimer((0,), now, None)
    got = {(k, t) for k, first, last in spans.itertuples(index=False) for t in range(first // h, last // h + 1)}
    assert got == {(k, t) for k in range(n) for t in (*range(k % 2 + 1, 201, 2), 200)}
    assert len(handle.value[0]) == n and handle.messages <= 6
    now.getCurrentWatermarkInMs = lambda: 210 * h
    (spans,) = made.handleExpiredTimer((0,), now, None)
    assert set(spans["__last"] // h) == {201, 202} and handle.value is None  # all keys are given up


def test_requests_with_a_deadline(spark, tmp_path):
    asked, answers = Feed(spark, tmp_path, "id int, at timestamp", "asked"), Feed(spark, tmp_path, "id int, done timestamp", "answers")
    more = {"key": "id", "requested_at": "at", "answered_at": "done", "within": "1 hour", "late": "10 minutes"}
    step = lambda: drained(spark, tmp_path, requests.answered_requests(asked.stream(), answers.stream(), **more))
    h = lambda *a: T(2024, 1, 1, *a)
    asked.add([(1, h(1)), (2, h(1)), (3, h(1)), (4, h(1, 30)), (None, h(1))])
    answers.add([(1, h(1, 20)), (3, h(0, 59)), (None, h(1, 10))])
    assert step() == [(1, h(1), h(1, 20), False)]
    answers.add([(2, h(2, 0)), (4, h(2, 31)), (1, h(1, 40))])  # on the bound, after it, a second answer
    assert set(step()) == {(1, h(1), h(1, 20), False), (1, h(1), h(1, 40), False), (2, h(1), h(2), False)}
    asked.add([(9, h(12))])
    answers.add([(9, h(12))])
    time.sleep(0.01)
    final = step()
    table = requests.answered_requests(spark.read.parquet(asked.path), spark.read.parquet(answers.path), **more)
    assert final == sorted((tuple(r) for r in table.collect()), key=repr)
    assert {r for r in final if r[3]} == {(3, h(1), None, True), (4, h(1, 30), None, True), (None, h(1), None, True)}


@pytest.mark.parametrize("slide", [None, "2 hours"])
def test_windows_in_both_modes(spark, tmp_path, slide):
    feed = Feed(spark, tmp_path, "k int, at timestamp")
    count = lambda df: ingest.windowed_counts(df, at="at", size="6 hours", slide=slide, late="1 hour", keys=("k",))
    feed.add([(1, T(2024, 1, 1, 3)), (1, T(2024, 1, 1, 5))])
    feed.add([(1, T(2024, 1, 1, 7)), (2, T(2024, 1, 3))])
    given = drained(spark, tmp_path, count(feed.stream()))
    whole = count(spark.read.parquet(feed.path)).filter(F.col("window_start") < F.lit("2024-01-02").cast("timestamp"))
    assert given == sorted((tuple(r) for r in whole.collect()), key=repr) and len(given) == (2 if slide is None else 5)
