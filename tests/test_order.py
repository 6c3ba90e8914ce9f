"""Popular keys, as-of joins, trailing windows and series, against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoloom.operators import asof, dedup, enrich, skew, trailing

T = dt.datetime


@pytest.fixture
def unmerged(spark):
    """Sixteen shuffle partitions, no broadcasts, no merging of small partitions and no splitting by size."""
    own = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def rows_per_task(df):
    counts = Counter(r.task for r in df.select(F.spark_partition_id().alias("task")).collect())
    return sorted(counts.values(), reverse=True)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# --- popular keys


@pytest.mark.parametrize("popular", [7, None])
def test_a_popular_key_is_spread(unmerged, popular):
    key = F.when(F.col("id") % 10 < 9, F.lit(popular)).otherwise(F.col("id")).cast("int")
    events = unmerged.range(6000).select("id", key.alias("k"))
    lookup = unmerged.range(6000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    out = enrich.enrich(events, lookup, {"k": "key"}, {"v": "v"}, flag="found", name="lookup")
    tasks = rows_per_task(out)
    assert sum(tasks) == 6000 and len(tasks) >= 4 and tasks[0] < 2000
    assert all((r.v, r.found) == ((r.k * 2, True) if r.k is not None else (None, False)) for r in out.collect())
    assert "BroadcastHashJoin" not in plan_of(out)
    plain = rows_per_task(events.join(lookup, events.k == lookup.key, "left"))
    assert plain[0] >= 5400  # what happens without


def test_a_fixed_number_of_pieces(unmerged):
    events = unmerged.range(4000).select("id", F.lit("x").alias("k"))
    lookup = unmerged.createDataFrame([("x", 1), ("y", 2)], "key string, v int")
    out = enrich.enrich(events, lookup, {"k": "key"}, {"v": "v"}, flag=None, name="lookup", hot=32)
    tasks = rows_per_task(out)
    assert sum(tasks) == 4000 and tasks[0] < 4000 / 3 and {r.v for r in out.collect()} == {1}


def test_guarded_lookups_are_joined_by_plain_exchanges(unmerged):
    """The check of keys is not what the join reads: Spark can split what it reads by size."""
    events, lookup = unmerged.range(100).select(F.col("id").alias("k")), unmerged.range(100).select(F.col("id").alias("key"), F.lit(1).alias("v"))
    plan = plan_of(enrich.enrich(events, lookup, {"k": "key"}, {"v": "v"}, flag=None, name="lookup"))
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in final
    for line, above in zip(final.splitlines()[1:], final.splitlines(), strict=False):
        if "Exchange" in above and "__copy" in above:
            assert "Aggregate" not in above
    with pytest.raises(Exception, match="lookup: keys are not unique"):
        enrich.enrich(events, lookup.unionByName(lookup), {"k": "key"}, {"v": "v"}, flag=None, name="lookup").collect()


def test_pieces_follow_from_the_rows(spark):
    """Wider right keys, several lookup rows per key, repeated rows and an empty left side."""
    events = spark.createDataFrame([(1, "a")] * 50 + [(2, "b"), (None, "c")], "k int, x string")
    lookup = spark.createDataFrame([(1, "p"), (1, "q"), (1 << 40, "r"), (None, "s")], "key long, v string")
    out = enrich.enrich(events, lookup, {"k": "key"}, {"v": "v"}, flag="found", name="lookup", guard=False)
    assert Counter((r.k, r.v, r.found) for r in out.collect()) == {(1, "p", True): 50, (1, "q", True): 50, (2, None, False): 1, (None, None, False): 1}
    assert enrich.enrich(events.limit(0), lookup, {"k": "key"}, {"v": "v"}, flag=None, name="lookup", guard=False).count() == 0
    once = skew.dealt(events, ["k"], skew.hot_slots(events, ["k"])).collect()
    assert sorted(map(tuple, once), key=repr) == sorted(map(tuple, skew.dealt(events.repartition(3), ["k"], skew.hot_slots(events, ["k"])).collect()), key=repr)


# --- calendars


def test_far_dates_match_the_last_release(unmerged):
    calendar = unmerged.createDataFrame([(2019, dt.date(2020, 12, 10), 2019, "a"), (2020, dt.date(2022, 3, 17), 2020, "b")], "acs_vintage int, acs_release_date date, tiger_line_year int, tract_definition_vintage string")
    days = ["2020-12-10", "2020-12-11", "2022-03-17", "2022-03-18", "9999-12-31", "+99999-01-01", "-0400-01-01", None]
    events = unmerged.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d string").select("i", F.col("d").cast("date").alias("occurred_date"))
    out = asof.attach_vintage(events, asof.calendar_ranges(calendar))
    got = {r.i: (r.selected_acs_vintage, r.tiger_line_year, r.tract_definition_vintage) for r in out.drop("occurred_date").collect()}
    none, first, second = (None, None, None), (2019, 2019, "a"), (2020, 2020, "b")
    assert [got[i] for i in range(8)] == [none, first, first, second, second, second, none, none]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    many = unmerged.range(200).select(F.col("id").cast("int").alias("acs_vintage"), F.date_add(F.lit("1000-01-01").cast("date"), (F.col("id") * 1500).cast("int")).alias("acs_release_date"), F.lit(1).alias("tiger_line_year"), F.lit("x").alias("tract_definition_vintage"))
    releases = [(r.acs_vintage, r.acs_release_date) for r in many.collect()]
    asked = unmerged.createDataFrame([(dt.date(1000, 1, 1) + dt.timedelta(days=n),) for n in range(0, 310_000, 977)], "occurred_date date")
    for r in asof.attach_vintage(asked, asof.calendar_ranges(many)).collect():
        assert r.selected_acs_vintage == max((v for v, d in releases if d < r.occurred_date), default=None)
    assert {r.selected_acs_vintage for r in asof.attach_vintage(asked, asof.calendar_ranges(many).limit(0)).collect()} == {None}


# --- as-of joins


def made(seed, n, keys=4, hot=0.7):
    """(id, key, time) rows; most of them on one key, times to the minute with ties."""
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.05 else 0 if rng.random() < hot else rng.randrange(keys), None if rng.random() < 0.05 else T(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(6 * 1440))) for i in range(n)]


@pytest.mark.parametrize("strictly", [False, True])
@pytest.mark.parametrize("tolerance", [None, 90])
def test_asof_join_like_brute_force(spark, strictly, tolerance):
    events, seen = made(1, 600), made(2, 250)
    left = spark.createDataFrame(events, "i long, k int, at timestamp")
    right = spark.createDataFrame(seen, "v long, k int, at timestamp").withColumnRenamed("k", "key")
    out = asof.asof_join(left, right, by={"k": "key"}, at="at", observed_at="at", attributes={"v": "seen", "at": "seen_at"}, tolerance=tolerance and f"{tolerance} minutes", strictly=strictly, flag="found", cut="6 hours")
    got = {r.i: (r.seen, r.seen_at, r.found) for r in out.collect()}
    assert len(got) == 600 and out.count() == 600
    for i, k, at in events:
        fits = [(t, v) for v, key, t in seen if None not in (k, at, key, t) and key == k and (t < at or (t == at and not strictly)) and (tolerance is None or at - t <= dt.timedelta(minutes=tolerance))]
        best = max(fits, default=None)
        assert got[i] == ((best[1], best[0], True) if best else (None, None, False)), i


def test_asof_join_compares_no_ranges_and_broadcasts_nothing(unmerged):
    left = unmerged.createDataFrame(made(3, 2000, hot=0.9), "i long, k int, at timestamp")
    right = unmerged.createDataFrame(made(4, 500, hot=0.9), "v long, k int, at timestamp")
    out = asof.asof_join(left, right, by={"k": "k"}, at="at", observed_at="at", attributes={"v": "seen"})
    plan = plan_of(out)
    assert "Broadcast" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    tasks = rows_per_task(out)
    assert sum(tasks) == 2000 and tasks[0] < 2000 / 3
    assert asof.asof_join(left, right.limit(0), by={"k": "k"}, at="at", observed_at="at", attributes={"v": "seen"}).filter("seen IS NOT NULL").count() == 0


# --- trailing counts


def test_trailing_counts_like_brute_force_and_without_leakage(spark):
    rows = made(5, 500)
    df = spark.createDataFrame(rows, "i long, k int, at timestamp").withColumn("day", F.lit("replaced"))
    spans = {"hour": ("1 hour", dt.timedelta(hours=1)), "day": ("1 day", dt.timedelta(days=1)), "month": ("30 days", dt.timedelta(days=30))}
    count = lambda d: {r.i: tuple(r[s] for s in spans) for r in trailing.trailing_counts(d, by=["k"], at="at", spans={s: text for s, (text, _) in spans.items()}, cut="6 hours").collect()}
    got = count(df)
    assert len(got) == 500
    for i, k, at in rows:
        plain = tuple(None if k is None or at is None else sum(1 for _, key, t in rows if key == k and t is not None and at - length <= t < at) for _, length in spans.values())
        assert got[i] == plain, i
    cut = T(2024, 1, 4)  # what happens from here on changes nothing before
    before = count(df.filter(F.col("at") < F.lit(cut)))
    assert all(got[i] == counts for i, counts in before.items()) and len(before) > 100


def test_a_popular_cell_is_cut_by_time(unmerged):
    events = unmerged.range(20_000).select("id", F.lit(5).alias("k"), F.timestamp_seconds(F.col("id") * 120).alias("at"))
    out = trailing.trailing_counts(events, by=["k"], at="at", spans={"day": "1 day"}, cut="1 day")
    assert rows_per_task(out)[0] < 20_000 / 3
    assert {r.id: r.day for r in out.collect()} == {i: min(i, 720) for i in range(20_000)}


# --- series


def plain_series(rows, gap):
    out = Counter()
    for key in {k for _, k, t in rows if k is not None and t is not None}:
        times = sorted(t for _, k, t in rows if k == key and t is not None)
        start = last = times[0]
        n = 0
        for t in [*times, None]:
            if t is None or t >= last + gap:
                out[key, start, last + gap, n] += 1
                start, n = t, 0
            last, n = t, n + 1
    return out


@pytest.mark.parametrize("minutes", [1, 20, 300, 3000])
def test_sessions_like_plain_python(spark, minutes):
    rows = made(6, 400)
    df = spark.createDataFrame(rows, "i long, user int, at timestamp")
    got = trailing.event_sessions(df, by=["user"], at="at", gap=f"{minutes} minutes", cut="6 hours").collect()
    assert Counter((r.user, r.session_start, r.session_end, r.event_count) for r in got) == plain_series(rows, dt.timedelta(minutes=minutes))
    assert trailing.event_sessions(df.limit(0), by=["user"], at="at", gap="1 hour").count() == 0


def test_identities_stay_guarded(spark):
    with pytest.raises(ValueError, match="not unique"):
        dedup.guard_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], name="x")
