"""Registered queries over the order of events: as-of joins, trailing windows, series, gaps, deadlines.

Streams read the same rows from files in the shared folder and are drained, so a table and a stream
are held against the same SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..operators import asof, trailing
from ..sources.scratch import fresh_path
from ..streaming import gaps, ingest, requests
from . import catalog as base
from .registry import ntz, query, table


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.with_cell(base._located(spark, sf_dir))


def _shown(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: ntz(t) for t in times})


def _streamed(df: DataFrame, name: str) -> DataFrame:
    """The rows as a stream of files."""
    path = fresh_path(df.sparkSession, f"{name}-in")
    df.write.parquet(path)
    return ingest.stream_table(df.sparkSession, path, df.schema)


def _drained(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    path = fresh_path(spark, f"{name}-out")
    ingest.drain_to(stream, path, fresh_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB; the setting is put back after."""
    key, own = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, own)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _newest(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()


# --- as-of joins

_OBSERVED = f"SELECT event_id, CASE WHEN e.ts - w.h <= INTERVAL 6 HOUR THEN w.h END AS weather_observed_at, CASE WHEN e.ts - w.h <= INTERVAL 6 HOUR THEN w.t END AS temperature_2m_c FROM ({base._CELLS}) e ASOF LEFT JOIN ({base._WEATHER}) w ON e.weather_query_cell_id = w.weather_query_cell_id AND e.ts >= w.h"


@query(f"SELECT *, weather_observed_at IS NOT NULL AS weather_match_found FROM ({_OBSERVED})")
def asof_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last observation in an event's cell, up to six hours old."""
    found = asof.attach_nearest_weather(_placed(spark, sf_dir), base._weather_table(spark, sf_dir), tolerance="6 hours")
    return _shown(found.select("event_id", "weather_observed_at", "temperature_2m_c", "weather_match_found"), "weather_observed_at")


@query(
    """SELECT l_orderkey, l_linenumber, k AS previous_orderkey, d AS previous_orderdate FROM (SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey) o
    ASOF LEFT JOIN (SELECT o_custkey AS c, o_orderdate AS d, max(o_orderkey) AS k FROM orders GROUP BY ALL) p ON p.c = o.o_custkey AND o.o_orderdate > p.d"""
)
def previous_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each line of an order, the customer's order before it: strictly earlier, whatever its age."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "left")
    found = asof.asof_join(lines, orders, by={"o_custkey": "o_custkey"}, at="o_orderdate", observed_at="o_orderdate", attributes={"o_orderkey": "previous_orderkey", "o_orderdate": "previous_orderdate"}, strictly=True, cut="30 days")
    return found.select("l_orderkey", "l_linenumber", "previous_orderkey", "previous_orderdate")


# --- trailing windows

_SPANS = {"events_1h": "1 hour", "events_7d": "7 days", "events_30d": "30 days"}


@query(
    "SELECT event_id, "
    + ", ".join(f"count(*) OVER (PARTITION BY weather_query_cell_id ORDER BY ts RANGE BETWEEN INTERVAL {span} PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS {name}" for name, span in _SPANS.items())
    + f" FROM ({base._CELLS})"
)
def recent_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier events of an event's cell over three spans."""
    return trailing.trailing_counts(_placed(spark, sf_dir), by=["weather_query_cell_id"], at="occurred_at", spans=_SPANS).select("event_id", *_SPANS)


# --- series and sliding windows

_SESSIONS = """WITH b AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
  s AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS n FROM b)
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS event_count FROM s GROUP BY user_id, n"""


@query(_SESSIONS)
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _shown(trailing.event_sessions(events, by=["user_id"], at="ts", gap="6 hours"), "session_start", "session_end")


@query(f"SELECT * FROM ({_SESSIONS}) WHERE session_end <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)")
def event_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same series from a stream; those that ended a day before the last event are final."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    found = _drained(trailing.event_sessions(_streamed(events, "sessions"), by=["user_id"], at="ts", gap="6 hours"), "sessions")
    return _shown(found.filter(F.col("session_end") <= _newest(spark, sf_dir) - F.expr("interval 1 day")), "session_start", "session_end")


_SLIDING = "SELECT time_bucket(INTERVAL 2 HOUR, ts) - to_hours(2 * unnest([0, 1, 2])) AS window_start, event_type FROM events"


@query(f"SELECT window_start, event_type, count(*) AS count FROM ({_SLIDING}) GROUP BY ALL")
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _shown(ingest.windowed_counts(events, at="ts", size="6 hours", slide="2 hours", late="1 hour", keys=("event_type",)), "window_start")


@query(f"SELECT window_start, event_type, count(*) AS count FROM ({_SLIDING}) GROUP BY ALL HAVING window_start <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)")
def sliding_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    found = _drained(ingest.windowed_counts(_streamed(events, "sliding"), at="ts", size="6 hours", slide="2 hours", late="1 hour", keys=("event_type",)), "sliding")
    return _shown(found.filter(F.col("window_start") <= _newest(spark, sf_dir) - F.expr("interval 1 day")), "window_start")


# --- gaps

_MISSING = """WITH h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events WHERE user_id IS NOT NULL),
  c AS (SELECT date_trunc('hour', max(ts) - INTERVAL 1 HOUR) - INTERVAL 1 HOUR AS closed FROM events),
  u AS (SELECT user_id, h, least(coalesce(lead(h) OVER (PARTITION BY user_id ORDER BY h) - INTERVAL 1 HOUR, closed), closed, h + INTERVAL 12 HOUR) AS upto FROM h, c)
  SELECT user_id, unnest(generate_series(h + INTERVAL 1 HOUR, upto, INTERVAL 1 HOUR)) AS missing_hour FROM u WHERE upto > h"""


@query(_MISSING)
def missing_observation_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that an observing user skipped, up to twelve after each one seen."""
    return _shown(gaps.missing_hours(table(spark, sf_dir, "events"), by="user_id", at="ts", expire_hours=12), "missing_hour")


@query(_MISSING)
def missing_observation_hours_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hours from keyed state whose timers fire as the watermark passes."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    with rocksdb_state(spark):
        found = _drained(gaps.stream_missing_hours(_streamed(events, "gaps"), by="user_id", at="ts", expire_hours=12), "gaps")
    return _shown(found, "missing_hour")


# --- deadlines


def _asked_and_answered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A request per event; two of three are answered, some too late."""
    asked = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("requested_at"))
    delay = F.make_dt_interval(mins=(F.col("event_id") % 5 * 20).cast("int"))
    return asked, asked.filter("event_id % 3 <> 0").select("event_id", (F.col("requested_at") + delay).alias("answered_at"))


_ANSWERED = "SELECT event_id, ts AS requested_at, CASE WHEN event_id % 3 <> 0 AND event_id % 5 <= 3 THEN ts + to_minutes(20 * (event_id % 5)) END AS answered_at, NOT (event_id % 3 <> 0 AND event_id % 5 <= 3) AS overdue FROM events"


@query(_ANSWERED)
def answered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, answers = _asked_and_answered(spark, sf_dir)
    return _shown(requests.answered_requests(asked, answers, key="event_id", requested_at="requested_at", answered_at="answered_at", within="1 hour"), "requested_at", "answered_at")


@query(f"SELECT * FROM ({_ANSWERED}) WHERE requested_at <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)")
def answered_requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two streams; requests a day before the last one are decided."""
    asked, answers = (_streamed(df, name) for df, name in zip(_asked_and_answered(spark, sf_dir), ("requests", "responses"), strict=True))
    found = _drained(requests.answered_requests(asked, answers, key="event_id", requested_at="requested_at", answered_at="answered_at", within="1 hour"), "answered")
    return _shown(found.filter(F.col("requested_at") <= _newest(spark, sf_dir) - F.expr("interval 1 day")), "requested_at", "answered_at")
