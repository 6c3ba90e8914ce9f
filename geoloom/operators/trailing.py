"""Features of what happened before an event: trailing counts, and series of events by gap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from .enrich import enrich
from .ordered import bucket, carried, micros, summed_before

#: Sorts before any time; the place of what a bucket takes over from earlier ones.
_OPENING = -(1 << 62)


def trailing_counts(events: DataFrame, *, by: Sequence[str], at: str, spans: Mapping[str, str], cut: str = "1 day") -> DataFrame:
    """Add, per span (new column: interval), how many events of the same keys came in that span
    before each event.

    The span begins span before the event and ends just before it: neither the event itself nor
    others of the same instant count, and nothing later does. Rows with a null key or time count
    nowhere and get null. Columns of events named as in spans are replaced.

    Events are reduced to counts per instant before they are shuffled. A count is the difference of
    two prefix sums, at the event and where its span begins, and prefix sums are kept per bucket of
    length cut and carried over, so a popular key is cut by time and a long span costs as much as a
    short one.
    """
    keys = [f"__by_{i}" for i in range(len(by))]
    require_columns(events, [*by, at], context="trailing counts")
    df = events.drop(*spans)
    instants = df.select(*(F.col(b).alias(k) for b, k in zip(by, keys, strict=True)), F.col(at).alias("__at")).na.drop().groupBy(*keys, "__at").agg(F.count(F.lit(1)).alias("__n"))
    own = F.struct(F.lit(-1).alias("span"), F.col("__at").alias("at"), F.col("__n").alias("n"))
    begins = [F.struct(F.lit(i).alias("span"), (F.col("__at") - F.expr(f"interval {span}")).alias("at"), F.lit(0).cast("long").alias("n")) for i, span in enumerate(spans.values())]
    points = instants.select(*keys, "__at", F.explode(F.array(own, *begins)).alias("p"))
    points = points.select(*keys, F.col("__at").alias("__event"), "p.span", bucket("p.at", cut).alias("__bucket"), micros("p.at").alias("__micros"), F.col("p.n").alias("__n"))
    opening = summed_before(points, keys, {"__n": F.col("__n")}).withColumn("__micros", F.lit(_OPENING))
    before = Window.partitionBy(*keys, "__bucket").orderBy("__micros").rangeBetween(Window.unboundedPreceding, -1)
    prefix = points.unionByName(opening, allowMissingColumns=True).withColumn("__prefix", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    at_span = lambda i: F.max(F.when(F.col("span") == i, F.col("__prefix")))
    counts = prefix.filter("span IS NOT NULL").groupBy(*keys, "__event").agg(*((at_span(-1) - at_span(i)).alias(f"__count_{i}") for i in range(len(spans))))
    return enrich(df, counts, {**dict(zip(by, keys, strict=True)), at: "__event"}, {f"__count_{i}": name for i, name in enumerate(spans)}, flag=None, name="trailing counts", guard=False)


def event_sessions(events: DataFrame, *, by: Sequence[str], at: str, gap: str, late: str = "1 hour", cut: str = "1 day") -> DataFrame:
    """Series of events of the same keys in which each comes less than gap after the one before.

    Returns the keys, session_start (first event), session_end (last event plus gap) and event_count.
    Rows with a null key or time belong to no series.

    On a stream these are Spark's session windows, final once the watermark, late behind the newest
    event, has passed their end. On a table, events are reduced to counts per instant first, and
    gaps are looked for per bucket of length cut with the last instant of earlier buckets carried
    over, so that a popular key is no single task's work.
    """
    require_columns(events, [*by, at], context="sessions")
    given = events.filter(F.col(at).isNotNull()).na.drop(subset=list(by))
    if events.isStreaming:
        windows = given.withWatermark(at, late).groupBy(*by, F.session_window(at, gap).alias("__session"))
        return windows.agg(F.count(F.lit(1)).alias("event_count")).select(*by, F.col("__session.start").alias("session_start"), F.col("__session.end").alias("session_end"), "event_count")
    keys, length = list(by), F.expr(f"interval {gap}")
    instants = given.groupBy(*keys, F.col(at).alias("__at")).agg(F.count(F.lit(1)).alias("__n")).withColumn("__bucket", bucket("__at", cut))
    in_bucket = Window.partitionBy(*keys, "__bucket").orderBy("__at")
    last = carried(instants, keys, {"__at": F.max("__at")}).filter(F.col("__at").isNotNull())  # earlier than all in its bucket
    previous = F.lag("__at").over(in_bucket)
    begun = instants.unionByName(last, allowMissingColumns=True).withColumn("__start", F.when(previous.isNull() | (F.col("__at") >= previous + length), F.col("__at"))).filter(F.col("__n").isNotNull())
    opening = carried(begun, keys, {"__start": F.max("__start")}).filter(F.col("__start").isNotNull())
    started = F.last("__start", ignorenulls=True).over(Window.partitionBy(*keys, "__bucket").orderBy(F.asc_nulls_first("__at")).rowsBetween(Window.unboundedPreceding, 0))
    series = begun.unionByName(opening, allowMissingColumns=True).withColumn("session_start", started).filter(F.col("__n").isNotNull())
    return series.groupBy(*keys, "session_start").agg((F.max("__at") + length).alias("session_end"), F.sum("__n").alias("event_count"))
