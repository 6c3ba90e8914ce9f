"""Hours that an observation stream skipped, found by keyed state with timers, or in one batch."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
#: Stands for the end of waiting of a key none of whose hours was judged yet.
UNJUDGED = -1
#: Groups that the keys of a stream are dealt over; fixed for the life of its checkpoint.
KEY_GROUPS = 4096


def missing_hours(observations: DataFrame, *, by: str, at: str, expire_hours: int = 48, late: str = "1 hour") -> DataFrame:
    """(by, missing_hour): hours without an observation that follow an hour with one.

    After each observed hour the next expire_hours hours are expected; a key that is silent for
    longer is given up until it is observed again. An hour is judged once the time late behind the
    newest observation of all keys has passed its end. Repeated observations count once; a null key
    or time is left out. Keys have at most one row an hour here, so a key is a small window.
    """
    seen = observations.select(by, F.date_trunc("hour", F.col(at).cast("timestamp")).alias("__hour")).na.drop().distinct()
    newest = observations.agg(F.max(F.col(at).cast("timestamp"))).scalar()
    closed = F.date_trunc("hour", newest - F.expr(f"interval {late}")) - F.expr("interval 1 hour")  # the last hour that is over
    hour = F.expr("interval 1 hour")
    following = F.lead("__hour").over(Window.partitionBy(by).orderBy("__hour")) - hour
    upto = F.least(F.coalesce(following, closed), closed, F.col("__hour") + F.expr(f"interval {expire_hours} hours"))
    spans = seen.withColumn("__upto", upto).filter(F.col("__upto") > F.col("__hour"))
    return spans.select(by, F.explode(F.sequence(F.col("__hour") + hour, F.col("__upto"), hour)).alias("missing_hour"))


class _Gaps(StatefulProcessor):
    """Per key: the next hour to judge, how long the key is still waited for, and hours seen beyond.

    Each access of the state, each timer and each frame is a message between Python and the JVM, so
    keys share a group's: all that its keys wait for is one value, read and written once per call,
    and one timer stands at the end of the earliest next hour. When the watermark has passed it, all
    hours that are over are judged and the timer moves on. A key that is given up leaves the state, a
    group without keys leaves none. Skipped hours are given out as spans.
    """

    def __init__(self, by: str, key_type: T.DataType, expire_hours: int) -> None:
        self.by, self.key_type, self.expire = by, key_type, expire_hours * HOUR_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = {"keys": self.key_type, "next": T.LongType(), "until": T.LongType(), "ahead": T.ArrayType(T.LongType())}
        self.state = handle.getValueState("gaps", T.StructType([T.StructField(n, T.ArrayType(k)) for n, k in kinds.items()]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        seen: dict[Any, set[int]] = {}
        for part in rows:
            hours = part["observed_ms"] // HOUR_MS * HOUR_MS
            for k, hour in zip(part["observed_key"].tolist(), hours.tolist(), strict=True):
                seen.setdefault(_hashed(k), set()).add(hour)
        waiting = self._waiting()
        for k, hours in seen.items():
            following, until, ahead = waiting.get(k, (min(hours), UNJUDGED, ()))
            if until == UNJUDGED:  # rows may come in any order until the first hour is over
                following = min(following, *hours)
            waiting[k] = following, until, sorted(hours.union(ahead))
        self._wait(waiting)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        waiting, skipped = {}, []
        over = timerValues.getCurrentWatermarkInMs() // HOUR_MS * HOUR_MS  # hours before this one are over
        for k, (following, until, ahead) in self._waiting().items():
            judged = bisect_left(ahead, over)
            for hour in ahead[:judged]:
                skipped.append((k, following, min(until, hour - HOUR_MS)))
                following, until = hour + HOUR_MS, hour + self.expire
            skipped.append((k, following, min(until, over - HOUR_MS)))
            if judged < len(ahead) or until >= over:
                waiting[k] = max(following, over), until, ahead[judged:]
        self._wait(waiting)
        skipped = [span for span in skipped if span[1] <= span[2]]
        if skipped:
            yield pd.DataFrame(skipped, columns=[self.by, "__first", "__last"])

    def _waiting(self) -> dict[Any, tuple[int, int, list[int]]]:
        return {_hashed(k): kept for k, *kept in zip(*(self.state.get() or ()), strict=True)}

    def _wait(self, waiting: dict[Any, tuple[int, int, list[int]]]) -> None:
        if waiting:
            self.state.update((list(waiting), *(list(part) for part in zip(*waiting.values(), strict=True))))
            self.handle.registerTimer(min(following for following, _, _ in waiting.values()) + HOUR_MS)
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def _hashed(key: Any) -> Any:
    """The key itself; all NaN are one object, and so one key."""
    return key if key == key else math.nan


def stream_missing_hours(observations: DataFrame, *, by: str, at: str, expire_hours: int = 48, late: str = "1 hour") -> DataFrame:
    """The same hours as missing_hours(), from a stream, given out when the watermark has passed them.

    Observations later than the watermark are left out; those within it fill their hour. Needs a
    state store with column families, such as RocksDB. State of a key that is given up is dropped.
    Keys are dealt by hash over KEY_GROUPS groups, whose state is kept as a whole.
    """
    key_type = observations.schema[by].dataType
    named = observations.select(F.col(by).alias("observed_key"), F.col(at).cast("timestamp").alias("observed_at")).na.drop()
    rows = named.withWatermark("observed_at", late).withColumns({"observed_ms": F.unix_millis("observed_at"), "key_group": F.pmod(F.xxhash64("observed_key"), F.lit(KEY_GROUPS))})
    schema = T.StructType([T.StructField(by, key_type), T.StructField("__first", T.LongType()), T.StructField("__last", T.LongType())])
    spans = rows.groupBy("key_group").transformWithStateInPandas(statefulProcessor=_Gaps(by, key_type, expire_hours), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    hours = spans.select(by, F.explode(F.sequence("__first", "__last", F.lit(HOUR_MS))).alias("__ms"))
    return hours.select(by, F.timestamp_millis("__ms").alias("missing_hour"))
