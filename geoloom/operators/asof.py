"""Release calendars and leakage-free as-of joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import require_columns, sorted_place
from .enrich import enrich
from .ordered import bucket, carried

#: Releases of a calendar, at most: one a year. They become literals of an expression.
MOST_RELEASES = 1000


def calendar_ranges(calendar: DataFrame) -> DataFrame:
    """When each vintage is the newest one known: from the day after its release to the next release.

    The last range is open. Null vintages or dates, repeated ones, vintages that do not rise with the
    release date, and more than MOST_RELEASES rows are errors. The calendar is read once.
    """
    rows = calendar.limit(MOST_RELEASES + 1).collect()
    if len(rows) > MOST_RELEASES:
        raise ValueError(f"calendar: more than {MOST_RELEASES} releases")
    if any(r["acs_vintage"] is None or r["acs_release_date"] is None for r in rows):
        raise ValueError("calendar: null vintage or release date")
    rows.sort(key=lambda r: r["acs_release_date"])
    for name in ("acs_vintage", "acs_release_date"):
        if len({r[name] for r in rows}) < len(rows):
            raise ValueError(f"calendar: keys {name} are not unique")
    if any(a["acs_vintage"] >= b["acs_vintage"] for a, b in zip(rows, rows[1:], strict=False)):
        raise ValueError("calendar: vintages must rise with their release dates")
    checked = calendar.sparkSession.createDataFrame(rows, calendar.schema)
    order = Window.orderBy("acs_release_date")
    return checked.withColumns({"eligible_start_date": F.date_add("acs_release_date", 1), "eligible_end_date": F.lead("acs_release_date").over(order)})


def attach_vintage(events: DataFrame, ranges: DataFrame, *, day: str = "occurred_date") -> DataFrame:
    """The vintage eligible on each event's day, left outer: selected_acs_vintage and release date.

    The ranges, at most MOST_RELEASES of a calendar, become a sorted array of literals that each
    event is looked up in, so events are neither joined nor moved, and their days are not read
    beforehand. A day before the first release, or a null day, matches nothing; any day after the
    last release matches that. Ranges don't overlap, so no event is doubled.
    """
    rows = sorted(ranges.limit(MOST_RELEASES + 1).collect(), key=lambda r: r["eligible_start_date"])
    if len(rows) > MOST_RELEASES:
        raise ValueError(f"ranges: more than {MOST_RELEASES}")
    names = {"acs_vintage": "selected_acs_vintage", "acs_release_date": "selected_acs_release_date", "tiger_line_year": "tiger_line_year", "tract_definition_vintage": "tract_definition_vintage"}
    kinds = {n: ranges.schema[n].dataType for n in (*names, "eligible_end_date")}
    if not rows:
        return events.withColumns({new: F.lit(None).cast(kinds[old]) for old, new in names.items()})
    listed = F.array(*(F.struct(*(F.lit(r[n]).cast(kind).alias(n) for n, kind in kinds.items())) for r in rows))
    place = sorted_place(F.col(day), [r["eligible_start_date"] for r in rows])
    found = events.withColumn("__range", F.get(listed, place - 1))
    open_or_in = F.col("__range.eligible_end_date").isNull() | (F.col(day) <= F.col("__range.eligible_end_date"))
    return found.withColumns({new: F.when(open_or_in, F.col(f"__range.{old}")) for old, new in names.items()}).drop("__range")


def asof_join(df: DataFrame, observations: DataFrame, *, by: Mapping[str, str], at: str, observed_at: str, attributes: Mapping[str, str], tolerance: str | None = None, strictly: bool = False, flag: str | None = None, cut: str = "1 day") -> DataFrame:
    """The latest observation of the same keys at or before each row's time, left outer.

    by: df column: observation column. attributes: observation column: new name. tolerance, an
    interval as text, is how old an observation may be; strictly leaves out those of the same time.
    Of several observations of one key and time the one with the largest attributes counts, in their
    order. A null key or time matches nothing.

    Both sides are reduced to distinct keys and times before they are shuffled, then put in one order
    per key and bucket of length cut, and each bucket gets the last observation of earlier ones. A
    task works on one bucket of one key: a popular key is cut by time. The result comes back to the
    rows by an equality join that deals popular keys, so nothing is broadcast and nothing compares
    ranges.
    """
    require_columns(df, [*by, at], context="as-of join")
    require_columns(observations, [*by.values(), observed_at, *attributes], context="observations")
    keys = {left: f"__by_{i}" for i, left in enumerate(by)}
    own = list(keys.values())
    asked = df.select(*(F.col(left).alias(k) for left, k in keys.items()), F.col(at).alias("__at")).na.drop().distinct()
    seen = observations.select(*(F.col(right).alias(keys[left]) for left, right in by.items()), F.col(observed_at).alias("__at"), F.struct(*(F.col(a).alias(b) for a, b in attributes.items())).alias("__value")).na.drop(subset=[*own, "__at"])
    seen = seen.groupBy(*own, "__at").agg(F.max("__value").alias("__value")).withColumn("__seen", F.struct(F.col("__at").alias("at"), F.col("__value").alias("value"))).drop("__value")
    rows = seen.withColumn("__turn", F.lit(2 if strictly else 0)).unionByName(asked.withColumn("__turn", F.lit(1)), allowMissingColumns=True).withColumn("__bucket", bucket("__at", cut))
    before = carried(rows, own, {"__seen": F.max_by("__seen", F.when(F.col("__seen").isNotNull(), F.col("__at")))})
    opening = before.filter(F.col("__seen").isNotNull()).withColumn("__turn", F.lit(0))  # without a time: first of its bucket
    order = Window.partitionBy(*own, "__bucket").orderBy(F.asc_nulls_first("__at"), "__turn").rowsBetween(Window.unboundedPreceding, 0)
    latest = rows.unionByName(opening, allowMissingColumns=True).withColumn("__seen", F.last("__seen", ignorenulls=True).over(order))
    answers = latest.filter((F.col("__turn") == 1) & F.col("__seen").isNotNull())
    if tolerance is not None:
        answers = answers.filter(F.col("__seen.at") >= F.col("__at") - F.expr(f"interval {tolerance}"))
    found = answers.select(*own, "__at", *(F.col(f"__seen.value.{b}").alias(f"__new_{i}") for i, b in enumerate(attributes.values())))
    return enrich(df, found, {**keys, at: "__at"}, {f"__new_{i}": b for i, b in enumerate(attributes.values())}, flag=flag, name="as-of join", guard=False)


def attach_nearest_weather(df: DataFrame, lookup: DataFrame, *, tolerance: str = "3 hours") -> DataFrame:
    """The last weather at or before an event in its cell, up to tolerance old, with its own hour."""
    names = {"weather_timestamp": "weather_observed_at", "provider": "weather_provider", "model": "weather_model", "h3_resolution": "weather_h3_resolution", "request_id": "weather_request_id", "source_row_hash": "weather_source_row_hash", "temperature_2m_c": "temperature_2m_c", "grid_elevation": "grid_elevation"}
    return asof_join(df, lookup, by={"weather_query_cell_id": "weather_query_cell_id"}, at="occurred_at", observed_at="weather_timestamp", attributes=names, tolerance=tolerance, flag="weather_match_found")
