"""Which requests were answered in time: a join of two streams, or of two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answered_requests(requests: DataFrame, responses: DataFrame, *, key: str, requested_at: str, answered_at: str, within: str, late: str = "10 minutes") -> DataFrame:
    """Every request with each response of its key that came within the bound, or overdue without one.

    Columns: those of requests, answered_at and overdue. A response before its request, after the
    bound, or without a key or time answers nothing. A request that is answered twice has two rows; a
    request without a time is overdue on a table and never gets into a stream's result.

    On streams both sides keep rows only as long as a partner may still come: watermarks stand late
    behind each side's newest time, and a request is given out as overdue once no response in time
    can come any more.
    """
    asked = requests.withWatermark(requested_at, late)
    answers = responses.select(F.col(key).alias("__key"), F.col(answered_at).alias("__answered")).withWatermark("__answered", late)
    in_time = (F.col("__answered") >= F.col(requested_at)) & (F.col("__answered") <= F.col(requested_at) + F.expr(f"interval {within}"))
    joined = asked.join(answers, (F.col(key) == F.col("__key")) & in_time, "left_outer")
    return joined.select(*requests.columns, F.col("__answered").alias("answered_at"), F.col("__answered").isNull().alias("overdue"))
