"""Registered queries over whole tables: coverage at many grains, mergeable metrics, snapshots, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..operators import profile, reconcile
from ..sources import layout
from ..sources.scratch import fresh_path
from . import catalog as base
from .registry import ntz, query, table

# --- coverage

_MATCHED = {"priority": "o_orderpriority IN ('1-URGENT', '2-HIGH')", "finished": "o_orderstatus = 'F'", "large": "o_totalprice > 150000"}
_GRAINS = {"all": (), "year": ("order_year",), "segment": ("c_mktsegment",), "year_and_segment": ("order_year", "c_mktsegment")}
_ORDERS = "SELECT year(o_orderdate)::INTEGER AS order_year, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment, o_orderpriority, o_orderstatus, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"
_COVERAGE = f"""SELECT CASE grouping_id(order_year, c_mktsegment) WHEN 3 THEN 'all' WHEN 1 THEN 'year' WHEN 2 THEN 'segment' ELSE 'year_and_segment' END AS grain, order_year, c_mktsegment, count(*) AS row_count,
  {", ".join(f"count(*) FILTER (WHERE {p}) AS {n}_count, round(count(*) FILTER (WHERE {p}) / count(*), 8) AS {n}_rate" for n, p in _MATCHED.items())}
  FROM ({_ORDERS}) GROUP BY GROUPING SETS ((), (order_year), (c_mktsegment), (order_year, c_mktsegment))"""


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn("order_year", F.year("o_orderdate"))
    return profile.coverage_by_grain(orders, {n: F.expr(p) for n, p in _MATCHED.items()}, _GRAINS)


@query(_COVERAGE)
def coverage_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four grains from one scan; a segment that is null is a group and no subtotal."""
    return _coverage(spark, sf_dir)


_SEGMENTS = ("AUTOMOBILE", "FURNITURE", "MACHINERY")


@query(f"SELECT order_year, {', '.join(f'max(finished_rate) FILTER (WHERE c_mktsegment = {s!r}) AS {s}' for s in _SEGMENTS)} FROM ({_COVERAGE}) WHERE grain = 'year_and_segment' GROUP BY order_year")
def coverage_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = _coverage(spark, sf_dir).filter("grain = 'year_and_segment'")
    return profile.pivoted(fine, rows="order_year", columns="c_mktsegment", values=_SEGMENTS, measure="finished_rate")


# --- mergeable metrics

@query(
    """SELECT event_type, count(*) AS row_count, true AS distinct_close, true AS median_close, true AS p95_close FROM events GROUP BY event_type"""
)
def merged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per day and type, merged to types: within their bounds of the exact values."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    path = fresh_path(spark, "daily-sketches")
    profile.sketched(events, ["day", "event_type"], distinct=["user_id"], quantiles=["value"]).write.parquet(path)
    read = profile.read_metrics(profile.merged(spark.read.parquet(path), ["event_type"]))
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    both = events.join(read, "event_type").groupBy("event_type").agg(*(F.avg((F.col("value") <= F.col(f"value_{p}")).cast("double")).alias(p) for p in ("p50", "p95"))).join(exact, "event_type").join(read, "event_type")
    return both.select("event_type", "row_count", (F.abs(F.col("user_id_distinct") - F.col("users")) <= 0.03 * F.col("users")).alias("distinct_close"), (F.abs(F.col("p50") - 0.5) <= 0.02).alias("median_close"), (F.abs(F.col("p95") - 0.95) <= 0.02).alias("p95_close"))


# --- snapshots


def _next_orders(orders: DataFrame) -> DataFrame:
    """Some orders gone, some changed in one or two columns, some to or from null, some new."""
    n = F.col("o_orderkey")
    changed = orders.filter(n % 13 != 0).withColumns({"o_orderstatus": F.when(n % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")), "o_totalprice": F.when(n % 7 != 0, F.col("o_totalprice"))})
    return changed.unionByName(orders.filter(n % 17 == 0).withColumn("o_orderkey", n + 10_000_000))


@query(
    """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'removed' ELSE 'changed' END AS change, list_filter([CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus <> 'X' THEN 'o_orderstatus' END, CASE WHEN o_orderkey % 7 = 0 AND o_totalprice IS NOT NULL THEN 'o_totalprice' END], lambda x: x IS NOT NULL) AS names FROM orders)
    SELECT o_orderkey, change, CASE WHEN change = 'changed' THEN names ELSE [] END AS changed_columns FROM c WHERE change = 'removed' OR len(names) > 0
    UNION ALL SELECT o_orderkey + 10000000, 'added', [] FROM orders WHERE o_orderkey % 17 = 0"""
)
def reconciled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return reconcile.reconcile(orders, _next_orders(orders), ["o_orderkey"])


@query(
    """WITH b AS (SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem), a AS (SELECT l_suppkey, CASE WHEN l_orderkey % 11 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey % 19 <> 0)
    SELECT l_suppkey, l_returnflag, l_linestatus, sum(n)::BIGINT AS row_difference FROM (SELECT *, 1 AS n FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL HAVING sum(n) <> 0"""
)
def multiset_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key, each with how many more of it there are."""
    lines = table(spark, sf_dir, "lineitem")
    columns = ("l_suppkey", "l_returnflag", "l_linestatus")
    after = lines.filter("l_orderkey % 19 <> 0").withColumn("l_returnflag", F.when(F.col("l_orderkey") % 11 == 0, F.lit("X")).otherwise(F.col("l_returnflag")))
    return reconcile.multiset_difference(lines.select(*columns), after.select(*columns))


# --- layout


@query(f"SELECT event_id, weather_query_cell_id, ts FROM ({base._CELLS}) WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' OR user_id % 50 = 7")
def z_ordered_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events laid out by cell and time, then read by either."""
    path = fresh_path(spark, "z-ordered")
    layout.write_z_ordered(grid.with_cell(base._located(spark, sf_dir)), path, ["weather_query_cell_id", "occurred_at"], files=16)
    stored = spark.read.parquet(path)
    day = (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))
    return stored.filter(day | (F.col("user_id") % 50 == 7)).select("event_id", "weather_query_cell_id", ntz("ts").alias("ts"))
