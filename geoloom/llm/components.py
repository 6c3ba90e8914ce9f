"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """One step over edges (u, v). Nodes of any degree: minima combine before their shuffle and are
    written, so that the join back to the edges has two plain exchanges and Spark can split a node
    that has very many."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    rows = edges.join(least, "u")
    if large:
        out = rows.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = rows.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    out = written(out.filter("u <> v").distinct(), "edges")
    discard(least)
    return out


def _settled(edges: DataFrame) -> bool:
    """Whether edges are stars: every u has one v, which is no u itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.coalesce(F.max("up"), F.lit(0)) <= 1, F.coalesce(F.max(F.col("up") * F.col("down")), F.lit(0)) == 0).first() == (True, True)


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of every node that a link (a, b) names; the label is the least node reached.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs one
    round at most. Links of a node with itself and repeated links change nothing; no link, no row.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "edges")
    rounds = 0
    while not _settled(edges):
        rounds += 1
        if rounds > most_rounds:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
        before, middle = edges, _star(edges, large=True)
        edges = _star(middle, large=False)
        discard(before, middle)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))
