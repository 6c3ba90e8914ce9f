"""Coverage at many grains in one pass, and metrics that merge without reading old rows again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative error of a distinct count: 1.04 / sqrt(2**LG_K), three times that in 99 % of cases.
LG_K = 14
#: Accuracy parameter of quantile sketches: ranks are off by at most about 1 %.
KLL_K = 350


def coverage_by_grain(df: DataFrame, matched: Mapping[str, Column], grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Row count, and count and rate of each predicate, for every group of every grain.

    grains: name: columns, () for the whole table. Columns: grain, the grouping columns (null where
    a grain does not group by them), row_count, then <name>_count and <name>_rate (8 decimals). All
    grains come from one pass with grouping sets, and a grouping column's own nulls stay a group: the
    grouping id tells the grains apart. A predicate that is null did not match.
    """
    columns = list(dict.fromkeys(c for cs in grains.values() for c in cs))
    ids = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cs) for name, cs in grains.items()}
    if len(set(ids.values())) < len(ids):
        raise ValueError("grains must differ in their columns")
    flags = df.select(*columns, *(F.coalesce(p, F.lit(False)).alias(f"__{n}") for n, p in matched.items()))
    counts = [F.count_if(F.col(f"__{n}")).cast("long").alias(f"{n}_count") for n in matched]
    rates = [F.round(F.avg(F.col(f"__{n}").cast("double")), 8).alias(f"{n}_rate") for n in matched]
    sets = flags.groupingSets([[F.col(c) for c in cs] for cs in grains.values()], *columns)
    out = sets.agg(F.grouping_id().alias("__id"), F.count(F.lit(1)).alias("row_count"), *counts, *rates)
    grain = F.coalesce(*(F.when(F.col("__id") == i, F.lit(name)) for name, i in ids.items()))
    return out.select(grain.alias("grain"), *columns, "row_count", *(f"{n}_count" for n in matched), *(f"{n}_rate" for n in matched))


def pivoted(coverage: DataFrame, *, rows: str, columns: str, values: Sequence[str], measure: str) -> DataFrame:
    """One grain as a table: a row per value of rows, a column per listed value of columns.

    The values are given, so no pass looks for them, and the columns are the same for any data.
    """
    return coverage.groupBy(rows).pivot(columns, list(values)).agg(F.first(measure))


def sketched(df: DataFrame, by: Sequence[str], *, distinct: Sequence[str] = (), quantiles: Sequence[str] = ()) -> DataFrame:
    """Mergeable metrics per group: by, row_count, and per column a sketch, each a few KB.

    distinct: columns whose distinct values are counted (<name>_hll); quantiles: columns of numbers
    (<name>_kll). Nulls are left out of the sketches.
    """
    hlls = [F.hll_sketch_agg(F.col(c), F.lit(LG_K)).alias(f"{c}_hll") for c in distinct]
    klls = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"{c}_kll") for c in quantiles]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *hlls, *klls)


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups from those of finer ones, without the rows they came from."""
    hlls = [F.hll_union_agg(c, F.lit(False)).alias(c) for c in sketches.columns if c.endswith("_hll")]
    klls = [F.kll_merge_agg_double(c).alias(c) for c in sketches.columns if c.endswith("_kll")]
    return sketches.groupBy(*by).agg(F.sum("row_count").cast("long").alias("row_count"), *hlls, *klls)


def read_metrics(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """The numbers in sketches: <name>_distinct, and <name>_p<rank> for each rank, null without a value."""
    out: list[Column] = []
    for c in sketches.columns:
        if c.endswith("_hll"):
            out.append(F.hll_sketch_estimate(c).alias(f"{c[:-4]}_distinct"))
        elif c.endswith("_kll"):
            empty = F.kll_sketch_get_n_double(c) == 0
            out += [F.when(~empty, F.kll_sketch_get_quantile_double(c, F.lit(r))).alias(f"{c[:-4]}_p{round(r * 100)}") for r in ranks]
        else:
            out.append(F.col(c))
    return sketches.select(*out)
