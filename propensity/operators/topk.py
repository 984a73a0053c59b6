"""Sorts, limits, top-k, arg-max.

Top-k is ``orderBy(...).limit(k)`` (Spark plans TakeOrderedAndProject: each
task keeps its own k best, so no full sort); every order has a tie key so
the result is total and repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_correlations(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Pearson r of each column with the label: one aggregation, long output."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("r")) for i, c in enumerate(cols)])).alias("e")) \
        .select("e.feature", "e.r")


def top_k(df: DataFrame, order, k: int, tie: str | None = None, rank_col: str = "rank") -> DataFrame:
    """H1/H4: the first k rows by ``order`` (a Column or list), with a 1-based rank."""
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    if tie:
        order.append(F.col(tie).asc())
    top = df.orderBy(*order).limit(k)
    from pyspark.sql import Window
    w = Window.partitionBy(F.lit(0)).orderBy(*order)   # k rows only
    return top.withColumn(rank_col, F.row_number().over(w).cast("long"))


def top_correlated(df: DataFrame, cols: Sequence[str], label: str, k: int) -> DataFrame:
    """H4: the k columns with the largest |r| against the label."""
    c = label_correlations(df, cols, label)
    return top_k(c, [F.abs("r").desc_nulls_last()], k, tie="feature").select("feature", "r", "rank")


def head_tail(df: DataFrame, value: str, n_head: int, n_tail: int, tie: str) -> DataFrame:
    """H3: ``head(sorted desc, n)`` and ``tail(sorted desc, n)`` (tail = ascending order, rank from the end)."""
    head = top_k(df, [F.col(value).desc_nulls_last()], n_head, tie=tie).withColumn("part", F.lit("head"))
    tail = top_k(df, [F.col(value).asc_nulls_last()], n_tail, tie=tie).withColumn("part", F.lit("tail"))
    return head.unionByName(tail).select(tie, value, "part", "rank")


def arg_extremes(df: DataFrame, group_cols: Sequence[str], value: str, key: str) -> DataFrame:
    """H5: first arg-max and arg-min per group; ties go to the smallest key.

    Two aggregations (the least key of each value, then the extreme values with
    theirs) and no join, both partially aggregated: a group holding a third of
    all rows costs nothing extra. A group without any value has nulls.
    """
    g = list(group_cols)
    v = F.col(value)
    first = df.groupBy(*g, v.alias("_v")).agg(F.min(key).alias("_k"))
    pair = F.when(F.col("_v").isNotNull(), F.struct("_v", "_k"))
    ends = first.groupBy(*g).agg(F.max(pair).alias("_hi"), F.min(pair).alias("_lo"))
    return ends.select(*g, F.col("_hi._v").alias("max_" + value), F.col("_lo._v").alias("min_" + value),
                       F.col("_hi._k").alias("argmax_id"), F.col("_lo._k").alias("argmin_id"))
