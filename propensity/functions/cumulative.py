"""Distributed running sums and exact order statistics.

Running sums over an ordered histogram (ROC / PR curves, exact quantiles,
Youden) are the one place where a naive plan puts a whole group into a single
window partition. ``running_totals`` avoids that with one lazy plan, whatever
the size:

1. the input is a *histogram* (one row per distinct ordering value and group),
   so a value held by a third of all rows is already one row;
2. it is range-partitioned by group and value, and summed within each range;
3. a group that ends inside a range has nothing to hand on; only the last row of a
   range carries its group's total to the later ranges, where a second window adds
   up what has arrived: ranges^2 / 2 rows, whatever the number of groups.

No job runs while the plan is built, nothing is cached, and a range's number is
computed once, in the stage that deals the ranges out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_totals(hist: DataFrame, order_col: str, value_cols: Sequence[str],
                   partition_cols: Sequence[str] = (), descending: bool = False,
                   n_ranges: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order_col`` per group.

    ``hist`` must hold one row per (partition_cols, order_col) value.
    Adds ``<value>_cum`` columns. ``n_ranges`` (default: the session's shuffle
    partitions) is the number of ranges the rows are dealt to.
    """
    parts = list(partition_cols)
    if not parts:   # a constant group key instead of a global window
        out = running_totals(hist.withColumn("_g0", F.lit(0)), order_col, value_cols, ["_g0"],
                             descending, n_ranges, suffix)
        return out.drop("_g0")
    n = n_ranges or int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = hist.repartitionByRange(n, *[F.col(p) for p in parts], o).withColumn("_range", F.spark_partition_id())
    whole = Window.partitionBy("_range").orderBy(*[F.col(p) for p in parts], o)
    so_far = Window.partitionBy("_range", *parts).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = ranged.withColumn("_last", F.lead(F.lit(1)).over(whole).isNull())
    summed = marked.select("*", *[F.sum(c).over(so_far).alias(f"_in_{i}") for i, c in enumerate(value_cols)])
    # the last row of a range goes on as a carrier to every later range of the plan
    to = F.when(F.col("_last"), F.sequence(F.col("_range"), F.lit(n - 1))).otherwise(F.array("_range"))
    sent = summed.withColumn("_to", F.explode(to))
    arrived = Window.partitionBy(*parts, "_to")
    carried = [F.coalesce(F.sum(F.when(F.col("_to") != F.col("_range"), F.col(f"_in_{i}"))).over(arrived), F.lit(0))
               for i in range(len(value_cols))]
    out = sent.select("*", *[(F.col(f"_in_{i}") + c).alias(v + suffix)
                             for (i, v), c in zip(enumerate(value_cols), carried)])
    return out.where(F.col("_to") == F.col("_range")).drop(
        "_range", "_to", "_last", *[f"_in_{i}" for i in range(len(value_cols))])


def order_statistics(long_df: DataFrame, group_cols: Sequence[str], value_col: str,
                     positions: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Exact k-th smallest values (0-based ``k``) per group, without sorting rows.

    ``positions``: (group_cols..., key, k) -- the wanted ranks.
    Returns (group_cols..., key, x) where x is the k-th smallest non-null value.
    """
    g = list(group_cols)
    if not g:
        long_df = long_df.withColumn("_g0", F.lit(0))
        positions = positions.withColumn("_g0", F.lit(0))
        return order_statistics(long_df, ["_g0"], value_col, positions, n_ranges).drop("_g0")
    hist = (long_df.where(F.col(value_col).isNotNull())
            .groupBy(*g, F.col(value_col).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    return histogram_statistics(hist, g, positions, n_ranges)


def histogram_statistics(hist: DataFrame, group_cols: Sequence[str], positions: DataFrame,
                         n_ranges: int | None = None) -> DataFrame:
    """``order_statistics`` of a histogram (group_cols..., _v, _c)."""
    g = list(group_cols)
    cum = running_totals(hist, "_v", ["_c"], g, n_ranges=n_ranges)
    pos = positions.select(*g, F.col("key").alias("_pkey"), F.col("k").alias("_pk"))
    hit = cum.join(pos, g, "inner").where(
        (F.col("_c_cum") - F.col("_c") <= F.col("_pk")) & (F.col("_pk") < F.col("_c_cum")))
    return hit.select(*g, F.col("_pkey").alias("key"), F.col("_v").alias("x"))
