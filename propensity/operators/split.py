"""Splitting, sampling and class weights.

All splits are narrow projections (a ``split`` column), so they cost nothing
until a consumer filters -- and a written table partitioned by ``split`` is
then pruned at the scan. Class statistics are one tiny aggregation whose
result (one number per class) goes back into a literal expression, so
applying a weight is a projection, not a join or a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions.columns import isin_safe
from propensity.functions.cumulative import order_statistics


def split_by_period(df: DataFrame, period_col: str, test_values: Sequence,
                    out: str = "split") -> DataFrame:
    """Chronological split: rows whose period is in ``test_values`` are test."""
    return df.withColumn(out, F.when(isin_safe(period_col, test_values), "test").otherwise("train"))


def split_by_cutoff(df: DataFrame, ts_col: str, cutoff: str, out: str = "split") -> DataFrame:
    """C1, cut-off form: ``ts >= cutoff`` is test (a null time is train, as R's ``%in%``)."""
    return df.withColumn(out, F.when(F.coalesce(F.col(ts_col) >= F.lit(cutoff), F.lit(False)), "test")
                         .otherwise("train"))


def temporal_holdout(df: DataFrame, split_col: str, period_col: str, fit: Sequence,
                     validate: Sequence, out: str = "role") -> DataFrame:
    """Inner hold-out on the train rows: fit / validate / unused; test stays test."""
    s, p = F.col(split_col), F.col(period_col)
    return df.withColumn(out, F.when(s == "test", "test")
                         .when(isin_safe(p, fit), "fit")
                         .when(isin_safe(p, validate), "validate")
                         .otherwise("unused"))


def fold_column(key: Column | str, k: int, prime: int = 2_654_435_761) -> Column:
    """Fold id from an integer key: ``pmod(key * prime, k)`` (deterministic, no shuffle)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(key.cast("long") * F.lit(prime), F.lit(k)).cast("int")


def hash_fold_column(cols: Sequence[str], k: int, seed: int = 42) -> Column:
    """C3 for any key type: ``xxhash64`` of the key modulo k."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols], F.lit(seed)), F.lit(k)).cast("int")


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class: one aggregation, one row per class back to the driver."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def sample_balanced(df: DataFrame, label: str, order_col: str, ratio: float = 1.0,
                    minority=None) -> DataFrame:
    """C4: exact per-class sample sizes {minority: n_min, majority: floor(n_min * ratio)}.

    Rows are taken in ascending ``order_col`` (a unique numeric key or a hash of
    one). Instead of a window per class (one task per class), the cut-off value
    per class is the exact k-th order statistic from a distributed histogram,
    and sampling is a filter.
    """
    counts = class_counts(df, label)
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], c))
    n_min = counts[minority]
    sizes = {c: (n_min if c == minority else min(n, int(n_min * ratio))) for c, n in counts.items()}
    spark = df.sparkSession
    pos = spark.createDataFrame([(c, "cut", s - 1) for c, s in sizes.items() if s > 0],
                                f"{label} {df.schema[label].dataType.simpleString()}, key string, k long")
    cuts = order_statistics(df.select(label, order_col), [label], order_col, pos)
    return (df.join(cuts.select(label, F.col("x").alias("_cut")), label, "inner")
              .where(F.col(order_col) <= F.col("_cut")).drop("_cut"))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Inverse-frequency weights w_c = N / (K * n_c)."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    expr = None
    for c, nc in sorted(counts.items(), key=lambda t: str(t[0])):
        term = F.lit(n / (k * nc))
        expr = F.when(F.col(label) == F.lit(c), term) if expr is None else expr.when(F.col(label) == F.lit(c), term)
    return df.withColumn(out, expr)


def scale_pos_weight(df: DataFrame, label: str, positive=1, out: str = "weight") -> DataFrame:
    """Positives weigh n_neg / n_pos, negatives 1."""
    counts = class_counts(df, label)
    n_pos = counts.get(positive, 0)
    n_neg = sum(v for k, v in counts.items() if k != positive)
    w = n_neg / n_pos if n_pos else 1.0
    return df.withColumn(out, F.when(F.col(label) == F.lit(positive), F.lit(w)).otherwise(F.lit(1.0)))
