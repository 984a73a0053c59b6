"""Feature preparation.

Fit functions run one small aggregation over the *train* rows and return
plain Python parameters (a probability, level lists, means, sds) -- their
size grows with the number of columns and levels, never with rows. Apply
functions turn those parameters into literal column expressions, so the
whole preparation is one narrow projection that stays inside whole-stage
codegen and works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions.columns import isin_safe, safe_div, unpivot_long


# ------------------------------------------------------------------ D1

def fit_prob_returning(train: DataFrame, col: str, yes: str = "Returning_Visitor",
                       no: str = "New_Visitor") -> float:
    """D1 fit: P(yes | value is yes or no) on train."""
    r = train.agg(F.avg(F.when(F.col(col) == yes, 1.0).when(F.col(col) == no, 0.0)).alias("p")).first()
    return float(r["p"]) if r["p"] is not None else 0.0


def prob_impute(col: str, p: float, yes: str = "Returning_Visitor", no: str = "New_Visitor") -> Column:
    """D1 apply: yes -> 1, no -> 0, anything else (incl. null) -> p."""
    return F.when(F.col(col) == yes, F.lit(1.0)).when(F.col(col) == no, F.lit(0.0)).otherwise(F.lit(p))


# ------------------------------------------------------------------ D2

#: The level list of the month column, in calendar order; a month's quarter follows from its place.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def quarter(col: str) -> Column:
    """Month (name or number) -> Q1..Q3; anything else, unknown included, is Q4."""
    c = F.col(col).cast("string")
    q = F.lit("Q4")
    for k in range(3):
        places = range(3 * k, 3 * k + 3)
        q = F.when(isin_safe(c, [MONTHS[i] for i in places] + [str(i + 1) for i in places]), F.lit(f"Q{k + 1}")).otherwise(q)
    return q


# ------------------------------------------------------------------ D4

def level_shares(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of train rows per (feature, level) -- one pass for all columns."""
    long = unpivot_long(train, [], cols, "feature", "level", cast="string")
    c = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    n = train.count()
    return c.select("feature", "level", "n", (F.col("n") / F.lit(n)).alias("share"))


def fit_lump(train: DataFrame, cols: Sequence[str], min_share: float = 0.05) -> dict[str, list[str]]:
    """D4 fit: levels with train share >= min_share (inclusive) per column.

    Rare levels are dropped in Spark: at most 1 / min_share levels per column come back.
    """
    shares = level_shares(train, cols)
    rows = shares.where(F.col("share") >= min_share).where(F.col("level").isNotNull()) \
        .select("feature", "level").collect()
    keep: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        keep[r.feature].append(r.level)
    return {c: sorted(v) for c, v in keep.items()}


def lump(col: str, keep: Sequence[str], other: str = "Other") -> Column:
    """D4 apply: kept levels stay, everything else (unseen, null) becomes ``other``."""
    return F.when(isin_safe(F.col(col).cast("string"), keep), F.col(col).cast("string")).otherwise(F.lit(other))


# ------------------------------------------------------------------ D5

#: Levels that the one-hot columns of a table may have together; each becomes a column.
MAX_LEVELS = 10_000


def collect_levels(levels: DataFrame, max_levels: int = MAX_LEVELS) -> list:
    """Rows of ``levels``, one a level; an error (not a cut) where there are more than ``max_levels``."""
    rows = levels.limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} levels: lump rare levels first, or leave out columns that name single rows")
    return rows


def fit_onehot_levels(train: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Level lists (sorted as strings) of categorical columns on train; each level becomes a column."""
    long = unpivot_long(train, [], cols, "feature", "level", cast="string")
    rows = collect_levels(long.where(F.col("level").isNotNull()).select("feature", "level").distinct(), max_levels)
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r.feature].append(r.level)
    return {c: sorted(v) for c, v in out.items()}


def onehot_full_rank(levels: Mapping[str, Sequence[str]], sep: str = "_") -> list[Column]:
    """One 0/1 double per level except the first string-sorted one.

    Names are ``<col><sep><level>`` (the reference writes ``col.level``; a dot
    in a Spark column name needs quoting everywhere, so ``_`` is the default).
    A null value, or a level that the list does not hold, gives nulls in all of
    its dummies.
    """
    return [dummy(F.col(c).cast("string"), lv, level).alias(f"{c}{sep}{level}")
            for c, lv in levels.items() for level in sorted(lv)[1:]]


def dummy(value: Column, levels: Sequence[str], level: str) -> Column:
    """1 for ``level``, 0 for another known level, null for anything else."""
    return F.when(isin_safe(value, levels), (value == F.lit(level)).cast("double"))


# ------------------------------------------------------------------ D6, D7

def log1p_columns(cols: Sequence[str]) -> list[Column]:
    """``log1p`` on each column, same names."""
    return [F.log1p(F.col(c).cast("double")).alias(c) for c in cols]


def fit_moments(train: DataFrame, cols: Sequence[str], log1p: bool = False) -> tuple[dict, dict]:
    """D7 fit: sample mean and sd (n-1) of each column (after log1p if asked), one pass."""
    ex = {c: (F.log1p(F.col(c).cast("double")) if log1p else F.col(c).cast("double")) for c in cols}
    r = train.agg(*[F.avg(e).alias(f"m_{i}") for i, e in enumerate(ex.values())],
                  *[F.stddev_samp(e).alias(f"s_{i}") for i, e in enumerate(ex.values())]).first()
    means = {c: float(r[f"m_{i}"]) if r[f"m_{i}"] is not None else 0.0 for i, c in enumerate(cols)}
    sds = {c: float(r[f"s_{i}"]) if r[f"s_{i}"] is not None else 0.0 for i, c in enumerate(cols)}
    return means, sds


def zscore(col: str | Column, mean: float, sd: float, name: str | None = None) -> Column:
    """D7 apply: (x - mean) / sd; a zero sd gives 0 instead of infinity."""
    c = F.col(col) if isinstance(col, str) else col
    z = (c - F.lit(mean)) / F.lit(sd) if sd else F.lit(0.0) * c
    return z.alias(name) if name else z


# ------------------------------------------------------------------ D8

def target_yes_no(col: str, positive=1) -> Column:
    """Outcome -> 'Yes' / 'No'."""
    return F.when(F.col(col) == F.lit(positive), "Yes").otherwise("No")


def target_label(col: str, positive=1) -> Column:
    """Outcome -> 1.0 / 0.0 (Spark ML's label convention)."""
    return F.when(F.col(col) == F.lit(positive), 1.0).otherwise(0.0)


# ------------------------------------------------------------------ D9-D11

def collinearity_treatment(df: DataFrame, drop: Sequence[str] = (),
                           ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Add safe ratios ``name = num / den`` (D9), then drop their inputs and ``drop``."""
    ratios = dict(ratios or {})
    out = df.select("*", *[safe_div(n, d).alias(name) for name, (n, d) in ratios.items()])
    gone = set(drop) | {c for nd in ratios.values() for c in nd}
    return out.drop(*[c for c in out.columns if c in gone])


# ------------------------------------------------------------------ D12

def design_matrix(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns -> one ML vector column (no intercept column)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)
