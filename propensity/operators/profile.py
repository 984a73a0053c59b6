"""Table profiling.

The reference loops over columns and scans the frame once per column. Here
every profile is fused: numerics go through one aggregation, categoricals
are unpivoted once and counted by (feature, level) with map-side partial
aggregation, so a level holding a third of all rows costs one row per map
task in the shuffle. Order statistics use the bucketed running counts of
``functions.cumulative`` instead of one global sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.functions.columns import categorical_columns, numeric_columns, unpivot_long
from propensity.functions.cumulative import histogram_statistics, order_statistics


# ------------------------------------------------------------------ B1, B2

def split_column_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """B1: (numeric, categorical) column names by schema."""
    return numeric_columns(df, exclude), categorical_columns(df, exclude)


def with_ordered_levels(df: DataFrame, col: str, levels: Sequence[str],
                        pos_col: str | None = None) -> DataFrame:
    """B2: categorical with a declared level order; values outside it become null.

    Adds ``<pos_col>`` (1-based level position) so sorts follow the declared order.
    """
    arr = F.array(*[F.lit(x) for x in levels])
    pos = F.array_position(arr, F.col(col).cast("string"))
    pos_col = pos_col or f"{col}_pos"
    return (df.withColumn(pos_col, F.when(pos > 0, pos))
              .withColumn(col, F.when(pos > 0, F.col(col).cast("string"))))


def level_counts(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    """``table(factor)``: counts for every declared level, zero for absent ones."""
    spark = df.sparkSession
    lv = spark.createDataFrame([(i + 1, x) for i, x in enumerate(levels)], "level_pos long, level string")
    c = with_ordered_levels(df.select(col), col, levels, "_pos").groupBy("_pos").agg(F.count(F.lit(1)).alias("n"))
    # declared levels: a fixed, short list -> broadcast side
    return (F.broadcast(lv).join(c, lv.level_pos == c._pos, "left")
            .select("level_pos", "level", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


# ------------------------------------------------------------------ B3-B6 duplicates

def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of 2nd+ occurrences (``sum(duplicated(df))``) over ``cols``."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))   # partial agg: skew-safe
    return g.agg(F.sum("_n").cast("long").alias("n_rows"),
                 F.count(F.lit(1)).cast("long").alias("n_distinct"),
                 F.sum(F.col("_n") - 1).cast("long").alias("n_duplicates"))


def duplicate_rows(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows that are a 2nd+ occurrence of their ``key``.

    Occurrence order within a key is the ascending order of the remaining
    columns (Spark rows have no position); null keys are equal. The table is
    read once: identical rows are counted (partially before the shuffle), the
    first of each key is an aggregation over those, and each distinct row is
    emitted as often as it occurs, the first one once less. No window over a
    key; AQE splits a skewed key in the join.
    """
    key = list(key or df.columns)
    rest = [c for c in df.columns if c not in key]
    if not rest:   # whole-row duplicates: every copy after the first
        g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return (g.withColumn("_rep", F.explode(F.sequence(F.lit(2), F.col("_n"))))
                 .select(*df.columns))
    # identical rows become one, with their number: the only pass over the table
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    rs = F.struct(*[F.col(c) for c in rest])
    first = (g.groupBy(*key).agg(F.sum("_n").alias("_all"), F.min(rs).alias("_first"))
              .where("_all > 1").drop("_all"))
    match = [F.col(f"g.{c}").eqNullSafe(F.col(f"f.{c}")) for c in key]
    j = g.alias("g").join(first.alias("f"), match, "inner").select("g.*", "_first")
    copies = F.col("_n") - F.when(rs.eqNullSafe(F.col("_first")), 1).otherwise(0)
    return (j.withColumn("_copies", copies).where("_copies > 0")
             .withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*df.columns))


def duplicate_values(dups: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Distinct values of each numeric column among duplicate rows.

    Long form (feature, value, n) instead of one comma-joined string per
    column: a column can have millions of distinct values, and one string per
    column would funnel them through one task.
    """
    h = typed_histogram(dups, numeric)
    return h.where("not is_null").groupBy("feature", "value").agg(F.sum("n").cast("long").alias("n")).unionByName(
        h.where("is_null").select("feature", F.lit(None).cast("double").alias("value"), F.col("n").cast("long").alias("n")))


def typed_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, exact, value, is_null, n): rows per distinct value of each numeric column.

    Columns are unpivoted by type and told apart in their own type: integers as
    bigint, decimals as they are, so values that a double cannot tell apart stay
    apart. ``exact`` is the value as text where a double may lose digits (integers
    and decimals), else null; ``value`` is its double.
    """
    kinds: dict[str, list[str]] = {}
    for c in cols:
        t = df.schema[c].dataType
        kind = ("bigint" if isinstance(t, T.IntegralType) else t.simpleString() if isinstance(t, T.DecimalType)
                else "double")
        kinds.setdefault(kind, []).append(c)
    out = None
    for kind, names in kinds.items():
        long = unpivot_long(df, [], names, "feature", "value", cast=kind)
        h = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        exact = F.col("value").cast("string") if kind != "double" else F.lit(None).cast("string")
        h = h.select("feature", exact.alias("exact"), F.col("value").cast("double").alias("value"),
                     F.col("value").cast("decimal(38,18)").alias("_order") if kind.startswith("decimal")
                     else F.col("value").cast("decimal(38,0)").alias("_order") if kind == "bigint"
                     else F.lit(None).cast("decimal(38,0)").alias("_order"),
                     F.col("value").isNull().alias("is_null"), "n")
        out = h if out is None else out.unionByName(h)
    return out


def frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts per (feature, level) for categorical columns, one pass."""
    long = unpivot_long(df, [], cols, "feature", "level", cast="string")
    return long.groupBy("feature", "level").agg(F.count(F.lit(1)).cast("long").alias("n"))


# ------------------------------------------------------------------ B7-B9 summaries

def numeric_summary(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Per numeric column: type, missing, distinct (a null counts as one value), min, max.

    ``min_exact`` / ``max_exact`` hold the extremes of integers and decimals as
    text, digit for digit; for floating-point columns they are null.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if approx:
        long = unpivot_long(df, [], cols, "feature", "value", cast="double")
        agg = long.groupBy("feature").agg(
            F.count_if(F.col("value").isNull()).alias("n_missing"),
            F.approx_count_distinct("value").alias("_nd"),
            F.min("value").alias("min_value"), F.max("value").alias("max_value"),
            F.lit(None).cast("string").alias("min_exact"), F.lit(None).cast("string").alias("max_exact"))
    else:
        # two-stage distinct: (feature, value) histogram in the column's own type, then per feature
        h = typed_histogram(df, cols)
        agg = h.groupBy("feature").agg(
            F.sum(F.when(F.col("is_null"), F.col("n")).otherwise(0)).alias("n_missing"),
            F.count_if(~F.col("is_null")).alias("_nd"),
            F.min("value").alias("min_value"), F.max("value").alias("max_value"),
            F.min_by("exact", "_order").alias("min_exact"), F.max_by("exact", "_order").alias("max_exact"))
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return agg.select(
        "feature", F.element_at(tmap, F.col("feature")).alias("type"),
        F.col("n_missing").cast("long").alias("n_missing"),
        (F.col("_nd") + F.when(F.col("n_missing") > 0, 1).otherwise(0)).cast("long").alias("n_unique"),
        "min_value", "max_value", "min_exact", "max_exact")


def _top_level(freq: DataFrame, exclude: DataFrame | None = None, suffix: str = "1") -> DataFrame:
    """Most frequent non-null level per feature (count desc, then smallest level).

    Two aggregations joined through a table of one row per feature, so
    a column with millions of levels is still spread over many tasks (a
    window per feature would put all of its levels in one task).
    ``exclude``: (feature, level) rows to leave out (for the runner-up).
    """
    f = freq.where(F.col("level").isNotNull())
    if exclude is not None:
        f = f.join(exclude, ["feature", "level"], "left_anti")
    best = f.groupBy("feature").agg(F.max("n").alias("_nmax"))
    return (f.join(best, "feature").where(F.col("n") == F.col("_nmax"))
             .groupBy("feature").agg(F.min("level").alias(f"top{suffix}"), F.first("_nmax").alias(f"_n{suffix}")))


def categorical_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Type, missing, distinct (null counts), most frequent level (ties: smallest level)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    freq = frequencies(df, cols)
    stats = freq.groupBy("feature").agg(
        F.sum(F.when(F.col("level").isNull(), F.col("n")).otherwise(0)).cast("long").alias("n_missing"),
        F.count(F.lit(1)).cast("long").alias("n_unique"))
    top = _top_level(freq).select("feature", F.col("top1").alias("top_level"))
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return (stats.join(top, "feature", "left")
            .select("feature", F.element_at(tmap, F.col("feature")).alias("type"),
                    "n_missing", "n_unique", "top_level"))


def category_top2(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Top-1 and top-2 level with percent, percent of all other levels.

    Top-2 is ``'N/A'`` with a null percent when a column has one level.
    Ties go to the smallest level.
    """
    freq = frequencies(df, cols)
    # percentages among non-null values (as ``prop.table(table(x))``); n_unique counts null as a value
    tot = freq.groupBy("feature").agg(F.sum(F.when(F.col("level").isNotNull(), F.col("n"))).alias("_tot"),
                                      F.count(F.lit(1)).cast("long").alias("n_unique"))
    t1 = _top_level(freq, None, "1")
    t2 = _top_level(freq, t1.select("feature", F.col("top1").alias("level")), "2")
    j = t1.join(t2.withColumnRenamed("top2", "_top2"), "feature", "left").join(tot, "feature")
    pct = lambda c: F.lit(100.0) * F.col(c) / F.col("_tot")
    return j.select(
        "feature", "n_unique", "top1", pct("_n1").alias("top1_pct"),
        F.coalesce(F.col("_top2"), F.lit("N/A")).alias("top2"),
        pct("_n2").alias("top2_pct"),
        (F.lit(100.0) * (F.col("_tot") - F.col("_n1") - F.coalesce(F.col("_n2"), F.lit(0))) / F.col("_tot"))
        .alias("other_pct"))


def format_top2(top2: DataFrame) -> DataFrame:
    """B9 text: ``"%s (%.2f%%)"`` labels, as printed by the reference (small input)."""
    return top2.select(
        "feature", "n_unique",
        F.format_string("%s (%.2f%%)", "top1", "top1_pct").alias("top_class_1"),
        F.when(F.col("top2_pct").isNull(), F.lit("N/A"))
         .otherwise(F.format_string("%s (%.2f%%)", "top2", "top2_pct")).alias("top_class_2"),
        F.format_string("%.2f%%", "other_pct").alias("other_classes"))


# ------------------------------------------------------------------ B10 histogram

def histogram(df: DataFrame, cols: Sequence[str], group_col: str | None = None,
              bins: int | None = None) -> DataFrame:
    """Equal-width histogram per numeric column (and group).

    Bins per column: ``bins`` or Sturges ``ceil(log2 n) + 1`` (integer form:
    bit length of n-1, plus one). Empty bins are reported with 0.
    """
    ids = [group_col] if group_col else []
    long = unpivot_long(df, ids, cols, "feature", "value", cast="double").where(F.col("value").isNotNull())
    gk = ids + ["feature"]
    st = long.groupBy(*gk).agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_lo"),
                               F.max("value").alias("_hi"))
    if bins:
        nb = F.lit(bins)
    else:
        nb = F.when(F.col("_n") <= 1, F.lit(1)).otherwise(F.length(F.bin(F.col("_n") - 1)) + 1)
    st = st.withColumn("_nb", nb.cast("int"))
    # without groups one row a column: sent to the rows, which would otherwise all meet in one task a column
    j = long.join(st if ids else F.broadcast(st), gk)
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_nb")),
                F.col("_nb") - 1))
    cnt = j.groupBy(*gk, b.cast("long").alias("bin")).agg(F.count(F.lit(1)).cast("long").alias("n"))
    allb = st.select(*gk, "_lo", "_hi", "_nb",
                     F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_nb") - 1).cast("long"))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_nb")
    return (allb.join(cnt, gk + ["bin"], "left")
            .select(*gk, "bin",
                    (F.col("_lo") + F.col("bin") * width).alias("lower"),
                    F.when(F.col("bin") == F.col("_nb") - 1, F.col("_hi"))
                     .otherwise(F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


# ------------------------------------------------------------------ B11, B13 box plots

def boxplot_stats(df: DataFrame, cols: Sequence[str], group_col: str | None = None,
                  coef: float = 1.5, n_ranges: int | None = None,
                  approx_accuracy: int | None = None) -> DataFrame:
    """Tukey five numbers, 1.5-IQR whiskers and outlier count.

    Hinges follow R's ``boxplot.stats``/``fivenum``: with n values and
    m = floor((n+3)/2)/2 the lower hinge is the mean of the floor(m)-th and
    ceil(m)-th smallest values (1-based), the median likewise at (n+1)/2.
    Everything follows from one (feature, value, count) histogram, the only
    pass over the rows; order statistics need no global sort.
    ``approx_accuracy`` switches the hinges to ``percentile_approx`` quartiles
    (one pass, bounded memory per group; not Tukey hinges) for very large tables.
    """
    ids = [group_col] if group_col else []
    gk = ids + ["feature"]
    long = unpivot_long(df, ids, cols, "feature", "value", cast="double").where(F.col("value").isNotNull())
    hist = long.groupBy(*gk, F.col("value").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    st = hist.groupBy(*gk).agg(F.sum("_c").alias("_n"), F.min("_v").alias("ymin"), F.max("_v").alias("ymax"))
    if approx_accuracy:
        q = long.groupBy(*gk).agg(F.percentile_approx("value", [0.25, 0.5, 0.75], approx_accuracy).alias("_q"))
        five = q.select(*gk, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("med"), F.col("_q")[2].alias("q3")) \
            .join(st, gk)
        return _whiskers(hist, five, gk, coef)
    n = F.col("_n")
    m = F.floor((n + 3) / 2) / 2
    pos = {"q1": m, "med": (n + 1) / 2, "q3": n + 1 - m}
    ranks = st.select(*gk, F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), (F.floor(p) - 1).cast("long").alias("k")) for k, p in pos.items()
    ] + [
        F.struct(F.lit(k + "_hi").alias("key"), (F.ceil(p) - 1).cast("long").alias("k")) for k, p in pos.items()
    ])).alias("_r")).select(*gk, "_r.key", "_r.k")
    xs = histogram_statistics(hist, gk, ranks, n_ranges)
    piv = xs.groupBy(*gk).agg(*[
        ((F.max(F.when(F.col("key") == k, F.col("x"))) + F.max(F.when(F.col("key") == k + "_hi", F.col("x"))))
         / 2).alias(k) for k in pos])
    return _whiskers(hist, piv.join(st, gk), gk, coef)


def _whiskers(hist: DataFrame, five: DataFrame, gk: list, coef: float) -> DataFrame:
    """1.5-IQR whiskers and outlier count, from the histogram and the hinges."""
    iqr = F.col("q3") - F.col("q1")
    five = five.withColumn("_lf", F.col("q1") - coef * iqr).withColumn("_uf", F.col("q3") + coef * iqr)
    out = (F.col("_v") < F.col("_lf")) | (F.col("_v") > F.col("_uf"))
    w = hist.join(five.select(*gk, "_lf", "_uf"), gk).groupBy(*gk).agg(
        F.min(F.when(F.col("_v") >= F.col("_lf"), F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(F.col("_v") <= F.col("_uf"), F.col("_v"))).alias("whisker_hi"),
        F.sum(F.when(out, F.col("_c")).otherwise(0)).cast("long").alias("n_out"))
    return five.join(w, gk).select(*gk, F.col("_n").cast("long").alias("n"), "ymin", "whisker_lo", "q1",
                                   "med", "q3", "whisker_hi", "ymax", "n_out")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              group_col: str | None = None, n_ranges: int | None = None) -> DataFrame:
    """Exact type-7 quantiles (linear interpolation, = R default, DuckDB quantile_cont)."""
    ids = [group_col] if group_col else []
    gk = ids + ["feature"]
    long = unpivot_long(df, ids, cols, "feature", "value", cast="double").where(F.col("value").isNotNull())
    st = long.groupBy(*gk).agg(F.count(F.lit(1)).alias("_n"))
    parts = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        parts += [F.struct(F.lit(f"p{i}_lo").alias("key"), F.floor(h).cast("long").alias("k")),
                  F.struct(F.lit(f"p{i}_hi").alias("key"), F.ceil(h).cast("long").alias("k"))]
    ranks = st.select(*gk, F.explode(F.array(*parts)).alias("_r")).select(*gk, "_r.key", "_r.k")
    xs = order_statistics(long, gk, "value", ranks, n_ranges)
    piv = xs.groupBy(*gk).pivot("key", [f"p{i}_{s}" for i in range(len(probs)) for s in ("lo", "hi")]).agg(F.first("x"))
    out = piv.join(st, gk)
    sel = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"p{i}_lo"), F.col(f"p{i}_hi")
        sel.append((lo + (h - F.floor(h)) * (hi - lo)).alias(f"q{i}"))
    return out.select(*gk, *sel)


# ------------------------------------------------------------------ B14 conversion

def conversion_rate(df: DataFrame, cols: Sequence[str], label: str,
                    levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Percent of positive labels per level; declared-but-empty levels give 0."""
    long = unpivot_long(df, [label], cols, "feature", "level", cast="string")
    agg = long.groupBy("feature", "level").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.sum(F.col(label)).cast("long").alias("n_pos"))
    if levels:
        spark = df.sparkSession
        decl = spark.createDataFrame([(f, l) for f, ls in levels.items() for l in ls], "feature string, level string")
        seen = agg.select("feature", "level")
        extra = decl.join(seen, ["feature", "level"], "left_anti") \
            .select("feature", "level", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_pos"))
        agg = agg.unionByName(extra)
    return agg.select("feature", "level", "n", "n_pos",
                      F.when(F.col("n") == 0, F.lit(0.0))
                       .otherwise(F.lit(100.0) * F.col("n_pos") / F.col("n")).alias("conversion_pct"))


# ------------------------------------------------------------------ B15, B16 correlation

def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, one aggregation pass.

    p(p-1)/2 ``corr`` aggregates in a single ``agg``; the diagonal is 1.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}")
                   for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries += [F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"{i}").alias("r")),
                    F.struct(F.lit(b).alias("var1"), F.lit(a).alias("var2"), F.col(f"{i}").alias("r"))]
    entries += [F.struct(F.lit(c).alias("var1"), F.lit(c).alias("var2"), F.lit(1.0).alias("r")) for c in cols]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.var1", "e.var2", "e.r")


def high_correlations(corr: DataFrame, cols: Sequence[str], cutoff: float = 0.4) -> DataFrame:
    """|r| > cutoff and r != 1, each unordered pair once (var1 before var2 in column order)."""
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return corr.where((F.abs("r") > cutoff) & (F.col("r") != 1.0)
                      & (F.element_at(order, F.col("var1")) < F.element_at(order, F.col("var2"))))


# ------------------------------------------------------------------ B17-B19

def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share per class, and the majority / minority ratio."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).cast("long").alias("n"))
    w = Window.partitionBy(F.lit(0))   # one row per class: tiny
    return c.select(F.col(label).alias("label"), "n",
                    (F.col("n") / F.sum("n").over(w)).alias("share"),
                    (F.max("n").over(w) / F.min("n").over(w)).alias("imbalance_ratio"))


def near_zero_variance(df: DataFrame, cols: Sequence[str], freq_cut: float = 95 / 5,
                       unique_cut: float = 10.0) -> DataFrame:
    """freqRatio, percentUnique, zeroVar, nzv per column.

    freqRatio = most common count / second most common count (0 with a single
    value); percentUnique = 100 * distinct / n; nzv = (freqRatio > freq_cut and
    percentUnique <= unique_cut) or zeroVar. The top-2 counts come from two
    aggregations over the (feature, value) histogram, not a window over it.
    """
    full = typed_histogram(df, cols).select("feature", "is_null", F.col("n").alias("_c"))
    h = full.where("not is_null")
    s1 = h.groupBy("feature").agg(F.max("_c").alias("_n1"), F.count(F.lit(1)).alias("_nd"))
    h2 = h.join(s1, "feature").groupBy("feature").agg(
        F.count_if(F.col("_c") == F.col("_n1")).alias("_k1"),
        F.max(F.when(F.col("_c") < F.col("_n1"), F.col("_c"))).alias("_n2"))
    tot = full.groupBy("feature").agg(F.sum("_c").alias("_n"))
    j = s1.join(h2, "feature").join(tot, "feature")
    n2 = F.when(F.col("_k1") >= 2, F.col("_n1")).otherwise(F.col("_n2"))
    fr = F.when(F.col("_nd") <= 1, F.lit(0.0)).otherwise(F.col("_n1") / n2)
    pu = F.lit(100.0) * F.col("_nd") / F.col("_n")
    zv = F.col("_nd") <= 1
    return j.select("feature", fr.alias("freq_ratio"), pu.alias("percent_unique"),
                    zv.cast("int").alias("zero_var"),
                    (((fr > freq_cut) & (pu <= unique_cut)) | zv).cast("int").alias("nzv"))


def split_shares(df: DataFrame, split_col: str = "period") -> DataFrame:
    """Rows and share of rows per split."""
    c = df.groupBy(split_col).agg(F.count(F.lit(1)).cast("long").alias("n"))
    return c.select(F.col(split_col).alias("split"), "n",
                    (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))
