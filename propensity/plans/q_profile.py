"""Registered profiling queries (B*) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.operators import profile as P
from propensity.plans import fixtures as FX
from propensity.plans.registry import register
from propensity.plans.sql import DOCS, ORDERS, VISITS, rounded, unpivot, with_

L_KEY = ["l_orderkey", "l_linenumber"]
L_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_returnflag", "l_linestatus", "l_shipdate"]
L_NUM = FX.L_NUMERIC
L_CAT = FX.L_CATEGORICAL
L_SUMMARY_NUM = L_NUM + ["l_linenumber"]
DUP_SHOW = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]

# ------------------------------------------------------------------ SQL pieces

_L_DUPS = f"""
ldups AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(L_KEY)} ORDER BY {', '.join(L_REST)}) AS rn
    FROM lineitem) WHERE rn > 1)"""


def _sql_num_long(src, cols, ids=()):
    return f"({unpivot(src, cols, ids, 'feature', 'value', 'DOUBLE')})"


def _sql_cat_long(src, cols, ids=()):
    return f"({unpivot(src, cols, ids, 'feature', 'level', 'VARCHAR')})"


def _sql_box(long_src: str, gk: list[str]) -> str:
    g = ", ".join(gk)
    on = " AND ".join(f"r.{c} = p.{c}" for c in gk)
    on2 = " AND ".join(f"l.{c} = f.{c}" for c in gk)
    return f"""
blong AS (SELECT * FROM {long_src} WHERE value IS NOT NULL),
bs AS (SELECT {g}, count(*) AS n, min(value) AS ymin, max(value) AS ymax FROM blong GROUP BY {g}),
br AS (SELECT {g}, value, row_number() OVER (PARTITION BY {g} ORDER BY value) AS rn FROM blong),
bp AS (SELECT *, floor((n + 3) / 2) / 2 AS m FROM bs),
bq AS (
  SELECT {', '.join('p.' + c for c in gk)}, p.n, p.ymin, p.ymax,
    (max(CASE WHEN r.rn = floor(p.m) THEN r.value END) + max(CASE WHEN r.rn = ceil(p.m) THEN r.value END)) / 2 AS q1,
    (max(CASE WHEN r.rn = floor((p.n + 1) / 2) THEN r.value END) + max(CASE WHEN r.rn = ceil((p.n + 1) / 2) THEN r.value END)) / 2 AS med,
    (max(CASE WHEN r.rn = floor(p.n + 1 - p.m) THEN r.value END) + max(CASE WHEN r.rn = ceil(p.n + 1 - p.m) THEN r.value END)) / 2 AS q3
  FROM bp p JOIN br r ON {on}
  GROUP BY {', '.join('p.' + c for c in gk)}, p.n, p.ymin, p.ymax),
bf AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM bq),
bw AS (
  SELECT {', '.join('f.' + c for c in gk)},
    min(CASE WHEN l.value >= f.lf THEN l.value END) AS whisker_lo,
    max(CASE WHEN l.value <= f.uf THEN l.value END) AS whisker_hi,
    count(*) FILTER (WHERE l.value < f.lf OR l.value > f.uf) AS n_out
  FROM bf f JOIN blong l ON {on2} GROUP BY {', '.join('f.' + c for c in gk)})"""


_BOX_COLS = ["ymin", "whisker_lo", "q1", "med", "q3", "whisker_hi", "ymax"]


def _sql_box_select(gk):
    g = ", ".join(f"f.{c}" for c in gk)
    on = " AND ".join(f"f.{c} = w.{c}" for c in gk)
    return (f"SELECT {g}, f.n, f.ymin, w.whisker_lo, f.q1, f.med, f.q3, w.whisker_hi, f.ymax, w.n_out "
            f"FROM bf f JOIN bw w ON {on}")


# ------------------------------------------------------------------ B2

@register("prof_ordered_levels", with_(ORDERS, body="""
SELECT CAST(p.level_pos AS BIGINT) AS level_pos, p.level, CAST(count(o.month_name) AS BIGINT) AS n
FROM (SELECT i AS level_pos, ['Jan','Feb','Mar','Apr','May','June','Jul','Aug','Sep','Oct','Nov','Dec'][i] AS level
      FROM range(1, 13) t(i)) p
LEFT JOIN ords o ON o.month_name = p.level
GROUP BY ALL"""))
def prof_ordered_levels(spark, base):
    """B2: order months by the declared level list, zero-count levels included."""
    return P.level_counts(FX.orders(spark, base), "month_name", FX.MONTH_LEVELS)


# ------------------------------------------------------------------ B3-B6

@register("prof_duplicate_count", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def prof_duplicate_count(spark, base):
    """Duplicate count over the lineitem key."""
    return P.duplicate_count(FX.lineitem(spark, base), L_KEY)


@register("prof_duplicate_rows", with_(_L_DUPS, body=f"""
SELECT {', '.join(DUP_SHOW)}, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM ldups"""))
def prof_duplicate_rows(spark, base):
    """The 2nd+ occurrences of each lineitem key."""
    d = P.duplicate_rows(FX.lineitem(spark, base), L_KEY)
    return d.select(*DUP_SHOW, F.col("l_shipdate").cast("string").alias("l_shipdate"))


@register("prof_dup_values", with_(_L_DUPS, body=f"""
SELECT feature, value, count(*) AS n FROM {_sql_num_long('ldups', L_NUM)} GROUP BY ALL"""))
def prof_dup_values(spark, base):
    """Distinct numeric values among duplicate rows (long form)."""
    d = P.duplicate_rows(FX.lineitem(spark, base), L_KEY)
    return P.duplicate_values(d, L_NUM)


@register("prof_dup_freq", with_(_L_DUPS, body=f"""
SELECT feature, level, count(*) AS n FROM {_sql_cat_long('ldups', L_CAT)} GROUP BY ALL"""))
def prof_dup_freq(spark, base):
    """Category frequencies within duplicate rows."""
    d = P.duplicate_rows(FX.lineitem(spark, base), L_KEY)
    return P.frequencies(d, L_CAT)


# ------------------------------------------------------------------ B7-B9, B12

_TYPES_SQL = "CASE feature WHEN 'l_linenumber' THEN 'int' ELSE 'double' END"


@register("prof_numeric_summary", rounded(f"""
SELECT feature, {_TYPES_SQL} AS type, count(*) FILTER (WHERE value IS NULL) AS n_missing,
       count(DISTINCT value) + CASE WHEN count(*) FILTER (WHERE value IS NULL) > 0 THEN 1 ELSE 0 END AS n_unique,
       min(value) AS min_value, max(value) AS max_value,
       CASE WHEN feature = 'l_linenumber' THEN CAST(CAST(min(value) AS BIGINT) AS VARCHAR) END AS min_exact,
       CASE WHEN feature = 'l_linenumber' THEN CAST(CAST(max(value) AS BIGINT) AS VARCHAR) END AS max_exact
FROM {_sql_num_long('lineitem', L_SUMMARY_NUM)} GROUP BY feature""", ["min_value", "max_value"]))
def prof_numeric_summary(spark, base):
    """Numeric summary of lineitem."""
    return P.numeric_summary(FX.lineitem(spark, base), L_SUMMARY_NUM)


@register("prof_key_summary", "\n UNION ALL ".join(f"""
SELECT '{c}' AS feature, 'bigint' AS type, count(*) FILTER (WHERE v IS NULL) AS n_missing,
       count(DISTINCT v) + CASE WHEN count(*) FILTER (WHERE v IS NULL) > 0 THEN 1 ELSE 0 END AS n_unique,
       CAST(min(v) AS DOUBLE) AS min_value, CAST(max(v) AS DOUBLE) AS max_value,
       CAST(min(v) AS VARCHAR) AS min_exact, CAST(max(v) AS VARCHAR) AS max_exact
FROM (SELECT {e} AS v FROM lineitem)""" for c, e in (("l_orderkey", "CAST(l_orderkey AS BIGINT)"),
                                                     ("wide_key", "9007199254740992 + CAST(l_partkey AS BIGINT)"))))
def prof_key_summary(spark, base):
    """B7 on keys: order keys, and part keys beyond 2^53, which doubles would merge."""
    li = FX.lineitem(spark, base).select(F.col("l_orderkey").cast("long").alias("l_orderkey"),
                                         (F.lit(2**53) + F.col("l_partkey").cast("long")).alias("wide_key"))
    return P.numeric_summary(li, ["l_orderkey", "wide_key"])


@register("prof_categorical_summary", f"""
WITH f AS (SELECT feature, level, count(*) AS n FROM {_sql_cat_long('lineitem', L_CAT)} GROUP BY ALL),
t AS (SELECT feature, level AS top_level FROM (
        SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, level ASC) AS rk
        FROM f WHERE level IS NOT NULL) WHERE rk = 1)
SELECT f.feature, 'string' AS type,
       CAST(sum(CASE WHEN f.level IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_missing,
       count(*) AS n_unique, any_value(t.top_level) AS top_level
FROM f LEFT JOIN t ON f.feature = t.feature GROUP BY f.feature""")
def prof_categorical_summary(spark, base):
    """Categorical summary of lineitem."""
    return P.categorical_summary(FX.lineitem(spark, base), L_CAT)


@register("prof_category_top2", rounded(f"""
WITH f AS (SELECT feature, level, count(*) AS n FROM {_sql_cat_long('lineitem', L_CAT)} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, level ASC) AS rk,
             sum(n) OVER (PARTITION BY feature) AS tot FROM f WHERE level IS NOT NULL),
u AS (SELECT feature, count(*) AS nu FROM f GROUP BY feature)
SELECT r.feature, any_value(u.nu) AS n_unique,
       max(CASE WHEN rk = 1 THEN level END) AS top1,
       100.0 * max(CASE WHEN rk = 1 THEN n END) / any_value(tot) AS top1_pct,
       coalesce(max(CASE WHEN rk = 2 THEN level END), 'N/A') AS top2,
       100.0 * max(CASE WHEN rk = 2 THEN n END) / any_value(tot) AS top2_pct,
       100.0 * (any_value(tot) - max(CASE WHEN rk = 1 THEN n END) - coalesce(max(CASE WHEN rk = 2 THEN n END), 0))
         / any_value(tot) AS other_pct
FROM r JOIN u ON r.feature = u.feature GROUP BY r.feature""", ["top1_pct", "top2_pct", "other_pct"]))
def prof_category_top2(spark, base):
    """Top-two levels with percent per categorical column."""
    return P.category_top2(FX.lineitem(spark, base), L_CAT)


@register("prof_frequency", f"""
SELECT feature, level, count(*) AS n FROM {_sql_cat_long('lineitem', L_CAT)} GROUP BY ALL""")
def prof_frequency(spark, base):
    """Frequency table of each categorical column."""
    return P.frequencies(FX.lineitem(spark, base), L_CAT)


# ------------------------------------------------------------------ B10, B11, B13

@register("prof_histogram", rounded(f"""
WITH lg AS (SELECT * FROM {_sql_num_long('lineitem', L_NUM)} WHERE value IS NOT NULL),
s AS (SELECT feature, count(*) AS n, min(value) AS lo, max(value) AS hi FROM lg GROUP BY feature),
s2 AS (SELECT *, CASE WHEN n <= 1 THEN 1 ELSE CAST(ceil(log2(n)) AS INTEGER) + 1 END AS nb FROM s),
c AS (SELECT lg.feature,
             CAST(CASE WHEN s2.hi = s2.lo THEN 0
                  ELSE least(floor((lg.value - s2.lo) / (s2.hi - s2.lo) * s2.nb), s2.nb - 1) END AS BIGINT) AS bin,
             count(*) AS n
      FROM lg JOIN s2 ON lg.feature = s2.feature GROUP BY ALL),
a AS (SELECT feature, lo, hi, nb, unnest(range(0, nb)) AS bin FROM s2)
SELECT a.feature, CAST(a.bin AS BIGINT) AS bin, a.lo + a.bin * ((a.hi - a.lo) / a.nb) AS lower,
       CASE WHEN a.bin = a.nb - 1 THEN a.hi ELSE a.lo + (a.bin + 1) * ((a.hi - a.lo) / a.nb) END AS upper,
       coalesce(c.n, 0) AS n
FROM a LEFT JOIN c ON a.feature = c.feature AND a.bin = c.bin""", ["lower", "upper"]))
def prof_histogram(spark, base):
    """Sturges histogram per lineitem numeric column."""
    return P.histogram(FX.lineitem(spark, base), L_NUM)


@register("prof_boxplot", rounded(with_(_sql_box(_sql_num_long("lineitem", L_NUM), ["feature"]),
                                        body=_sql_box_select(["feature"])), _BOX_COLS))
def prof_boxplot(spark, base):
    """Box-plot statistics per lineitem numeric column."""
    return P.boxplot_stats(FX.lineitem(spark, base), L_NUM)


@register("prof_boxplot_by_target", rounded(with_(
    VISITS, _sql_box(_sql_num_long("visits", FX.V_NUMERIC, ["label"]), ["label", "feature"]),
    body=_sql_box_select(["label", "feature"])), _BOX_COLS))
def prof_boxplot_by_target(spark, base):
    """Box-plot statistics of visit numerics by label."""
    return P.boxplot_stats(FX.visits(spark, base), FX.V_NUMERIC, group_col="label")


# ------------------------------------------------------------------ B14

_V_CONV_COLS = ["visitor", "segment", "weekend", "nation"]
VISITOR_LEVELS = ["New_Visitor", "Other", "Returning_Visitor"]


@register("prof_conversion_rate", rounded(with_(VISITS, f"""
agg AS (SELECT feature, level, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_pos
        FROM {_sql_cat_long('visits', _V_CONV_COLS, ['label'])} GROUP BY ALL),
decl AS (SELECT 'visitor' AS feature, unnest(['New_Visitor', 'Other', 'Returning_Visitor']) AS level),
allr AS (SELECT * FROM agg
         UNION ALL SELECT d.feature, d.level, 0, 0 FROM decl d
         WHERE NOT EXISTS (SELECT 1 FROM agg a WHERE a.feature = d.feature AND a.level = d.level))""", body="""
SELECT feature, level, CAST(n AS BIGINT) AS n, CAST(n_pos AS BIGINT) AS n_pos,
       CASE WHEN n = 0 THEN 0.0 ELSE 100.0 * n_pos / n END AS conversion_pct FROM allr"""), ["conversion_pct"]))
def prof_conversion_rate(spark, base):
    """Conversion percent per level over all visits, before any split; empty declared levels give 0."""
    return P.conversion_rate(FX.visits(spark, base), _V_CONV_COLS, "label", levels={"visitor": VISITOR_LEVELS})


# ------------------------------------------------------------------ B15, B16

def _sql_corr(cols):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    parts = []
    for a, b in pairs:
        parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS r FROM lineitem")
        parts.append(f"SELECT '{b}' AS var1, '{a}' AS var2, corr({a}, {b}) AS r FROM lineitem")
    for c in cols:
        parts.append(f"SELECT '{c}' AS var1, '{c}' AS var2, 1.0 AS r")
    return "\n UNION ALL ".join(parts)


@register("prof_corr_matrix", rounded(_sql_corr(L_NUM), ["r"]))
def prof_corr_matrix(spark, base):
    """Pearson correlation matrix of lineitem numerics."""
    return P.correlation_matrix(FX.lineitem(spark, base), L_NUM)


_V_CORR = ["prd", "prd_value", "adm", "adm_value"]


def _sql_high_corr(src, cols):
    return "\n UNION ALL ".join(f"SELECT '{x}' AS var1, '{y}' AS var2, corr({x}, {y}) AS r FROM {src}"
                                for i, x in enumerate(cols) for y in cols[i + 1:])


@register("prof_high_corr_pairs", rounded(with_(VISITS, body=f"""
SELECT * FROM ({_sql_high_corr('visits', _V_CORR)}) m WHERE abs(r) > 0.4 AND r <> 1.0"""), ["r"]))
def prof_high_corr_pairs(spark, base):
    """Pairs of visit numerics with |r| > 0.4 (a count and its value go together), each once."""
    return P.high_correlations(P.correlation_matrix(FX.visits(spark, base), _V_CORR), _V_CORR, 0.4)


# ------------------------------------------------------------------ B17-B19

@register("prof_class_balance", rounded(with_(DOCS, body="""
SELECT label, n, n / sum(n) OVER () AS share, max(n) OVER () / min(n) OVER () AS imbalance_ratio
FROM (SELECT quality AS label, count(*) AS n FROM docs GROUP BY quality)"""), ["share", "imbalance_ratio"]))
def prof_class_balance(spark, base):
    """Class counts and shares of document quality."""
    return P.class_balance(FX.documents(spark, base), "quality")


_NZV_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice", "bulk", "one"]
_NZV_SQL = "(SELECT *, CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS bulk, 1 AS one FROM lineitem)"


@register("prof_nzv", rounded(f"""
WITH lg AS {_sql_num_long(_NZV_SQL, _NZV_COLS)},
h AS (SELECT feature, value, count(*) AS c FROM lg WHERE value IS NOT NULL GROUP BY ALL),
s1 AS (SELECT feature, max(c) AS n1, count(*) AS nd FROM h GROUP BY feature),
h2 AS (SELECT h.feature, count(*) FILTER (WHERE h.c = s1.n1) AS k1, max(CASE WHEN h.c < s1.n1 THEN h.c END) AS n2
       FROM h JOIN s1 ON h.feature = s1.feature GROUP BY h.feature),
tot AS (SELECT feature, count(*) AS n FROM lg GROUP BY feature),
j AS (SELECT s1.feature, s1.n1, s1.nd, h2.k1, h2.n2, tot.n,
             CASE WHEN s1.nd <= 1 THEN 0.0 ELSE s1.n1 / (CASE WHEN h2.k1 >= 2 THEN s1.n1 ELSE h2.n2 END) END AS fr,
             100.0 * s1.nd / tot.n AS pu
      FROM s1 JOIN h2 ON s1.feature = h2.feature JOIN tot ON s1.feature = tot.feature)
SELECT feature, fr AS freq_ratio, pu AS percent_unique, CASE WHEN nd <= 1 THEN 1 ELSE 0 END AS zero_var,
       CASE WHEN (fr > 19 AND pu <= 10) OR nd <= 1 THEN 1 ELSE 0 END AS nzv FROM j""",
    ["freq_ratio", "percent_unique"]))
def prof_nzv(spark, base):
    """Near-zero-variance screen over lineitem columns, a rare flag and a constant among them."""
    li = FX.lineitem(spark, base).withColumn("bulk", (F.col("l_orderkey") % 97 == 0).cast("int")).withColumn("one", F.lit(1))
    return P.near_zero_variance(li, _NZV_COLS)


@register("split_shares", rounded(with_(ORDERS, body="""
SELECT period AS split, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM ords GROUP BY period"""),
    ["share"]))
def split_shares(spark, base):
    """Share of order rows in each split."""
    return P.split_shares(FX.orders(spark, base), "period")
