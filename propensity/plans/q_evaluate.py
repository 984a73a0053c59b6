"""Registered evaluation queries (G*, H*, scalar pack) and the flagship comparison.

Scores for the exact checks are three fixed formulas over visit features
("SQL-made scores"), so the oracle can rebuild them; model scores are
evaluated by the same operators in the model queries and in ``entry``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions.columns import clean_name, isin_safe
from propensity.functions.cumulative import running_totals
from propensity.operators import evaluate as EV
from propensity.operators import topk as TK
from propensity.plans import fixtures as FX
from propensity.plans.registry import register
from propensity.plans.sql import VISITS, rounded, with_

THRESHOLDS = {"views": 0.3, "value": 0.5, "clean": 0.75}


def scored_visits(spark, base):
    """(visit_id, period, label, model, score) for three formula scores."""
    v = FX.visits(spark, base)
    s = v.select("visit_id", "period", "label",
                 (F.col("prd") / (F.col("adm") + F.col("inf") + F.col("prd") + 1)).alias("views"),
                 (F.col("prd_value") / (F.col("adm_value") + F.col("inf_value") + F.col("prd_value") + 1))
                 .alias("value"),
                 (F.lit(1) - F.col("err_rate")).alias("clean"))
    return s.unpivot(["visit_id", "period", "label"], ["views", "value", "clean"], "model", "score")


def test_scores(spark, base):
    return scored_visits(spark, base).where(F.col("period") == "test")


def thresholds_frame(spark):
    return spark.createDataFrame(list(THRESHOLDS.items()), "model string, threshold double")


SCORED = VISITS + """,
scored AS (
  SELECT visit_id, period, label, 'views' AS model, prd / (adm + inf + prd + 1) AS score FROM visits
  UNION ALL SELECT visit_id, period, label, 'value', prd_value / (adm_value + inf_value + prd_value + 1) FROM visits
  UNION ALL SELECT visit_id, period, label, 'clean', 1 - err_rate FROM visits),
st AS (SELECT * FROM scored WHERE period = 'test'),
thr AS (SELECT * FROM (VALUES ('views', CAST(0.3 AS DOUBLE)), ('value', CAST(0.5 AS DOUBLE)),
                              ('clean', CAST(0.75 AS DOUBLE))) t(model, threshold))"""


def _roc_sql(src="st", g="model"):
    return f"""
sh AS (SELECT {g}, score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
              CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
       FROM {src} WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY {g}, score),
roc AS (SELECT {g}, score AS threshold, pos, neg,
          sum(pos) OVER (PARTITION BY {g} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
          sum(neg) OVER (PARTITION BY {g} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
          sum(pos) OVER (PARTITION BY {g}) AS P, sum(neg) OVER (PARTITION BY {g}) AS N FROM sh)"""


def _auc_sql(g="model"):
    return f"""
rauc AS (SELECT {g}, sum(neg * (2.0 * tp - pos) / 2.0) / (any_value(P) * any_value(N)) AS roc_auc FROM roc GROUP BY {g}),
pseg AS (SELECT {g}, P, pos, tp, tp - pos AS tp0, neg / pos AS h, (fp - neg) - (neg / pos) * (tp - pos) AS b
         FROM roc WHERE pos > 0),
pauc AS (SELECT {g}, sum(CASE WHEN b = 0 THEN pos / (1 + h)
                          ELSE (tp / (1 + h) - b / ((1 + h) * (1 + h)) * ln((1 + h) * tp + b))
                             - (tp0 / (1 + h) - b / ((1 + h) * (1 + h)) * ln((1 + h) * tp0 + b)) END)
                 / any_value(P) AS pr_auc FROM pseg GROUP BY {g})"""


_CONF_SQL = """
conf AS (SELECT s.model, any_value(t.threshold) AS threshold,
                count(*) FILTER (WHERE s.score >= t.threshold AND s.label = 1) AS tp,
                count(*) FILTER (WHERE s.score >= t.threshold AND s.label <> 1) AS fp,
                count(*) FILTER (WHERE NOT (s.score >= t.threshold) AND s.label <> 1) AS tn,
                count(*) FILTER (WHERE NOT (s.score >= t.threshold) AND s.label = 1) AS fn,
                count(*) FILTER (WHERE s.score IS NULL OR isnan(s.score) OR s.label IS NULL) AS n_unscored
         FROM st s JOIN thr t ON s.model = t.model GROUP BY s.model),
cd AS (SELECT model, threshold, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn,
              CAST(fn AS DOUBLE) AS fn FROM conf),
met AS (SELECT model, threshold, (tp + tn) / (tp + fp + tn + fn) AS po,
               ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / ((tp + fp + tn + fn) * (tp + fp + tn + fn)) AS pe,
               CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) END AS sensitivity,
               CASE WHEN tn + fp <> 0 THEN tn / (tn + fp) END AS specificity,
               CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) END AS precision FROM cd),
metrics AS (SELECT model, threshold, po AS accuracy, CASE WHEN 1 - pe <> 0 THEN (po - pe) / (1 - pe) END AS kappa,
                   sensitivity, specificity, precision,
                   CASE WHEN precision + sensitivity <> 0 THEN 2 * precision * sensitivity / (precision + sensitivity) END AS f1,
                   (sensitivity + specificity) / 2 AS balanced_accuracy FROM met)"""

_METRIC_COLS = ["threshold"] + EV.METRICS

_CMP_SQL = (_CONF_SQL + "," + _roc_sql() + "," + _auc_sql() + """,
cmp AS (SELECT m.*, p.pr_auc, r.roc_auc FROM metrics m JOIN pauc p ON m.model = p.model JOIN rauc r ON m.model = r.model),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY pr_auc DESC NULLS LAST, balanced_accuracy DESC NULLS LAST, model)
                       AS BIGINT) AS rank FROM cmp)""")


def _compare(spark, base):
    return EV.compare_models(test_scores(spark, base), thresholds_frame(spark))


# ------------------------------------------------------------------ G1-G4

@register("eval_classify", with_(SCORED, body="""
SELECT visit_id, model, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM st"""))
def eval_classify(spark, base):
    """G1: score >= 0.5 -> 1 on test visits."""
    return test_scores(spark, base).select("visit_id", "model", EV.classify("score", 0.5).alias("pred"))


@register("eval_confusion", rounded(with_(SCORED, _CONF_SQL, body="SELECT * FROM conf"), ["threshold"]))
def eval_confusion(spark, base):
    """Confusion counts per model at its threshold."""
    return EV.confusion(test_scores(spark, base), thresholds_frame(spark))


@register("eval_metrics", rounded(with_(SCORED, _CONF_SQL, body="SELECT * FROM metrics"), _METRIC_COLS))
def eval_metrics(spark, base):
    """Accuracy, kappa, sensitivity, specificity, precision, F1, balanced accuracy."""
    return EV.metrics(EV.confusion(test_scores(spark, base), thresholds_frame(spark)))


_REPORT_COLS = ["threshold", "npv", "prevalence", "detection_rate", "detection_prevalence",
                "no_information_rate", "mcnemar_statistic"]


@register("eval_report", rounded(with_(SCORED, _CONF_SQL, body="""
SELECT model, threshold, CASE WHEN tn + fn <> 0 THEN tn / (tn + fn) END AS npv,
       (tp + fn) / (tp + fp + tn + fn) AS prevalence, tp / (tp + fp + tn + fn) AS detection_rate,
       (tp + fp) / (tp + fp + tn + fn) AS detection_prevalence,
       greatest(tp + fn, tn + fp) / (tp + fp + tn + fn) AS no_information_rate,
       CASE WHEN fp + fn <> 0 THEN pow(abs(fp - fn) - CASE WHEN fp <> fn THEN 1.0 ELSE 0.0 END, 2) / (fp + fn) END
         AS mcnemar_statistic
FROM cd"""), _REPORT_COLS))
def eval_report(spark, base):
    """The remaining confusion-report statistics."""
    return EV.report(EV.confusion(test_scores(spark, base), thresholds_frame(spark)))


def _binomial_tail_sql(k: str, n: str, p: str) -> str:
    """P(X >= k), term by term."""
    return (f"list_sum(list_transform(range({k}, {n} + 1), lambda i: exp(lgamma({n} + 1) - lgamma(i + 1) - lgamma({n} - i + 1)"
            f" + i * ln({p}) + ({n} - i) * ln(1 - {p}))))")


@register("eval_accuracy_interval", rounded(with_(SCORED, _CONF_SQL, """
counts AS (SELECT model, threshold, CAST(tp + tn AS BIGINT) AS k, CAST(tp + fp + tn + fn AS BIGINT) AS n,
                  greatest(tp + fn, tn + fp) / (tp + fp + tn + fn) AS nir FROM cd),
bounds AS (SELECT model, k, n, 0 AS step, CAST(0 AS DOUBLE) AS l0, CAST(1 AS DOUBLE) AS l1,
                  CAST(0 AS DOUBLE) AS h0, CAST(1 AS DOUBLE) AS h1 FROM counts
  UNION ALL
  SELECT model, k, n, step + 1, CASE WHEN lt < 0.025 THEN (l0 + l1) / 2 ELSE l0 END,
         CASE WHEN lt < 0.025 THEN l1 ELSE (l0 + l1) / 2 END, CASE WHEN ht < 0.975 THEN (h0 + h1) / 2 ELSE h0 END,
         CASE WHEN ht < 0.975 THEN h1 ELSE (h0 + h1) / 2 END
  FROM (SELECT *, """ + _binomial_tail_sql("k", "n", "((l0 + l1) / 2)") + """ AS lt,
               coalesce(""" + _binomial_tail_sql("(k + 1)", "n", "((h0 + h1) / 2)") + """, 0) AS ht
        FROM bounds WHERE step < 40))""", body="""
SELECT c.model, c.threshold, c.k / c.n AS accuracy, CASE WHEN c.k = 0 THEN 0.0 ELSE (l0 + l1) / 2 END AS accuracy_low,
       CASE WHEN c.k = c.n THEN 1.0 ELSE (h0 + h1) / 2 END AS accuracy_high, nir AS no_information_rate,
       CASE WHEN nir >= 1 THEN 1.0 ELSE """ + _binomial_tail_sql("c.k", "c.n", "nir") + """ END AS accuracy_p_value
FROM counts c JOIN bounds b ON c.model = b.model WHERE b.step = 40""").replace("WITH ", "WITH RECURSIVE ", 1),
    ["threshold", "accuracy", "accuracy_low", "accuracy_high", "no_information_rate", "accuracy_p_value"]))
def eval_accuracy_interval(spark, base):
    """Accuracy, its exact 95 % interval, and its p-value against the no-information rate."""
    return EV.accuracy_interval(EV.confusion(test_scores(spark, base), thresholds_frame(spark)))


# ------------------------------------------------------------------ G5-G10

@register("eval_roc_curve", rounded(with_(SCORED, _roc_sql(), body="""
SELECT model, threshold, pos, neg, tp, fp, CASE WHEN P <> 0 THEN tp / P END AS tpr,
       CASE WHEN N <> 0 THEN fp / N END AS fpr, P, N FROM roc"""),
    ["threshold", "pos", "neg", "tp", "fp", "tpr", "fpr", "P", "N"]))
def eval_roc_curve(spark, base):
    """ROC points per distinct score."""
    return EV.roc_points(test_scores(spark, base), ["model"])


@register("eval_roc_auc", rounded(with_(SCORED, _roc_sql(), _auc_sql(), body="SELECT * FROM rauc"), ["roc_auc"]))
def eval_roc_auc(spark, base):
    """ROC AUC (ties count half)."""
    return EV.roc_auc(test_scores(spark, base), ["model"])


@register("eval_pr_auc", rounded(with_(SCORED, _roc_sql(), _auc_sql(), body="SELECT * FROM pauc"), ["pr_auc"]))
def eval_pr_auc(spark, base):
    """PR AUC with Davis-Goadrich interpolation."""
    return EV.pr_auc(test_scores(spark, base), ["model"])


@register("eval_pr_curve", rounded(with_(SCORED, _roc_sql(), body="""
SELECT model, threshold, CASE WHEN P <> 0 THEN tp / P END AS recall,
       CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) END AS precision FROM roc"""), ["threshold", "recall", "precision"]))
def eval_pr_curve(spark, base):
    """Precision-recall points per distinct score."""
    return EV.pr_points(test_scores(spark, base), ["model"])


@register("eval_youden", rounded(with_(SCORED, _roc_sql(), """
rj AS (SELECT *, tp / P + (N - fp) / N - 1 AS j FROM roc),
bj AS (SELECT model, max(j) AS bj FROM rj GROUP BY model),
bs AS (SELECT r.model, min(r.threshold) AS s, max(r.j) AS j FROM rj r JOIN bj ON r.model = bj.model AND r.j = bj.bj
       GROUP BY r.model),
nx AS (SELECT b.model, max(r.threshold) FILTER (WHERE r.threshold < b.s) AS nxt FROM bs b JOIN rj r ON r.model = b.model
       GROUP BY b.model)""", body="""
SELECT b.model, CASE WHEN nx.nxt IS NULL THEN CAST('-inf' AS DOUBLE) ELSE (b.s + nx.nxt) / 2 END AS threshold,
       CASE WHEN r.P <> 0 THEN r.tp / r.P END AS sensitivity, 1 - CASE WHEN r.N <> 0 THEN r.fp / r.N END AS specificity, b.j
FROM bs b JOIN nx ON b.model = nx.model JOIN rj r ON r.model = b.model AND r.threshold = b.s"""),
    ["threshold", "sensitivity", "specificity", "j"]))
def eval_youden(spark, base):
    """Youden-optimal threshold per model (midpoint between distinct scores)."""
    return EV.youden(test_scores(spark, base), ["model"])


@register("eval_threshold_grid", rounded(with_(SCORED, """
g AS (SELECT i, CAST(0.1 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS threshold FROM range(0, 61) t(i)),
pn AS (SELECT model, count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label <> 1) AS N FROM st
       WHERE score IS NOT NULL GROUP BY model),
cm AS (SELECT s.model, g.i, any_value(g.threshold) AS threshold,
              count(*) FILTER (WHERE s.score > g.threshold AND s.label = 1) AS tp,
              count(*) FILTER (WHERE s.score > g.threshold AND s.label <> 1) AS fp
       FROM st s JOIN g ON TRUE WHERE s.score IS NOT NULL GROUP BY s.model, g.i),
m AS (SELECT cm.model, cm.i, cm.threshold, CASE WHEN P <> 0 THEN tp / P END AS sensitivity,
             CASE WHEN N <> 0 THEN (N - fp) / N END AS specificity FROM cm JOIN pn ON cm.model = pn.model),
b AS (SELECT *, (sensitivity + specificity) / 2 AS balanced_accuracy FROM m)""", body="""
SELECT model, threshold, sensitivity, specificity, balanced_accuracy,
       CASE WHEN row_number() OVER (PARTITION BY model ORDER BY balanced_accuracy DESC NULLS LAST, i) = 1 THEN 1 ELSE 0 END
         AS best FROM b"""),
    ["threshold", "sensitivity", "specificity", "balanced_accuracy"]))
def eval_threshold_grid(spark, base):
    """Balanced accuracy on the 0.10..0.70 grid (score > t), best marked."""
    return EV.threshold_grid(test_scores(spark, base), ["model"])


# ------------------------------------------------------------------ G11-G18

_CMP_COLS = _METRIC_COLS + ["pr_auc", "roc_auc"]


@register("eval_compare", rounded(with_(SCORED, _CMP_SQL, body="SELECT * FROM cmp"), _CMP_COLS))
def eval_compare(spark, base):
    """Comparison row per model."""
    return _compare(spark, base)


@register("eval_rank", rounded(with_(SCORED, _CMP_SQL, body="SELECT * FROM ranked"), _CMP_COLS))
def eval_rank(spark, base):
    """Rank by PR-AUC, then balanced accuracy."""
    return EV.rank_models(_compare(spark, base))


@register("eval_best", rounded(with_(SCORED, _CMP_SQL, body="SELECT * FROM ranked WHERE rank = 1"), _CMP_COLS))
def eval_best(spark, base):
    """Best model row."""
    return EV.best_model(_compare(spark, base))


@register("eval_baseline", rounded(with_(SCORED, body="""
SELECT model, avg(CAST(label AS DOUBLE)) AS baseline FROM st GROUP BY model"""), ["baseline"]))
def eval_baseline(spark, base):
    """Prevalence (random-ranking PR baseline) per model."""
    return EV.baseline(test_scores(spark, base))


@register("eval_profile_long", rounded(with_(SCORED, _CMP_SQL, body="UNPIVOT (SELECT model, " +
                                             ", ".join(EV.METRICS + ["pr_auc", "roc_auc"]) +
                                             " FROM cmp) ON " + ", ".join(EV.METRICS + ["pr_auc", "roc_auc"]) +
                                             " INTO NAME metric VALUE value"), ["value"]))
def eval_profile_long(spark, base):
    """Metric profile in long form."""
    return EV.profile_long(_compare(spark, base))


@register("eval_fourfold", rounded(with_(SCORED, _CONF_SQL, """
cells AS (SELECT model, 1 AS actual, 1 AS predicted, tp AS n FROM conf
            UNION ALL SELECT model, 1, 0, fn FROM conf UNION ALL SELECT model, 0, 1, fp FROM conf
            UNION ALL SELECT model, 0, 0, tn FROM conf)""", body="""
SELECT model, actual, predicted, CAST(n AS BIGINT) AS n,
       CASE WHEN sum(n) OVER (PARTITION BY model, actual) <> 0
            THEN CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY model, actual) AS DOUBLE) END AS share
FROM cells"""), ["share"]))
def eval_fourfold(spark, base):
    """Confusion standardised within each actual class."""
    return EV.fourfold(EV.confusion(test_scores(spark, base), thresholds_frame(spark)))


@register("fn_clean_names", r"""
SELECT page_id, regexp_replace(url, '\..*$', '') AS clean FROM pages""")
def fn_clean_names(spark, base):
    """Text after the first dot removed (applied to page URLs)."""
    p = spark.read.parquet(f"{base}/pages.parquet").select("page_id", "url")
    return p.select("page_id", clean_name("url").alias("clean"))


@register("eval_by_split", rounded(with_(VISITS + """,
scored AS (
  SELECT visit_id, period, label, 'views' AS model, prd / (adm + inf + prd + 1) AS score FROM visits
  UNION ALL SELECT visit_id, period, label, 'value', prd_value / (adm_value + inf_value + prd_value + 1) FROM visits
  UNION ALL SELECT visit_id, period, label, 'clean', 1 - err_rate FROM visits)""",
    _roc_sql("(SELECT *, model || '|' || period AS mp FROM scored)", "mp"), _auc_sql("mp"), body="""
SELECT split_part(r.mp, '|', 1) AS model, split_part(r.mp, '|', 2) AS split, r.roc_auc, p.pr_auc
FROM rauc r JOIN pauc p ON r.mp = p.mp"""), ["roc_auc", "pr_auc"]))
def eval_by_split(spark, base):
    """ROC-AUC and PR-AUC per model and split, never mixed."""
    s = scored_visits(spark, base).withColumnRenamed("period", "split")
    return EV.curve_areas(s, ["model", "split"])


# ------------------------------------------------------------------ H

_CORR_SQL = ",\ncl AS (" + "\n UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE)) AS r FROM visits" for c in FX.V_NUMERIC) + ")"


@register("topk_features", rounded(with_(VISITS + _CORR_SQL, body="""
SELECT feature, r, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS rk FROM cl) WHERE rk <= 3"""), ["r"]))
def topk_features(spark, base):
    """H4: the 3 numerics most correlated with the label (by |r|)."""
    return TK.top_correlated(FX.visits(spark, base), FX.V_NUMERIC, "label", 3)


@register("topk_head_tail", rounded(with_(VISITS + _CORR_SQL, body="""
SELECT feature, r, 'head' AS part, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY r DESC NULLS LAST, feature) AS rk FROM cl) WHERE rk <= 3
UNION ALL
SELECT feature, r, 'tail', CAST(rk AS BIGINT) FROM (
  SELECT *, row_number() OVER (ORDER BY r ASC NULLS LAST, feature) AS rk FROM cl) WHERE rk <= 2"""), ["r"]))
def topk_head_tail(spark, base):
    """H3: head 3 and tail 2 of the label correlations sorted descending."""
    c = TK.label_correlations(FX.visits(spark, base), FX.V_NUMERIC, "label")
    return TK.head_tail(c, "r", 3, 2, tie="feature")


@register("fn_argmax", rounded(with_(SCORED, """
ext AS (SELECT model, max(score) AS mx, min(score) AS mn FROM st GROUP BY model)""", body="""
SELECT e.model, min(s.visit_id) FILTER (WHERE s.score = e.mx) AS argmax_id, e.mx AS max_score,
       min(s.visit_id) FILTER (WHERE s.score = e.mn) AS argmin_id, e.mn AS min_score
FROM ext e JOIN st s ON s.model = e.model GROUP BY e.model, e.mx, e.mn"""),
    ["max_score", "min_score"]))
def fn_argmax(spark, base):
    """H5: first arg-max / arg-min per model (ties -> smallest id)."""
    return TK.arg_extremes(test_scores(spark, base), ["model"], "score", "visit_id")


# ------------------------------------------------------------------ 2.9 scalar pack

@register("fn_scalar_pack", rounded("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_r,
       CASE WHEN coalesce(l_linestatus IN ('O'), false) THEN 1 ELSE 0 END AS in_o,
       ln(1 + l_quantity) AS log1p_q, exp(-l_discount) AS exp_d, abs(l_tax - 0.04) AS abs_t,
       sqrt(l_extendedprice) AS sqrt_p, CAST(floor(l_quantity / 7) AS BIGINT) AS floor_q, pow(l_discount, 2) AS sq_d,
       CAST(l_linenumber AS VARCHAR) || '-' || l_returnflag || l_linestatus AS code,
       regexp_replace(l_returnflag || '.' || l_linestatus, '\\..*$', '') AS before_dot,
       coalesce(nullif(l_tax, 0.0), -1.0) AS tax_or_neg,
       round_even(l_extendedprice / 1000, 1) AS bround_p,
       printf('%s:%d', l_returnflag, CAST(l_linenumber AS BIGINT)) AS label_text,
       CASE WHEN isnan(l_discount / nullif(l_tax, 0.0)) THEN 1 ELSE 0 END AS nan_ratio,
       CASE WHEN nullif(l_tax, 0.0) IS NULL THEN 1 ELSE 0 END AS null_ratio,
       CAST(len(range(1, CAST(l_linenumber AS BIGINT) + 1)) AS INTEGER) AS seq_n,
       l_discount * l_discount + l_tax * l_tax AS sum_sq,
       l_quantity * 2 + l_discount * 3 AS dot_23
FROM lineitem""", ["log1p_q", "exp_d", "abs_t", "sqrt_p", "sq_d", "tax_or_neg", "bround_p", "sum_sq", "dot_23"]))
def fn_scalar_pack(spark, base):
    """2.9: the reference's row-wise scalar functions in one projection over lineitem."""
    li = FX.lineitem(spark, base)
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    add = lambda a, b: a + b
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_r"),
        F.when(isin_safe("l_linestatus", ["O"]), 1).otherwise(0).alias("in_o"),
        F.log1p("l_quantity").alias("log1p_q"), F.exp(-F.col("l_discount")).alias("exp_d"),
        F.abs(F.col("l_tax") - F.lit(0.04)).alias("abs_t"), F.sqrt("l_extendedprice").alias("sqrt_p"),
        F.floor(F.col("l_quantity") / 7).cast("long").alias("floor_q"), F.pow("l_discount", 2).alias("sq_d"),
        F.concat_ws("", F.col("l_linenumber").cast("string"), F.lit("-"), "l_returnflag", "l_linestatus").alias("code"),
        clean_name(F.concat_ws(".", "l_returnflag", "l_linestatus")).alias("before_dot"),
        F.coalesce(tax, F.lit(-1.0)).alias("tax_or_neg"),
        F.bround(F.col("l_extendedprice") / 1000, 1).alias("bround_p"),
        F.format_string("%s:%d", "l_returnflag", F.col("l_linenumber").cast("long")).alias("label_text"),
        F.when(F.isnan(F.col("l_discount") / tax), 1).otherwise(0).alias("nan_ratio"),
        F.when(F.isnull(tax), 1).otherwise(0).alias("null_ratio"),
        F.size(F.sequence(F.lit(1).cast("long"), F.col("l_linenumber").cast("long"))).alias("seq_n"),
        F.aggregate(F.transform(F.array("l_discount", "l_tax"), lambda x: x * x), F.lit(0.0), add).alias("sum_sq"),
        F.aggregate(F.zip_with(F.array("l_quantity", "l_discount"), F.array(F.lit(2.0), F.lit(3.0)), lambda a, b: a * b),
                    F.lit(0.0), add).alias("dot_23"))


@register("fn_series_pack", rounded("""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, count(DISTINCT o_custkey) AS n_cust FROM orders GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, n, n_cust, lag(n, 1, 0) OVER (ORDER BY day) AS prev_n,
       n - lag(n, 1, 0) OVER (ORDER BY day) AS diff_n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS cum_n FROM d""", []))
def fn_series_pack(spark, base):
    """2.9: distinct count, lag, difference and cumulative sum, on orders by day."""
    o = FX.orders(spark, base)
    daily = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("n_cust"))
    # days are numbered by a distributed running count; yesterday's row is found by that number
    cum = running_totals(daily.withColumn("one", F.lit(1)), "day", ["one", "n"])
    before = cum.select((F.col("one_cum") + 1).alias("one_cum"), F.col("n").alias("prev_n"))
    prev = F.coalesce("prev_n", F.lit(0))
    return cum.join(before, "one_cum", "left").select(
        F.col("day").cast("string").alias("day"), "n", "n_cust", prev.alias("prev_n"), (F.col("n") - prev).alias("diff_n"),
        F.col("n_cum").cast("long").alias("cum_n"))


# ------------------------------------------------------------------ G8 with soft labels

@register("eval_pr_curve_weighted", rounded(with_(SCORED, """
soft AS (SELECT model, score, label, 1 + length(visit_id) % 3 AS w FROM st),
sh AS (SELECT model, score, sum(CASE WHEN label = 1 THEN CAST(w AS DOUBLE) ELSE 0.0 END) AS pos,
              sum(CASE WHEN label = 1 THEN 0.0 ELSE CAST(w AS DOUBLE) END) AS neg FROM soft GROUP BY model, score),
roc AS (SELECT model, score AS threshold,
          sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
          sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
          sum(pos) OVER (PARTITION BY model) AS P FROM sh)""", body="""
SELECT model, threshold, CASE WHEN P <> 0 THEN tp / P END AS recall,
       CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) END AS precision FROM roc"""), ["threshold", "recall", "precision"]))
def eval_pr_curve_weighted(spark, base):
    """G8 with row weights: precision and recall by mass instead of counts."""
    s = test_scores(spark, base).withColumn("w", F.lit(1) + F.length("visit_id") % 3)
    return EV.pr_points(s, ["model"], weight="w")
