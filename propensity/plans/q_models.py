"""Registered model queries (F*): closed-form models with oracles, Spark ML fits rows-only."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators import evaluate as EV
from propensity.operators import features as FE
from propensity.operators import split as S
from propensity.operators.artifact import fit_artifact
from propensity.operators.models import bagging as BG
from propensity.operators.models import boosting as BO
from propensity.operators.models import explain as X
from propensity.operators.models import generative as G
from propensity.operators.models import linear as LIN
from propensity.operators.models import pruning as PR
from propensity.operators.models import trees as TR
from propensity.operators.models.binned import binned_table, fit_bins
from propensity.operators import profile as P
from propensity.functions.cumulative import running_totals
from propensity.plans import fixtures as FX
from propensity.plans.q_evaluate import SCORED, _CMP_COLS, _CMP_SQL, _compare, _roc_sql
from propensity.plans.q_features import ART_SQL, COLLINEAR, V_SPEC, _IMPUTE_SQL, _Z_SQL, visit_artifact
from propensity.plans.q_split import FOLD_PRIME, visit_key
from propensity.plans.registry import register
from propensity.plans.sql import ORDERS, VISITS, rounded, with_
from propensity.session import checkpoint_dir, written
from propensity.sources import io as IO

NB_F = FX.V_NUMERIC + ["is_returning"]
LDA_F = ["prd", "prd_value"]
N_FOLDS = 5
LR_FOLDS = 10
LR_LAMBDAS = 100
N_TREES = 500
#: The order of the prepared columns that models keep besides the features.
KEEP = ["visit_id", "period", "vkey", "role"]


def with_roles(v):
    """C2 on visits: the train weeks before the last one to fit, the last one to validate on."""
    week = F.concat(F.lit("w"), F.floor(F.datediff("day", F.lit("2024-01-01").cast("date")) / 7).cast("string"))
    return S.temporal_holdout(v.withColumn("week", week), "period", "week", ["w0", "w1"], ["w2"])


def apply_with_folds(v, art):
    """The artifact applied, fold ids as projections of the key, balanced class weights as a literal."""
    prep = art.transform(with_roles(v)).withColumns({
        "fold": S.fold_column("vkey", N_FOLDS, FOLD_PRIME), "fold10": S.fold_column("vkey", LR_FOLDS, FOLD_PRIME)})
    counts = S.class_counts(prep.where(F.col("period") == "train"), "label")
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for c, n in counts.items():
        weight = F.when(F.col("label") == F.lit(c), F.lit(total / (len(counts) * n))).otherwise(weight)
    return prep.withColumn("weight", weight)


def visit_table(spark, base):
    """The visits with their key, written once for a query that reads them again and again."""
    return written(visit_key(FX.visits(spark, base)), "visits")


@contextmanager
def prepared(spark, base, visits=None):
    """Prepared visits (artifact fitted on train), cached while the models of a query are fitted on them."""
    v, art = visit_artifact(spark, base, replace(V_SPEC, keep=KEEP), visit_table(spark, base) if visits is None else visits)
    prep = apply_with_folds(v, art).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield prep, art.feature_names()
    finally:
        prep.unpersist()


def _train(prep):
    return prep.where(F.col("period") == "train")


def _test(prep):
    return prep.where(F.col("period") == "test")


# ------------------------------------------------------------------ SQL: prepared visits, NB, LDA

VPREP = f"""
vprep AS (SELECT visit_id, period, {_Z_SQL}, {_IMPUTE_SQL} AS is_returning, CAST(label AS DOUBLE) AS label
          FROM visits, art_num, art_p)"""

NB_SQL = f"""
nbs AS (SELECT label, count(*) AS n, {', '.join(f'avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}' for f in NB_F)}
        FROM vprep WHERE period = 'train' GROUP BY label),
nbp AS (SELECT label, n / sum(n) OVER () AS prior,
               {', '.join(f'm_{f}, CASE WHEN s_{f} IS NULL OR isnan(s_{f}) OR s_{f} <= 0 THEN 0.001 ELSE s_{f} END AS s_{f}' for f in NB_F)}
        FROM nbs)"""


def _nb_term(f):
    z = f"((v.{f} - p.m_{f}) / p.s_{f})"
    d = f"(exp(-0.5 * {z} * {z}) / (p.s_{f} * sqrt(2 * pi())))"
    return f"ln(CASE WHEN {d} <= 0 THEN 0.001 ELSE {d} END)"


NB_SCORE_SQL = f"""
nbl AS (SELECT v.visit_id, v.period, p.label AS cls, ln(p.prior) + {' + '.join(_nb_term(f) for f in NB_F)} AS L
        FROM vprep v JOIN nbp p ON TRUE),
nbscore AS (SELECT visit_id, any_value(period) AS period,
                   1 / (1 + exp(max(L) FILTER (WHERE cls = 0) - max(L) FILTER (WHERE cls = 1))) AS score
            FROM nbl GROUP BY visit_id)"""

LDA_SQL = """
lm AS (SELECT label, count(*) AS n, avg(prd) AS a1, avg(prd_value) AS a2 FROM vprep WHERE period = 'train' GROUP BY label),
lw AS (SELECT sum((v.prd - m.a1) * (v.prd - m.a1)) AS w11, sum((v.prd - m.a1) * (v.prd_value - m.a2)) AS w12,
              sum((v.prd_value - m.a2) * (v.prd_value - m.a2)) AS w22, count(*) - 2 AS df
       FROM vprep v JOIN lm m ON v.label = m.label WHERE v.period = 'train'),
lc AS (SELECT w11 / df AS W11, w12 / df AS W12, w22 / df AS W22, m0.a1 AS m01, m0.a2 AS m02, m1.a1 AS m11, m1.a2 AS m12
       FROM lw, lm m0, lm m1 WHERE m0.label = 0 AND m1.label = 1),
ld AS (SELECT *, W11 * W22 - W12 * W12 AS det FROM lc),
lb AS (SELECT *, (W22 * (m11 - m01) - W12 * (m12 - m02)) / det AS b1, (-W12 * (m11 - m01) + W11 * (m12 - m02)) / det AS b2
       FROM ld),
lfin AS (SELECT *, -((m01 + m11) * b1 + (m02 + m12) * b2) / 2 + ln(0.5 / 0.5) AS c,
                sqrt(b1 * (W11 * b1 + W12 * b2) + b2 * (W12 * b1 + W22 * b2)) AS scale FROM lb)"""


def _visit_prep(spark, base):
    v, art = visit_artifact(spark, base)
    return art.transform(v)


# ------------------------------------------------------------------ F6, F7

@register("nb_fit", rounded(with_(VISITS, ART_SQL, VPREP, NB_SQL, body="\n UNION ALL ".join(
    f"SELECT label, '{f}' AS feature, m_{f} AS mean, s_{f} AS sd, prior FROM nbp" for f in NB_F)),
    ["label", "mean", "sd", "prior"]))
def nb_fit(spark, base):
    """F6 fit: class priors, per-class means and sample sds (floored) on prepared train visits."""
    prep = _visit_prep(spark, base)
    return G.fit_gaussian_nb(_train(prep), NB_F).to_frame(spark)


@register("nb_scores", rounded(with_(VISITS, ART_SQL, VPREP, NB_SQL, NB_SCORE_SQL, body="""
SELECT visit_id, score FROM nbscore WHERE period = 'test'"""), ["score"]))
def nb_scores(spark, base):
    """F6 apply: naive-Bayes posterior of a purchase for test visits."""
    prep = _visit_prep(spark, base)
    nb = G.fit_gaussian_nb(_train(prep), NB_F)
    return _test(prep).select("visit_id", nb.posterior().alias("score"))


@register("nb_insights", rounded(with_(VISITS, ART_SQL, VPREP, NB_SQL, """
ins AS (""" + "\n UNION ALL ".join(
    f"SELECT '{f}' AS feature, max(m_{f}) FILTER (WHERE label = 0) AS mn, max(m_{f}) FILTER (WHERE label = 1) AS my FROM nbp"
    for f in NB_F) + ")", body="""
SELECT feature, mean_no, mean_yes, ratio, CAST(rk AS BIGINT) AS rank FROM (
  SELECT feature, round_even(mn, 4) AS mean_no, round_even(my, 4) AS mean_yes, round_even(my / (mn + 1e-9), 4) AS ratio,
         row_number() OVER (ORDER BY round_even(my / (mn + 1e-9), 4) DESC, feature) AS rk FROM ins) WHERE rk <= 10"""),
    ["mean_no", "mean_yes", "ratio"]))
def nb_insights(spark, base):
    """class means, yes/no ratio (rounded to 4), top 10 by ratio."""
    prep = _visit_prep(spark, base)
    return G.nb_insights(G.fit_gaussian_nb(_train(prep), NB_F))


# ------------------------------------------------------------------ F8, F9

@register("lda_scores", rounded(with_(VISITS, ART_SQL, VPREP, LDA_SQL, body="""
SELECT v.visit_id, 1 / (1 + exp(-(l.c + v.prd * l.b1 + v.prd_value * l.b2))) AS score
FROM vprep v, lfin l WHERE v.period = 'test'"""), ["score"]))
def lda_scores(spark, base):
    """F8: two-feature LDA with equal priors, posterior for test visits."""
    prep = _visit_prep(spark, base)
    lda = G.fit_lda(_train(prep), LDA_F)
    return _test(prep).select("visit_id", lda.posterior().alias("score"))


@register("lda_projection", rounded(with_(VISITS, ART_SQL, VPREP, LDA_SQL, """
p AS (SELECT v.label AS label, (0.0 + (v.prd - (l.m01 + l.m11) / 2) * l.b1 + (v.prd_value - (l.m02 + l.m12) / 2) * l.b2)
                                / l.scale AS value FROM vprep v, lfin l WHERE v.period = 'train'),
s AS (SELECT label, count(*) AS n, min(value) AS lo, max(value) AS hi FROM p GROUP BY label),
s2 AS (SELECT *, CASE WHEN n <= 1 THEN 1 ELSE CAST(ceil(log2(n)) AS INTEGER) + 1 END AS nb FROM s),
c AS (SELECT p.label, CAST(CASE WHEN s2.hi = s2.lo THEN 0
                  ELSE least(floor((p.value - s2.lo) / (s2.hi - s2.lo) * s2.nb), s2.nb - 1) END AS BIGINT) AS bin,
             count(*) AS n FROM p JOIN s2 ON p.label = s2.label GROUP BY ALL),
a AS (SELECT label, lo, hi, nb, unnest(range(0, nb)) AS bin FROM s2)""", body="""
SELECT a.label, 'ld1' AS feature, CAST(a.bin AS BIGINT) AS bin, a.lo + a.bin * ((a.hi - a.lo) / a.nb) AS lower,
       CASE WHEN a.bin = a.nb - 1 THEN a.hi ELSE a.lo + (a.bin + 1) * ((a.hi - a.lo) / a.nb) END AS upper,
       coalesce(c.n, 0) AS n
FROM a LEFT JOIN c ON a.label = c.label AND a.bin = c.bin"""), ["label", "lower", "upper"]))
def lda_projection(spark, base):
    """histogram of the discriminant projection LD1 per class (train visits)."""
    prep = _visit_prep(spark, base)
    lda = G.fit_lda(_train(prep), LDA_F)
    proj = _train(prep).select("label", lda.ld1().alias("ld1"))
    return P.histogram(proj, ["ld1"], group_col="label")


# ------------------------------------------------------------------ F12 on a given series, F19

@register("pd_lda", rounded(with_(VISITS, ART_SQL, VPREP, LDA_SQL, """
tr AS (SELECT * FROM vprep WHERE period = 'train'),
gs AS (SELECT min(prd) AS lo, max(prd) AS hi, least(51, count(DISTINCT prd)) AS k FROM tr),
grid AS (SELECT CASE WHEN gs.k > 1 THEN gs.lo + (gs.hi - gs.lo) * i / (gs.k - 1) ELSE gs.lo END AS g
         FROM gs, range(0, 51) t(i) WHERE i < gs.k),
sc AS (SELECT grid.g, 1 / (1 + exp(-(l.c + grid.g * l.b1 + tr.prd_value * l.b2))) AS p FROM tr, grid, lfin l)""",
    body="""
SELECT 'prd' AS feature, g AS value,
       avg(0.5 * (ln(greatest(p, 2.220446049250313e-16)) - ln(greatest(1.0 - p, 2.220446049250313e-16)))) AS pd
FROM sc GROUP BY g"""), ["value", "pd"]))
def pd_lda(spark, base):
    """F22 with a closed-form model: partial dependence of the two-feature LDA on 'prd' (51-point grid)."""
    prep = _visit_prep(spark, base)
    tr = _train(prep)
    lda = G.fit_lda(tr, LDA_F)
    return X.partial_dependence(lambda d: d.withColumn("score", lda.posterior()), tr, LDA_F, ["prd"], n_grid=51)


@register("stable_iteration", with_(ORDERS, """
d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_all, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f
      FROM orders GROUP BY 1),
c AS (SELECT row_number() OVER (ORDER BY day) AS n,
             sum(n_f) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / sum(n_all) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM d),
e AS (SELECT n, v, CASE WHEN abs(v - lag(v) OVER (ORDER BY n)) < 0.0005 THEN 1 ELSE 0 END AS small FROM c),
g AS (SELECT *, sum(1 - small) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM e),
h AS (SELECT *, sum(small) OVER (PARTITION BY grp ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS len
      FROM g)""", body="""
SELECT CAST(coalesce(min(n) FILTER (WHERE len >= 50), max(n)) AS BIGINT) AS stable_n FROM h"""))
def stable_iteration(spark, base):
    """F12 on a given error series: running share of finished orders by day; first day after 50 calm steps."""
    o = FX.orders(spark, base)
    daily = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("o_orderstatus") == "F").alias("n_f"))
    cum = running_totals(daily, "day", ["n_all", "n_f"])
    idx = running_totals(cum.withColumn("_one", F.lit(1)), "day", ["_one"])
    series = idx.select(F.col("_one_cum").alias("n"), (F.col("n_f_cum") / F.col("n_all_cum")).alias("v"))
    return TR.stable_iteration(series, "n", "v", 0.0005, 50)


@register("model_pick", rounded(with_(SCORED, _CMP_SQL, body="""
SELECT 'views' AS default_model, 'value' AS tuned_model,
       max(pr_auc) FILTER (WHERE model = 'views') AS default_pr_auc, max(pr_auc) FILTER (WHERE model = 'value') AS tuned_pr_auc,
       CASE WHEN max(pr_auc) FILTER (WHERE model = 'value') > max(pr_auc) FILTER (WHERE model = 'views')
            THEN 'value' ELSE 'views' END AS picked
FROM cmp WHERE model IN ('views', 'value')"""), ["default_pr_auc", "tuned_pr_auc"]))
def model_pick(spark, base):
    """tuned vs default by PR-AUC, ties to the default."""
    return TR.model_pick(_compare(spark, base), "views", "value")


# ------------------------------------------------------------------ flagship (entry)

def model_scores(spark, base):
    """Visits -> artifact -> naive Bayes and two-feature LDA fitted on train -> scores for train and test."""
    prep = _visit_prep(spark, base)
    models = {"naive_bayes": G.fit_gaussian_nb(_train(prep), NB_F), "lda": G.fit_lda(_train(prep), LDA_F)}
    return reduce(DataFrame.unionByName, [
        prep.select("visit_id", "period", "label", F.lit(n).alias("model"), m.posterior().alias("score"))
        for n, m in models.items()])


def flagship_comparison(spark, base):
    """Youden thresholds chosen on train scores, models compared and ranked on test."""
    s = model_scores(spark, base)
    thr = EV.youden(s.where(F.col("period") == "train"), ["model"]).select("model", "threshold")
    return EV.rank_models(EV.compare_models(s.where(F.col("period") == "test"), thr))


_TRAIN_ROC = _roc_sql("strain").replace("sh AS (", "tsh AS (").replace("FROM sh)", "FROM tsh)").replace("roc AS (", "troc AS (")


@register("flagship_compare", rounded(with_(VISITS, ART_SQL, VPREP, NB_SQL, NB_SCORE_SQL, LDA_SQL, """
scored AS (SELECT n.visit_id, n.period, v.label, 'naive_bayes' AS model, n.score FROM nbscore n JOIN vprep v ON n.visit_id = v.visit_id
           UNION ALL SELECT v.visit_id, v.period, v.label, 'lda', 1 / (1 + exp(-(l.c + v.prd * l.b1 + v.prd_value * l.b2)))
           FROM vprep v, lfin l),
st AS (SELECT * FROM scored WHERE period = 'test'), strain AS (SELECT * FROM scored WHERE period = 'train')""",
    _TRAIN_ROC, """
tj AS (SELECT *, tp / P + (N - fp) / N - 1 AS j FROM troc),
tb AS (SELECT model, max(j) AS bj FROM tj GROUP BY model),
ts AS (SELECT t.model, min(t.threshold) AS s FROM tj t JOIN tb ON t.model = tb.model AND t.j = tb.bj GROUP BY t.model),
thr AS (SELECT ts.model, CASE WHEN max(t.threshold) FILTER (WHERE t.threshold < ts.s) IS NULL THEN CAST('-inf' AS DOUBLE)
                              ELSE (ts.s + max(t.threshold) FILTER (WHERE t.threshold < ts.s)) / 2 END AS threshold
        FROM ts JOIN tj t ON t.model = ts.model GROUP BY ts.model, ts.s)""", _CMP_SQL, body="SELECT * FROM ranked"), _CMP_COLS))
def flagship_compare(spark, base):
    """Flagship: NB and LDA on prepared visits, Youden thresholds from train, ranked on test."""
    return flagship_comparison(spark, base)


# ------------------------------------------------------------------ F1-F3

def _logistic(prep, feats, alpha=0.5):
    return LIN.fit_logistic_cv(_train(prep), feats, "label", "weight", alpha, LR_LAMBDAS, "fold10", LR_FOLDS)


def _scored(model, prep, feats):
    rows = model.score(prep) if hasattr(model, "bins") else TR.score_model(model, prep, feats)
    return rows.select("visit_id", "period", "label", "score")


@register("logreg_scores")
def logreg_scores(spark, base):
    """F1: weighted elastic-net logistic regression (alpha 0.5, CV lambda) scores on all visits."""
    with prepared(spark, base) as (prep, feats):
        model, _ = _logistic(prep, feats)
    return _scored(model, prep, feats)


@register("logreg_cv_path")
def logreg_cv_path(spark, base):
    """the lambda path (100 penalties, 10 folds) with its cross-validated deviance."""
    with prepared(spark, base) as (prep, feats):
        return _logistic(prep, feats)[1]


@register("penalty_comparison")
def penalty_comparison(spark, base):
    """ridge / elastic net / lasso: accuracy, kappa (Youden threshold on train, '>'), test AUC."""
    names = {0.0: "Ridge", 0.5: "ElasticNet", 1.0: "Lasso"}
    with prepared(spark, base) as (prep, feats):
        table = LIN.penalty_path_cv(_train(prep), feats, "label", "weight", list(names), LR_LAMBDAS, "fold10", LR_FOLDS)
        models = {a: LIN.fit_logistic(_train(prep), feats, "label", "weight", a, lam)
                  for a, lam in LIN.best_penalties(table).items()}
    sc = reduce(DataFrame.unionByName, [
        _scored(m, prep, feats).withColumn("model", F.lit(names[a])).withColumn("alpha", F.lit(a)) for a, m in models.items()])
    thr = EV.youden(sc.where(F.col("period") == "train"), ["model", "alpha"]).select("model", "alpha", "threshold")
    te = sc.where(F.col("period") == "test")
    m = EV.metrics(EV.confusion(te, thr, ["model", "alpha"], inclusive=False), ["model", "alpha"])
    return m.join(EV.roc_auc(te, ["model", "alpha"]), ["model", "alpha"]).select(
        "model", "alpha", "accuracy", "kappa", F.col("roc_auc").alias("auc"))


@register("odds_ratios")
def odds_ratios(spark, base):
    """odds ratios of the non-zero coefficients, top 10 and bottom 5."""
    with prepared(spark, base) as (prep, feats):
        model, _ = _logistic(prep, feats)
    return LIN.odds_head_tail(LIN.odds_ratios(model, feats), 10, 5)


@register("odds_rank", rounded(with_(VISITS, ART_SQL, VPREP, LDA_SQL, """
b AS (SELECT 'prd' AS feature, b1 AS coefficient FROM lfin UNION ALL SELECT 'prd_value', b2 FROM lfin)""", body="""
SELECT feature, coefficient, exp(coefficient) AS odds_ratio,
       CAST(row_number() OVER (ORDER BY exp(coefficient) DESC, feature) AS BIGINT) AS rank FROM b WHERE coefficient <> 0"""),
    ["coefficient", "odds_ratio"]))
def odds_rank(spark, base):
    """F3 on closed-form coefficients: the log-odds weights of the two-feature discriminant, as ranked odds ratios."""
    lda = G.fit_lda(_train(_visit_prep(spark, base)), LDA_F)
    return LIN.ranked_odds(spark, lda.features, lda.coef)


# ------------------------------------------------------------------ F4, F5

def binned(prep, feats, *tags):
    """The train visits, written once as bins; every tree model of a query is fitted on them."""
    return binned_table(_train(prep), feats, "visit_id", "label", tags)


@register("tree_scores")
def tree_scores(spark, base):
    """class-weighted CART, pruned at the penalty that 10-fold cross-validation chooses; scores of all visits."""
    with prepared(spark, base) as (prep, feats):
        model, _ = PR.fit_cart(binned(prep, feats, "fold10"), "fold10")
    return _scored(model, prep, feats)


@register("tree_prune_path")
def tree_prune_path(spark, base):
    """the cost-complexity table: penalty, splits, relative and cross-validated error."""
    with prepared(spark, base) as (prep, feats):
        return PR.fit_cart(binned(prep, feats, "fold10"), "fold10")[1]


# ------------------------------------------------------------------ F10-F14

def _forest(prep, feats, num_trees=N_TREES):
    return BG.fit_forest(binned(prep, feats), num_trees, seed=42)


@register("forest_scores")
def forest_scores(spark, base):
    """random forest (500 full trees, mtry floor(sqrt p)) with a balanced draw per tree, scores on all visits."""
    with prepared(spark, base) as (prep, feats):
        model = _forest(prep, feats)
    return _scored(model, prep, feats)


@register("oob_scores")
def oob_scores(spark, base):
    """out-of-bag votes of the forest for the train visits."""
    with prepared(spark, base) as (prep, feats):
        table = binned(prep, feats)
    return BG.oob_votes(table, [BG.fit_forest(table, N_TREES, seed=42)], "visit_id").drop("forest")


@register("oof_scores")
def oof_scores(spark, base):
    """Out-of-fold scores of forests on train visits: the check on F11's out-of-bag votes."""
    with prepared(spark, base) as (prep, feats):
        tr = _train(prep)
        bins, parts = fit_bins(tr, feats), []
        for f in range(N_FOLDS):
            rest = binned_table(tr.where(F.col("fold") != f), feats, "visit_id", "label", bins=bins)
            parts.append(written(BG.fit_forest(rest, N_TREES, seed=42).score(tr.where(F.col("fold") == f)).select("visit_id", "label", "score"),
                                 "oof"))                                    # while the visits are cached
    return reduce(DataFrame.unionByName, parts)


@register("forest_stability")
def forest_stability(spark, base):
    """F12 on a forest: out-of-bag error by number of trees (800) and the stable tree count (else 800)."""
    with prepared(spark, base) as (prep, feats):
        table = binned(prep, feats)
    path = BG.oob_error_path(table, BG.fit_forest(table, 800, seed=42))
    stable = TR.stable_iteration(path, "n_trees", "error", 0.0005, 50, fallback=800)      # one row
    return path.withColumn("_k", F.lit(0)).join(stable.withColumn("_k", F.lit(0)), "_k").drop("_k")


@register("forest_tuning")
def forest_tuning(spark, base):
    """F13 + F14: coordinate search on out-of-bag PR-AUC over the full grids, 500 trees a setting; the sensitivity table."""
    with prepared(spark, base) as (prep, feats):
        return BG.forest_search(binned(prep, feats), N_TREES)


@register("forest_decision")
def forest_decision(spark, base):
    """F19 on real models: the default forest or the tuned one, by test PR-AUC, ties to the default."""
    with prepared(spark, base) as (prep, feats):
        table = binned(prep, feats)
        best = BG.tuned_parameters(BG.forest_search(table, N_TREES))
        models = dict(zip(("default", "tuned"), BG.fit_forests(table, [{}, best], N_TREES, seed=42)))
        scores = written(reduce(DataFrame.unionByName, [                    # while the visits are cached; read more than once
            _scored(m, _test(prep), feats).withColumn("model", F.lit(n)) for n, m in models.items()]), "scores")
    return TR.model_pick(EV.pr_auc(scores, ["model"]), "default", "tuned")


# ------------------------------------------------------------------ F15-F18

def _scale_pos(prep):
    return S.scale_pos_weight(prep.drop("weight"), "label", 1.0, "weight")


def _positive_weight(table):
    """Rows of class 0 over rows of class 1."""
    n0, n1 = (int(n) for n in table.totals)
    return n0 / n1 if n1 else 1.0


def _with_role(prep):
    """The period roles as numbers: 0 to fit on, 1 to validate on, null otherwise."""
    role = F.when(F.col("role") == "fit", 0).when(F.col("role") == "validate", 1)
    return prep.withColumn("role", role)


def _default_booster(table):
    return BO.fit_booster(table, BO.Params(scale_pos=_positive_weight(table)), 30)


@register("boost_scores")
def boost_scores(spark, base):
    """gradient-boosted trees (30 rounds, L2 10, L1 1, positive-class weight), scores on all visits."""
    with prepared(spark, base) as (prep, feats):
        m = _default_booster(binned(prep, feats))
    return _scored(m, prep, feats)


@register("boost_tuning")
def boost_tuning(spark, base):
    """F16: 5 spread + 10 guided trials within the reference's bounds, on the temporal hold-out by PR-AUC, patience 10."""
    with prepared(spark, base) as (prep, feats):
        return BO.boost_search(binned(_with_role(prep), feats, "role"), "role")


@register("boost_rounds")
def boost_rounds(spark, base):
    """boosting rounds (300 at most) by 5-fold cross-validated PR-AUC with a patience of 30."""
    with prepared(spark, base) as (prep, feats):
        table = binned(prep, feats, "fold")
    params = BO.Params(max_depth=4, eta=0.1, scale_pos=_positive_weight(table))
    return BO.cv_rounds(table, params, "fold", range(N_FOLDS))


@register("boost_final")
def boost_final(spark, base):
    """refit on all train visits with the best trial's parameters and the rounds that CV chooses for them;
    every visit's score and its class at the threshold of G10 on train."""
    with prepared(spark, base) as (prep, feats):
        table = binned(_with_role(prep), feats, "role", "fold")
        best = replace(BO.best_params(BO.boost_search(table, "role")), scale_pos=_positive_weight(table))
        rounds = BO.cv_rounds(table, best, "fold", range(N_FOLDS)).where("chosen = 1").first()["round"]      # one row
        m = BO.fit_booster(table, best, rounds)
    scores = _scored(m, prep, feats).withColumn("model", F.lit("boost"))
    grid = EV.threshold_grid(scores.where(F.col("period") == "train"), ["model"]).where("best = 1")
    return scores.join(grid.select("model", "threshold"), "model").select(
        "visit_id", "period", "label", "score", "threshold", EV.classify("score", "threshold", False).alias("pred"))


# ------------------------------------------------------------------ F20: six models from saved packets

RATIO_NUM = [c for c in FX.V_NUMERIC if c not in ("adm", "adm_value", "err_rate")] + ["adm_avg"]


def own_preparation(spark, base, visits=None):
    """Visits for the linear and closed-form models: near-constant columns (train) and collinear ones dropped,
    a count and its value replaced by their ratio, then an artifact of their own."""
    v = with_roles(visit_key(FX.visits(spark, base)) if visits is None else visits)
    treated = FE.collinearity_treatment(v, **COLLINEAR)
    train = treated.where(F.col("period") == "train")
    flat = {r["feature"] for r in P.near_zero_variance(train, RATIO_NUM).where("nzv = 1").collect()}
    spec = replace(V_SPEC, numeric=[c for c in RATIO_NUM if c not in flat], keep=KEEP)
    art = fit_artifact(train, spec)
    return apply_with_folds(treated, art), art


def train_packets(spark, base, path, visits=None):
    """Fit the six models side by side, each on its own preparation, choose each threshold on train, save the packets."""
    def on_own():
        own, art = own_preparation(spark, base, visits)
        own, feats = own.persist(StorageLevel.MEMORY_AND_DISK), art.feature_names()
        plain = art.spec.numeric + ["is_returning"]        # no dummies: the discriminant needs full rank
        return own, {"naive_bayes": (G.fit_gaussian_nb(_train(own), feats), own, feats, "own"),
                     "lda": (G.fit_lda(_train(own), plain), own, plain, "own"),
                     "logistic": (_logistic(own, feats)[0], own, feats, "own")}

    with ThreadPoolExecutor(6) as pool:
        linear = pool.submit(on_own)
        with prepared(spark, base, visits) as (prep, all_feats):
            table = binned(prep, all_feats, "fold10")
            trees = {"cart": pool.submit(lambda: PR.fit_cart(table, "fold10")[0]),
                     "forest": pool.submit(BG.fit_forest, table, N_TREES, seed=42),
                     "boost": pool.submit(_default_booster, table)}
            own, fitted = linear.result()
            fitted |= {name: (m.result(), prep, all_feats, "all") for name, m in trees.items()}
            scores = written(reduce(DataFrame.unionByName, [                    # read more than once: the models score once
                _packet_scores(name, m, _train(d), f) for name, (m, d, f, _) in fitted.items()]), "scores")
            thresholds = {r["model"]: r["threshold"] for r in EV.youden(scores, ["model"]).collect()}      # six rows
        own.unpersist()
    for name, (m, _, f, preparation) in fitted.items():
        IO.save_packet(m, path, name, thresholds[name], {"features": f, "preparation": preparation})


def _packet_scores(name, model, df, feats):
    if hasattr(model, "bins"):
        s = model.score(df)
    else:
        s = model.transform(df) if hasattr(model, "posterior") else TR.score_model(model, df, feats)
    return s.select("visit_id", F.lit(name).alias("model"), "score", "label")


MODEL_NAMES = ["naive_bayes", "lda", "logistic", "cart", "forest", "boost"]


def score_packets(spark, base, path, visits=None):
    """every packet's score of the test visits: (visit_id, model, score, label, threshold)."""
    packets = IO.load_packets(spark, path, MODEL_NAMES)
    with ThreadPoolExecutor(1) as pool:
        own = pool.submit(own_preparation, spark, base, visits)
        v, art = visit_artifact(spark, base, replace(V_SPEC, keep=KEEP), visits)
        inputs = {"all": art.transform(with_roles(v)), "own": own.result()[0]}
    return reduce(DataFrame.unionByName, [
        _packet_scores(n, p["model"], _test(inputs[p["params"]["preparation"]]), p["params"]["features"])
        .withColumn("threshold", F.lit(p["threshold"])) for n, p in packets.items()])


def _all_scores(spark, base):
    """The six models fitted, saved, loaded and scored: once, however often the scores are read."""
    # cached, not written: the logistic fits then see the rows in the order of the shuffle, as they do without
    path, visits = _packet_path(spark), visit_key(FX.visits(spark, base)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_packets(spark, base, path, visits)
        return written(score_packets(spark, base, path, visits), "scores")
    finally:
        visits.unpersist()


def _packet_path(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/packets-{uuid.uuid4().hex}"


@register("score_all_models")
def score_all_models(spark, base):
    """every model scored on the test visits from its saved packet, long form, with its threshold."""
    return _all_scores(spark, base)


@register("final_comparison")
def final_comparison(spark, base):
    """The six models, loaded from packets, at their own thresholds, compared and ranked on the test visits."""
    scores = _all_scores(spark, base)
    thresholds = scores.select("model", "threshold").distinct()
    return EV.rank_models(EV.compare_models(scores.drop("threshold"), thresholds))


# ------------------------------------------------------------------ F21-F23

@register("permutation_importance")
def permutation_importance(spark, base):
    """mean loss of out-of-bag accuracy by permuted feature, over its standard error (default forest), top 10."""
    with prepared(spark, base) as (prep, feats):
        table = binned(prep, feats)
    imp = BG.oob_importance(table, BG.fit_forest(table, N_TREES, seed=42), seed=7)
    return imp.orderBy(F.col("importance").desc(), "feature").limit(10)


@register("partial_dependence")
def partial_dependence(spark, base):
    """partial dependence (half log-odds) of the 3 most important features of the default forest, 51-point grids."""
    with prepared(spark, base) as (prep, feats):
        table = binned(prep, feats)
        forest = BG.fit_forest(table, N_TREES, seed=42)
        imp = BG.oob_importance(table, forest, seed=7)
        top = [r.feature for r in imp.orderBy(F.col("importance").desc(), "feature").limit(3).collect()]
        return BG.partial_dependence(table, forest, _train(prep), top, n_grid=51)


@register("shap_summary")
def shap_summary(spark, base):
    """mean |SHAP| per feature of the boosted model (TreeSHAP), top 10."""
    with prepared(spark, base) as (prep, feats):
        m = TR.fit_boost(_scale_pos(_train(prep)), feats, "label", "weight", max_iter=30, max_depth=4)
    contrib = X.tree_shap(m, _test(prep), feats, "visit_id")
    return X.shap_summary(contrib, feats).orderBy(F.col("mean_abs_shap").desc(), "feature").limit(10)
