import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from propensity.operators import evaluate as EV
from propensity.operators import split as S
from propensity.operators.features import design_matrix
from propensity.operators.models import explain as X
from propensity.operators.models import generative as G
from propensity.operators.models import linear as LIN
from propensity.operators.models import trees as TR


@pytest.fixture(scope="module")
def gaussian_pair(spark):
    rng = np.random.default_rng(11)
    cov = np.array([[1.0, 0.3, 0.1], [0.3, 1.0, 0.2], [0.1, 0.2, 1.0]])
    a = rng.multivariate_normal([0, 0, 0], cov, 600)
    b = rng.multivariate_normal([1, 0.5, -0.5], cov, 400)
    X_ = np.vstack([a, b])
    y = np.r_[np.zeros(600), np.ones(400)]
    rows = [(i, float(y[i]), *map(float, X_[i])) for i in range(1000)]
    return spark.createDataFrame(rows, "id long, label double, x0 double, x1 double, x2 double"), X_, y


def test_naive_bayes_matches_numpy(spark, gaussian_pair):
    df, X_, y = gaussian_pair
    feats = ["x0", "x1", "x2"]
    nb = G.fit_gaussian_nb(df, feats)
    got = np.array([r.s for r in df.orderBy("id").select(nb.posterior().alias("s")).collect()])
    L = []
    for c in (0, 1):
        Xc = X_[y == c]
        m, s = Xc.mean(0), Xc.std(0, ddof=1)
        dens = np.exp(-0.5 * ((X_ - m) / s) ** 2) / (s * math.sqrt(2 * math.pi))
        L.append(math.log(len(Xc) / len(X_)) + np.log(dens).sum(1))
    want = 1 / (1 + np.exp(L[0] - L[1]))
    assert np.allclose(got, want, atol=1e-9)


def test_lda_matches_numpy(spark, gaussian_pair):
    df, X_, y = gaussian_pair
    lda = G.fit_lda(df, ["x0", "x1", "x2"])
    m0, m1 = X_[y == 0].mean(0), X_[y == 1].mean(0)
    W = ((X_[y == 0] - m0).T @ (X_[y == 0] - m0) + (X_[y == 1] - m1).T @ (X_[y == 1] - m1)) / (len(X_) - 2)
    w = np.linalg.solve(W, m1 - m0)
    c = -(m0 + m1) @ w / 2
    want = 1 / (1 + np.exp(-(X_ @ w + c)))
    got = np.array([r.s for r in df.orderBy("id").select(lda.posterior().alias("s")).collect()])
    assert np.allclose(got, want, atol=1e-9)
    ld = np.array([r.v for r in df.orderBy("id").select(lda.ld1().alias("v")).collect()])
    within = np.r_[ld[y == 0] - ld[y == 0].mean(), ld[y == 1] - ld[y == 1].mean()]
    assert (within ** 2).sum() / (len(ld) - 2) == pytest.approx(1.0, rel=1e-6)


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    n = 3000
    X_ = rng.normal(size=(n, 6))
    logit = 2.0 * X_[:, 0] - 1.5 * X_[:, 1] - 2.5
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(float)
    rows = [(i, float(y[i]), *map(float, X_[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, " + ", ".join(f"x{j} double" for j in range(6)))
    df = df.withColumn("fold", S.fold_column("id", 5)).withColumn("split", F.when(F.col("id") % 4 == 0, "test")
                                                                   .otherwise("train"))
    return S.balanced_weights(df, "label").cache()


FEATS = [f"x{j}" for j in range(6)]


def auc_of(scored):
    return EV.roc_auc(scored.withColumn("model", F.lit("m")), ["model"]).first()["roc_auc"]


def test_logistic_cv_learns_signal(spark, planted):
    tr, te = planted.where("split = 'train'"), planted.where("split = 'test'")
    model, cv = LIN.fit_logistic_cv(tr, FEATS, "label", "weight", 0.5, n_lambda=5, n_folds=5)
    assert cv.count() == 5
    assert auc_of(LIN.score_logistic(model, te, FEATS)) > 0.8
    odds = LIN.odds_ratios(model, FEATS).collect()
    top = odds[0].feature
    assert top == "x0" and odds[-1].feature == "x1"


def test_tree_forest_boost_beat_chance(spark, planted):
    tr, te = planted.where("split = 'train'"), planted.where("split = 'test'")
    tree, path = TR.fit_tree_cv(tr, FEATS, "label", "weight", grid=[0.0, 0.01], max_depth=5)
    assert path.count() == 2 and auc_of(TR.score_model(tree, te, FEATS)) > 0.7
    rf = TR.fit_forest(tr, FEATS, "label", "weight", num_trees=10, max_depth=5)
    assert auc_of(TR.score_model(rf, te, FEATS)) > 0.75
    gbt = TR.fit_boost(tr, FEATS, "label", None, max_iter=10, max_depth=3)
    assert auc_of(TR.score_model(gbt, te, FEATS)) > 0.75
    err = TR.tree_error_path(rf, te, FEATS).toPandas()
    assert list(err["n_trees"]) == list(range(1, 11))
    whole = TR.score_model(rf, te, FEATS).toPandas()
    votes = np.mean([t.transform(design_matrix(te, FEATS)).select("prediction").toPandas()["prediction"]
                     for t in rf.trees], axis=0)
    want = ((votes > 0.5) != (whole["label"] > 0.5)).mean()
    assert err["error"].iloc[-1] == pytest.approx(want)


def test_penalty_path_equals_one_fit_at_a_time(spark, planted):
    """The batched Newton fits against Spark ML's on one fold and penalty."""
    tr = planted.where("split = 'train'")
    table = LIN.penalty_path_cv(tr, FEATS, "label", "weight", [0.0, 0.5, 1.0], 4, "fold", 5).toPandas()
    assert len(table) == 12
    for alpha in (0.0, 0.5, 1.0):
        row = table[table.alpha == alpha].iloc[2]
        dev = []
        for f in range(5):
            m = LIN.fit_logistic(tr.where(F.col("fold") != f), FEATS, "label", "weight", alpha, row.reg_param, 500)
            p = LIN.score_logistic(m, tr.where(F.col("fold") == f), FEATS).toPandas()
            ll = -2 * (p.label * np.log(p.score) + (1 - p.label) * np.log(1 - p.score))
            dev.append((p.weight * ll).sum() / p.weight.sum())
        assert row.cv_deviance == pytest.approx(np.mean(dev), rel=5e-3)


def test_first_penalty_zeroes_every_coefficient(spark, planted):
    tr = planted.where("split = 'train'")
    lam = LIN.lambda_max(tr, FEATS, "label", "weight", 0.5)
    at = lambda k: np.abs(LIN.fit_logistic(tr, FEATS, "label", "weight", 0.5, lam * k, 300).coefficients.toArray()).max()
    assert at(1.02) < 1e-3 < at(0.8)


def test_out_of_fold_scores_cover_train(spark, planted):
    tr = planted.where("split = 'train'")
    fit = lambda d: TR.fit_forest(d, FEATS, "label", "weight", num_trees=5, max_depth=4)
    oof = TR.out_of_fold_scores(tr, FEATS, fit, "fold", 5)
    assert oof.count() == tr.count() and oof.select("id").distinct().count() == tr.count()


def test_tree_shap_additivity_and_importance(spark, planted):
    tr, te = planted.where("split = 'train'"), planted.where("split = 'test'")
    gbt = TR.fit_boost(tr, FEATS, "label", None, max_iter=8, max_depth=3)
    contrib = X.tree_shap(gbt, te, FEATS, "id")
    raw = gbt.transform(design_matrix(te, FEATS)).select("id", vector_to_array("rawPrediction")[1].alias("m"))
    j = contrib.join(raw, "id").toPandas()
    assert np.allclose(j["margin"], j["m"], atol=1e-9)
    summ = {r.feature: r.mean_abs_shap for r in X.shap_summary(contrib, FEATS).collect()}
    assert max(summ, key=summ.get) in ("x0", "x1")
    imp = X.permutation_importance(gbt, te, FEATS, "id", "label", seed=3).toPandas()
    assert imp.sort_values("importance").iloc[-1]["feature"] in ("x0", "x1")
    pdp = X.partial_dependence(gbt, te, FEATS, ["x0"], n_grid=11).toPandas().sort_values("value")
    assert len(pdp) == 11 and pdp["pd"].iloc[-1] > pdp["pd"].iloc[0]


def test_stable_iteration(spark):
    calm = [(i + 1, 0.3 - 0.01 * i) for i in range(10)] + [(i + 11, 0.2) for i in range(60)]
    df = spark.createDataFrame(calm, "n long, err double")
    assert TR.stable_iteration(df, "n", "err", 0.0005, 50).first()[0] == 61   # 50th calm step
    noisy = spark.createDataFrame([(i + 1, 0.1 * (i % 2)) for i in range(80)], "n long, err double")
    assert TR.stable_iteration(noisy, "n", "err", 0.0005, 50, fallback=800).first()[0] == 800


def test_model_pick(spark):
    cmp = spark.createDataFrame([("rf", 0.6), ("rf_tuned", 0.6), ("gb", 0.5), ("gb_tuned", 0.7)],
                                "model string, pr_auc double")
    assert TR.model_pick(cmp, "rf", "rf_tuned").first().picked == "rf"
    assert TR.model_pick(cmp, "gb", "gb_tuned").first().picked == "gb_tuned"


def test_boost_search_uses_the_later_period_and_stops_early(spark, planted):
    tr = planted.where("split = 'train'").withColumn("role", F.when(F.col("id") % 5 == 0, "validate").when(
        F.col("id") % 5 == 1, "unused").otherwise("fit"))
    trials = TR.boost_tuning(tr, "role", FEATS, n_init=2, n_iter=1, max_rounds=6).toPandas()
    assert len(trials) == 3 and trials["rounds"].between(1, 6).all() and sorted(trials["rank"]) == [1, 2, 3]
    best = TR.best_trial(TR.boost_tuning(tr, "role", FEATS, n_init=1, n_iter=0, max_rounds=3))
    assert set(best) == set(TR.BOOST_SPACE)
    path = TR.boost_rounds(tr, FEATS, k=2, fold_col="fold", max_rounds=8, patience=3, max_depth=3).toPandas()
    assert path["chosen"].sum() == 1 and len(path) <= 8


def test_six_models_from_saved_packets(spark, tmp_path, monkeypatch):
    from propensity.plans import q_models as Q
    from tests.conftest import SMALL
    monkeypatch.setattr(Q, "N_TREES", 10)
    monkeypatch.setattr(Q, "LR_LAMBDAS", 6)
    path = str(tmp_path / "packets")
    Q.train_packets(spark, SMALL, path)
    s = Q.score_packets(spark, SMALL, path)
    ranked = EV.rank_models(EV.compare_models(s.drop("threshold"), s.select("model", "threshold").distinct())).toPandas()
    assert sorted(ranked["model"]) == sorted(Q.MODEL_NAMES) and sorted(ranked["rank"]) == [1, 2, 3, 4, 5, 6]
    # the closed-form rows follow from the tables alone
    own, art = Q.own_preparation(spark, SMALL)
    tr = own.where("period = 'train'").toPandas()
    te = own.where("period = 'test'").toPandas()
    feats = art.feature_names()
    L = []
    for c in (0.0, 1.0):
        x = tr[tr.label == c][feats]
        sd = x.std(ddof=1).where(lambda v: v > 0, 0.001)
        z = (te[feats] - x.mean()) / sd
        dens = np.exp(-0.5 * z * z) / (sd * math.sqrt(2 * math.pi))
        L.append(math.log((tr.label == c).mean()) + np.log(dens.where(dens > 0, 0.001)).sum(axis=1))
    want = dict(zip(te.visit_id, 1 / (1 + np.exp(L[0] - L[1]))))
    got = {r.visit_id: r.score for r in s.where("model = 'naive_bayes'").collect()}
    assert set(got) == set(want) and max(abs(got[k] - want[k]) for k in want) < 1e-8


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scores_that_queries_return_are_not_computed_again(spark, monkeypatch):
    """However often a caller reads the scores, the models score once: the result is a table, the visits are built once."""
    from propensity.plans import fixtures as FX
    from propensity.plans import q_models as Q
    from tests.conftest import SMALL
    monkeypatch.setattr(Q, "N_TREES", 6)
    monkeypatch.setattr(Q, "LR_LAMBDAS", 6)
    built, visits = [], FX.visits
    monkeypatch.setattr(FX, "visits", lambda *a: built.append(1) or visits(*a))
    got = Q.score_all_models(spark, SMALL)
    assert len(built) == 1 and "MapInArrow" not in plan_of(got)
    assert sorted(r["model"] for r in got.groupBy("model").count().collect()) == sorted(Q.MODEL_NAMES)
    built.clear()
    got = Q.oof_scores(spark, SMALL)
    assert len(built) == 1 and "MapInArrow" not in plan_of(got) and got.count() == got.select("visit_id").distinct().count()
    monkeypatch.setattr(Q.BG, "forest_search", lambda table, n: None)
    monkeypatch.setattr(Q.BG, "tuned_parameters", lambda search: {"mtry": 2, "nodesize": 5, "ratio": 1.0})
    built.clear()
    assert "MapInArrow" not in plan_of(Q.forest_decision(spark, SMALL)) and len(built) == 1


def test_warm_screened_path_meets_the_optimality_conditions(spark, planted):
    """At every penalty the slope of a non-zero coefficient equals its penalty, and no zero one has more."""
    tr = planted.where("split = 'train'").toPandas()
    x = tr[FEATS].to_numpy()
    mean = np.average(x, axis=0, weights=tr.weight)
    sd = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=tr.weight))
    rows = planted.where("split = 'train'").select(F.col("label").alias("y"), F.col("weight").alias("w"),
                                                   F.col("fold").cast("int").alias("f"), F.array(*FEATS).alias("x"))
    lmax = LIN.lambda_max(planted.where("split = 'train'"), FEATS, "label", "weight", 0.8)
    lam = np.array(LIN.lambda_path(lmax, 12))
    beta = LIN._PathFits(rows, mean, sd, 4).solve(np.zeros((12, 7)), np.zeros(12, int), lam, np.full(12, 0.8), 40, 1e-9)
    z, keep = (x - mean) / sd, (tr.fold != 0).to_numpy()
    for b, v in zip(beta, lam):
        p = 1 / (1 + np.exp(-(b[0] + z @ b[1:])))
        g = np.average((z * (p - tr.label.to_numpy())[:, None])[keep], axis=0, weights=tr.weight[keep])
        g = g + v * 0.2 * b[1:]
        on = b[1:] != 0
        assert np.allclose(g[on], -np.sign(b[1:][on]) * v * 0.8, atol=1e-6)
        assert (np.abs(g[~on]) <= v * 0.8 + 1e-6).all()
    assert (beta[0, 1:] == 0).sum() >= 4 and (beta[-1, 1:] != 0).all()


def test_penalty_path_does_not_depend_on_partitions(spark, planted):
    tr = planted.where("split = 'train'")
    few = LIN.penalty_path_cv(tr.coalesce(1), FEATS, "label", "weight", [0.5], 20, "fold", 5).toPandas()
    many = LIN.penalty_path_cv(tr.repartition(60), FEATS, "label", "weight", [0.5], 20, "fold", 5, tasks=3).toPandas()
    assert np.allclose(few.cv_deviance, many.cv_deviance, rtol=1e-6)
    rows = tr.repartition(60).select(F.lit(0.0).alias("y"), F.lit(1.0).alias("w"), F.lit(0).alias("f"), F.array("x0").alias("x"))
    assert LIN._PathFits(rows, np.zeros(1), np.ones(1), 3).rows.rdd.getNumPartitions() <= 3


def test_newton_blocks_are_bounded_by_fits():
    import pyarrow as pa
    n, fits = 10_000, 2610
    batch = pa.RecordBatch.from_pydict({"x": pa.array([[float(i), 1.0] for i in range(n)]), "y": np.zeros(n), "w": np.ones(n),
                                        "f": np.zeros(n, np.int32)})
    sizes = [len(y) for _, y, _, _ in LIN._blocks(batch, np.zeros(2), np.ones(2), fits)]
    assert sum(sizes) == n and max(sizes) * fits <= 500_000
