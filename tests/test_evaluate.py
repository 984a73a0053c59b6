import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import evaluate as EV

SCORES = [0.9, 0.8, 0.8, 0.7, 0.5, 0.5, 0.3, 0.1]
LABELS = [1, 1, 0, 1, 0, 1, 0, 0]


def frame(spark, scores, labels, model="m"):
    return spark.createDataFrame([(model, None if s is None else float(s), int(y)) for s, y in zip(scores, labels)],
                                 "model string, score double, label int")


def brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def numeric_pr_auc(s, y, steps=20000):
    """Integrate the interpolated precision over recall numerically."""
    s, y = np.array(s), np.array(y)
    P = y.sum()
    area, tp, fp = 0.0, 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        dtp, dfp = y[s == t].sum(), (1 - y[s == t]).sum()
        if dtp > 0:
            xs = np.linspace(0, 1, steps + 1)
            mid = (xs[:-1] + xs[1:]) / 2
            tpi = tp + mid * dtp
            fpi = fp + mid * dfp
            area += (tpi / (tpi + fpi)).mean() * dtp / P
        tp, fp = tp + dtp, fp + dfp
    return area


@pytest.mark.parametrize("rpb", [1, 2])
def test_auc_and_pr_auc(spark, rpb):
    df = frame(spark, SCORES, LABELS)
    auc = EV.roc_auc(df, ["model"], n_ranges=rpb).first()["roc_auc"]
    assert auc == pytest.approx(brute_auc(SCORES, LABELS), abs=1e-12)
    pr = EV.pr_auc(df, ["model"], n_ranges=rpb).first()["pr_auc"]
    assert pr == pytest.approx(numeric_pr_auc(SCORES, LABELS), abs=1e-6)


def test_random_ties_pr_auc(spark):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(400), 1)
    y = (rng.random(400) < 0.3).astype(int)
    df = frame(spark, s.tolist(), y.tolist())
    assert EV.pr_auc(df, ["model"]).first()["pr_auc"] == pytest.approx(numeric_pr_auc(s, y), abs=1e-6)
    assert EV.roc_auc(df, ["model"]).first()["roc_auc"] == pytest.approx(brute_auc(s, y), abs=1e-12)


def test_auc_invariant_under_monotone_transform(spark):
    df = frame(spark, SCORES, LABELS)
    a = EV.roc_auc(df, ["model"]).first()["roc_auc"]
    b = EV.roc_auc(df.withColumn("score", F.pow("score", 3) + 7), ["model"]).first()["roc_auc"]
    assert a == pytest.approx(b)


def test_edge_cases(spark):
    one_class = frame(spark, [0.1, 0.2, 0.3], [1, 1, 1])
    assert EV.roc_auc(one_class, ["model"]).first()["roc_auc"] is None
    equal = frame(spark, [0.5] * 6, [1, 0, 1, 0, 0, 1])
    assert EV.roc_auc(equal, ["model"]).first()["roc_auc"] == pytest.approx(0.5)
    assert EV.pr_auc(equal, ["model"]).first()["pr_auc"] == pytest.approx(0.5)
    with_null = frame(spark, SCORES + [None], LABELS + [1])
    assert EV.roc_auc(with_null, ["model"]).first()["roc_auc"] == pytest.approx(brute_auc(SCORES, LABELS))
    # ungrouped input works through a constant group
    assert EV.roc_auc(frame(spark, SCORES, LABELS).drop("model")).first()["roc_auc"] == pytest.approx(
        brute_auc(SCORES, LABELS))


def test_confusion_metrics_by_hand(spark):
    df = frame(spark, SCORES, LABELS)
    conf = EV.confusion(df, 0.5, ["model"]).first()
    # >= 0.5: predicted positive = 0.9 0.8 0.8 0.7 0.5 0.5
    assert (conf.tp, conf.fp, conf.tn, conf.fn) == (4, 2, 2, 0)
    m = EV.metrics(EV.confusion(df, 0.5, ["model"]), ["model"]).first()
    po, pe = 6 / 8, (6 * 4 + 2 * 4) / 64
    assert m.accuracy == pytest.approx(po)
    assert m.kappa == pytest.approx((po - pe) / (1 - pe))
    assert m.sensitivity == 1.0 and m.specificity == 0.5 and m.precision == pytest.approx(4 / 6)
    assert m.f1 == pytest.approx(2 * (4 / 6) / (4 / 6 + 1))
    assert m.balanced_accuracy == pytest.approx(0.75)
    strict = EV.confusion(df, 0.5, ["model"], inclusive=False).first()
    assert (strict.tp, strict.fp) == (3, 1)
    rep = EV.report(EV.confusion(df, 0.5, ["model"]), ["model"]).first()
    assert rep.npv == 1.0 and rep.prevalence == 0.5 and rep.mcnemar_statistic == pytest.approx((2 - 1) ** 2 / 2)


def test_youden_brute_force(spark):
    df = frame(spark, SCORES, LABELS)
    r = EV.youden(df, ["model"]).first()
    s, y = np.array(SCORES), np.array(LABELS)
    d = sorted(set(SCORES))
    cands = [-math.inf] + [(a + b) / 2 for a, b in zip(d, d[1:])] + [math.inf]
    best = max(cands, key=lambda t: (((s >= t) & (y == 1)).sum() / 4 + ((s < t) & (y == 0)).sum() / 4, -t))
    assert r.threshold == pytest.approx(best)


def test_threshold_grid_brute_force(spark):
    rng = np.random.default_rng(5)
    s, y = rng.random(300), (rng.random(300) < 0.4).astype(int)
    df = frame(spark, s.tolist(), y.tolist())
    g = EV.threshold_grid(df, ["model"]).toPandas().sort_values("threshold")
    grid = [0.1 + i * 0.01 for i in range(61)]
    want = [(((s > t) & (y == 1)).sum() / y.sum() + ((s <= t) & (y == 0)).sum() / (1 - y).sum()) / 2 for t in grid]
    assert np.allclose(g["balanced_accuracy"].to_numpy(), want)
    assert g.loc[g["best"] == 1, "threshold"].iloc[0] == pytest.approx(grid[int(np.argmax(want))])


def test_compare_rank_best(spark):
    a = frame(spark, SCORES, LABELS, "a")
    b = frame(spark, list(reversed(SCORES)), LABELS, "b")
    cmp = EV.compare_models(a.unionByName(b), {"a": 0.5, "b": 0.5})
    ranked = {r.model: r.rank for r in EV.rank_models(cmp).collect()}
    assert ranked["a"] == 1 and EV.best_model(cmp).first().model == "a"
    long = EV.profile_long(cmp)
    assert long.count() == 2 * 9
    ff = EV.fourfold(EV.confusion(a, 0.5, ["model"])).toPandas()
    assert np.allclose(ff.groupby("actual")["share"].sum(), 1.0)


def test_mcnemar_p_value(spark):
    rep = spark.createDataFrame([("a", 3.841458820694124), ("b", 0.0), ("c", None)], "model string, mcnemar_statistic double")
    got = {r.model: r.mcnemar_p_value for r in EV.mcnemar_p_value(rep).collect()}
    assert got["a"] == pytest.approx(0.05, abs=1e-9) and got["b"] == pytest.approx(1.0) and got["c"] is None


def test_null_and_nan_scores_count_nowhere(spark):
    rows = [("m", 0.9, 1), ("m", 0.2, 0), ("m", None, 1), ("m", float("nan"), 0), ("m", 0.4, None)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    c = EV.confusion(df, 0.5).first()
    assert (c.tp, c.fp, c.tn, c.fn, c.n_unscored) == (1, 0, 1, 0, 3)
    assert EV.roc_points(df, ["model"]).count() == 2
    assert [r.p for r in df.select(EV.classify("score", 0.5).alias("p")).collect()] == [1, 0, None, None, 0]
