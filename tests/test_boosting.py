import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import evaluate as EV
from propensity.operators import split as S
from propensity.operators.models import binned as BN
from propensity.operators.models import boosting as BO

FEATS = [f"x{j}" for j in range(5)]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(6)
    n = 1600
    x = np.round(rng.normal(size=(n, 5)), 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(2.0 * x[:, 0] - 1.5 * x[:, 1] * x[:, 2] - 1.5)))).astype(float)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, " + ", ".join(f"{f} double" for f in FEATS))
    return df.withColumn("fold", S.fold_column("id", 4)).cache()


@pytest.fixture(scope="module")
def table(planted):
    return BN.binned_table(planted, FEATS, "id", tags=["fold"], block_rows=300)


def plain_boost(x, y, p, rounds, width):
    """Exhaustive search over all cuts, one node at a time, in floating point; the margins after every round."""
    margin, out = np.zeros(len(y)), []
    value = lambda g, h: -p.eta * np.sign(g) * max(abs(g) - p.l1, 0) / (h + p.l2)
    worth = lambda g, h: max(abs(g) - p.l1, 0) ** 2 / (h + p.l2)
    w = np.where(y == 1, p.scale_pos, 1.0)
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-margin))
        g, h = np.rint((prob - y) * w * 2 ** 26) / 2 ** 26, np.rint(prob * (1 - prob) * w * 2 ** 26) / 2 ** 26

        def go(rows, depth):
            best = None
            if depth < p.max_depth:
                for f in range(x.shape[1]):
                    for c in range(width - 1):
                        l, r = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                        if not len(l) or not len(r) or min(h[l].sum(), h[r].sum()) < p.min_child_weight:
                            continue
                        gain = worth(g[l].sum(), h[l].sum()) + worth(g[r].sum(), h[r].sum()) - worth(g[rows].sum(), h[rows].sum())
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, l, r)
            if best is None:
                return True, [(rows, value(g[rows].sum(), h[rows].sum()))]
            (leaf_l, a), (leaf_r, b) = go(best[1], depth + 1), go(best[2], depth + 1)
            if leaf_l and leaf_r and best[0] < p.gamma:
                return True, [(rows, value(g[rows].sum(), h[rows].sum()))]
            return False, a + b

        add = np.zeros(len(y))
        for rows, v in go(np.arange(len(y)), 0)[1]:
            add[rows] = v
        margin = margin + add
        out.append(margin)
    return out


@pytest.mark.parametrize("params", [BO.Params(max_depth=3, scale_pos=2.5), BO.Params(max_depth=4, gamma=6.0, min_child_weight=8, l2=1, l1=3),
                                    BO.Params(max_depth=2, eta=0.05, l1=0, l2=0.5)])
def test_boosting_equals_an_exhaustive_search(planted, table, params):
    whole = planted.toPandas()
    x = table.bins.codes(whole[FEATS].to_numpy())
    want = plain_boost(x, whole.label.to_numpy(), params, 4, table.bins.width)
    booster = BO.fit_booster(table, params, 4)
    for r in (1, 4):
        got = booster.score(planted, rounds=r).toPandas().set_index("id")["score"]
        assert np.allclose(got.loc[whole.id], 1 / (1 + np.exp(-want[r - 1])), atol=1e-7)
    assert any((t[0] >= 0).any() for t in booster.trees)


def same(a, b):
    return len(a.trees) == len(b.trees) and all(np.array_equal(x, y) for s, t in zip(a.trees, b.trees) for x, y in zip(s, t))


def test_resumed_and_saved_rounds_equal_one_long_fit(planted, table, monkeypatch, spark, tmp_path):
    params = BO.Params(max_depth=3, subsample=0.7, colsample=0.6, eta=0.2)
    long = BO.fit_booster(table, params, 9)
    monkeypatch.setattr(BO, "SAVE_ROUNDS", 2)
    parts = BO.Boosting(table, [BO.Spec(params)])
    for n in (1, 3, 5):
        parts.resume(n)
    assert parts.saved > 0 and same(long, parts.boosters[0])
    other = BN.binned_table(planted.repartition(9), FEATS, "id", tags=["fold"], block_rows=300)
    assert same(long, BO.fit_booster(other, params, 9))                 # any partitioning
    long.save(spark, str(tmp_path / "b"))
    assert same(long, BO.Booster.load(spark, str(tmp_path / "b"))) and BO.Booster.load(spark, str(tmp_path / "b")).params == params


def test_boosters_grown_together_equal_boosters_grown_alone(table):
    specs = [BO.Spec(BO.Params(max_depth=d, eta=0.3), frozenset({0, 1, 2, 3}) - {f}, frozenset([f])) for d, f in ((2, 0), (4, 1), (3, 2))]
    together = BO.Boosting(table, specs, "fold").run(5)
    for k, s in enumerate(specs):
        alone = BO.Boosting(table, [s], "fold").run(5)
        assert same(together.boosters[k], alone.boosters[0]) and together.history[k] == alone.history[0]
        assert len(alone.history[0]) == 5
    parts = BO.Boosting(table, specs[:1], "fold").run(2).resume(3)         # a round is measured once
    assert parts.history[0] == together.history[0]


@pytest.mark.parametrize("local", [0, 400])
def test_histogram_jobs_and_local_subtrees_give_the_same_trees(table, monkeypatch, local):
    specs = [BO.Spec(BO.Params(max_depth=4, gamma=1.0, subsample=0.8), frozenset({0, 1, 2, 3}) - {f}, frozenset([f])) for f in (0, 1)]
    here = BO.Boosting(table, specs, "fold").run(3)
    monkeypatch.setattr(BO, "LOCAL_ROWS", local)
    spread = BO.Boosting(table, specs, "fold").run(3)
    x = np.random.default_rng(0).integers(0, 32, size=(4000, len(FEATS))).astype(np.uint8)
    for a, b in zip(here.boosters, spread.boosters):
        for s, t in zip(a.trees, b.trees):
            assert (BO._margin_of(np.zeros(len(x)), x, [s]) == BO._margin_of(np.zeros(len(x)), x, [t])).all() and len(s[0]) == len(t[0])
    assert here.history == spread.history and len(here.history[0]) == 3


def test_held_out_measures(planted, table):
    spec = BO.Spec(BO.Params(max_depth=3), frozenset([0, 1, 2]), frozenset([3]))
    run = BO.Boosting(table, [spec], "fold").run(6)
    held = run.boosters[0].score(planted.where("fold = 3")).withColumn("m", F.lit(1))
    binned = held.withColumn("score", F.least(F.floor(F.col("score") * BO.SCORE_BINS), F.lit(BO.SCORE_BINS - 1)).cast("double"))
    assert run.history[0][-1]["pr_auc"] == pytest.approx(EV.pr_auc(binned, ["m"]).first()["pr_auc"], abs=1e-9)
    p = held.toPandas()
    want = -np.log(np.where(p.label == 1, p.score, 1 - p.score)).mean()
    assert run.history[0][-1]["log_loss"] == pytest.approx(want, abs=1e-6)


def test_patience_stops_at_the_best_round(table):
    spec = BO.Spec(BO.Params(max_depth=6, eta=1.0, l1=0, l2=0.1), frozenset([0, 1, 2]), frozenset([3]))
    run = BO.Boosting(table, [spec], "fold").run(60, patience=4, measure="log_loss")
    losses = [m["log_loss"] for m in run.history[0]]
    assert len(losses) < 60 and run.best_round(0, "log_loss") == int(np.argmin(losses)) + 1 == len(losses) - 4


def test_rounds_by_cross_validation(table):
    path = BO.cv_rounds(table, BO.Params(max_depth=4, eta=0.8, l1=0, l2=1), "fold", range(4), 40, 5).toPandas()
    assert path["chosen"].sum() == 1 and path["chosen"].to_numpy().argmax() == path["cv_score"].to_numpy().argmax()
    assert len(path) == 40 or len(path) - 1 - path["cv_score"].to_numpy().argmax() == 5


def test_guided_trials_beat_random_ones_on_planted_surfaces():
    wins = []
    for seed in range(12):
        rng = np.random.default_rng(100 + seed)
        peak = rng.random(3)
        f = lambda x: np.exp(-4 * ((np.atleast_2d(x) - peak) ** 2).sum(axis=1))
        proposer = BO.Proposer(3, seed)
        x = proposer.first(5)
        y = f(x)
        while len(x) < 15:
            new = proposer.next(x, y, 5)
            x, y = np.vstack([x, new]), np.append(y, f(new))
        wins.append(y.max() - f(rng.random((15, 3))).max())
    assert np.mean(wins) > 0.03 and sum(w > 0 for w in wins) >= 9


def test_search_and_best_trial(planted):
    df = planted.withColumn("role", F.when(F.col("fold") == 3, 1).when(F.col("fold") == 2, None).otherwise(0))
    table = BN.binned_table(df, FEATS, "id", tags=["role"], block_rows=500)
    space = BO.SPACE | {"eta": (0.1, 0.5), "gamma": (0.0, 2.0), "min_child_weight": (1, 5)}
    got = BO.boost_search(table, "role", n_init=3, n_iter=3, batch=2, max_rounds=6, patience=3, space=space).toPandas()
    assert len(got) == 6 and sorted(got["rank"]) == list(range(1, 7)) and got["rounds"].between(1, 6).all()
    for name, (low, high) in space.items():
        assert got[name].between(low, high).all()
    best = got.sort_values(["pr_auc", "trial"], ascending=[False, True]).iloc[0]
    assert best["rank"] == 1 and best["pr_auc"] > 0.5


def test_no_rows_and_one_class(spark, planted):
    none = BN.binned_table(planted.where("id < 0"), FEATS, "id")
    b = BO.fit_booster(none, BO.Params(), 2)
    assert b.score(planted).where("score <> 0.5").count() == 0
    one = BO.fit_booster(BN.binned_table(planted.where("label = 0"), FEATS, "id"), BO.Params(), 2)
    assert one.score(planted).where("score < 0.5").count() == planted.count()


def random_tree(rng, depth, stop):
    feature, cut, left, open_ = [-1], [0], [0], [(0, 0)]
    while open_:
        node, level = open_.pop()
        if level < depth and (level == 0 or rng.random() > stop):
            feature[node], cut[node], left[node] = int(rng.integers(0, len(FEATS))), int(rng.integers(0, 31)), len(feature)
            open_ += [(len(feature), level + 1), (len(feature) + 1, level + 1)]
            feature, cut, left = feature + [-1, -1], cut + [0, 0], left + [0, 0]
    return np.array(feature, np.int32), np.array(cut, np.int32), np.array(left, np.int64), rng.normal(size=len(feature))


@pytest.mark.parametrize("depth, stop", [(0, 0.0), (1, 0.0), (4, 0.0), (6, 0.3), (8, 0.0), (11, 0.4)])
def test_trees_applied_to_columns_equal_trees_applied_to_rows(depth, stop):
    import pyarrow as pa
    rng = np.random.default_rng(depth)
    x = [rng.integers(0, 32, size=(n, len(FEATS))).astype(np.uint8) for n in (301, 40, 1)]
    part = pa.RecordBatch.from_pydict({"block": [4, 5, 9], "x": [v.tobytes() for v in x], "y": [bytes(len(v)) for v in x]})
    chunk = BO._Chunk(part, len(FEATS), (), 2, np.zeros(0, np.int64))
    trees = [random_tree(rng, depth, stop) for _ in range(3)]
    assert np.array_equal(chunk.margin(1, trees), BO._margin_of(np.zeros(342), np.concatenate(x), trees))
    p = BO.Params(subsample=0.5)
    assert np.array_equal(chunk.drawn(p, 3), np.concatenate([BO.drawn_rows(p, 3, b, len(v)) for b, v in zip((4, 5, 9), x)]))


def test_small_nodes_of_a_wide_tree_send_no_rows_and_siblings_are_summed_once(planted, monkeypatch):
    with_two = planted.withColumn("x4", (F.col("x4") > 0.2).cast("double"))              # a feature of two bins
    table = BN.binned_table(with_two, FEATS, "id", tags=["fold"], block_rows=300)
    specs = [BO.Spec(BO.Params(max_depth=4, gamma=1.0, subsample=0.8, colsample=0.7, l2=0.5), frozenset({0, 1, 2, 3}) - {f}, frozenset([f]))
             for f in (0, 1)]
    here = BO.Boosting(table, specs, "fold").run(3)                                      # whole trees by one task each
    monkeypatch.setattr(BO, "LOCAL_ROWS", 400)
    asked, sums, finish, sent = [], BO.Boosting._sums, BO.Boosting._finish, []
    monkeypatch.setattr(BO.Boosting, "_sums", lambda self, trees, first: asked.extend(
        (len(t.asked()), len(t.level)) for t in trees.values()) or sums(self, trees, first))
    monkeypatch.setattr(BO.Boosting, "_finish", lambda self, trees, first: sent.append(1) or finish(self, trees, first))
    spread = BO.Boosting(table, specs, "fold").run(3)
    assert not sent and all(a <= max(1, (n + 1) // 2) for a, n in asked if n % 2 == 0) and max(n for _, n in asked) >= 4
    monkeypatch.setattr(BO, "SPREAD_DEPTH", 0)
    mixed = BO.Boosting(table, specs, "fold").run(3)
    assert sent
    x = np.random.default_rng(0).integers(0, 32, size=(4000, len(FEATS))).astype(np.uint8)
    for a, b, c in zip(here.boosters, spread.boosters, mixed.boosters):
        for s, t, u in zip(a.trees, b.trees, c.trees):
            want = BO._margin_of(np.zeros(len(x)), x, [s])
            assert (want == BO._margin_of(np.zeros(len(x)), x, [t])).all() and (want == BO._margin_of(np.zeros(len(x)), x, [u])).all()
    assert here.history == spread.history == mixed.history


def test_few_sums_are_added_up_without_a_shuffle_and_give_the_same_trees(table, monkeypatch):
    p, plans = BO.Params(max_depth=3, eta=0.3), []
    run = BO.Boosting._map
    def spied(self, *a):
        plans.append(self._tasks())
        return run(self, *a)
    monkeypatch.setattr(BO.Boosting, "_map", spied)
    here = BO.fit_booster(table, p, 3)
    monkeypatch.setattr(BO, "DRIVER_CELLS", 0)
    spread = BO.fit_booster(table, p, 3)
    assert min(plans) >= 1
    for a, b in zip(here.trees, spread.trees):
        assert all((np.asarray(x) == np.asarray(y)).all() for x, y in zip(a, b))
