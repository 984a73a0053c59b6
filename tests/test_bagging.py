import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import evaluate as EV
from propensity.operators import split as S
from propensity.operators.models import bagging as BG
from propensity.operators.models import binned as BN
from propensity.operators.models import grower as GR

FEATS = [f"x{j}" for j in range(6)]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    n = 2400
    x = rng.normal(size=(n, 6))
    x[:, 5] = np.round(x[:, 5])
    y = (rng.random(n) < 1 / (1 + np.exp(-(2.0 * x[:, 0] - 1.5 * x[:, 1] - 2.0)))).astype(float)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, " + ", ".join(f"{f} double" for f in FEATS))
    return df.withColumn("fold", S.fold_column("id", 5)).cache()


@pytest.fixture(scope="module")
def table(planted):
    return BG.binned_table(planted, FEATS, "id", block_rows=300)


def blocks_of(table):
    def run(block):
        import pyarrow as pa
        yield pa.RecordBatch.from_arrays([pa.array([block.number]), pa.array([block.x.tobytes()]), pa.array([block.y.tobytes()]),
                                          pa.array([block.keys.to_pylist()], pa.list_(pa.int64()))], names=["n", "x", "y", "k"])

    out = []
    for r in sorted(table.map(run, "n long, x binary, y binary, k array<long>").collect(), key=lambda r: r["n"]):
        y = np.frombuffer(r["y"], np.uint8)
        out.append(BN.Block(r["n"], np.frombuffer(r["x"], np.uint8).reshape(len(y), -1), y, {}, r["k"]))
    return out


def test_bins_are_quantile_classes_and_do_not_depend_on_partitions(planted, table):
    again = BN.fit_bins(planted.repartition(7), FEATS)
    assert all((a == b).all() for a, b in zip(again.cuts, table.bins.cuts))
    whole = planted.toPandas()
    values = np.unique(whole["x5"])
    assert len(values) <= BN.MAX_BINS and np.allclose(table.bins.cuts[5], (values[1:] + values[:-1]) / 2)
    sizes = np.bincount(table.bins.codes(whole[FEATS].to_numpy())[:, 0])
    assert len(sizes) == BN.MAX_BINS and sizes.max() <= 2 * len(whole) / BN.MAX_BINS
    other = BN.binned_table(planted.repartition(11), FEATS, "id", block_rows=300)
    for a, b in zip(blocks_of(table), blocks_of(other)):
        assert (a.x == b.x).all() and (a.y == b.y).all() and a.keys == b.keys


def test_every_tree_draws_the_exact_class_sizes(table):
    draws = BG.BalancedDraws(40, BG.class_sizes(table, 1.5), 3, table.counts)
    total = np.zeros((40, 2), dtype=int)
    for b in blocks_of(table):
        m = draws.counts(b)
        assert (m == draws.counts(b)).all()
        total += np.stack([m[:, b.y == 0].sum(axis=1), m[:, b.y == 1].sum(axis=1)], axis=1)
    n1 = int(table.totals[1])
    assert (total == [int(1.5 * n1), n1]).all() and (draws.totals() == total).all()
    # a bootstrap: about exp(-1) of the rarer class is left out by a tree
    out = np.mean([(draws.counts(b)[:, b.y == 1] == 0).mean() for b in blocks_of(table)])
    assert out == pytest.approx(np.exp(-1), abs=0.03)


def plain_tree(x, y, m, root, rules, width):
    """One node at a time, one candidate cut at a time; the majority of each row's leaf."""
    leaf = np.zeros(len(x), dtype=int)

    def go(rows, h, depth):
        n1, n0 = int((m[rows] * y[rows]).sum()), int((m[rows] * (1 - y[rows])).sum())
        best = None
        if n0 + n1 >= rules.min_split and n0 and n1 and depth < rules.max_depth:
            whole = (n0 ** 2 + n1 ** 2) / (n0 + n1)
            for f in GR.features_of(np.array([h]), x.shape[1], rules.mtry)[0]:
                for c in range(width - 1):
                    l = rows[x[rows, f] <= c]
                    r = rows[x[rows, f] > c]
                    a1, b1 = (m[l] * y[l]).sum(), (m[r] * y[r]).sum()
                    a, b = m[l].sum(), m[r].sum()
                    if min(a, b) < rules.min_leaf:
                        continue
                    gain = ((a - a1) ** 2 + a1 ** 2) / a + ((b - b1) ** 2 + b1 ** 2) / b - whole
                    if gain > 1e-9 * (n0 + n1) and (best is None or gain > best[0] + 1e-9):
                        best = (gain, l, r)
        if best is None:
            leaf[rows] = 1000 * n1 + n0
            return
        go(best[1], GR.child_hash(np.array(h), 0)[()], depth + 1)
        go(best[2], GR.child_hash(np.array(h), 1)[()], depth + 1)

    go(np.flatnonzero(m), GR.mix(root)[()], 0)
    return leaf


@pytest.mark.parametrize("rules", [GR.Rules(mtry=2), GR.Rules(min_split=20, min_leaf=7, max_depth=4), GR.Rules(mtry=3, min_split=6)])
def test_a_tree_equals_a_plain_recursion(rules):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, size=(260, 5)).astype(np.uint8)
    y = ((x[:, 0] + x[:, 3] + rng.normal(size=260) * 4) > 12).astype(np.uint8)
    m = rng.integers(0, 3, size=260)
    arrays = GR.grow_here(x, y, m, GR.mix(9)[()], 0, rules, 12)
    tree = GR.Trees(np.zeros(1, np.int64), *arrays)
    at = tree.leaf(x, 0)
    assert (np.where(m > 0, 1000 * tree.n1[at] + tree.n0[at], 0) == plain_tree(x, y.astype(int), m, 9, rules, 12)).all()


def test_histogram_jobs_and_local_subtrees_give_the_same_forest(table, monkeypatch):
    settings = [{"mtry": 2, "nodesize": 5}, {"mtry": 3, "nodesize": 1}]
    here = BG.fit_forests(table, settings, 3, seed=1)
    monkeypatch.setattr(GR, "JOB_CELLS", 4 * 6 * BN.MAX_BINS)
    spread = BG.fit_forests(table, settings, 3, seed=1, local_rows=150)
    x = np.concatenate([b.x for b in blocks_of(table)])
    for a, b in zip(here, spread):
        for t in range(3):
            i, j = a.trees.leaf(x, t), b.trees.leaf(x, t)
            assert (a.trees.n0[i] == b.trees.n0[j]).all() and (a.trees.n1[i] == b.trees.n1[j]).all() and (a.trees.tie[i] == b.trees.tie[j]).all()


@pytest.fixture(scope="module")
def forest(table):
    return BG.fit_forest(table, num_trees=60, seed=2)


def test_out_of_bag_votes_come_from_trees_that_have_not_seen_the_row(table, forest):
    got = {r["key"]: r for r in BG.oob_votes(table, [forest]).collect()}
    told = forest.trees.votes_of()
    n = 0
    for b in blocks_of(table):
        m = forest.draws.counts(b)
        for i, k in enumerate(b.keys):
            unseen = np.flatnonzero(m[:, i] == 0)
            votes = sum(int(told[forest.trees.leaf(b.x[i:i + 1], t)][0]) for t in unseen)
            assert (got[k]["trees"], got[k]["votes"], got[k]["label"]) == (len(unseen), votes, b.y[i])
            n += 1
    assert n == len(got) == table.totals.sum()


def test_out_of_bag_is_as_good_as_out_of_fold(planted, table, forest):
    area = lambda df: EV.pr_auc(df.withColumn("m", F.lit(1)), ["m"]).first()["pr_auc"]
    oob = area(BG.oob_votes(table, [forest]).where("score IS NOT NULL"))
    parts = None
    for f in range(5):
        part = BG.fit_forest(BG.binned_table(planted.where(F.col("fold") != f), FEATS, "id"), 60, seed=f) \
            .score(planted.where(F.col("fold") == f)).select("label", "score")
        parts = part if parts is None else parts.unionByName(part)
    assert oob == pytest.approx(area(parts), abs=0.02) and oob > 0.55


def test_error_path_is_the_error_of_the_first_trees(table, forest):
    path = BG.oob_error_path(table, forest).toPandas()
    assert list(path["n_trees"]) == list(range(1, 61))
    whole = BG.oob_votes(table, [forest]).where("trees > 0").toPandas()
    assert path["error"].iloc[-1] == pytest.approx(((2 * whole.votes > whole.trees) != (whole.label == 1)).mean())
    assert path["error"].iloc[-1] < path["error"].iloc[0]


def test_importance_finds_the_planted_order(table, forest):
    got = {r["feature"]: r for r in BG.oob_importance(table, forest).collect()}
    order = sorted(got, key=lambda f: -got[f]["importance"])
    assert order[:2] == ["x0", "x1"] and set(got) == set(FEATS)
    assert all(abs(got[f]["raw"]) < 0.01 and got[f]["importance"] < got["x1"]["importance"] / 3 for f in FEATS[2:])
    assert all(r["importance"] == pytest.approx(r["raw"] / (r["sd"] / 60 ** 0.5)) for r in got.values())


def test_search_returns_the_five_steps(table):
    got = BG.forest_search(table, num_trees=8, mtry_grid=[2, 4], node_grid=(1, 20), ratios=(1.0, 2.0)).toPandas()
    assert list(got["parameter"]) == ["ntree", "mtry", "nodesize", "sampsize", "refinement"]
    assert got["pr_auc"].between(0.3, 1).all() and got["oob_error"].between(0, 0.5).all()
    best = BG.tuned_parameters(BG.forest_search(table, num_trees=4, mtry_grid=[3], node_grid=(5,), ratios=(1.5,)))
    assert best == {"mtry": 3, "nodesize": 5, "ratio": 1.5}


def test_saved_forest_scores_the_same(spark, planted, forest, tmp_path, monkeypatch):
    forest.save(spark, str(tmp_path / "f"))
    again = BG.Forest.load(spark, str(tmp_path / "f"))
    rows = planted.select("id", *FEATS).withColumn("score", F.lit("x"))
    want = {r["id"]: r["score"] for r in forest.score(rows).collect()}
    monkeypatch.setattr(BN, "PASS_BYTES", 4 * BN.NODE_BYTES * len(forest.trees.feature) // 10)      # several passes
    assert {r["id"]: r["score"] for r in again.score(rows).collect()} == want
    assert all(0 <= v <= 1 for v in want.values())


def test_nulls_one_class_and_flat_features(spark):
    rows = [(i, float(i % 3 == 0), None if i % 5 == 0 else float(i % 7), float("nan") if i % 4 == 0 else 1.0) for i in range(90)]
    df = spark.createDataFrame([*rows, (100, None, 1.0, 1.0)], "id long, label double, a double, b double")
    t = BG.binned_table(df, ["a", "b"], "id")
    assert t.totals.tolist() == [60, 30]
    f = BG.fit_forest(t, 5)
    assert f.score(df).where("score BETWEEN 0 AND 1").count() == 91
    one = BG.binned_table(df.where("label = 0"), ["a", "b"], "id")
    assert BG.fit_forest(one, 3).score(df).where("score = 0").count() >= 0
    empty = BG.binned_table(df.where("id < 0"), ["a", "b"], "id")
    assert empty.totals.tolist() == [0, 0] and BG.oob_votes(empty, [BG.fit_forest(empty, 2)]).count() == 0


def test_partial_dependence_equals_rows_set_to_each_value(planted, table, forest):
    some = BG.Forest(forest.trees.subset(range(12)), forest.bins, forest.draws)
    got = BG.partial_dependence(table, some, planted, ["x0", "x5"], n_grid=9).toPandas()
    whole = planted.toPandas()
    assert sorted(got.groupby("feature").size().items()) == [("x0", 9), ("x5", min(9, whole["x5"].nunique()))]
    told = some.trees.votes_of()
    for _, r in got.iterrows():
        x = whole[FEATS].copy()
        x[r["feature"]] = r["value"]
        codes = table.bins.codes(x.to_numpy())
        share = np.mean([told[some.trees.leaf(codes, t)] for t in range(12)], axis=0)
        want = 0.5 * (np.log(np.maximum(share, BG.EPS)) - np.log(np.maximum(1 - share, BG.EPS)))
        assert r["pd"] == pytest.approx(want.mean(), abs=1e-9)


def test_a_forest_in_several_passes_equals_one_pass(planted, table, forest, monkeypatch):
    some = BG.Forest(forest.nodes.view(3, 20), forest.bins, forest.draws)
    few = BG.BalancedDraws(17, forest.draws.sizes, forest.draws.seed, forest.draws.block_rows)
    some.draws = few
    def everything():
        votes = {r["key"]: (r["votes"], r["trees"], r["score"]) for r in BG.oob_votes(table, [some, some]).where("forest = 1").collect()}
        path = [(r["n_trees"], r["error"]) for r in BG.oob_error_path(table, some).collect()]
        lost = {r["feature"]: r["raw"] for r in BG.oob_importance(table, some).collect()}
        pd = {(r["feature"], r["value"]): r["pd"] for r in BG.partial_dependence(table, some, planted, ["x1"], n_grid=5).collect()}
        return votes, path, lost, pd
    want = everything()
    monkeypatch.setattr(BN, "PASS_BYTES", BN.NODE_BYTES * int(some.nodes.sizes.sum()) // 3)
    assert len(list(some.nodes.passes())) > 2
    got = everything()
    assert got[0] == want[0] and got[1] == want[1]
    for a, b in zip(got[2:], want[2:]):
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)


def test_the_nodes_of_a_forest_stay_off_the_driver(table):
    forest = BG.fit_forest(table, 4, seed=3)
    assert all(len(top.feature) == 1 for top in forest.nodes.tops) and forest.nodes.sizes.min() > 20
    assert forest.nodes.sizes.sum() == len(forest.trees.feature)


def test_equal_rows_are_merged_whatever_their_hash(monkeypatch):
    rng = np.random.default_rng(4)
    x, y, m = rng.integers(0, 3, (500, 4)).astype(np.uint8), rng.integers(0, 2, 500).astype(np.uint8), rng.integers(0, 4, 500)
    want = GR.grow_here(x, y, m, GR.mix(2)[()], 0, GR.Rules(mtry=2), 3)
    codes, rows, ones = GR.merged(x, y, m)
    assert len(codes) <= 81 and rows.sum() == m.sum() and ones.sum() == (m * y).sum()
    monkeypatch.setattr(GR, "merged", lambda x, y, m: (x[m > 0], m[m > 0].astype(float), (m * y)[m > 0].astype(float)))
    assert all((a == b).all() for a, b in zip(want, GR.grow_here(x, y, m, GR.mix(2)[()], 0, GR.Rules(mtry=2), 3)))


def test_a_saved_forest_is_a_row_per_subtree(spark, forest, tmp_path):
    forest.save(spark, str(tmp_path / "f"))
    saved = spark.read.parquet(str(tmp_path / "f" / "subtrees"))
    assert saved.count() == saved.select("tree").distinct().count() == len(forest.nodes)
    longest = saved.selectExpr("max(length(feature)) AS n").first()["n"]
    assert longest == 2 * forest.nodes.sizes.max() < forest.nodes.sizes.sum() // 10


@pytest.fixture(scope="module")
def coarse(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, size=(1500, 3))
    y = rng.random(1500) < 0.15 + 0.2 * (x[:, 0] > 1) + 0.1 * x[:, 2]
    df = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(1500)], "id long, label double, a double, b double, c double")
    return BG.binned_table(df, ["a", "b", "c"], "id", block_rows=200)


def test_many_rows_of_few_codes_grow_without_sending_rows(coarse, monkeypatch):
    x = np.concatenate([b.x for b in blocks_of(coarse)])
    monkeypatch.setattr(BN.Table, "distinct", lambda self, most: None)
    want = BG.fit_forest(coarse, 7, seed=5).trees
    monkeypatch.undo()
    for name in ("_finish", "_split_wide"):
        monkeypatch.setattr(GR, name, lambda *a: pytest.fail("rows were sent"))
    monkeypatch.setattr(GR, "LOT_CELLS", 7 * 300)               # several sums a task
    monkeypatch.setattr(GR, "GROUP_CELLS", 2 * 64 * 3)          # several groups of trees
    got = BG.fit_forest(coarse, 7, seed=5, local_rows=64)
    for t in range(7):
        i, j = got.trees.leaf(x, t), want.leaf(x, t)
        assert (got.trees.n0[i] == want.n0[j]).all() and (got.trees.n1[i] == want.n1[j]).all() and (got.trees.tie[i] == want.tie[j]).all()
    assert BG.fit_forest(coarse, 3, seed=5).nodes.codes is coarse.distinct(64) and coarse.distinct(63) is None


def test_votes_by_code_are_those_of_a_walk(coarse, monkeypatch):
    forest = BG.fit_forest(coarse, 21, seed=6)
    monkeypatch.setattr(BN, "PASS_BYTES", 64)                   # eight trees a pass
    assert [(first, len(told)) for first, told in BG.voters(coarse, forest)] == [(0, 8), (8, 8), (16, 5)]
    by_code = [sorted(BG.oob_votes(coarse, [forest]).collect()), BG.oob_error_path(coarse, forest).collect()]
    monkeypatch.undo()
    forest.nodes.codes = None
    assert all(isinstance(grown, GR.Lean) for _, grown in BG.voters(coarse, forest))
    assert by_code == [sorted(BG.oob_votes(coarse, [forest]).collect()), BG.oob_error_path(coarse, forest).collect()]


def test_distinct_codes_are_found_whatever_their_hash(coarse, monkeypatch):
    codes = coarse.distinct(64)
    x = np.concatenate([b.x for b in blocks_of(coarse)])
    assert len(codes) == len(np.unique(x, axis=0)) and (codes.x[codes.find(x)] == x).all()
    monkeypatch.setattr(BN, "marks_of", lambda x: (x.sum(axis=1) % 2).astype(np.uint64))
    assert len(np.unique(BN.distinct_rows(x), axis=0)) == len(codes) and coarse._find_distinct(10_000) is None


def test_counts_in_one_number_are_exact():
    rng = np.random.default_rng(1)
    codes, at = rng.integers(0, 5, (300, 2)), rng.integers(0, 3, 300)
    for most in (100, 10 ** 6):                                 # in one number, and one by one
        total = rng.integers(1, most, 300).astype(float)
        ones = np.floor(total * rng.random(300))
        h0, h1 = GR.histograms(codes, at, total, ones, 3, 5)
        for k, s, b in np.ndindex(3, 2, 5):
            own = (at == k) & (codes[:, s] == b)
            assert (h0[k, s, b], h1[k, s, b]) == ((total - ones)[own].sum(), ones[own].sum())


def test_a_changed_row_goes_down_from_the_first_node_that_asks_for_the_feature():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 6, (400, 4)).astype(np.uint8), rng.integers(0, 2, 400).astype(np.uint8)
    parts = [GR.Trees(np.zeros(1, np.int64), *GR.grow_here(x, y, rng.integers(0, 3, 400), GR.mix(s)[()], 0, GR.Rules(mtry=2), 6)) for s in (1, 2)]
    both = GR.Trees(np.array([0, len(parts[0].feature)]), *(np.concatenate([getattr(parts[0], c), getattr(parts[1], c) + (
        len(parts[0].feature) if c == "left" else 0)]) for c in ("feature", "cut", "left", "n0", "n1", "tie"))).lean()
    for t in range(2):
        leaf = both.leaf(x, t)
        root, tests = both.first_tests(t)
        for f in range(4):
            other = x.copy()
            other[:, f] = rng.permutation(x[:, f])
            end, start = both.leaf(other, t), tests[leaf - root, f]
            assert (end[start < 0] == leaf[start < 0]).all()
            went = both.leaf(other[start >= 0], t, start=start[start >= 0])
            assert (went == end[start >= 0]).all() and (both.feature[start[start >= 0]] == f).all()
        assert (tests > root).any()


def test_importance_equals_one_row_block_and_feature_at_a_time(table, forest, monkeypatch):
    few = BG.Forest(forest.nodes.view(3, 8), forest.bins, BG.BalancedDraws(5, forest.draws.sizes, forest.draws.seed, forest.draws.block_rows))
    told, lost = few.trees.votes_of(), np.zeros((5, len(FEATS)))
    seen = np.zeros(5)
    for b in blocks_of(table):
        counts = few.draws.counts(b)
        for t in range(5):
            a, e = few.trees.roots[t], [*few.trees.roots[1:], len(few.trees.feature)][t]
            rows = np.flatnonzero(counts[t] == 0)
            right = (told[few.trees.leaf(b.x[rows], t)] == b.y[rows]).sum()
            seen[t] += len(rows)
            rng = np.random.Generator(np.random.PCG64([7, b.number, t]))
            for f in np.unique(few.trees.feature[a:e][few.trees.feature[a:e] >= 0]):
                other = b.x[rows]
                other[:, f] = other[rng.permutation(len(rows)), f]
                lost[t, f] += right - (told[few.trees.leaf(other, t)] == b.y[rows]).sum()
    want = dict(zip(FEATS, (lost / seen[:, None]).mean(axis=0)))
    monkeypatch.setattr(BG, "LOT_ROWS", 700)
    got = {r["feature"]: r["raw"] for r in BG.oob_importance(table, few, seed=7).collect()}
    assert got == pytest.approx(want, abs=1e-12)
