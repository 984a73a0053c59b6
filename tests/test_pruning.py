import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import split as S
from propensity.operators.models import binned as BN
from propensity.operators.models import grower as GR
from propensity.operators.models import pruning as PR

W = (1.0, 2.0)


def small_tree(seed, n=160, depth=4):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, size=(n, 3)).astype(np.uint8)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3) ^ (rng.random(n) < 0.25)).astype(np.uint8)
    rules = GR.Rules(None, 2, 1, depth, W)
    return GR.Trees(np.zeros(1, np.int64), *GR.grow_here(x, y, np.ones(n, int), GR.mix(seed)[()], 0, rules, 6)), x, y


def subtrees(tree, node=0):
    """Every pruned subtree as the set of its inner nodes."""
    if tree.feature[node] < 0:
        return [frozenset()]
    left, right = tree.left[node], tree.left[node] + 1
    return [frozenset()] + [a | b | {node} for a, b in itertools.product(subtrees(tree, left), subtrees(tree, right))]


def cost(tree, inner, alpha):
    risk, leaves, todo = 0.0, 0, [0]
    own = PR.risks(tree, W)
    while todo:
        t = todo.pop()
        if t in inner:
            todo += [tree.left[t], tree.left[t] + 1]
        else:
            risk, leaves = risk + own[t], leaves + 1
    return risk + alpha * leaves, leaves


@pytest.mark.parametrize("seed", range(6))
def test_pruned_tree_is_the_best_of_all_subtrees(seed):
    tree, _, _ = small_tree(seed, depth=3)
    collapse = PR.weakest_links(tree, W)
    every = subtrees(tree)
    for alpha in [0.0, *[c + d for c in set(collapse) for d in (-1e-3, 1e-3) if c + d > 0], 1e9]:
        mine = PR.pruned(tree, collapse, alpha)
        leaf = mine.feature < 0
        got = (PR.risks(mine, W)[leaf].sum() + alpha * leaf.sum(), int(leaf.sum()))
        want = min((round(cost(tree, s, alpha)[0], 9), cost(tree, s, alpha)[1]) for s in every)
        assert got[0] == pytest.approx(want[0]) and got[1] == want[1]       # the smallest of the best


@pytest.mark.parametrize("seed", range(3))
def test_subtrees_are_nested(seed):
    tree, _, _ = small_tree(seed, depth=6)
    collapse = PR.weakest_links(tree, W)
    inner = np.flatnonzero(tree.feature >= 0)
    for t in inner:
        for c in (tree.left[t], tree.left[t] + 1):
            assert collapse[c] <= collapse[t]
    sizes = [len(PR.pruned(tree, collapse, a).feature) for a in sorted({0.0, *collapse})]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == 1


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(8)
    n = 1500
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] > 0.4) & (x[:, 1] > -0.3) | (rng.random(n) < 0.08)).astype(float)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, a double, b double, c double, d double")
    return df.withColumn("fold", S.fold_column("id", 10)).cache()


def test_cross_validated_errors_equal_one_fold_and_penalty_at_a_time(planted):
    table = BN.binned_table(planted, list("abcd"), "id", tags=["fold"], block_rows=400)
    model, path = PR.fit_cart(table)
    path = path.toPandas()
    assert path["chosen"].sum() == 1 and (np.diff(path["cp"]) < 0).all() and (np.diff(path["n_split"]) > 0).all()
    assert path["cp"].iloc[-1] == PR.CP and path["n_split"].iloc[0] == 0 and path["rel_error"].iloc[0] == 1.0
    w = PR.balanced_weights(table.totals)
    whole = planted.toPandas()
    root = min(w[0] * (whole.label == 0).sum(), w[1] * (whole.label == 1).sum())
    betas = np.sqrt(path["cp"].to_numpy() * np.concatenate([[np.inf], path["cp"].to_numpy()[:-1]]))
    rules, wrong = GR.Rules(None, PR.MIN_SPLIT, PR.MIN_LEAF, PR.MAX_DEPTH, w), np.zeros(len(betas))
    codes = table.bins.codes(whole[list("abcd")].to_numpy())
    for f in range(10):
        tr, te = (whole.fold != f).to_numpy(), (whole.fold == f).to_numpy()
        tree = GR.Trees(np.zeros(1, np.int64), *GR.grow_here(codes[tr], whole.label[tr].to_numpy().astype(np.uint8), np.ones(tr.sum(), int),
                                                             GR.mix(123)[()], 0, rules, table.bins.width))
        collapse, scale = PR.weakest_links(tree, w), PR.risks(tree, w)[0]
        for i, b in enumerate(betas):
            t = PR.pruned(tree, collapse, b * scale)
            told = t.votes_of(w)[t.leaf(codes[te], 0)]
            y = whole.label[te].to_numpy()
            wrong[i] += (np.where(y == 1, w[1], w[0]) * (told != y)).sum()
    assert np.allclose(path["x_error"], wrong / root)
    assert path["chosen"].to_numpy().argmax() == (wrong / root).argmin()
    scored = model.score(planted).toPandas()
    assert ((scored.score > 0.5) == (scored.label == 1)).mean() > 0.85
    assert 1 <= path.loc[path.chosen == 1, "n_split"].iloc[0] < path["n_split"].iloc[-1] + 1


def test_nodes_split_by_jobs_give_the_same_tree(planted, spark, tmp_path):
    table = BN.binned_table(planted, list("abcd"), "id", tags=["fold"], block_rows=200)
    one, path = PR.fit_cart(table)
    two, again = PR.fit_cart(table, local_rows=100)
    assert [tuple(r) for r in path.collect()] == [tuple(r) for r in again.collect()]
    two.save(spark, str(tmp_path / "t"))
    rows = lambda m: {r["id"]: r["score"] for r in m.score(planted.select("id", *"abcd")).collect()}
    assert rows(one) == rows(PR.PrunedTree.load(spark, str(tmp_path / "t")))


def test_one_class_and_no_rows(planted):
    for df, n in ((planted.where("label = 0"), None), (planted.where("id < 0"), 0)):
        model, path = PR.fit_cart(BN.binned_table(df, list("abcd"), "id", tags=["fold"]))
        assert path.count() == 1 and path.first()["n_split"] == 0
        assert model.score(df).where(F.col("score") != 0).count() == 0
