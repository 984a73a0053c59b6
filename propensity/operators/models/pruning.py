"""Classification tree with cost-complexity pruning.

The tree is grown in full on class-weighted Gini, together with one tree per
fold on the other folds' rows, in the same jobs (``grower``). Its weakest links
give, for every inner node, the penalty per leaf from which on the node is
better off as a leaf; the subtrees of rising penalties are nested. Each fold's
tree is pruned at the geometric mean of neighbouring penalties, and one pass
over the blocks scores every row by its fold's tree at all of them. The penalty
with the least cross-validated error wins (the smaller tree on ties).

Penalties (``cp``) are in units of the root's risk; risk is the weighted number
of misclassified rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators.models.binned import Bins, Block, Table, tree_sums
from propensity.operators.models.grower import Draws, Rules, Trees, grow

#: Defaults: the least penalty kept, rows of a node that may be split, rows of a leaf, depth.
CP, MIN_SPLIT, MIN_LEAF, MAX_DEPTH = 0.001, 20, 7, 30


@dataclass
class FoldDraws(Draws):
    """Sample 0 is every row once, sample i every row outside the i-th fold."""

    tag: str
    folds: Sequence[int]
    rows: np.ndarray                                        # (folds + 1) x 2

    @property
    def samples(self) -> int:
        return len(self.folds) + 1

    def totals(self) -> np.ndarray:
        return self.rows

    def counts(self, block: Block) -> np.ndarray:
        fold = block.tags[self.tag]
        return np.stack([np.ones(len(fold), np.int32), *[(fold != f).astype(np.int32) for f in self.folds]])


def fold_draws(table: Table, tag: str) -> FoldDraws:
    """Folds are the distinct values of the tag (a number fixed by the caller, not by the rows)."""

    def count(block: Block):
        fold, at = np.unique(block.tags[tag], return_inverse=True)
        n1 = np.bincount(at, block.y == 1, len(fold)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"fold": pa.array(fold.astype(np.int32)), "n0": np.bincount(at, minlength=len(fold)) - n1, "n1": n1})

    got = table.map(count, "fold int, n0 long, n1 long").groupBy("fold").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")) \
        .orderBy("fold").collect()
    own = np.array([[r["n0"], r["n1"]] for r in got], dtype=np.int64).reshape(-1, 2)
    whole = own.sum(axis=0)
    return FoldDraws(tag, [r["fold"] for r in got], np.vstack([whole[None], whole - own]))


def depths(tree: Trees) -> np.ndarray:
    out = np.zeros(len(tree.feature), dtype=np.int64)
    level = np.array([tree.roots[0]]) if len(tree.roots) else np.zeros(0, int)
    d = 0
    while len(level):
        out[level] = d
        inner = level[tree.feature[level] >= 0]
        level = np.concatenate([tree.left[inner], tree.left[inner] + 1])
        d += 1
    return out


def risks(tree: Trees, weights: tuple[float, float]) -> np.ndarray:
    return np.minimum(weights[0] * tree.n0, weights[1] * tree.n1)


def weakest_links(tree: Trees, weights: tuple[float, float]) -> np.ndarray:
    """For every node the penalty per leaf from which on it is a leaf or gone (0 for leaves); never rises on the way down."""
    n = len(tree.feature)
    own, collapse = risks(tree, weights), np.zeros(n)
    depth = depths(tree)
    parent = np.full(n, -1, dtype=np.int64)
    inner = tree.feature >= 0
    parent[tree.left[inner]] = parent[tree.left[inner] + 1] = np.flatnonzero(inner)
    levels = [np.flatnonzero(inner & (depth == d)) for d in range(int(depth.max(initial=0)) + 1)]
    cut = ~inner
    last = 0.0
    while True:
        risk, leaves = own.copy(), np.ones(n, dtype=np.int64)
        for level in reversed(levels):
            at = level[~cut[level]]
            left = tree.left[at]
            risk[at], leaves[at] = risk[left] + risk[left + 1], leaves[left] + leaves[left + 1]
        alive = np.flatnonzero(~cut)
        if not len(alive):
            break
        link = (own[alive] - risk[alive]) / (leaves[alive] - 1)
        last = max(last, float(link.min()))
        goes = alive[link <= last + 1e-12 * max(1.0, abs(last))]
        collapse[goes] = last
        cut[goes] = True
        for level in levels:                                 # what hangs on a node that goes, goes with it
            at = level[(parent[level] >= 0)]
            gone = at[cut[parent[at]] & ~cut[at]]
            collapse[gone], cut[gone] = last, True
    for level in levels:
        at = level[parent[level] >= 0]
        collapse[at] = np.minimum(collapse[at], collapse[parent[at]])
    return collapse


def pruned(tree: Trees, collapse: np.ndarray, penalty: float) -> Trees:
    """The subtree for a penalty: nodes that collapse at or below it are leaves."""
    keep, order, level = tree.feature.copy(), [], np.array([tree.roots[0]])
    keep[collapse <= penalty] = -1
    place = np.zeros(len(keep), dtype=np.int64)
    n = 1
    while len(level):
        order.append(level)
        inner = level[keep[level] >= 0]
        level = np.stack([tree.left[inner], tree.left[inner] + 1], axis=1).ravel()
        place[level] = n + np.arange(len(level))
        n += len(level)
    at = np.concatenate(order)
    left = np.where(keep[at] >= 0, place[np.where(keep[at] >= 0, tree.left[at], 0)], 0)
    return Trees(np.zeros(1, np.int64), keep[at], tree.cut[at], left, tree.n0[at], tree.n1[at], tree.tie[at])


def cp_table(tree: Trees, collapse: np.ndarray, weights: tuple[float, float], cp: float = CP) -> list[dict]:
    """Rows of falling cp: cp, splits, relative error; the last row is the tree at the least cp."""
    root = float(risks(tree, weights)[tree.roots[0]])
    steps = sorted({float(c) for c in collapse[tree.feature >= 0]}, reverse=True) if root > 0 else []
    out = []
    for value in [s / root for s in steps if s / root > cp] + [cp]:
        # the subtree that is best from this cp up to the one before
        t = pruned(tree, collapse, value * root * (1 + 1e-12))
        leaf = t.feature < 0
        out.append({"cp": value, "n_split": int((~leaf).sum()),
                    "rel_error": float(risks(t, weights)[leaf].sum() / root) if root else 0.0})
    return out


@dataclass
class PrunedTree:
    """A pruned tree; its score is the weighted share of class 1 in the row's leaf."""

    tree: Trees
    bins: Bins
    weights: tuple[float, float]

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        a, b = self.weights[0] * self.tree.n0, self.weights[1] * self.tree.n1
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.where(a + b > 0, b / (a + b), 0.0)
        return tree_sums(df, self.tree, share, self.bins, out)

    def save(self, spark: SparkSession, path: str) -> None:
        t = self.tree
        meta = {"features": self.bins.features, "cuts": [c.tolist() for c in self.bins.cuts], "weights": self.weights}
        rows = [(json.dumps(meta), int(i), int(t.feature[i]), int(t.cut[i]), int(t.left[i]), int(t.n0[i]), int(t.n1[i]), int(t.tie[i]))
                for i in range(len(t.feature))]
        spark.createDataFrame(rows, "meta string, node int, feature int, cut int, left int, n0 long, n1 long, tie int") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PrunedTree":
        rows = spark.read.parquet(path).orderBy("node").collect()
        meta = json.loads(rows[0]["meta"])
        of = lambda c, kind: np.array([r[c] for r in rows], dtype=kind)
        tree = Trees(np.zeros(1, np.int64), of("feature", np.int32), of("cut", np.int32), of("left", np.int64), of("n0", np.int64),
                     of("n1", np.int64), of("tie", np.uint8))
        return PrunedTree(tree, Bins(tuple(meta["features"]), tuple(np.array(c) for c in meta["cuts"])), tuple(meta["weights"]))


def balanced_weights(totals: np.ndarray) -> tuple[float, float]:
    """N / (2 n_c) per class (C5); 1 for a class without rows."""
    n = int(totals.sum())
    return tuple(n / (2 * int(c)) if c else 1.0 for c in totals)


def fold_errors(table: Table, draws: FoldDraws, trees: Trees, links: Sequence[np.ndarray], betas: np.ndarray,
                weights: tuple[float, float]) -> np.ndarray:
    """Weighted held-out error at each of the ascending penalties ``betas[f]`` of each fold's tree, summed over the folds.

    On the way from root to leaf the nodes' penalties fall, so a node decides for
    one stretch of the penalties: a row adds its errors to stretches.
    """
    own = np.asarray(weights)
    told = trees.votes_of(weights)

    def run(blocks):
        total = np.zeros(betas.shape[1] + 1)
        for block in blocks:
            fold = block.tags[draws.tag]
            for i, f in enumerate(draws.folds):
                rows = np.flatnonzero(fold == f)
                node = np.full(len(rows), trees.roots[i])
                upper = np.full(len(rows), betas.shape[1], dtype=np.int64)
                while len(rows):
                    lower = np.minimum(np.searchsorted(betas[i], links[i][node - trees.roots[i]], side="left"), upper)
                    wrong = np.where(told[node] != block.y[rows], own[block.y[rows]], 0.0)
                    np.add.at(total, lower, wrong)
                    np.add.at(total, upper, -wrong)
                    inner = (trees.feature[node] >= 0) & (lower > 0)
                    rows, node, upper = rows[inner], node[inner], lower[inner]
                    node = trees.left[node] + (block.x[rows, trees.feature[node]] > trees.cut[node])
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(betas.shape[1], dtype=np.int32)), "e": np.cumsum(total)[:-1]})

    got = table.map_task(run, "i int, e double").groupBy("i").agg(F.sum("e").alias("e")).collect()
    out = np.zeros(betas.shape[1])
    for r in got:
        out[r["i"]] = r["e"]
    return out


def fit_cart(table: Table, fold_tag: str = "fold", cp: float = CP, min_split: int = MIN_SPLIT, min_leaf: int = MIN_LEAF,
             max_depth: int = MAX_DEPTH, weights: tuple[float, float] | None = None, seed: int = 123, **grow_options):
    """F4 + F5: (PrunedTree at the best cp, cp table (cp, n_split, rel_error, x_error, chosen))."""
    weights = weights or balanced_weights(table.totals)
    draws = fold_draws(table, fold_tag)
    rules = Rules(None, min_split, min_leaf, max_depth, weights)
    trees = grow(table, draws, [(i, rules, seed) for i in range(draws.samples)], **grow_options)
    whole = trees.subset([0])
    collapse = weakest_links(whole, weights)
    rows = cp_table(whole, collapse, weights, cp)
    root = float(risks(whole, weights)[0])
    cps = np.array([r["cp"] for r in rows])
    # between neighbouring penalties, in the order of the table (falling); the first stands for all above
    betas = np.sqrt(cps * np.concatenate([[np.inf], cps[:-1]]))[::-1]
    own = trees.subset(range(1, draws.samples))
    links = [weakest_links(own.subset([i]), weights) for i in range(len(own))]
    scale = np.array([float(risks(own, weights)[a]) for a in own.roots])
    at = np.array([[b * s if s else 0.0 for b in betas] for s in scale]).reshape(len(own), len(betas))
    errors = fold_errors(table, draws, own, links, at, weights)[::-1] if len(own) else np.zeros(len(rows))
    best = int(np.argmin(errors))
    path = table.spark.createDataFrame(
        [(float(r["cp"]), r["n_split"], r["rel_error"], float(e / root) if root else 0.0, int(i == best))
         for i, (r, e) in enumerate(zip(rows, errors))], "cp double, n_split int, rel_error double, x_error double, chosen int")
    return PrunedTree(pruned(whole, collapse, cps[best] * root * (1 + 1e-12)), table.bins, weights), path
