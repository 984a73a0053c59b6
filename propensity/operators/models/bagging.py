"""Balanced random forests with out-of-bag votes.

* Every tree has its own bootstrap sample of exactly the asked size per class
  (``BalancedDraws``): the draws of a class are dealt over the blocks of the
  binned table by binomial halving, then over the rows of a block. All is keyed
  by seed, class and block number, so any task can work out which rows a tree
  has seen, without a table of draws, for any partitioning.
* A row's out-of-bag score is the share of positive votes of the trees that
  have not drawn it (``oob_votes``); errors by number of trees (``oob_error_path``)
  and the accuracy importance scaled by its standard error
  (``oob_importance``) come from one pass over the blocks.
* The coordinate search (``forest_search``) grows all settings of a step in the
  same jobs on the same binned table and samples.

A forest's nodes stay in a written table (``StoredTrees``). All that walks down
its trees does so in passes over some of them, so the driver and the tasks hold
at most ``PASS_BYTES`` of nodes, however many rows the trees were grown on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.operators import evaluate as EV
from propensity.operators.models import binned
from propensity.operators.models.binned import Bins, Block, Table, binned_table, one_of_each, pass_sums, read_blocks
from propensity.operators.models.grower import _SUBTREE, SUBTREE_SCHEMA, Draws, Lean, Rules, StoredTrees, Told, Trees, grow_stored
from propensity.session import ship, written

EPS = 2.220446049250313e-16   # fixed value: machine epsilon used for log(0)
#: Rows x codes that go down a tree at once.
CURVE_ROWS = 8192
#: Rows whose importance losses a task works out at once.
LOT_ROWS = 1 << 15


@dataclass
class BalancedDraws(Draws):
    """``trees`` bootstrap samples of exactly ``sizes`` (class 0, class 1) rows, with replacement."""

    trees: int
    sizes: tuple[int, int]
    seed: int
    block_rows: np.ndarray                                  # blocks x 2

    @property
    def samples(self) -> int:
        return self.trees

    def totals(self) -> np.ndarray:
        have = self.block_rows.sum(axis=0) > 0
        return np.tile(np.where(have, self.sizes, 0), (self.trees, 1)).astype(np.int64)

    def of_block(self, label: int, block: int) -> np.ndarray:
        """How many of each tree's draws of a class fall into a block."""
        rows = np.concatenate([[0], np.cumsum(self.block_rows[:, label])])
        low, high = 0, len(rows) - 1
        if not rows[-1]:
            return np.zeros(self.trees, dtype=np.int64)
        k = np.full(self.trees, self.sizes[label], dtype=np.int64)
        while high - low > 1:
            mid = (low + high) // 2
            here = rows[high] - rows[low]
            rng = np.random.Generator(np.random.PCG64([self.seed, 1, label, low, high]))
            first = rng.binomial(k, (rows[mid] - rows[low]) / here) if here else np.zeros_like(k)
            low, high, k = (low, mid, first) if block < mid else (mid, high, k - first)
        return k

    def counts(self, block: Block) -> np.ndarray:
        n = len(block.y)
        out = np.zeros(self.trees * n, dtype=np.int32)
        for label in (0, 1):
            rows = np.flatnonzero(block.y == label)
            k = self.of_block(label, block.number)
            if len(rows) and k.any():
                rng = np.random.Generator(np.random.PCG64([self.seed, 2, label, block.number]))
                drawn = rows[rng.integers(0, len(rows), int(k.sum()))]
                out += np.bincount(np.repeat(np.arange(self.trees), k) * n + drawn, minlength=len(out)).astype(np.int32)
        return out.reshape(self.trees, n)


@dataclass
class Forest:
    """Trees that vote, with the bins they were grown on and the samples they have seen."""

    nodes: StoredTrees | Trees
    bins: Bins
    draws: BalancedDraws

    def __post_init__(self):
        if isinstance(self.nodes, Trees):
            t = self.nodes
            tops = [t.subset([i]) for i in range(len(t))]
            self.nodes = StoredTrees(tops, None, np.array([len(top.feature) for top in tops], dtype=np.int64))

    @cached_property
    def trees(self) -> Trees:
        """All nodes on the driver, for a look at a small forest."""
        return self.nodes.whole()

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with the share of positive votes."""
        return pass_sums(df, (trees for _, trees in self.nodes.passes()), self.bins, out) \
            .withColumn(out, F.col(out) / len(self.nodes))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row for the forest, one for each tree's top, and the table of the subtrees as it is."""
        meta = {"features": self.bins.features, "cuts": [c.tolist() for c in self.bins.cuts], "shift": self.nodes.shift,
                "trees": self.draws.trees, "sizes": [int(s) for s in self.draws.sizes], "seed": self.draws.seed}
        rows = [(json.dumps(meta), np.ascontiguousarray(self.draws.block_rows).tobytes())]
        spark.createDataFrame(rows, "meta string, block_rows binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")
        tops = [(i, int(n), *[getattr(t, c).astype(k).tobytes() for c, k in _TOP.items()])
                for i, (t, n) in enumerate(zip(self.nodes.tops, self.nodes.sizes))]
        spark.createDataFrame(tops, _TOP_SCHEMA).write.mode("overwrite").parquet(f"{path}/tops")
        first, last = self.nodes.shift, self.nodes.shift + len(self.nodes) - 1
        subtrees = spark.createDataFrame([], SUBTREE_SCHEMA) if self.nodes.subtrees is None \
            else self.nodes.subtrees.where(F.col("tree").between(first, last)).select(_SUBTREE)
        subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forest":
        r = spark.read.parquet(f"{path}/forest").first()
        meta = json.loads(r["meta"])
        bins = Bins(tuple(meta["features"]), tuple(np.array(c) for c in meta["cuts"]))
        tops, sizes = [], []
        for t in spark.read.parquet(f"{path}/tops").orderBy("tree").toLocalIterator():
            tops.append(Trees(np.zeros(1, np.int64), *(np.frombuffer(t[c], k) for c, k in _TOP.items())))
            sizes.append(t["nodes"])
        nodes = StoredTrees(tops, spark.read.schema(SUBTREE_SCHEMA).parquet(f"{path}/subtrees"), np.array(sizes, dtype=np.int64), meta["shift"])
        return Forest(nodes, bins, BalancedDraws(meta["trees"], tuple(meta["sizes"]), meta["seed"],
                                                 np.frombuffer(r["block_rows"], np.int64).reshape(-1, 2)))


_TOP = {"feature": np.int32, "cut": np.int32, "left": np.int64, "n0": np.int64, "n1": np.int64, "tie": np.uint8}
_TOP_SCHEMA = "tree int, nodes long, " + ", ".join(f"{c} binary" for c in _TOP)


def voters(table: Table, forest: Forest) -> Iterator[tuple[int, Lean | Told]]:
    """``passes`` of a forest to vote on the table's rows: by their codes, if the trees were grown from the table's codes."""
    codes = forest.nodes.codes
    return forest.nodes.told() if codes is not None and codes is table._distinct[1] else forest.nodes.passes()


def votes_on(grown: Lean | Told, x: np.ndarray, unseen: np.ndarray) -> np.ndarray:
    """trees x rows: the trees' votes on rows they have not seen, 0 on others."""
    if isinstance(grown, Told):
        return grown.of(x) & unseen
    out = np.zeros(unseen.shape, dtype=np.uint8)
    for t in range(len(grown)):
        rows = np.flatnonzero(unseen[t])
        out[t, rows] = grown.value.take(grown.leaf(x, t, rows))
    return out


def passes_of(table: Table, forests: Sequence[Forest]) -> Iterator[list[tuple[int, int, Lean | Told]]]:
    """Bounded lots of (number of the forest, its first tree of the lot, voters on the table's rows)."""
    lot, size = [], 0
    for number, forest in enumerate(forests):
        for first, trees in voters(table, forest):
            more = trees.bits.nbytes if isinstance(trees, Told) else len(trees.feature) * binned.NODE_BYTES
            if lot and size + more > binned.PASS_BYTES:
                yield lot
                lot, size = [], 0
            lot.append((number, first, trees))
            size += more
    if lot:
        yield lot


def over_passes(lots: Iterator, one) -> tuple[DataFrame, bool]:
    """The rows that ``one`` gives for each lot of trees, and whether there are several lots.

    A single lot stays lazy; of several each is written before the next is read.
    """
    got, waiting = [], None
    for lot in lots:
        if waiting is not None:
            got.append(written(waiting, "pass"))
        waiting = one(lot)
    if not got:
        return waiting, False
    return reduce(DataFrame.unionByName, [*got, written(waiting, "pass")]), True


def lots_of(blocks: Iterator[Block], rows: int) -> Iterator[list[Block]]:
    """Blocks of about so many rows together."""
    lot, n = [], 0
    for block in blocks:
        lot.append(block)
        n += len(block.y)
        if n >= rows:
            yield lot
            lot, n = [], 0
    if lot:
        yield lot


def class_sizes(table: Table, ratio: float = 1.0) -> tuple[int, int]:
    """Rows a tree draws per class: the rarer class as often as it has rows, the other ``ratio`` times that."""
    n0, n1 = (int(n) for n in table.totals)
    rare = min(n0, n1)
    return (int(rare * ratio), rare) if n1 <= n0 else (rare, int(rare * ratio))


def rules_of(p: int, mtry: int | None = None, nodesize: int = 1) -> Rules:
    """A node of at most ``nodesize`` rows is not split."""
    return Rules(mtry=min(mtry or max(1, int(p ** 0.5)), p), min_split=nodesize + 1)


def fit_forests(table: Table, settings: Sequence[dict], num_trees: int = 500, seed: int = 42, **grow_options) -> list[Forest]:
    """One forest per setting (mtry, nodesize, ratio), all grown in the same jobs.

    Settings of one ratio share their samples.
    """
    p = len(table.bins.features)
    out: list[Forest | None] = [None] * len(settings)
    for ratio in dict.fromkeys(s.get("ratio", 1.0) for s in settings):
        mine = [i for i, s in enumerate(settings) if s.get("ratio", 1.0) == ratio]
        draws = BalancedDraws(num_trees, class_sizes(table, ratio), seed, table.counts)
        plan = [(t, rules_of(p, settings[i].get("mtry"), settings[i].get("nodesize", 1)), seed * 1_000_003 + t)
                for i in mine for t in range(num_trees)]
        trees = grow_stored(table, draws, plan, **grow_options)
        for at, i in enumerate(mine):
            out[i] = Forest(trees.view(at * num_trees, (at + 1) * num_trees), table.bins, draws)
    return out


def fit_forest(table: Table, num_trees: int = 500, mtry: int | None = None, nodesize: int = 1, ratio: float = 1.0,
               seed: int = 42, **grow_options) -> Forest:
    """balanced bootstrap per tree, ``mtry`` (default floor(sqrt p)) features per node, fully grown trees."""
    return fit_forests(table, [{"mtry": mtry, "nodesize": nodesize, "ratio": ratio}], num_trees, seed, **grow_options)[0]


# ------------------------------------------------------------------ F11, F12: out-of-bag

def oob_votes(table: Table, forests: Sequence[Forest], key: str = "key") -> DataFrame:
    """(forest, key, label, votes, trees, score) of every row; score is null where all trees have seen the row."""
    key_type = table.blocks.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField("forest", T.IntegerType()), T.StructField(key, key_type), T.StructField("label", T.DoubleType()),
                           T.StructField("votes", T.LongType()), T.StructField("trees", T.LongType()),
                           T.StructField("_block", T.IntegerType()), T.StructField("_row", T.IntegerType())])
    unlike = list({id(f.draws): f.draws for f in forests}.values())
    drawn_by = [next(i for i, d in enumerate(unlike) if d is f.draws) for f in forests]

    def one(lot):
        numbers = list(dict.fromkeys(number for number, _, _ in lot))

        def run(block: Block):
            unseen = {i: unlike[i].counts(block) == 0 for i in {drawn_by[number] for number in numbers}}
            n = len(block.y)
            for number in numbers:
                votes, trees = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for _, first, grown in (part for part in lot if part[0] == number):
                    own = unseen[drawn_by[number]][first:first + len(grown)]
                    votes += votes_on(grown, block.x, own).sum(axis=0, dtype=np.int64)
                    trees += own.sum(axis=0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, number, np.int32)), block.keys, pa.array(block.y.astype(float)), pa.array(votes), pa.array(trees),
                    pa.array(np.full(n, block.number, np.int32)), pa.array(np.arange(n, dtype=np.int32))], names=schema.names)

        return table.map(run, schema)

    got, several = over_passes(passes_of(table, forests), one)
    if several:
        got = got.groupBy("forest", "_block", "_row").agg(F.first(key).alias(key), F.first("label").alias("label"),
                                                          F.sum("votes").alias("votes"), F.sum("trees").alias("trees"))
    score = F.when(F.col("trees") > 0, F.col("votes") / F.col("trees")).alias("score")
    return got.select("forest", key, "label", "votes", "trees", score)


def oob_error_path(table: Table, forest: Forest) -> DataFrame:
    """out-of-bag error of the first n trees, n = 1..T (rows that all of them have seen are left out).

    Passes after the first start from the votes that the earlier trees have left (two numbers a row, in a table by block).
    """
    draws, lots = forest.draws, voters(table, forest)
    parts, before = [], None
    names, p = table.tags, len(table.bins.features)

    def one(first: int, grown: Lean | Told, source: DataFrame):
        def run(batches):
            for batch in batches:
                held = batch.column("votes") if "votes" in batch.schema.names else None
                for i, block in enumerate(read_blocks([batch], p, names)):
                    unseen, n = draws.counts(block)[first:first + len(grown)] == 0, len(block.y)
                    votes, trees = np.zeros((2, n), np.int32) if held is None else \
                        np.frombuffer(held[i].as_py(), np.int32).reshape(2, n)
                    votes = votes + np.cumsum(votes_on(grown, block.x, unseen), axis=0, dtype=np.int32)      # after each tree
                    trees = trees + np.cumsum(unseen, axis=0, dtype=np.int32)
                    known = trees > 0
                    wrong = np.count_nonzero(((2 * votes > trees) != (block.y == 1)) & known, axis=1)
                    rows_ = np.count_nonzero(known, axis=1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([block.number], pa.int32()), pa.array([np.stack([votes[-1], trees[-1]]).tobytes()], pa.binary()),
                        pa.array([wrong.tolist()], pa.list_(pa.int64())), pa.array([rows_.tolist()], pa.list_(pa.int64()))],
                        names=["block", "votes", "wrong", "rows"])

        return source.mapInArrow(run, "block int, votes binary, wrong array<long>, rows array<long>")

    ship(table.spark)
    for first, grown in lots:
        source = table.blocks if before is None else table.blocks.join(before, "block")
        after = written(one(first, grown, source), "path")
        pairs = after.select(F.posexplode(F.arrays_zip("wrong", "rows")).alias("t", "e"))
        parts.append(pairs.groupBy((F.col("t") + 1 + first).cast("long").alias("n_trees")).agg(
            (F.sum("e.wrong") / F.sum("e.rows")).alias("error")))
        before = after.select("block", "votes")
    return reduce(DataFrame.unionByName, parts).orderBy("n_trees")


# ------------------------------------------------------------------ F21

def oob_importance(table: Table, forest: Forest, seed: int = 7) -> DataFrame:
    """(feature, importance, raw, sd): mean loss of out-of-bag accuracy over the trees when a feature is permuted.

    Per tree the feature's values change places among the tree's out-of-bag rows
    of a block; trees without the feature lose nothing and need no second vote. A
    row goes down again only from the first node on its way that tests the feature.
    ``importance`` is ``raw`` over its standard error (sd over the root of the
    number of trees); without variance it is ``raw``.
    """
    draws, p = forest.draws, len(table.bins.features)

    def one(lot):
        first, grown = lot
        ends = np.append(grown.roots[1:], len(grown.feature))
        uses = [np.unique(grown.feature[a:b][grown.feature[a:b] >= 0]) for a, b in zip(grown.roots, ends)]

        def run(blocks):
            lost, seen = np.zeros((len(grown), p), np.int64), np.zeros(len(grown), np.int64)
            for lot in lots_of(blocks, LOT_ROWS):
                x, y = np.concatenate([b.x for b in lot]), np.concatenate([b.y for b in lot])
                unseen = np.concatenate([draws.counts(b)[first:first + len(grown)] == 0 for b in lot], axis=1)
                ends = np.cumsum([0] + [len(b.y) for b in lot])
                one, place = one_of_each(x)
                for t in range(len(grown)):
                    rows, used = np.flatnonzero(unseen[t]), uses[t]
                    seen[t] += len(rows)
                    if not len(used) or not len(rows):
                        continue
                    leaf = grown.leaf(x[one], t)[place[rows]] if len(one) < len(rows) else grown.leaf(x, t, rows)
                    own, new = x[rows], np.empty((len(rows), p), np.uint8)
                    parts = np.searchsorted(rows, ends)
                    for block, a, b in zip(lot, parts, parts[1:]):
                        rng = np.random.Generator(np.random.PCG64([seed, block.number, first + t]))
                        for f in used:
                            new[a:b, f] = own[rng.permutation(b - a) + a, f]
                    # only rows whose value is another now, and whose way down asks for it, can get to another leaf
                    root, tests = grown.first_tests(t)
                    start = tests.take(leaf - root, axis=0)
                    row, f = np.nonzero((new[:, :start.shape[1]] != own[:, :start.shape[1]]) & (start >= 0))
                    other = own[row]
                    other[np.arange(len(row)), f] = new[row, f]
                    now = grown.value.take(grown.leaf(other, t, start=start[row, f]))
                    was, truth = grown.value.take(leaf)[row], y[rows][row]
                    lost[t] += np.bincount(f, (was == truth).astype(float) - (now == truth), p).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array(np.repeat(np.arange(first, first + len(grown), dtype=np.int32), p)),
                "f": pa.array(np.tile(np.arange(p, dtype=np.int32), len(grown))), "lost": lost.ravel(), "n": np.repeat(seen, p)})

        return table.map_task(run, "tree int, f int, lost long, n long")

    got, _ = over_passes(forest.nodes.passes(), one)
    per_tree = got.groupBy("tree", "f").agg((F.sum("lost") / F.sum("n")).alias("d"))
    names = F.array(*[F.lit(f) for f in table.bins.features])
    raw, sd = F.avg("d").alias("raw"), F.coalesce(F.stddev_samp("d"), F.lit(0.0)).alias("sd")
    got = per_tree.groupBy("f").agg(raw, sd, F.count("d").alias("trees"))
    scaled = F.when(F.col("sd") > 0, F.col("raw") / (F.col("sd") / F.sqrt("trees"))).otherwise(F.col("raw"))
    return got.select(F.get(names, F.col("f")).alias("feature"), scaled.alias("importance"), "raw", "sd")


# ------------------------------------------------------------------ F22

def partial_dependence(table: Table, forest: Forest, df: DataFrame, targets: Sequence[str], n_grid: int = 51) -> DataFrame:
    """(feature, value, pd): mean over the table's rows of half the log odds of the votes, one feature set to each grid value.

    The grid is ``min(n_grid, distinct values)`` equally spaced points between the
    least and the greatest value in ``df``. Rows that differ in the feature
    only (by their codes) give the same curve and are walked once, once per code of the grid.
    """
    ends = df.agg(*[f(c).alias(f"{n}_{c}") for c in targets
                    for n, f in (("a", F.min), ("b", F.max), ("n", F.count_distinct))]).first()
    grids = {c: np.linspace(ends[f"a_{c}"], ends[f"b_{c}"], min(n_grid, ends[f"n_{c}"])) for c in targets if ends[f"n_{c}"]}
    at = {c: table.bins.features.index(c) for c in grids}
    codes = {}
    for c, grid in grids.items():
        x = np.zeros((len(grid), len(table.bins.features)))
        x[:, at[c]] = grid
        codes[c] = table.bins.codes(x)[:, at[c]]
    names, p, total = list(grids), len(table.bins.features), len(forest.nodes)
    curves = _distinct_curves(table, [at[c] for c in names])

    def one(lot):
        _, grown = lot

        def run(batches):
            for batch in batches:
                key = batch.column("x").to_pylist()
                which = batch.column("f").to_numpy()
                rows = np.frombuffer(b"".join(key), np.uint8).reshape(len(key), p)
                for f in np.unique(which):
                    own = np.flatnonzero(which == f)
                    votes = code_votes(grown, rows[own], at[names[f]], codes[names[f]])
                    yield pa.RecordBatch.from_arrays([batch.column("f").take(pa.array(own)), batch.column("x").take(pa.array(own)),
                                                      batch.column("n").take(pa.array(own)),
                                                      pa.array(list(votes.astype(np.int32)), pa.list_(pa.int32()))], names=["f", "x", "n", "votes"])

        return curves.mapInArrow(run, "f int, x binary, n long, votes array<int>")

    ship(table.spark)
    got, several = over_passes(forest.nodes.passes(), one)
    votes = got.select("f", "x", "n", F.posexplode("votes").alias("c", "v"))
    if several:
        votes = votes.groupBy("f", "x", "c").agg(F.first("n").alias("n"), F.sum("v").alias("v"))
    share = F.col("v") / F.lit(total)
    half = 0.5 * (F.log(F.greatest(share, F.lit(EPS))) - F.log(F.greatest(1 - share, F.lit(EPS))))
    sums = votes.groupBy("f", "c").agg((F.sum(half * F.col("n")) / F.sum("n")).alias("pd"))
    place = {c: np.unique(codes[c], return_inverse=True)[1] for c in names}
    points = table.spark.createDataFrame([(names[f], f, int(place[names[f]][i]), float(v)) for f in range(len(names))
                                          for i, v in enumerate(grids[names[f]])], "feature string, f int, c int, value double")
    return points.join(sums, ["f", "c"]).select("feature", "value", "pd")


def _distinct_curves(table: Table, features: Sequence[int]) -> DataFrame:
    """(f, x, n): for each of the features (numbered) the distinct codes of the others, the feature at 0, and their rows."""
    def run(blocks):
        for block in blocks:
            for number, f in enumerate(features):
                x = block.x.copy()
                x[:, f] = 0
                rows, n = np.unique(x, axis=0, return_counts=True) if x.shape[1] else (x, np.ones(len(x), int))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), number, np.int32)), pa.array([r.tobytes() for r in rows], pa.binary()),
                                                  pa.array(n.astype(np.int64))], names=["f", "x", "n"])

    return written(table.map_task(run, "f int, x binary, n long").groupBy("f", "x").agg(F.sum("n").alias("n")), "curves")


def code_votes(trees: Lean, x: np.ndarray, feature: int, codes: np.ndarray) -> np.ndarray:
    """rows x distinct codes: votes for class 1 with ``feature`` set to each code."""
    wanted = np.unique(codes)
    out = np.zeros((len(x), len(wanted)), dtype=np.int64)
    step = max(1, CURVE_ROWS // max(len(wanted), 1))
    for a in range(0, len(x), step):
        part = np.repeat(x[a:a + step], len(wanted), axis=0)
        part[:, feature] = np.tile(wanted, len(part) // len(wanted))
        for t in range(len(trees)):
            out[a:a + step] += trees.value.take(trees.leaf(part, t)).reshape(-1, len(wanted))
    return out


# ------------------------------------------------------------------ F13, F14

def forest_search(table: Table, num_trees: int = 500, mtry_grid: Sequence[int] | None = None,
                  node_grid: Sequence[int] = (1, 5, 10, 20, 50), ratios: Sequence[float] = (1.0, 1.5, 2.0), seed: int = 42) -> DataFrame:
    """F13 + F14: mtry, nodesize, class ratio, then mtry again, each by out-of-bag PR-AUC (the first of equals wins).

    Returns the sensitivity table: parameter, selected_value, oob_error, pr_auc,
    precision, recall, f1, balanced_accuracy.
    """
    p = len(table.bins.features)
    mtry_grid = list(mtry_grid or range(2, max(3, p // 2 + 1), 2))
    best = {"mtry": max(1, int(p ** 0.5)), "nodesize": 1, "ratio": 1.0}
    rows = []

    def step(name, parameter, grid):
        forests = fit_forests(table, [best | {parameter: v} for v in grid], num_trees, seed)
        votes = oob_votes(table, forests).where(F.col("score").isNotNull()).groupBy("forest", "label", "score").count()
        # one row per setting, class and score (at most trees^2 / 2 scores)
        scored = votes.withColumn("times", F.col("count").cast("double")).persist()
        try:
            areas = {r["forest"]: r["pr_auc"] or 0.0 for r in _weighted_pr_auc(scored).collect()}
            at = max(range(len(grid)), key=lambda i: (areas.get(i, 0.0), -i))
            best[parameter] = grid[at]
            rows.append((name, str(grid[at]), areas.get(at, 0.0), _confusion(scored.where(F.col("forest") == at))))
        finally:
            scored.unpersist()

    step("ntree", "mtry", [best["mtry"]])
    rows[0] = ("ntree", str(num_trees), *rows[0][2:])
    step("mtry", "mtry", mtry_grid)
    step("nodesize", "nodesize", list(node_grid))
    step("sampsize", "ratio", list(ratios))
    step("refinement", "mtry", mtry_grid)
    return table.spark.createDataFrame(
        [(n, v, m["oob_error"], pr, m["precision"], m["recall"], m["f1"], m["balanced_accuracy"]) for n, v, pr, m in rows],
        "parameter string, selected_value string, oob_error double, pr_auc double, precision double, recall double, f1 double, "
        "balanced_accuracy double")


def _weighted_pr_auc(scored: DataFrame) -> DataFrame:
    return EV.pr_auc(scored, ["forest"], "score", "label", weight="times")


def _confusion(scored: DataFrame) -> dict:
    yes, pos, n = F.col("score") > 0.5, F.col("label") == 1, F.col("count")
    r = scored.agg(*[F.coalesce(F.sum(F.when(c, n)), F.lit(0)).alias(a) for a, c in
                     (("tp", yes & pos), ("fp", yes & ~pos), ("fn", ~yes & pos), ("tn", ~yes & ~pos))]).first()
    tp, fp, fn, tn = r["tp"], r["fp"], r["fn"], r["tn"]
    div = lambda a, b: a / b if b else None
    precision, recall, special = div(tp, tp + fp), div(tp, tp + fn), div(tn, tn + fp)
    both = precision is not None and recall is not None
    return {"oob_error": div(fp + fn, tp + fp + fn + tn), "precision": precision, "recall": recall,
            "f1": div(2 * precision * recall, precision + recall) if both else None,
            "balanced_accuracy": None if recall is None or special is None else (recall + special) / 2}


def tuned_parameters(search: DataFrame) -> dict:
    """mtry, nodesize and ratio that the search ended with (a table of five rows)."""
    got = {r["parameter"]: r["selected_value"] for r in search.collect()}
    return {"mtry": int(got["refinement"]), "nodesize": int(got["nodesize"]), "ratio": float(got["sampsize"])}


__all__ = ["BalancedDraws", "Forest", "binned_table", "class_sizes", "fit_forest", "fit_forests", "forest_search", "oob_error_path",
           "oob_importance", "oob_votes", "partial_dependence", "tuned_parameters"]
