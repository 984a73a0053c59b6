"""Regularised, resumable gradient boosting on binned tables.

Second-order boosting of the logistic loss with leaf penalties: L1 (``l1``), L2
(``l2``), a least gain per split (``gamma``, applied from the leaves up after a
tree is grown), a least hessian per leaf, row and column shares per round.

Many boosters (trials, folds) grow in the same jobs. A tree on more than
``LOCAL_ROWS`` rows is split level by level: tasks add up gradient histograms
(booster x node x feature x bin), Spark adds up the tasks; the driver sees only
those sums, whose size depends on the models' shape and not on the rows, and
picks the splits. Of two siblings only the one with fewer rows is summed, the
other is the parent less that one. The rows of a smaller tree, or of a node with
no more rows in a tree of more than ``SPREAD_DEPTH`` levels, go to one task, which
grows the subtree from the same sums. Gradients are summed as integers
(multiples of 2^-26), so sums, splits and trees are the same for any
partitioning. Row shares are drawn per block and round.

Margins are a column of the blocks: every ``SAVE_ROUNDS`` rounds the blocks are
written anew with the margins so far, and later rounds start from there; a lost
executor costs at most the trees since. ``Boosting.resume`` goes on from a saved
state, with the same trees as one long fit (tested).

Held-out rows are scored by the first job of the next round: a histogram of
``SCORE_BINS`` score classes gives PR-AUC, and integer sums give the log-loss.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.operators.models.binned import Bins, Table, tree_sums
from propensity.operators.models.grower import Trees
from propensity.session import ship, written

SAVE_ROUNDS = 20
LOCAL_ROWS = 100_000
#: Trees of at most so many levels keep the small nodes of a wide tree with the others: no rows are sent.
SPREAD_DEPTH = 8
#: Cells that the tasks of a round may send to the driver as they are (28 bytes each); more are added up by Spark.
DRIVER_CELLS = 500_000
#: Blocks that a task holds as columns at once.
CHUNK_BLOCKS = 32
#: Levels and nodes up to which a tree is applied to whole columns, split by split.
COLUMN_LEVELS, COLUMN_NODES = 8, 255
SCORE_BINS = 4096
_UNIT = float(1 << 26)
_TOO_SMALL = 1e-6


@dataclass(frozen=True)
class Params:
    """Settings of a booster; the defaults are those of the reference's default model."""

    max_depth: int = 6
    eta: float = 0.3
    subsample: float = 1.0
    colsample: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    l2: float = 10.0
    l1: float = 1.0
    scale_pos: float = 1.0
    seed: int = 42


@dataclass
class Spec:
    """A booster to grow: settings, the tag values of its training rows and of its held-out rows (None: no such tag)."""

    params: Params
    train: frozenset | None = None
    held: frozenset | None = None


@dataclass
class Booster:
    """Grown trees with a value per node; its margin is the sum of the leaves' values."""

    params: Params
    bins: Bins
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)     # per round: feature, cut, left, value

    def arrays(self, rounds: int | None = None) -> tuple[Trees, np.ndarray]:
        chosen = self.trees[:rounds]
        sizes = [len(t[0]) for t in chosen]
        roots = np.cumsum([0] + sizes)[:-1].astype(np.int64)
        of = lambda i, kind: np.concatenate([t[i] for t in chosen]).astype(kind) if chosen else np.zeros(0, kind)
        left = np.concatenate([t[2] + r for t, r in zip(chosen, roots)]).astype(np.int64) if chosen else np.zeros(0, np.int64)
        none = np.zeros(sum(sizes), np.int64)
        return Trees(roots, of(0, np.int32), of(1, np.int32), left, none, none, none), of(3, float)

    def score(self, df: DataFrame, out: str = "score", rounds: int | None = None) -> DataFrame:
        """Probability of class 1 after ``rounds`` (default: all) rounds."""
        trees, values = self.arrays(rounds)
        return tree_sums(df, trees, values, self.bins, out).withColumn(out, 1 / (1 + F.exp(-F.col(out))))

    def save(self, spark: SparkSession, path: str) -> None:
        meta = json.dumps({"params": asdict(self.params), "features": self.bins.features, "cuts": [c.tolist() for c in self.bins.cuts]})
        rows = [(meta, i, *[a.astype(k).tobytes() for a, k in zip(t, _KINDS)]) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows or [(meta, -1, b"", b"", b"", b"")], "meta string, round int, feature binary, cut binary, "
                              "left binary, value binary").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Booster":
        rows = spark.read.parquet(path).orderBy("round").collect()
        meta = json.loads(rows[0]["meta"])
        bins = Bins(tuple(meta["features"]), tuple(np.array(c) for c in meta["cuts"]))
        trees = [tuple(np.frombuffer(r[c], k) for c, k in zip(("feature", "cut", "left", "value"), _KINDS)) for r in rows if r["round"] >= 0]
        return Booster(Params(**meta["params"]), bins, trees)


_KINDS = (np.int32, np.int32, np.int64, np.float64)


def soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g, h, p: Params):
    return -p.eta * soft(g, p.l1) / (h + p.l2)


def best_gains(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, p: Params):
    """(feature, cut, gain, left g, left h) of nodes x features x bins histograms; gain -1 where none is allowed."""
    lg, lh = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    tg, th = lg[:, :, -1:], lh[:, :, -1:]
    lg, lh = lg[:, :, :-1], lh[:, :, :-1]
    rg, rh = tg - lg, th - lh
    if not lg.shape[2]:
        none = np.zeros(len(g), dtype=np.int64)
        return none, none, none - 1.0, none, none
    worth = lambda a, b: soft(a, p.l1) ** 2 / (b + p.l2)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = worth(lg, lh) + worth(rg, rh) - worth(tg, th)
    ok = (lh >= p.min_child_weight) & (rh >= p.min_child_weight) & (lh > 0) & (rh > 0) & allowed[None, :, None]
    flat = np.where(ok & (gain > _TOO_SMALL), gain, -1.0).reshape(len(g), -1)
    best = flat.argmax(axis=1)
    f, c = np.divmod(best, lg.shape[2])
    at = np.arange(len(g))
    return f, c, flat[at, best], lg[at, f, c], lh[at, f, c]


def drawn_features(p: Params, round_: int, n: int) -> np.ndarray:
    keep = np.zeros(n, dtype=bool)
    rng = np.random.Generator(np.random.PCG64([p.seed, 3, round_]))
    keep[rng.permutation(n)[:max(1, int(n * p.colsample))]] = True
    return keep


def drawn_rows(p: Params, round_: int, block: int, n: int) -> np.ndarray:
    if p.subsample >= 1:
        return np.ones(n, dtype=bool)
    return np.random.Generator(np.random.PCG64([p.seed, 4, round_, block])).random(n) < p.subsample


class _Tree:
    """A tree of this round: nodes with their sums and rows, wide open ones in the order of their histograms, small open ones."""

    def __init__(self, p: Params, rows: int, local_rows: int):
        self.p, self.local_rows, self.depth = p, local_rows, 0
        self.feature, self.cut, self.left, self.gain, self.g, self.h = [-1], [0], [0], [0.0], [0.0], [0.0]
        self.level, self.small = ([0], []) if rows > local_rows else ([], [(0, 0)])
        self.spread = rows > local_rows and p.max_depth <= SPREAD_DEPTH
        self.rest: dict[int, tuple[int, np.ndarray]] = {}       # a node of the level: its sibling there, their parent's sums

    def asked(self) -> list[int]:
        """The nodes of the level whose sums no sibling gives."""
        return [n for n in self.level if n not in self.rest]

    def whole(self, sums: np.ndarray) -> np.ndarray:
        """Sums (3 x nodes x features x bins) of the level from those of the nodes asked for."""
        known = {n: sums[:, i] for i, n in enumerate(self.asked())}
        known |= {n: parent - known[other] for n, (other, parent) in self.rest.items()}
        return np.stack([known[n] for n in self.level], axis=1)

    def split(self, found, rows: np.ndarray, sums: np.ndarray | None = None) -> None:
        """The wide nodes' best splits; ``rows``: nodes x features x bins counts. Children are the next level or small."""
        nxt, self.depth, self.rest = [], self.depth + 1, {}
        for i, (node, f, c, gain, lg, lh) in enumerate(zip(self.level, *found)):
            if gain <= 0:
                continue
            self.feature[node], self.cut[node], self.left[node], self.gain[node] = int(f), int(c), len(self.feature), float(gain)
            left, first = int(rows[i, f, :c + 1].sum()), len(self.feature)
            right = int(rows[i, f].sum()) - left
            for g, h, n in ((lg, lh, left), (self.g[node] - lg, self.h[node] - lh, right)):
                if self.depth < self.p.max_depth:
                    wide = self.spread or n > self.local_rows
                    nxt.append(len(self.feature)) if wide else self.small.append((len(self.feature), self.depth))
                for store, v in zip((self.feature, self.cut, self.left, self.gain, self.g, self.h), (-1, 0, 0, 0.0, float(g), float(h))):
                    store.append(v)
            if sums is not None and nxt[-2:] == [first, first + 1]:
                less, more = (first, first + 1) if left <= right else (first + 1, first)
                self.rest[more] = less, sums[:, i]
        self.level = nxt

    def graft(self, node: int, arrays: Sequence[np.ndarray]) -> None:
        """A subtree (feature, cut, left, gain, g, h) in place of an open node."""
        base = len(self.feature) - 1
        for store, a in zip((self.feature, self.cut, self.left, self.gain, self.g, self.h), arrays):
            a = a + base if store is self.left else a
            store[node] = a[0].item()
            store.extend(a[1:].tolist())

    def finished(self) -> tuple[np.ndarray, ...]:
        """Pruned by gamma from the leaves up, with leaf values."""
        for node in reversed(range(len(self.feature))):
            if self.feature[node] >= 0 and self.gain[node] < self.p.gamma:
                left = self.left[node]
                if self.feature[left] < 0 and self.feature[left + 1] < 0:
                    self.feature[node] = -1
        value = leaf_value(np.array(self.g), np.array(self.h), self.p)
        return (np.array(self.feature, np.int32), np.array(self.cut, np.int32), np.array(self.left, np.int64), value)


def grow_rows(x: np.ndarray, g: np.ndarray, h: np.ndarray, p: Params, depth: int, allowed: np.ndarray, width: int):
    """A subtree from rows in memory, in the form that ``_Tree.graft`` takes."""
    t = _Tree(replace(p, max_depth=p.max_depth - depth), 1, 0)
    t.g[0], t.h[0] = float(g.sum()) / _UNIT, float(h.sum()) / _UNIT
    n = x.shape[1]
    rows, slot = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    while t.level and t.p.max_depth > 0:
        size = len(t.level)
        cell = ((slot[:, None] * n + np.arange(n)) * width + x[rows]).ravel()
        shape, cells = (size, n, width), size * n * width
        gs, hs = (np.bincount(cell, np.repeat(v[rows].astype(float), n), cells).reshape(shape) / _UNIT for v in (g, h))
        level = np.array(t.level)
        t.split(best_gains(gs, hs, allowed, t.p), np.bincount(cell, minlength=cells).reshape(shape))
        place = np.full(len(t.feature), -1, dtype=np.int64)
        place[t.level] = np.arange(len(t.level))
        f, cut, left = (np.array(a)[level][slot] for a in (t.feature, t.cut, t.left))
        kept = f >= 0
        rows, f, cut, left = rows[kept], f[kept], cut[kept], left[kept]
        slot = place[left + (x[rows, f] > cut)]
        rows, slot = rows[slot >= 0], slot[slot >= 0]
    return [np.array(a, k) for a, k in zip((t.feature, t.cut, t.left, t.gain, t.g, t.h), _GROWN)]


_GROWN = (np.int32, np.int32, np.int64, np.float64, np.float64, np.float64)


def _margin_of(margin: np.ndarray, x: np.ndarray, trees: Sequence[tuple]) -> np.ndarray:
    for feature, cut, left, value in trees:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while len(rows):
            f = feature[node[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            at = node[rows]
            node[rows] = left[at] + (x[rows, f] > cut[at])
        margin = margin + value[node]
    return margin


def _tagged(tags: np.ndarray, values) -> np.ndarray:
    return np.logical_or.reduce([tags == v for v in values]) if values else np.zeros(len(tags), bool)


class _Chunk:
    """Some blocks in a task as columns, with the margins of all boosters as saved."""

    def __init__(self, part: pa.RecordBatch, p: int, tags: Sequence[str], n: int, two: np.ndarray):
        ys = [np.frombuffer(v, np.uint8) for v in part.column("y").to_pylist()]
        self.numbers, self.sizes, self.y = part.column("block").to_pylist(), [len(y) for y in ys], np.concatenate(ys)
        self.columns = np.concatenate([np.frombuffer(v, np.uint8).reshape(-1, p) for v in part.column("x").to_pylist()]).T.copy()
        self.tags = {t: np.concatenate([np.frombuffer(v, np.int32) for v in part.column(f"tag_{t}").to_pylist()]) for t in tags}
        self.start = np.concatenate([np.frombuffer(v, float).reshape(n, -1) for v in part.column("margin").to_pylist()], axis=1) \
            if "margin" in part.schema.names else np.zeros((n, len(self.y)))
        self._two, self._ones, self._above = two, None, {}

    def ones(self) -> np.ndarray:
        """The features of two bins, as numbers to multiply with."""
        if self._ones is None:
            self._ones = self.columns[self._two].astype(float)
        return self._ones

    def above(self, feature: int, cut: int) -> np.ndarray:
        """Which rows are above the cut, a bit each; trees share most of their cuts."""
        if (feature, cut) not in self._above:
            self._above[feature, cut] = np.packbits(self.columns[feature] > cut)
        return self._above[feature, cut]

    def leaf_values(self, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The value of every row's leaf: bit d of a row's way says whether it goes right at level d (0 below its leaf)."""
        f, c, to, planes, ends, open_ = feature.tolist(), cut.tolist(), left.tolist(), [], {}, [(0, None, 0, 0)]
        if len(f) > COLUMN_NODES:
            return _margin_of(np.zeros(len(self.y)), self.columns.T, [(feature, cut, left, value)])
        while open_:
            node, here, level, way = open_.pop()
            if f[node] < 0:
                ends[way] = node
                continue
            if level == COLUMN_LEVELS:
                return _margin_of(np.zeros(len(self.y)), self.columns.T, [(feature, cut, left, value)])
            right = self.above(f[node], c[node])
            right = right if here is None else here & right
            if level == len(planes):
                planes.append(right)
            else:
                planes[level] = planes[level] | right
            open_ += [(to[node] + 1, right, level + 1, way | 1 << level),
                      (to[node], ~right if here is None else here ^ right, level + 1, way)]
        if not planes:
            return np.full(len(self.y), value[0])
        bits = np.unpackbits(np.stack(planes), axis=1, count=len(self.y))
        ways = bits[0]
        for level in range(1, len(bits)):
            ways |= bits[level] << level
        table = np.zeros(1 << len(planes), value.dtype)
        table[list(ends)] = value[list(ends.values())]
        return table.take(ways)

    def margin(self, k: int, trees: Sequence[tuple]) -> np.ndarray:
        out = self.start[k].copy()
        for tree in trees:
            out += self.leaf_values(*tree)
        return out

    def drawn(self, p: Params, round_: int) -> np.ndarray:
        if p.subsample >= 1:
            return np.ones(len(self.y), bool)
        return np.concatenate([drawn_rows(p, round_, b, n) for b, n in zip(self.numbers, self.sizes)])


class Boosting:
    """Boosters that grow together on one table; ``tag`` names the integer column that ``Spec.train`` and ``held`` speak of."""

    def __init__(self, table: Table, specs: Sequence[Spec], tag: str | None = None):
        self.table, self.specs, self.tag = table, list(specs), tag
        self.boosters = [Booster(s.params, table.bins) for s in specs]
        self.history: list[list[dict]] = [[] for _ in specs]
        self.active = list(range(len(specs)))
        self.blocks, self.saved, self.counted, self.tasks = table.blocks, 0, None, 0
        self.two = np.array([j for j, c in enumerate(table.bins.cuts) if len(c) == 1], np.int64)

    @property
    def rounds(self) -> int:
        return max((len(b.trees) for b in self.boosters), default=0)

    def _map(self, fn: Callable, schema, keep: Sequence[str] = ()) -> DataFrame:
        """``fn`` over (blocks with the columns ``keep`` besides, their chunk, margins of all boosters) of a task."""
        names, p, n, two = self.table.tags, len(self.table.bins.features), len(self.specs), self.two
        since = [b.trees[self.saved:] for b in self.boosters]
        used = ["block", "x", "y", *[f"tag_{t}" for t in names], *(["margin"] if "margin" in self.blocks.columns else [])]
        ship(self.table.spark)

        def rows(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, CHUNK_BLOCKS):
                    part = batch.slice(lo, CHUNK_BLOCKS)
                    chunk = _Chunk(part, p, names, n, two)
                    yield part, chunk, [lambda k=k, chunk=chunk: chunk.margin(k, since[k]) for k in range(n)]

        blocks = self.blocks.select(*used, *[c for c in keep if c not in used])
        return blocks.mapInArrow(lambda batches: fn(rows(batches)), schema)

    def save(self) -> None:
        """Writes the blocks with the margins so far."""
        schema = self.table.blocks.schema
        schema = T.StructType([*schema.fields, T.StructField("margin", T.BinaryType())])
        plain = self.table.blocks.columns

        def run(rows):
            for part, chunk, margins in rows:
                got = np.stack([m() for m in margins]) if margins else np.zeros((0, len(chunk.y)))
                ends = np.cumsum(chunk.sizes)
                own = [got[:, end - n:end].tobytes() for end, n in zip(ends, chunk.sizes)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in plain], pa.array(own, pa.binary())], names=[*plain, "margin"])

        self.blocks, self.saved = written(self._map(run, schema, plain), "margins"), self.rounds

    def _rows(self, trees: dict[int, _Tree], first: bool):
        """A function over a chunk: per booster the rows on open nodes (node place, rows, g, h), and held-out sums if ``first``."""
        tag, specs, round_ = self.tag, self.specs, self.rounds_now
        held = {k for k in self.active if specs[k].held is not None and first and len(self.history[k]) < len(self.boosters[k].trees)}
        at = {k: (np.array(t.feature, np.int32), np.array(t.cut, np.int32), np.array(t.left, np.int64),
                  t.asked() if t.level else [n for n, _ in t.small], t.p) for k, t in trees.items()}

        def of(chunk: _Chunk, margins):
            tags = chunk.tags[tag] if tag else None
            for k in sorted(set(at) | held):
                with np.errstate(over="ignore"):
                    prob = 1 / (1 + np.exp(-margins[k]()))
                seen = own = None
                if k in held:
                    here = _tagged(tags, specs[k].held)
                    score = np.minimum((prob[here] * SCORE_BINS).astype(np.int64), SCORE_BINS - 1)
                    y = chunk.y[here]
                    sure = np.clip(np.where(y == 1, prob[here], 1 - prob[here]), 1e-16, 1)
                    loss = int(np.rint(-np.log(sure) * _UNIT).astype(np.int64).sum())
                    seen = np.stack([np.append(np.bincount(score[y == 0], minlength=SCORE_BINS), loss),
                                     np.append(np.bincount(score[y == 1], minlength=SCORE_BINS), len(y))]).astype(np.int64)
                if k in at:
                    feature, cut, left, places, params = at[k]
                    slot = np.full(len(feature), -1, np.int64)
                    slot[places] = np.arange(len(places))
                    node = chunk.leaf_values(feature, cut, left, slot).astype(np.int64)
                    mine = (node >= 0) & chunk.drawn(params, round_)
                    if specs[k].train is not None:
                        mine &= _tagged(tags, specs[k].train)
                    rows = np.flatnonzero(mine)
                    y, pr = chunk.y[rows], prob[rows]
                    w = np.where(y == 1, params.scale_pos, 1.0)
                    own = (node[rows], rows, np.rint((pr - y) * w * _UNIT), np.rint(np.maximum(pr * (1 - pr), 1e-16) * w * _UNIT))
                yield k, own, seen

        return of, held

    def _tasks(self) -> int:
        """Tasks that read the blocks."""
        if self.counted is not self.blocks:
            self.counted, self.tasks = self.blocks, self.blocks.rdd.getNumPartitions()
        return self.tasks

    def _sums(self, trees: dict[int, _Tree], first: bool) -> tuple[dict[int, np.ndarray], dict[int, dict]]:
        """Histograms of the wide nodes (booster: (g, h, rows) x nodes x features x bins, of the features drawn for the round),
        and held-out measures if ``first``."""
        p, width, two = len(self.table.bins.features), self.table.bins.width, self.two
        of, held = self._rows(trees, first)
        nodes = {k: len(t.asked()) for k, t in trees.items()}
        more = {k: np.setdiff1d(np.flatnonzero(drawn_features(t.p, self.rounds_now, p)), two) for k, t in trees.items()}

        def run(rows):
            total = {k: np.zeros((3, n, p, width), np.int64) for k, n in nodes.items()}
            seen = {k: np.zeros((3, SCORE_BINS + 1), np.int64) for k in held}
            for _, chunk, margins in rows:
                for k, own, measured in of(chunk, margins):
                    if measured is not None:
                        seen[k][:2] += measured
                    if own is not None:
                        node, at, g, h = own
                        if len(two):                        # of two bins: the upper one by a product, the lower one is the rest
                            parts = np.zeros((3, nodes[k], len(chunk.y)))
                            for i, v in enumerate((g, h, 1.0)):
                                parts[i, node, at] = v
                            upper = parts.reshape(-1, len(chunk.y)) @ chunk.ones().T
                            upper = upper.astype(np.int64).reshape(3, nodes[k], -1)
                            total[k][:, :, two, 0] += parts.sum(axis=2).astype(np.int64)[:, :, None] - upper
                            total[k][:, :, two, 1] += upper
                        base, cells = node * width, nodes[k] * width
                        for j in more[k]:
                            cell = base + chunk.columns[j][at]
                            for i, v in enumerate((g, h, None)):
                                total[k][i, :, j] += np.bincount(cell, v, cells).astype(np.int64).reshape(-1, width)
            for kind, sums in ((0, total), (1, seen)):
                for k, s in sums.items():
                    s = s.reshape(3, -1)
                    cells = np.flatnonzero(s.any(axis=0))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(cells), kind, np.int32)), pa.array(np.full(len(cells), k, np.int32)),
                        pa.array(cells.astype(np.int32)), *[pa.array(v[cells]) for v in s]], names=["kind", "k", "cell", "a", "b", "c"])

        sent = self._map(run, "kind int, k int, cell int, a long, b long, c long")
        if self._tasks() * (sum(nodes.values()) * p * width + len(held) * (SCORE_BINS + 1)) > DRIVER_CELLS:
            sent = sent.groupBy("kind", "k", "cell").agg(*[F.sum(c).alias(c) for c in "abc"])
        got = sent.toArrow()                                    # few cells from few tasks are added up here, without a shuffle
        kind, k_, cell, *sums = (got.column(c).to_numpy() for c in ("kind", "k", "cell", *"abc"))

        def of_one(which: int, k: int, size: int) -> np.ndarray:
            flat, rows = np.zeros((3, size), np.int64), (kind == which) & (k_ == k)
            for i in range(3):
                np.add.at(flat[i], cell[rows], sums[i][rows])
            return flat

        out = {k: t.whole(of_one(0, k, nodes[k] * p * width).reshape(3, -1, p, width)) for k, t in trees.items()}
        return out, {k: measures(*of_one(1, k, SCORE_BINS + 1)[:2]) for k in held}

    def _finish(self, trees: dict[int, _Tree], first: bool) -> dict[int, dict]:
        """The small nodes' subtrees, each grown by one task from its rows; held-out measures if ``first``."""
        width, n_features, round_ = self.table.bins.width, len(self.table.bins.features), self.rounds_now
        of, held = self._rows(trees, first)
        groups, base = [], {}
        for k, t in trees.items():
            base[k] = len(groups)
            groups += [(k, node, depth, t.p, drawn_features(t.p, round_, n_features)) for node, depth in t.small]

        def send(rows):
            for _, chunk, margins in rows:
                out = []
                for k, own, measured in of(chunk, margins):
                    if measured is not None:
                        out.append((-1 - k, b"", measured[0].tobytes(), measured[1].tobytes()))
                    if own is not None:
                        node, at, g, h = own
                        x = chunk.columns.T[at]
                        for place in np.unique(node):
                            mine = node == place
                            out.append((base[k] + int(place), x[mine].tobytes(), g[mine].astype(np.int64).tobytes(),
                                        h[mine].astype(np.int64).tobytes()))
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=["grp", *"xab"])

        def finish(t: pa.Table) -> pa.Table:
            grp = t.column("grp")[0].as_py()
            a, b = ([np.frombuffer(v, np.int64) for v in t.column(c).to_pylist()] for c in "ab")
            if grp < 0:
                arrays = [np.sum(a, axis=0), np.sum(b, axis=0)] + [np.zeros(0)] * 4
            else:
                _, _, depth, params, allowed = groups[grp]
                x = np.concatenate([np.frombuffer(v, np.uint8) for v in t.column("x").to_pylist()]).reshape(-1, n_features)
                arrays = grow_rows(x, np.concatenate(a), np.concatenate(b), params, depth, allowed, width)
            return pa.Table.from_arrays([pa.array([grp], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in arrays]],
                                        names=["grp", *"abcdef"])

        done = self._map(send, "grp int, x binary, a binary, b binary").groupBy("grp").applyInArrow(
            finish, "grp int, " + ", ".join(f"{c} binary" for c in "abcdef"))
        measured = {}
        for r in done.collect():                             # a row per small node and per held-out part
            if r["grp"] < 0:
                measured[-1 - r["grp"]] = measures(*(np.frombuffer(r[c], np.int64) for c in "ab"))
            else:
                k, node, *_ = groups[r["grp"]]
                trees[k].graft(node, [np.frombuffer(r[c], kind) for c, kind in zip("abcdef", _GROWN)])
        for t in trees.values():
            t.small = []
        return measured

    def run(self, rounds: int, patience: int | None = None, measure: str = "pr_auc") -> "Boosting":
        """Up to ``rounds`` more rounds; a booster with held-out rows stops when ``patience`` rounds bring nothing better."""
        goal = self.rounds + rounds
        while self.active:
            self.rounds_now = min(len(self.boosters[k].trees) for k in self.active)
            more = self.rounds_now < goal
            if self.rounds_now - self.saved >= SAVE_ROUNDS:
                self.save()
            trees = {k: _Tree(self.specs[k].params, int(self.table.totals.sum()), LOCAL_ROWS) for k in self.active} if more else {}
            first = True
            while first or any(t.level for t in trees.values()):
                wide = {k: t for k, t in trees.items() if t.level}
                if not wide and trees:
                    break
                sums, measured = self._sums(wide, first)
                first = False
                self._measured(measured, trees, patience, measure)
                for k, t in wide.items():
                    if k in trees:
                        g, h = sums[k][:2].astype(float) / _UNIT
                        allowed = drawn_features(t.p, self.rounds_now, g.shape[1])
                        if t.depth == 0:
                            t.g[0], t.h[0] = (float(v[0, allowed.argmax()].sum()) for v in (g, h))
                        t.split(best_gains(g, h, allowed, t.p), sums[k][2], sums[k])
            if any(t.small for t in trees.values()):
                self._measured(self._finish({k: t for k, t in trees.items() if t.small}, first), trees, patience, measure)
            for k, t in trees.items():
                self.boosters[k].trees.append(t.finished())
            if not more:
                break
        return self

    def _measured(self, measured: dict[int, dict], trees: dict[int, _Tree], patience: int | None, measure: str) -> None:
        """Notes the held-out measures; a booster that has run out of patience stops, and its tree of this round is dropped."""
        for k, m in measured.items():
            self.history[k].append(m)
            if patience and len(self.history[k]) - self.best_round(k, measure) >= patience:
                self.active.remove(k)
                trees.pop(k, None)

    resume = run

    def best_round(self, k: int, measure: str = "pr_auc") -> int:
        """The (first) best of the rounds measured so far, counted from 1."""
        values = [m[measure] if m[measure] is not None else -math.inf for m in self.history[k]]
        return int(np.argmin(values) if measure == "log_loss" else np.argmax(values)) + 1 if values else 0


def measures(neg: np.ndarray, pos: np.ndarray) -> dict:
    """PR-AUC and log-loss from score classes; the last entries are the summed loss and the rows."""
    n = int(pos[-1])
    return {"pr_auc": histogram_pr_auc(pos[:-1], neg[:-1]), "log_loss": float(neg[-1]) / _UNIT / n if n else None}


def histogram_pr_auc(pos: np.ndarray, neg: np.ndarray) -> float | None:
    """Area under the precision-recall curve (the integral of G7) over score classes, ascending."""
    tp, fp = np.cumsum(pos[::-1]).astype(float), np.cumsum(neg[::-1]).astype(float)
    if not len(tp) or not tp[-1]:
        return None
    tp0, fp0 = np.concatenate([[0.0], tp[:-1]]), np.concatenate([[0.0], fp[:-1]])
    step = tp > tp0
    t0, t1, f0, f1 = tp0[step], tp[step], fp0[step], fp[step]
    a = 1 + (f1 - f0) / (t1 - t0)
    b = f0 - (f1 - f0) / (t1 - t0) * t0
    with np.errstate(divide="ignore", invalid="ignore"):
        curve = lambda t: t / a - b / (a * a) * np.log(a * t + b)
        area = np.where(b == 0, (t1 - t0) / a, curve(t1) - curve(t0))
    return float(area.sum() / tp[-1])


def fit_booster(table: Table, params: Params, rounds: int = 30) -> Booster:
    """one booster on all rows of the table."""
    return Boosting(table, [Spec(params)]).run(rounds).boosters[0]


def cv_rounds(table: Table, params: Params, fold_tag: str = "fold", folds: Sequence[int] = range(5), max_rounds: int = 300,
              patience: int = 30, measure: str = "pr_auc") -> DataFrame:
    """(round, cv_score, chosen): the mean held-out measure of all folds, grown together, until ``patience`` rounds
    bring no better mean or ``max_rounds`` are reached. Rounds go on from the saved margins; none is fitted twice."""
    folds = list(folds)
    specs = [Spec(params, frozenset(folds) - {f}, frozenset([f])) for f in folds]
    boosting = Boosting(table, specs, fold_tag)
    better = np.argmin if measure == "log_loss" else np.argmax
    mean: list[float] = []
    while len(mean) < max_rounds:
        boosting.run(min(5, max_rounds - len(mean)))
        known = [[m[measure] for m in h if m[measure] is not None] for h in boosting.history]
        known = [h for h in known if h]
        if not known:
            break
        mean = [float(np.mean([h[i] for h in known])) for i in range(min(len(h) for h in known))]
        stop = next((i for i in range(len(mean)) if i - int(better(mean[:i + 1])) >= patience), None)
        if stop is not None:
            mean = mean[:stop + 1]
            break
    best = int(better(mean)) if mean else -1
    return table.spark.createDataFrame([(i + 1, v, int(i == best)) for i, v in enumerate(mean)], "round int, cv_score double, chosen int")


# ------------------------------------------------------------------ F16: guided search

#: The bounded parameters of the search.
SPACE = {"max_depth": (2, 4), "eta": (0.01, 0.02), "subsample": (0.5, 0.7), "colsample": (0.5, 0.7), "gamma": (10.0, 20.0),
         "min_child_weight": (15, 30)}
INTEGERS = ("max_depth", "min_child_weight")


class Proposer:
    """Gaussian-process proposals with an upper-confidence rule, over the unit cube; bounded by the trials, not by rows."""

    def __init__(self, dims: int, seed: int = 42, kappa: float = 2.576, length: float = 0.4, candidates: int = 2000):
        self.dims, self.kappa, self.length, self.candidates = dims, kappa, length, candidates
        self.rng = np.random.default_rng(seed)

    def first(self, n: int) -> np.ndarray:
        """A Latin hypercube."""
        return np.stack([(self.rng.permutation(n) + self.rng.random(n)) / n for _ in range(self.dims)], axis=1)

    def _kernel(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.exp(-((a[:, None] - b[None]) ** 2).sum(axis=2) / (2 * self.length ** 2))

    def posterior(self, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation at ``at``, in standardised units of ``y``."""
        z = (y - y.mean()) / (y.std() or 1.0)
        k = self._kernel(x, x) + 1e-4 * np.eye(len(x))
        cross = self._kernel(at, x)
        mean = cross @ np.linalg.solve(k, z)
        var = 1 - np.einsum("ij,ji->i", cross, np.linalg.solve(k, cross.T))
        return mean, np.sqrt(np.maximum(var, 0))

    def next(self, x: np.ndarray, y: np.ndarray, n: int = 1) -> np.ndarray:
        """``n`` points for one batch: each counts as seen at its expected value before the next is chosen."""
        x, y, out = np.asarray(x, float), np.asarray(y, float), []
        for _ in range(n):
            near = np.clip(x[int(np.argmax(y))] + self.rng.normal(0, 0.1, (self.candidates // 4, self.dims)), 0, 1)
            at = np.vstack([self.rng.random((self.candidates, self.dims)), near])
            mean, sd = self.posterior(x, y, at)
            best = int(np.argmax(mean + self.kappa * sd))
            out.append(at[best])
            x, y = np.vstack([x, at[best]]), np.append(y, y.mean() + mean[best] * (y.std() or 1.0))
        return np.array(out)


def in_space(point: np.ndarray, space: dict) -> dict:
    out = {}
    for v, (name, (low, high)) in zip(point, space.items()):
        out[name] = int(min(high, low + math.floor(v * (high - low + 1)))) if name in INTEGERS else float(low + v * (high - low))
    return out


def boost_search(table: Table, role_tag: str, fit: int = 0, held: int = 1, base: Params = Params(), n_init: int = 5, n_iter: int = 10,
                 batch: int = 5, max_rounds: int = 100, patience: int = 10, space: dict | None = None, seed: int = 42) -> DataFrame:
    """F16: ``n_init`` spread and ``n_iter`` guided trials, each fitted on the rows of role ``fit``, stopped early and judged by
    PR-AUC on those of role ``held``; the trials of a batch grow in the same jobs. Returns the trials with ranks."""
    space = space or SPACE
    proposer = Proposer(len(space), seed)
    points, scores, rows = np.zeros((0, len(space))), np.zeros(0), []
    while len(points) < n_init + n_iter:
        if len(points) < n_init:
            new = proposer.first(n_init)
        else:
            new = proposer.next(points, scores, min(batch, n_init + n_iter - len(points)))
        chosen = [in_space(p, space) for p in new]
        run = Boosting(table, [Spec(replace(base, **c), frozenset([fit]), frozenset([held])) for c in chosen], role_tag)
        run.run(max_rounds, patience)
        for k, c in enumerate(chosen):
            best = run.best_round(k)
            rows.append((len(rows) + 1, *[c[n] for n in space], best, float((run.history[k][best - 1]["pr_auc"] or 0.0) if best else 0.0)))
        points, scores = np.vstack([points, new]), np.append(scores, [r[-1] for r in rows[len(scores):]])
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][-1], rows[i][0]))
    rank = {i: r + 1 for r, i in enumerate(order)}
    kinds = ", ".join(f"{n} {'int' if n in INTEGERS else 'double'}" for n in space)
    return table.spark.createDataFrame([(*r, rank[i]) for i, r in enumerate(rows)], f"trial int, {kinds}, rounds int, pr_auc double, rank long")


def best_params(trials: DataFrame, base: Params = Params()) -> Params:
    """The first-ranked trial's settings."""
    row = trials.where("rank = 1").drop("trial", "rounds", "pr_auc", "rank").first().asDict()
    return replace(base, **row)
