"""Classification trees grown together on one binned table.

All trees of a forest, of its settings or of the folds of a search grow in the
same jobs. A node with more than ``LOCAL_ROWS`` in-bag rows is split from a
histogram (node x feature x bin x class, exact integer counts): tasks add up
their blocks, Spark adds up the tasks, the driver sees the sums of a bounded
number of cells at a time. Smaller nodes are finished where they are: their
rows go to one task per node (at most ``LOCAL_ROWS`` of them), which grows the
whole subtree level by level from the distinct code vectors and their counts.
Both use the same counts and the same formula, so the trees do not depend on
where the line is drawn (tested).

Splits take the greatest decrease of the (class-weighted) Gini impurity; ties
go to the first feature, then the lowest cut. The features that a node may use
are drawn by a hash of tree and path. The subtrees stay in a written table
(``StoredTrees``): the driver holds the nodes above them, and reads as many
trees at a time as fit a pass. ``grow`` brings all nodes to the driver, for a
few trees; they are bounded by ``MAX_NODES``, beyond which it stops with an
error that names the settings to change.

A table with at most ``LOCAL_ROWS`` distinct codes sends no rows: tasks add up
how often each of the codes is in each sample, and a task grows whole trees
from these sums, however many rows are in them. With a tree goes its vote on
each of the codes, a bit each (``Told``), so that the table's own rows need not
walk down the trees again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators.models import binned
from propensity.operators.models.binned import Block, Codes, Table, marks_of, mix, parallelism
from propensity.session import written

LOCAL_ROWS = 1_500_000
#: Histogram cells that one job sums up.
JOB_CELLS = 2_000_000
#: Histogram cells that a task holds while it finishes a subtree.
TASK_CELLS = 1 << 20
#: Cells of rows x features that a histogram counts at once.
COUNT_CELLS = 1 << 20
#: Counts below this, and those of class 1 as often again, are exact in one float.
PACKED = 2.0 ** 26
#: Levels that rows go down before those at their leaves are set aside.
STRIDE = 4
MAX_NODES = 50_000_000
#: Samples x rows that a task adds up by their codes before it sends the sums.
LOT_CELLS = 64 << 20
#: Samples x codes x classes that a task holds while it adds up what was sent to it.
GROUP_CELLS = 16 << 20

def child_hash(parent: np.ndarray, side: int) -> np.ndarray:
    return mix(parent ^ np.uint64(0x5851F42D4C957F2D + side))


def odd(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(1)).astype(np.uint8)


@dataclass(frozen=True)
class Rules:
    """When and how a node is split; ``mtry`` None: all features. ``weights``: of a row of class 0 and 1."""

    mtry: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    max_depth: int = 64
    weights: tuple[float, float] = (1.0, 1.0)


@dataclass
class Trees:
    """Nodes of all trees in one numbering; children stand side by side, a leaf has feature -1."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    tie: np.ndarray                                         # the class of a node whose classes weigh the same

    def __len__(self) -> int:
        return len(self.roots)

    def lean(self, values: np.ndarray | None = None) -> "Lean":
        """What rows need to find their leaves, in few bytes: no counts; ``values`` of the nodes go along."""
        return Lean(self.roots, self.feature.astype(np.int16), self.cut.astype(np.uint8), self.left.astype(np.int32),
                    self.votes_of() if values is None else values)

    def subset(self, which: Sequence[int]) -> "Trees":
        """The trees at these positions, on their own; a tree's nodes stand together."""
        ends = np.append(self.roots[1:], len(self.feature))
        spans = [np.arange(self.roots[t], ends[t]) for t in which]
        keep = np.concatenate(spans) if spans else np.zeros(0, int)
        roots = np.cumsum([0] + [len(s) for s in spans])[:-1].astype(np.int64)
        shift = np.concatenate([np.full(len(s), r - s[0]) for s, r in zip(spans, roots)]) if spans else keep
        return Trees(roots, self.feature[keep], self.cut[keep], self.left[keep] + shift, self.n0[keep], self.n1[keep],
                     self.tie[keep])

    def leaf(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each row of codes in one tree."""
        out = np.full(len(x), self.roots[tree], dtype=np.int64)
        width, flat = x.shape[1], np.ascontiguousarray(x).ravel()
        rows, at = np.arange(len(x)), out.copy()
        while len(rows):
            f = self.feature[at]
            inner = f >= 0
            if not inner.all():
                out[rows[~inner]] = at[~inner]
                rows, at, f = rows[inner], at[inner], f[inner]
            at = self.left[at] + (flat[rows * width + f] > self.cut[at])
        return out

    def votes_of(self, weights: tuple[float, float] = (1.0, 1.0)) -> np.ndarray:
        """Each node's class; ties go by a hash of tree and path."""
        a, b = weights[0] * self.n0, weights[1] * self.n1
        return np.where(a == b, self.tie > 0, b > a).astype(np.uint8)


class Lean:
    """Trees to walk down: a leaf is its own child, whatever the row, so rows need not be told apart at every level."""

    def __init__(self, roots: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, value: np.ndarray):
        leaf = feature < 0
        self.roots, self.feature, self.value = roots, feature, value
        self.cut = np.where(leaf, np.uint8(255), cut)
        self.left = np.where(leaf, np.arange(len(left), dtype=left.dtype), left)

    def __len__(self) -> int:
        return len(self.roots)

    def first_tests(self, tree: int) -> tuple[int, np.ndarray]:
        """The tree's first node, and nodes x features: the first node above each that tests the feature (-1: none does)."""
        a = int(self.roots[tree])
        b = int(self.roots[tree + 1]) if tree + 1 < len(self) else len(self.feature)
        own = self.feature[a:b].astype(np.int64)
        out = np.full((b - a, int(self.feature.max(initial=0)) + 1), -1, dtype=np.int64)
        at = np.flatnonzero(own[:1] >= 0)
        while len(at):
            f, row = own[at], out[at]
            row[np.arange(len(at)), f] = np.where(row[np.arange(len(at)), f] < 0, a + at, row[np.arange(len(at)), f])
            left = self.left[a + at].astype(np.int64) - a
            out[left] = out[left + 1] = row
            at = np.concatenate([left, left + 1])
            at = at[own[at] >= 0]
        return a, out

    def leaf(self, x: np.ndarray, tree: int, rows: np.ndarray | None = None, start: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each of the ``rows`` (default: all) of codes in one tree, from the root or each from a node of its own."""
        flat = np.ascontiguousarray(x).ravel()
        base = (np.arange(len(x)) if rows is None else rows) * x.shape[1]
        at = np.full(len(base), self.roots[tree], dtype=np.int64) if start is None else start
        out, place = at, np.arange(len(at))
        while len(place):
            for _ in range(STRIDE):
                go = flat.take(base + self.feature.take(at)) > self.cut.take(at) if len(flat) else False
                at = self.left.take(at) + go
            inner = self.feature.take(at) >= 0
            left = int(np.count_nonzero(inner))
            if 2 * left <= len(at):
                out[place] = at
                at, base, place = at[inner], base[inner], place[inner]
        return out


class Told:
    """The votes of some trees on each of a table's distinct codes: codes x trees, a bit each."""

    def __init__(self, codes: Codes, bits: np.ndarray, trees: int):
        self.marks, self.bits, self.trees = codes.marks, bits, trees

    def __len__(self) -> int:
        return self.trees

    def of(self, x: np.ndarray) -> np.ndarray:
        """trees x rows: the votes on rows of codes."""
        return np.unpackbits(self.bits[np.searchsorted(self.marks, marks_of(x))], axis=1, count=self.trees).T


def features_of(hashes: np.ndarray, p: int, mtry: int | None) -> np.ndarray:
    """nodes x mtry features, ascending."""
    if mtry is None or mtry >= p:
        return np.broadcast_to(np.arange(p), (len(hashes), p))
    drawn = mix(hashes[:, None] ^ mix(np.arange(1, p + 1))[None, :])
    return np.sort(np.argsort(drawn, axis=1, kind="stable")[:, :mtry], axis=1)


def best_splits(h0: np.ndarray, h1: np.ndarray, rules: Rules):
    """(slot, cut, found, left n0, left n1) of nodes x slots x bins histograms."""
    l0, l1 = np.cumsum(h0, axis=2), np.cumsum(h1, axis=2)
    t0, t1 = l0[:, :1, -1:], l1[:, :1, -1:]
    l0, l1 = l0[:, :, :-1], l1[:, :, :-1]
    r0, r1 = t0 - l0, t1 - l1
    w0, w1 = rules.weights
    nl, nr = l0 + l1, r0 + r1
    a0, a1, b0, b1 = (l0, l1, r0, r1) if w0 == w1 == 1 else (w0 * l0, w1 * l1, w0 * r0, w1 * r1)
    a, b = a0 + a1, b0 + b1
    t0, t1 = w0 * t0, w1 * t1
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (a0 * a0 + a1 * a1) / a + (b0 * b0 + b1 * b1) / b - (t0 * t0 + t1 * t1) / (t0 + t1)
    # an empty side gives NaN, which no comparison lets through
    gain = np.where((nl >= rules.min_leaf) & (nr >= rules.min_leaf) & (gain > 1e-9 * (t0 + t1)), gain, -1.0)
    flat = gain.reshape(len(h0), -1)
    if not flat.shape[1]:
        none = np.zeros(len(h0), dtype=np.int64)
        return none, none, none.astype(bool), none, none
    best = flat.argmax(axis=1)
    slot, cut = np.divmod(best, l0.shape[2])
    at = np.arange(len(h0))
    return slot, cut, flat[at, best] > 0, l0[at, slot, cut], l1[at, slot, cut]


def splittable(n0, n1, depth, rules: Rules):
    return (n0 + n1 >= max(rules.min_split, 2)) & (n0 > 0) & (n1 > 0) & (depth < rules.max_depth)


def histograms(codes: np.ndarray, at: np.ndarray, total: np.ndarray, ones: np.ndarray, nodes: int, width: int):
    """Counts by node (``at``), slot (column of ``codes``) and bin, for each class, of rows that stand for
    ``total`` rows each, ``ones`` of them of class 1."""
    slots, cells = codes.shape[1], nodes * codes.shape[1] * width
    sums = np.zeros((2, cells))
    step = max(1, COUNT_CELLS // max(slots, 1))
    both = total.sum() < PACKED                                # both counts in one exact number
    for a in range(0, len(codes), step):
        cell = ((at[a:a + step, None] * slots + np.arange(slots)) * width + codes[a:a + step]).ravel()
        if both:
            sums[0] += np.bincount(cell, np.repeat(total[a:a + step] + PACKED * ones[a:a + step], slots), cells)
        else:
            for k, count in enumerate((total, ones)):
                sums[k] += np.bincount(cell, np.repeat(count[a:a + step], slots), cells)
    if both:
        sums[1] = np.floor(sums[0] / PACKED)
        sums[0] -= PACKED * sums[1]
    h, h1 = sums.reshape(2, nodes, slots, width)
    return h - h1, h1


def merged(x: np.ndarray, y: np.ndarray, m: np.ndarray):
    """In-bag rows of equal codes as one: (codes, rows, rows of class 1). Rows in the order of a hash are compared with
    their neighbours, so rows that differ stay apart, whatever the hash."""
    rows = np.flatnonzero(m)
    x, m = x[rows], m[rows].astype(float)
    ones = m * y[rows]
    if not len(rows) or not x.shape[1]:
        return x, m, ones
    order = np.argsort(marks_of(x), kind="stable")
    x = x[order]
    first = np.concatenate([[0], 1 + np.flatnonzero((x[1:] != x[:-1]).any(axis=1))])
    return x[first], np.add.reduceat(m[order], first), np.add.reduceat(ones[order], first)


def grow_here(x: np.ndarray, y: np.ndarray, m: np.ndarray, root: np.uint64, depth: int, rules: Rules, width: int):
    """A subtree grown level by level from rows in memory: (feature, cut, left, n0, n1, tie), children numbered from 0."""
    return grow_merged(*merged(x, y, m), root, depth, rules, width)


def grow_merged(x: np.ndarray, total: np.ndarray, ones: np.ndarray, root: np.uint64, depth: int, rules: Rules, width: int):
    """``grow_here`` from the distinct codes and their counts."""
    p, flat = x.shape[1], np.ascontiguousarray(x).ravel()
    out: list[list[np.ndarray]] = [[], [], [], [], [], []]
    rows = np.arange(len(x))
    node = np.zeros(len(rows), dtype=np.int64)
    hashes, below = np.array([root], dtype=np.uint64), 1
    while len(hashes):
        n1 = np.bincount(node, ones[rows], len(hashes)).astype(np.int64)
        n0 = np.bincount(node, total[rows], len(hashes)).astype(np.int64) - n1
        feature, cut = np.full(len(hashes), -1, dtype=np.int32), np.zeros(len(hashes), dtype=np.int32)
        left = np.zeros(len(hashes), dtype=np.int64)
        tie = odd(hashes)
        may = np.flatnonzero(splittable(n0, n1, depth, rules))
        if len(may):
            rank = np.full(len(hashes), -1, dtype=np.int64)
            rank[may] = np.arange(len(may))
            if len(may) < len(hashes):
                node = rank.take(node)
                used = np.flatnonzero(node >= 0)
                rows, node = rows.take(used), node.take(used)
            chosen = np.ascontiguousarray(features_of(hashes[may], p, rules.mtry))
            step = max(1, TASK_CELLS // (chosen.shape[1] * width))
            if len(may) > step:
                order = np.argsort(node, kind="stable")
                rows, node = rows.take(order), node.take(order)
            for a in range(0, len(may), step):
                b = min(a + step, len(may))
                i, j = np.searchsorted(node, (a, b)) if len(may) > step else (0, len(node))
                own, at = rows[i:j], node[i:j] - a
                codes = flat.take((own * p)[:, None] + chosen.take(at + a, axis=0)) if p else x[own]
                slot, c, found, _, _ = best_splits(*histograms(codes, at, total[own], ones[own], b - a, width), rules)
                hit = may[a:b][found]
                feature[hit] = chosen[a:b][found, slot[found]]
                cut[hit] = c[found]
            split = feature[may] >= 0
            place = np.cumsum(split) - 1
            left[may[split]] = below + 2 * place[split]
            if not split.all():
                kept = np.flatnonzero(split.take(node))
                rows, node = rows.take(kept), node.take(kept)
            f, c = feature[may].take(node), cut[may].take(node)
            node = 2 * place.take(node) + (flat.take(rows * p + f) > c if p else False)
            parents = hashes[may[split]]
            hashes = np.stack([child_hash(parents, 0), child_hash(parents, 1)], axis=1).ravel()
            below += len(hashes)
        else:
            hashes = hashes[:0]
        for store, values in zip(out, (feature, cut, left, n0, n1, tie)):
            store.append(values)
        depth += 1
    return [np.concatenate(s) for s in out]


class Draws:
    """How often each row of a block is in each of ``samples`` samples."""

    samples: int

    def totals(self) -> np.ndarray:
        """samples x 2: in-bag rows of each class."""
        raise NotImplementedError

    def counts(self, block: Block) -> np.ndarray:
        """samples x rows."""
        raise NotImplementedError


@dataclass
class _Growing:
    """The top of a tree, above its subtrees: node arrays as lists, open nodes with hash and depth."""

    sample: int
    rules: Rules
    seed: int
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    n0: list = field(default_factory=list)
    n1: list = field(default_factory=list)
    tie: list = field(default_factory=list)
    open: dict = field(default_factory=dict)                # node: (hash, depth)

    def add(self, n0: int, n1: int, h: np.uint64, depth: int) -> int:
        for store, value in zip((self.feature, self.cut, self.left, self.n0, self.n1, self.tie),
                                (-1, 0, 0, int(n0), int(n1), int(h & np.uint64(1)))):
            store.append(value)
        node = len(self.feature) - 1
        if splittable(n0, n1, depth, self.rules):
            self.open[node] = (h, depth)
        return node

    def split(self, node: int, f: int, c: int, l0: int, l1: int) -> None:
        h, depth = self.open.pop(node)
        self.feature[node], self.cut[node] = int(f), int(c)
        self.left[node] = self.add(l0, l1, child_hash(h, 0)[()], depth + 1)
        self.add(self.n0[node] - int(l0), self.n1[node] - int(l1), child_hash(h, 1)[()], depth + 1)

    def top(self) -> Trees:
        return Trees(np.zeros(1, np.int64), *(np.array(a, dtype=k) for a, k in zip(
            (self.feature, self.cut, self.left, self.n0, self.n1, self.tie), _KINDS.values())))


#: Node arrays of a subtree and of a top.
_KINDS = {"feature": np.int32, "cut": np.int32, "left": np.int64, "n0": np.int64, "n1": np.int64, "tie": np.uint8}
#: How they are written; ``vote`` is the class of a node.
_STORED = {"feature": np.int16, "cut": np.uint8, "left": np.int32, "n0": np.int64, "n1": np.int64, "tie": np.uint8, "vote": np.uint8}
_SUBTREE = ["tree", "node", *_STORED]
SUBTREE_SCHEMA = "tree int, node int, " + ", ".join(f"{c} binary" for c in _STORED)


@dataclass
class StoredTrees:
    """Grown trees: the nodes above the subtrees, and the table of the subtrees, of which a pass reads some trees.

    A subtree's node 0 is the node of the top that it hangs on. ``shift`` is the
    number of the first tree in the table; ``sizes`` are the trees' nodes.
    ``codes`` are those whose votes the table holds, if it does.
    """

    tops: list[Trees]
    subtrees: DataFrame | None
    sizes: np.ndarray
    shift: int = 0
    codes: Codes | None = None

    def __len__(self) -> int:
        return len(self.tops)

    def view(self, start: int, stop: int) -> "StoredTrees":
        return StoredTrees(self.tops[start:stop], self.subtrees, self.sizes[start:stop], self.shift + start, self.codes)

    def _read(self, start: int, stop: int, columns: Sequence[str]) -> list[list[np.ndarray]]:
        """The node arrays of some trees, each tree numbered from 0, and their lengths."""
        parts: list[list[tuple[int, list[np.ndarray]]]] = [[] for _ in range(start, stop)]
        if self.subtrees is not None:
            own = self.subtrees.where(F.col("tree").between(self.shift + start, self.shift + stop - 1))
            for batch in own.select("tree", "node", *columns).toArrow().to_batches():
                for i, (tree, node) in enumerate(zip(batch.column("tree").to_pylist(), batch.column("node").to_pylist())):
                    arrays = [np.frombuffer(batch.column(c)[i].as_buffer(), _STORED[c]) for c in columns]
                    parts[tree - self.shift - start].append((node, arrays))
        out = []
        for top, grafts in zip(self.tops[start:stop], parts):
            given = {c: (top.votes_of() if c == "vote" else getattr(top, c)).astype(_STORED[c]) for c in columns}
            pieces = {c: [given[c]] for c in columns}
            base = len(top.feature) - 1
            for node, arrays in sorted(grafts, key=lambda g: g[0]):
                for c, a in zip(columns, arrays):
                    if c == "left":
                        a = a + np.where(arrays[columns.index("feature")] >= 0, base, 0).astype(a.dtype)
                    given[c][node] = a[0]
                    pieces[c].append(a[1:])
                base += len(arrays[0]) - 1
            out.append([np.concatenate(pieces[c]) for c in columns])
        return out

    def _joined(self, start: int, stop: int, columns: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        trees = self._read(start, stop, columns)
        sizes = [len(t[0]) for t in trees]
        roots = np.cumsum([0] + sizes)[:-1].astype(np.int64)
        out = [np.concatenate([t[i] for t in trees]) if trees else np.zeros(0, _STORED[c]) for i, c in enumerate(columns)]
        at = columns.index("left")
        out[at] = out[at] + np.repeat(roots, sizes).astype(np.int64 if sum(sizes) > 2 ** 31 - 1 else out[at].dtype)
        return roots, out

    def passes(self) -> Iterator[tuple[int, Lean]]:
        """(number of the first tree, the trees of a pass with their votes); a pass is bounded unless it is one tree."""
        numbers = (np.cumsum(self.sizes) * binned.NODE_BYTES) // binned.PASS_BYTES
        starts = [i for i in range(len(self)) if not i or numbers[i] != numbers[i - 1]]
        for start, stop in zip(starts, [*starts[1:], len(self)]):
            yield start, Lean(*(lambda roots, a: (roots, *a))(*self._joined(start, stop, ["feature", "cut", "left", "vote"])))

    def told(self) -> Iterator[tuple[int, Told]]:
        """(number of the first tree, the votes of a pass of trees on each of ``codes``); a pass is bounded unless it is one byte a code."""
        n, wide = len(self.codes), -(-len(self.codes) // 8)
        step = 8 * max(1, binned.PASS_BYTES // max(n, 1))
        for start in range(0, len(self), step):
            stop = min(start + step, len(self))
            votes = np.stack([np.full(wide, 255 * int(top.votes_of()[0]), np.uint8) for top in self.tops[start:stop]])
            if self.subtrees is not None:
                own = self.subtrees.where(F.col("tree").between(self.shift + start, self.shift + stop - 1))
                for batch in own.select("tree", "told").toArrow().to_batches():
                    for i, tree in enumerate(batch.column("tree").to_pylist()):
                        votes[tree - self.shift - start] = np.frombuffer(batch.column("told")[i].as_buffer(), np.uint8)
            bits = np.empty((8 * wide, -(-(stop - start) // 8)), np.uint8)
            for a in range(0, wide, 1024):
                bits[8 * a:8 * (a + 1024)] = np.packbits(np.unpackbits(votes[:, a:a + 1024], axis=1).T, axis=1)
            yield start, Told(self.codes, bits[:n], stop - start)

    def whole(self) -> Trees:
        """All nodes on the driver."""
        if self.sizes.sum() > MAX_NODES:
            raise MemoryError(f"the model has more than {MAX_NODES} nodes: raise min_split or min_leaf, lower max_depth or the sample sizes")
        roots, arrays = self._joined(0, len(self), list(_KINDS))
        return Trees(roots, *(a.astype(k) for a, k in zip(arrays, _KINDS.values())))


def grow(table: Table, draws: Draws, plan: Sequence[tuple[int, Rules, int]], local_rows: int = LOCAL_ROWS) -> Trees:
    """One tree per (sample, rules, seed) of ``plan``, all nodes on the driver."""
    return grow_stored(table, draws, plan, local_rows).whole()


def grow_stored(table: Table, draws: Draws, plan: Sequence[tuple[int, Rules, int]], local_rows: int = LOCAL_ROWS) -> StoredTrees:
    """One tree per (sample, rules, seed) of ``plan``."""
    totals = draws.totals()
    trees = []
    for sample, rules, seed in plan:
        t = _Growing(sample, rules, seed)
        t.add(*totals[sample], mix(seed)[()], 0)
        trees.append(t)
    codes = table.distinct(local_rows)
    while codes is None:
        wide = [(i, node) for i, t in enumerate(trees) for node in t.open if t.n0[node] + t.n1[node] > local_rows]
        if not wide:
            break
        cells = max(len(table.bins.features), 1) * table.bins.width
        step = max(1, JOB_CELLS // cells)
        for a in range(0, len(wide), step):
            _split_wide(table, draws, trees, wide[a:a + step])
    subtrees = _finish(table, draws, trees) if codes is None else _from_codes(table, codes, draws, trees)
    sizes = np.array([len(t.feature) for t in trees], dtype=np.int64)
    if subtrees is not None:
        for r in subtrees.groupBy("tree").agg(F.sum(F.length("tie") - 1).alias("n")).collect():       # a byte a node
            sizes[r["tree"]] += r["n"]
    return StoredTrees([t.top() for t in trees], subtrees, sizes, codes=codes)


def _split_wide(table: Table, draws: Draws, trees: list[_Growing], wide: list[tuple[int, int]]) -> None:
    """Histograms of these nodes in one job; each is split or becomes a leaf."""
    p, width = len(table.bins.features), table.bins.width
    nodes_of: dict[int, list[int]] = {}
    for i, node in wide:
        nodes_of.setdefault(i, []).append(node)
    first, rank, chosen, tops, samples, number = {}, {}, {}, {}, {}, 0
    for i, nodes in nodes_of.items():
        first[i], number = number, number + len(nodes)
        rank[i] = np.full(len(trees[i].feature), -1, dtype=np.int64)
        rank[i][nodes] = np.arange(len(nodes))
        chosen[i] = np.array(features_of(np.array([trees[i].open[n][0] for n in nodes]), p, trees[i].rules.mtry))
        tops[i], samples[i] = trees[i].top().lean(), trees[i].sample

    def run(blocks):
        held: dict[int, np.ndarray] = {}
        for block in blocks:
            counts = draws.counts(block)
            for i in tops:
                m = counts[samples[i]]
                rows = np.flatnonzero(m)
                at = rank[i][tops[i].leaf(block.x, 0, rows)]
                rows, at = rows[at >= 0], at[at >= 0]
                if len(rows):
                    m = m[rows].astype(float)
                    codes = np.take_along_axis(block.x[rows], chosen[i][at], axis=1)
                    got = np.stack(histograms(codes, at, m, m * block.y[rows], len(chosen[i]), width))
                    held[i] = held[i] + got if i in held else got
        for i, h in held.items():
            for k in range(h.shape[1]):
                flat = h[:, k].reshape(2, -1).astype(np.int64)
                cell = np.flatnonzero(flat.any(axis=0))
                yield pa.RecordBatch.from_pydict({"node": pa.array(np.full(len(cell), first[i] + k, np.int32)),
                                                  "cell": pa.array(cell.astype(np.int32)), "n0": flat[0, cell], "n1": flat[1, cell]})

    sums = table.map_task(run, "node int, cell int, n0 long, n1 long").groupBy("node", "cell").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    node, cell, n0, n1 = (sums.column(c).to_numpy() for c in ("node", "cell", "n0", "n1"))
    order = np.argsort(node, kind="stable")
    node, cell, n0, n1 = node[order], cell[order], n0[order], n1[order]
    for i, nodes in nodes_of.items():
        for k, which in enumerate(nodes):
            a, b = np.searchsorted(node, (first[i] + k, first[i] + k + 1))
            slots = chosen[i].shape[1]
            h = np.zeros((2, slots * width))
            h[0, cell[a:b]], h[1, cell[a:b]] = n0[a:b], n1[a:b]
            slot, cut, found, l0, l1 = best_splits(*h.reshape(2, 1, slots, width), trees[i].rules)
            if found[0]:
                trees[i].split(which, chosen[i][k][slot[0]], cut[0], l0[0], l1[0])
            else:
                trees[i].open.pop(which)


def _finish(table: Table, draws: Draws, trees: list[_Growing]) -> DataFrame | None:
    """Every open node's rows go to a task of their own, which grows the subtree; trees that share a root's rows share the task."""
    groups: dict[tuple, int] = {}
    members: list[list[tuple[int, int]]] = []
    for i, t in enumerate(trees):
        for node in t.open:
            name = (t.sample,) if node == 0 else (t.sample, i, node)
            if name not in groups:
                groups[name] = len(members)
                members.append([])
            members[groups[name]].append((i, node))
    if not members:
        return None
    whole = {name[0]: g for name, g in groups.items() if len(name) == 1}
    group_of: dict[int, np.ndarray] = {}
    for name, g in groups.items():
        if len(name) == 3:
            group_of.setdefault(name[1], np.full(len(trees[name[1]].feature), -1, dtype=np.int32))[name[2]] = g
    routed = {i: (trees[i].sample, trees[i].top().lean()) for i in group_of}
    width = table.bins.width
    jobs = [[(i, node, *trees[i].open[node], trees[i].rules) for i, node in group] for group in members]

    def send(block: Block):
        counts = draws.counts(block)
        out = []
        for sample, g in whole.items():
            rows = np.flatnonzero(counts[sample])
            if len(rows):
                out.append((g, rows, counts[sample]))
        for i, (sample, top) in routed.items():
            rows = np.flatnonzero(counts[sample])
            own = group_of[i][top.leaf(block.x, 0, rows)]
            order = np.argsort(own, kind="stable")
            rows, own = rows[order], own[order]
            ends = np.append(np.flatnonzero(np.diff(own)) + 1, len(own))
            out += [(int(own[a]), rows[a:b], counts[sample]) for a, b in zip(np.append(0, ends[:-1]), ends) if b > a and own[a] >= 0]
        yield pa.RecordBatch.from_arrays([
            pa.array([g for g, _, _ in out], pa.int32()), pa.array([block.number] * len(out), pa.int32()),
            pa.array([block.x[rows].tobytes() for _, rows, _ in out], pa.binary()),
            pa.array([block.y[rows].tobytes() for _, rows, _ in out], pa.binary()),
            pa.array([m[rows].astype(np.int32).tobytes() for _, rows, m in out], pa.binary())],
            names=["grp", "block", "x", "y", "m"])

    def finish(t: pa.Table) -> pa.Table:
        t = t.sort_by([("block", "ascending")])
        y = np.concatenate([np.frombuffer(v, np.uint8) for v in t.column("y").to_pylist()])
        x = np.concatenate([np.frombuffer(v, np.uint8) for v in t.column("x").to_pylist()]).reshape(len(y), -1)
        m = np.concatenate([np.frombuffer(v, np.int32) for v in t.column("m").to_pylist()])
        group, rows = t.column("grp")[0].as_py(), merged(x, y, m)
        del t, x, y, m
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(_stored(
            i, node, Trees(np.zeros(1, np.int64), *grow_merged(*rows, h, depth, rules, width))), names=_SUBTREE)
            for i, node, h, depth, rules in jobs[group]])

    sent = table.map(send, "grp int, block int, x binary, y binary, m binary")
    dealt = sent.repartition(parallelism(sent, len(members), 4), "grp")
    return written(dealt.groupBy("grp").applyInArrow(finish, SUBTREE_SCHEMA), "subtrees")


def _stored(i: int, node: int, tree: Trees) -> list[pa.Array]:
    """The row of a subtree in the written table, as arrays of one value."""
    arrays = {c: tree.votes_of() if c == "vote" else getattr(tree, c) for c in _STORED}
    return [pa.array([i], pa.int32()), pa.array([node], pa.int32()),
            *[pa.array([arrays[c].astype(k).tobytes()], pa.binary()) for c, k in _STORED.items()]]


def _from_codes(table: Table, codes: Codes, draws: Draws, trees: list[_Growing]) -> DataFrame | None:
    """Whole trees, each grown by a task from the counts of the distinct codes in its sample, with its votes on all of them.

    A task adds up its blocks by code for all samples and sends the sums to groups of samples; of a group's trees
    those that share a sample share its sums.
    """
    jobs: dict[int, list[tuple]] = {}
    for i, t in enumerate(trees):
        for node, (h, depth) in t.open.items():
            jobs.setdefault(t.sample, []).append((i, node, h, depth, t.rules))
    if not jobs:
        return None
    samples, n, width = sorted(jobs), len(codes), table.bins.width
    step = min(-(-len(samples) // parallelism(table.blocks, len(samples), 4)), max(1, GROUP_CELLS // (2 * n)))
    groups = [samples[a:a + step] for a in range(0, len(samples), step)]
    lot_rows = max(1, LOT_CELLS // len(samples))

    def added(cells: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cell = np.concatenate(cells)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        first = np.concatenate([[0], 1 + np.flatnonzero(cell[1:] != cell[:-1])])
        m, at = np.concatenate(counts, axis=1), 0
        for g, group in enumerate(groups):
            sums = np.add.reduceat(m[at:at + len(group)][:, order], first, axis=1, dtype=np.int32)
            at += len(group)
            sums = sums.astype(np.uint8) if sums.max() < 256 else sums
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([cell[first].astype(np.int32).tobytes()], pa.binary()),
                                              pa.array([sums.tobytes()], pa.binary())], names=["grp", "cells", "m"])

    def send(blocks):
        cells, counts, rows = [], [], 0
        for block in blocks:
            m = draws.counts(block)[samples]
            cells.append(2 * codes.find(block.x) + block.y)
            counts.append(m.astype(np.uint8) if m.size and m.max() < 256 else m)
            rows += len(block.y)
            if rows >= lot_rows:
                yield from added(cells, counts)
                cells, counts, rows = [], [], 0
        if rows:
            yield from added(cells, counts)

    def finish(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                g, cells = batch.column("grp")[i].as_py(), np.frombuffer(batch.column("cells")[i].as_buffer(), np.int32)
                m, size = batch.column("m")[i].as_buffer(), len(groups[g])
                m = np.frombuffer(m, np.uint8 if m.size == size * len(cells) else np.int32).reshape(size, -1)
                if g not in held:
                    held[g] = np.zeros((size, 2 * n), np.int32)
                for sums, more in zip(held[g], m):
                    sums[cells] += more
        for g in list(held):
            for sample, sums in zip(groups[g], held.pop(g).reshape(-1, n, 2)):
                total = sums.sum(axis=1)
                used = np.flatnonzero(total)
                x, total, ones = codes.x[used], total[used].astype(float), sums[used, 1].astype(float)
                for i, node, h, depth, rules in jobs[sample]:
                    tree = Trees(np.zeros(1, np.int64), *grow_merged(x, total, ones, h, depth, rules, width))
                    lean = tree.lean()
                    told = np.packbits(lean.value.take(lean.leaf(codes.x, 0)))
                    yield pa.RecordBatch.from_arrays([*_stored(i, node, tree), pa.array([told.tobytes()], pa.binary())], names=[*_SUBTREE, "told"])

    sent = table.map_task(send, "grp int, cells binary, m binary")
    dealt = sent.repartitionById(len(groups), "grp")
    return written(dealt.mapInArrow(finish, f"{SUBTREE_SCHEMA}, told binary"), "subtrees")
