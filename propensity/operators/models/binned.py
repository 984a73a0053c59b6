"""Binned training tables for tree models.

A table is written once, with every feature as a one-byte bin, and all trees,
folds and settings of a search are fitted on it. Bins are exact quantile
classes of the distinct values (each value its own class where they are few),
so they do not depend on how rows are partitioned. Rows are dealt to blocks of
about ``BLOCK_ROWS`` by a hash of their key and sorted by it within a block; a
block is one row of the table. What is drawn at random per block (bootstrap
counts, permutations, row shares) is keyed by the block's number, so it does
not depend on partitions or lost executors either.

The key must be unique (equal keys share a block). Rows with a null label are
left out. A null or NaN value is below every other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.functions.cumulative import running_totals
from propensity.session import ship, written

MAX_BINS = 32
BLOCK_ROWS = 1024
#: Bytes of nodes that a scoring pass sends to the tasks; a larger model is scored in passes.
PASS_BYTES = 128 << 20
NODE_BYTES = 8
#: Rows that a scoring task holds to score those of equal codes once.
LOT_ROWS = 1 << 17
#: Bytes of a table's distinct codes that the driver and a task hold.
CODE_BYTES = 64 << 20

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x) -> np.ndarray:
    """A 64-bit hash of integers."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, dtype=np.uint64) + _C1
        x = (x ^ (x >> np.uint64(30))) * _C2
        x = (x ^ (x >> np.uint64(27))) * _C3
        return x ^ (x >> np.uint64(31))


def marks_of(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of codes."""
    mark = np.zeros(len(x), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j, factor in enumerate(mix(np.arange(x.shape[1]))):
            mark += x[:, j] * (factor | np.uint64(1))
    return mark


def distinct_rows(x: np.ndarray) -> np.ndarray:
    """Rows in the order of their hash, without those that equal the one before them; none that differs is lost."""
    x = x[np.argsort(marks_of(x), kind="stable")]
    return x[np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])] if len(x) else x


def one_of_each(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for all rows of equal codes, and which of them stands for each row."""
    _, first, place = np.unique(marks_of(x), return_index=True, return_inverse=True)
    if (x[first][place] != x).any():                            # two codes of one hash
        return np.arange(len(x)), np.arange(len(x))
    return first, place


@dataclass(frozen=True, eq=False)
class Codes:
    """The distinct code vectors of a table, ascending by a hash that is another for each of them."""

    x: np.ndarray
    marks: np.ndarray

    def __len__(self) -> int:
        return len(self.marks)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each row's codes, which must be among them."""
        return np.searchsorted(self.marks, marks_of(x))


@dataclass(frozen=True)
class Bins:
    """Cut points per feature: a value's bin is the number of cuts below it."""

    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]

    @property
    def width(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape, dtype=np.uint8)
        for j, cut in enumerate(self.cuts):
            known = ~np.isnan(x[:, j])
            out[known, j] = np.searchsorted(cut, x[known, j], side="left")
        return out


def fit_bins(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> Bins:
    """Exact quantile classes: one histogram of the distinct values, running sums, two ends per class."""
    if max_bins > 256:
        raise ValueError("a bin is one byte: at most 256 bins")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(j).alias("f"), F.col(c).cast("double").alias("v"))
                                         for j, c in enumerate(features)])).alias("e")).select("e.*")
    hist = long.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("c")) \
        .withColumn("one", F.lit(1).cast("long"))
    cum = running_totals(hist, "v", ["c", "one"], ["f"])
    total = hist.groupBy("f").agg(F.sum("c").alias("n"), F.sum("one").alias("d"))
    at = F.when(F.col("d") <= max_bins, F.col("one_cum") - 1).otherwise(
        F.floor((F.col("c_cum") - F.col("c")) * max_bins / F.col("n")))
    ends = cum.join(total, "f").groupBy("f", at.alias("bin")).agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    cuts = []
    for j in range(len(features)):                          # features x max_bins rows
        mine = sorted((r["low"], r["high"]) for r in ends if r["f"] == j)
        cuts.append(np.array([(a[1] + b[0]) / 2 if a[1] < (a[1] + b[0]) / 2 < b[0] else a[1] for a, b in zip(mine, mine[1:])]))
    return Bins(tuple(features), tuple(cuts))


@dataclass
class Block:
    """One block in a task: codes (rows x features), labels 0/1, integer tags, keys."""

    number: int
    x: np.ndarray
    y: np.ndarray
    tags: dict[str, np.ndarray]
    keys: pa.Array


@dataclass
class Table:
    """A binned table: its blocks, and per block and class the number of rows (two integers a block on the driver)."""

    blocks: DataFrame
    bins: Bins
    counts: np.ndarray
    tags: tuple[str, ...]
    _distinct: tuple[int, Codes | None] = field(default=(-1, None), repr=False)

    @property
    def spark(self):
        return self.blocks.sparkSession

    @property
    def totals(self) -> np.ndarray:
        return self.counts.sum(axis=0)

    def distinct(self, most: int) -> Codes | None:
        """The distinct codes, or None where there are more than ``most`` of them or than ``CODE_BYTES`` hold."""
        p = len(self.bins.features)
        most = min(most, CODE_BYTES // max(p, 1))
        asked, codes = self._distinct
        if codes is None and asked < most:
            codes = self._find_distinct(most) if p else None
            self._distinct = most, codes
        return codes if codes is not None and len(codes) <= most else None

    def _find_distinct(self, most: int) -> Codes | None:
        p = len(self.bins.features)

        def run(blocks):
            held, waiting, n = np.zeros((0, p), np.uint8), [], 0
            for block in blocks:
                waiting.append(block.x)
                n += len(block.x)
                if n > max(len(held), 1 << 16):
                    held, waiting, n = distinct_rows(np.concatenate([held, *waiting])), [], 0
                    if len(np.unique(marks_of(held))) > most:        # enough to know that there are too many
                        break
            held = distinct_rows(np.concatenate([held, *waiting]))
            yield pa.RecordBatch.from_pydict({"x": pa.array([r.tobytes() for r in held], pa.binary())})

        got = self.map_task(run, "x binary").distinct().limit(most + 1).toArrow().column("x")
        if not 0 < len(got) <= most:
            return None
        x = np.frombuffer(b"".join(got.to_pylist()), np.uint8).reshape(-1, p)
        marks = marks_of(x)
        order = np.argsort(marks, kind="stable")
        x, marks = x[order], marks[order]
        return Codes(x, marks) if (marks[1:] > marks[:-1]).all() else None      # two codes of one hash: not told apart

    def map(self, fn: Callable[[Block], Iterator[pa.RecordBatch]], schema) -> DataFrame:
        """``fn`` over every block."""
        names, p = self.tags, len(self.bins.features)
        ship(self.spark)

        def run(batches):
            for block in read_blocks(batches, p, names):
                yield from fn(block)

        return self.blocks.mapInArrow(run, schema)

    def map_task(self, fn: Callable[[Iterator[Block]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
        """``fn`` over all blocks of a task, to sum up before anything leaves it."""
        names, p = self.tags, len(self.bins.features)
        ship(self.spark)
        return self.blocks.mapInArrow(lambda batches: fn(read_blocks(batches, p, names)), schema)


def read_blocks(batches, p: int, tags: Sequence[str]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            y = np.frombuffer(row.column("y")[0].as_py(), dtype=np.uint8)
            x = np.frombuffer(row.column("x")[0].as_py(), dtype=np.uint8).reshape(len(y), p)
            own = {t: np.frombuffer(row.column(f"tag_{t}")[0].as_py(), dtype=np.int32) for t in tags}
            yield Block(row.column("block")[0].as_py(), x, y, own, row.column("keys").flatten())


def parallelism(df: DataFrame, items: int, waves: int = 1) -> int:
    """Tasks for ``items`` pieces of work, ``waves`` for each core."""
    spark = df.sparkSession
    wanted = max(waves * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(items, wanted))


def binned_table(df: DataFrame, features: Sequence[str], key: str, label: str = "label", tags: Sequence[str] = (),
                 bins: Bins | None = None, max_bins: int = MAX_BINS, block_rows: int = BLOCK_ROWS) -> Table:
    """Bins ``features`` and writes the blocks; ``tags`` are small integer columns (a fold, a role) that go along."""
    spark = df.sparkSession
    ship(spark)
    df = df.where(F.col(label).isNotNull())
    bins = bins or fit_bins(df, features, max_bins)
    rows = df.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"), *[F.col(t).cast("int").alias(f"t{i}") for i, t in
                                                                                    enumerate(tags)],
                     *[F.col(f).cast("double").alias(f"f{j}") for j, f in enumerate(features)])
    n = rows.count()
    n_blocks = max(1, -(-n // block_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int"))
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("x", T.BinaryType()), T.StructField("y", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(key_type)), *[T.StructField(f"tag_{t}", T.BinaryType()) for t in tags]])
    p, names = len(features), list(tags)

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("key", "ascending")]).combine_chunks()
        x = np.column_stack([t.column(f"f{j}").fill_null(float("nan")).to_numpy() for j in range(p)])
        out = [pa.array([t.column("block")[0].as_py()], pa.int32()), pa.array([bins.codes(x).tobytes()], pa.binary()),
               pa.array([t.column("y").to_numpy().astype(np.uint8).tobytes()], pa.binary()),
               pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column("key").combine_chunks()),
               *[pa.array([t.column(f"t{i}").fill_null(-1).to_numpy().astype(np.int32).tobytes()], pa.binary()) for i in range(len(names))]]
        return pa.Table.from_arrays(out, names=schema.names)

    dealt = rows.repartitionByRange(parallelism(df, n_blocks), "block")
    blocks = written(dealt.groupBy("block").applyInArrow(pack, schema), "binned")
    table = Table(blocks, bins, np.zeros((n_blocks, 2), dtype=np.int64), tuple(tags))

    def count(block: Block):
        ones = int((block.y == 1).sum())
        yield pa.RecordBatch.from_pydict({"block": pa.array([block.number], pa.int32()),
                                          "n0": pa.array([len(block.y) - ones], pa.int64()), "n1": pa.array([ones], pa.int64())})

    for r in table.map(count, "block int, n0 long, n1 long").collect():
        table.counts[r["block"]] = r["n0"], r["n1"]
    return table


def tree_sums(df: DataFrame, trees, values: np.ndarray, bins: Bins, out: str) -> DataFrame:
    """``df`` with ``out``: the sum over the trees of the value of the row's leaf; in passes of bounded model size."""
    ends = np.append(trees.roots[1:], len(trees.feature))
    numbers = (np.cumsum(ends - trees.roots) * NODE_BYTES) // PASS_BYTES

    def passes():
        for number in np.unique(numbers):
            which = np.flatnonzero(numbers == number)
            mine = np.concatenate([values[trees.roots[t]:ends[t]] for t in which])
            yield trees.subset(which).lean(mine.astype(np.uint8) if (mine == mine.astype(np.uint8)).all() else mine)

    return pass_sums(df, passes(), bins, out)


def pass_sums(df: DataFrame, passes: Iterator, bins: Bins, out: str) -> DataFrame:
    """``tree_sums`` of the trees that ``passes`` yields; what one pass has summed is written before the next is read."""
    ship(df.sparkSession)
    df, summed = df.drop(out).withColumn(out, F.lit(0.0)), False
    for trees in passes:
        df = _one_pass(written(df, "sums") if summed else df, trees, bins, out)
        summed = True
    return df


def _one_pass(df: DataFrame, trees, bins: Bins, out: str) -> DataFrame:
    names = df.columns
    rows = df.withColumn("_x", F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in bins.features]))

    def scored(lot: list[pa.RecordBatch]):
        x = np.concatenate([bins.codes(b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(bins.features)))
                            for b in lot])
        total = np.concatenate([b.column(out).to_numpy(zero_copy_only=False) for b in lot])
        whole = trees.value.dtype.kind in "ui"                  # sums in any order are the same
        first, place = one_of_each(x) if whole or not total.any() else (np.arange(len(x)), np.arange(len(x)))
        x, sums = x[first], np.zeros(len(first)) if whole else total[first]
        for t in range(len(trees)):
            sums += trees.value.take(trees.leaf(x, t))
        total, a = total + sums[place] if whole else sums[place], 0
        for b in lot:
            yield pa.RecordBatch.from_arrays([pa.array(total[a:a + b.num_rows]) if n == out else b.column(n) for n in names], names=names)
            a += b.num_rows

    def run(batches):
        lot, n = [], 0
        for batch in batches:
            lot.append(batch)
            n += batch.num_rows
            if n >= LOT_ROWS:
                yield from scored(lot)
                lot, n = [], 0
        if n:
            yield from scored(lot)

    return rows.mapInArrow(run, df.schema)
