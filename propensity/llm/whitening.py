"""Embedding whitening by polarisation covariance.

Every entry c becomes the integer floor(64 c) + 1000000. The fit list holds
each distinct integer vector once. The covariance of two dimensions is never
summed as a product: tasks add up exact squares of centred values, for every
dimension and for the sum of every pair of dimensions, and
``cov(j, k) = (var(j + k) - var(j) - var(k)) / 2``. The sums are integers and the
differences are taken in Python integers, so each covariance is exact until it
becomes a double for ``eigh``. Tasks centre by floor(S / n), which leaves small
integers; the remainder of that division is put right on the driver. Only sums
(d (d + 1) / 2 numbers) and the d x d matrix reach the driver.

Defined results: rows whose vector is null or holds null, NaN or infinite
entries are dropped, and so are vectors of another length than the usual one
(the most frequent, the shorter on ties); a null id is kept; repeated rows come
out as often as they are given and count once in the fit; an empty table gives
an empty result; a component without variance (eigenvalue at most
``RANK_EPS`` of the greatest) has null in ``whitened`` and is left out of
``identity_error``; equal eigenvalues give some orthonormal basis, the same for
all rows; an entry or a ``deviation`` beyond 64 bits is an error; columns other
than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import map_arrow, saved

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Eigenvalues at or below this share of the greatest count as zero.
RANK_EPS = 1e-12
#: Rows whose pair sums are held at once.
BLOCK_ROWS = 1024
SUMS = "at int, total decimal(38,0)"
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


@dataclass
class Whitening:
    """A fitted whitening: n vectors with sums S; unit components as columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centre(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Rows of integer vectors, centred and projected, in units of each component's deviation.

        x - S/n as (x - floor(S/n)) - (S mod n)/n: both parts are exact or small.
        """
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        scale = np.where(self.live(), np.sqrt(np.maximum(self.eigenvalues, 0)), np.nan)
        return ((x - self.centre()) - rest) @ self.components / scale

    def live(self) -> np.ndarray:
        top = max(self.eigenvalues[0], 0.0) if len(self.eigenvalues) else 0.0
        return self.eigenvalues > top * RANK_EPS


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x (array of long) of the rows that stay."""
    v = F.col(vector)
    rows = df.where(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))


def usual_length(vectors: DataFrame) -> int | None:
    """The most frequent length, the shorter on ties; None without rows."""
    got = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return got["d"] if got else None


def matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def pair_positions(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d, 1)


def exact_squares(y: np.ndarray) -> list[int]:
    """Sums over the rows of y_j^2, then of (y_j + y_k)^2 for j < k; in 64 bits where they hold them."""
    j, k = pair_positions(y.shape[1])
    most = int(np.abs(y).max(initial=0))
    if 4 * most * most * max(len(y), 1) >= 2 ** 63:
        y = y.astype(object)
    pair = y[:, j] + y[:, k]
    return [int(s) for s in np.concatenate([(y * y).sum(axis=0), (pair * pair).sum(axis=0)])]


def summed(vectors: DataFrame, terms, width: int) -> list[int]:
    """Column sums of ``terms(batch)`` (a list of ``width`` integers) over all rows, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                total = [a + b for a, b in zip(total, terms(batch.slice(at, BLOCK_ROWS)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(map(str, total), pa.string()).cast(pa.decimal128(38, 0))],
            names=["at", "total"])

    got = map_arrow(vectors.select("x"), run, SUMS).groupBy("at").agg(F.sum("total").alias("total")).collect()
    out = {r["at"]: int(r["total"]) for r in got}               # ``width`` rows
    return [out.get(i, 0) for i in range(width)]


def fit(distinct: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """``distinct``: the fit list, a table of unlike vectors of length ``d`` (at least one)."""
    first = summed(distinct, lambda b: [b.num_rows, *(int(s) for s in _sums(matrix(b, d)))], d + 1)
    n, sums = first[0], first[1:]
    centre = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]
    j, k = pair_positions(d)
    squares = summed(distinct, lambda b: exact_squares(matrix(b, d) - centre), d + len(j))
    # n^2 var = n sum(y^2) - (sum y)^2, in integers
    alone = [n * q - r * r for q, r in zip(squares, rest)]
    cov = np.zeros((d, d))
    square_n = n * n
    for a in range(d):
        cov[a, a] = alone[a] / square_n
    for a, b, q in zip(j.tolist(), k.tolist(), squares[d:]):
        both = n * q - (rest[a] + rest[b]) ** 2
        cov[a, b] = cov[b, a] = (both - alone[a] - alone[b]) / (2 * square_n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(cov))
    return Whitening(n, sums, vectors[:, order], values[order], values[order] / trace if trace else values[order] * 0)


def _sums(x: np.ndarray) -> np.ndarray:
    if int(np.abs(x).max(initial=0)) * max(len(x), 1) >= 2 ** 63:
        x = x.astype(object)
    return x.sum(axis=0)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity (0 without components)."""
    d, live = len(model.sums), np.flatnonzero(model.live())
    c = len(live)
    if not c:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(c + c * c)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                w = model.projected(matrix(batch.slice(at, BLOCK_ROWS), d))[:, live]
                total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(total), dtype=np.int32)), "total": total})

    got = map_arrow(distinct.select("x"), run, "at int, total double").groupBy("at").agg(F.sum("total").alias("s")).collect()
    total = np.zeros(c + c * c)
    for r in got:
        total[r["at"]] = r["s"]
    mean = total[:c] / model.n
    # whitened values are centred already: their mean is rounding only
    return float(np.abs(total[c:].reshape(c, c) / model.n - np.outer(mean, mean) - np.eye(c)).max())


def deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact."""
    y, rest = x - model.centre(), [s % model.n for s in model.sums]
    most = int(np.abs(y).max(initial=0)) + 1
    if (most * model.n) ** 2 * x.shape[1] >= 2 ** 63:
        y, rest = y.astype(object), np.array(rest, dtype=object)
    z = y * model.n - np.asarray(rest)
    return (z * z).sum(axis=1).tolist()


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component; the fit list is a table in the shared folder."""
    spark = df.sparkSession
    vectors = integer_vectors(df, vec_id, vector)
    d = usual_length(vectors)
    if not d:
        return spark.createDataFrame([], RESULT)
    vectors = vectors.where(F.size("x") == d)
    distinct = saved(vectors.select("x").distinct(), "whitening")
    model = fit(distinct, d, components)
    error = identity_error(distinct, model)
    c = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, d)
            w = model.projected(x)
            rows, total = len(x), len(x) * c
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), c))),
                pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), rows)),
                pa.array(np.full(total, model.n, dtype=np.int64)),
                pa.array(np.repeat(np.array(deviations(x, model), dtype=np.int64), c)),
                pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                pa.array(np.tile(model.explained, rows)), pa.array(np.full(total, error))],
                names=[f.split()[0] for f in RESULT.split(", ")])

    return map_arrow(vectors, run, RESULT)
