"""Best-fit packing of token pieces into sequences of a fixed length.

Pieces of equal length are interchangeable, and so are gaps (room left in open
sequences) of equal capacity. So the sweep runs over the histogram of lengths,
on the driver and one length class after the other, longest first: the class's
pieces go to the tightest gaps that hold them, and what finds no gap opens
sequences. Its state is runs of ranks over at most ``limit`` lengths, whatever
the number of documents, and its time grows with ``limit`` squared. This stands
in for distributed sweeps with conflicts resolved by rank. Counting the lengths,
ranking the pieces of a length and placing every piece (a successor search by
length and rank) are distributed.

Defined results: a null or empty text is one piece that holds the end id;
repeated rows are packed as often as they are given; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.chunk_encoder import encoder
from propensity.llm.common import doc_text, map_arrow, saved

LIMIT = 1024
END_ID = 2
#: Pieces that one task ranks, about.
BUCKET_ROWS = 50_000
#: Text that is encoded together: larger slices repeat fewer chunks.
SLICE_BYTES = 8 << 20
_RANK_BITS = 50


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): texts longer than ``limit`` ids are cut.

    All pieces but a document's first are full; the first holds the remainder.
    """

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in TB.slices(batch, target=SLICE_BYTES):
                flat, at = encoder(path).encode(part.column("text"))
                flat = np.insert(flat, at[1:], end_id).astype("<u4")
                at = at + np.arange(len(at))
                size = np.diff(at)
                per = -(-size // limit)
                doc = np.repeat(np.arange(len(size)), per)
                no = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
                first = size - (per - 1) * limit
                start = np.where(no > 0, first[doc] + (no - 1) * limit, 0)
                length = np.where(no > 0, limit, first[doc])
                begin = at[doc] + start
                raw = flat.view(np.uint8).data
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                out = {"doc_id": part.column("doc_id").take(pa.array(doc)), "piece": pa.array(no.astype(np.int32)),
                       "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    return map_arrow(doc_text(docs), cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
                     + (", ids array<int>" if with_ids else ""))


@dataclass
class Plan:
    """Runs of places: the pieces of ``length`` from rank ``lo`` on go ``per`` to a sequence from ``first`` on."""

    length: np.ndarray
    lo: np.ndarray
    first: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces, by successor search."""
        key = (self.length << _RANK_BITS) | self.lo
        k = np.searchsorted(key, (length << _RANK_BITS) | rank, side="right") - 1
        i = rank - self.lo[k]
        return self.first[k] + i // self.per[k], self.offset[k] + (i % self.per[k]) * length


def plan(counts: dict[int, int], limit: int = LIMIT) -> Plan:
    """Rounds of best fit over the number of pieces of each length."""
    gaps: dict[int, list[tuple[int, int]]] = {}         # capacity -> runs of sequences (first, how many)
    runs, opened = [], 0

    def leave(capacity: int, first: int, many: int) -> None:
        if capacity > 0 and many > 0:
            gaps.setdefault(capacity, []).append((first, many))

    def fill(length: int, rank: int, left: int, capacity: int, first: int, many: int) -> int:
        """Put up to ``left`` pieces into ``many`` sequences with this room; how many went in."""
        per = capacity // length
        used = min(many, -(-left // per))
        put = min(left, used * per)
        runs.append((length, rank, first, per, limit - capacity))
        leave(capacity - per * length, first, put // per)
        if put % per:
            leave(capacity - put % per * length, first + put // per, 1)
        leave(capacity, first + used, many - used)
        return put

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for capacity in sorted(c for c in gaps if c >= length):         # successors, the tightest first
            waiting = gaps.pop(capacity)
            while waiting and left:
                first, many = waiting.pop(0)
                put = fill(length, rank, left, capacity, first, many)
                rank, left = rank + put, left - put
            for run in waiting:
                leave(capacity, *run)
            if not left:
                break
        if left:
            many = -(-left // (limit // length))
            fill(length, rank, left, limit, opened, many)
            opened += many
    runs.sort(key=lambda r: r[:2])
    columns = np.array(runs, dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, opened)


def ranked(cut: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``cut`` with ``rank``, from 0 within each length, and the pieces of each length.

    A frequent length is dealt over buckets; each is numbered on its own and
    shifted by the sizes of the buckets before it.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    shift = sizes.select("length", "bucket", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    out = dealt.withColumn("inside", inside).join(shift, ["length", "bucket"])
    return out.withColumn("rank", F.col("before") + F.col("inside") - 1).drop("bucket", "inside", "before"), counts


def best_fit(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``cut`` (pieces) with sequence_id and offset: gapless from 0 within each sequence."""
    rows, counts = ranked(cut)
    places = plan(counts, limit)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, offset = places.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield batch.append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return map_arrow(rows, put, schema + ", sequence_id long, offset long").drop("rank")


def pack(docs: DataFrame, path: str, end_id: int = END_ID, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """One row per piece with its place; with ``with_ids`` also the ids."""
    cut = saved(pieces(docs, path, end_id, limit, with_ids), "pieces")
    names = [c for c in cut.columns]
    return best_fit(cut, limit).select(*names, "sequence_id", "offset")
