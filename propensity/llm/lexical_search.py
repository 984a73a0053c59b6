"""Ranked lexical search: the best documents for each item of a query set, by an integer BM25.

Terms are maximal runs of ASCII letters and digits and of characters beyond
ASCII, with A-Z in lower case. Hybrid TAAT-DAAT:

* one pass over the documents counts the terms of every whole text and writes
  index segments (slices of a few MB of text): the documents of the segment and
  the postings of the query terms. Document frequencies, N and L are sums over
  the segments;
* a segment is searched per item. Short lists (at most ``SHORT_SHARE`` of the
  segment's documents) are materialised term at a time into summed accumulators,
  sorted by document; from there on they are one list with the bounds of its
  blocks. The long lists and that one are walked document at a time in blocks of
  documents: a block whose bounds cannot reach the item's current k-th score is
  skipped, and within a block the accumulators and the lists are summed for its
  documents. Bounds are true maxima, so no result is lost;
* the k best of a task go on to the k best of all.

Items come in blocks of at most ``MAX_ITEMS`` items and ``MAX_QUERY_CHARS``
characters: that much is on the driver and in a task at a time, whatever the
size of the query set; all items are answered against all documents.

Defined results: a document or item without terms (null, empty, blanks) matches
nothing; repeated documents are ranked each; equal scores go by ascending
``doc_id``, a null id last; items that repeat an id are ranked each by
themselves; an empty table on either side gives an empty result; a term repeated
in an item counts each time; columns other than the ids and texts are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.common import doc_text, map_arrow, saved

TOP = 20
#: Items, and characters of their texts, that are answered together.
MAX_ITEMS = 4096
MAX_QUERY_CHARS = 4 << 20
#: Lists in at most this share of a segment's documents are summed into accumulators.
SHORT_SHARE = 0.02
#: Documents that are taken or skipped together.
BLOCK_DOCS = 256

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BYTE = np.arange(256)
IS_TERM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)

SEGMENT = ("docs array<long>, n array<long>, term array<int>, at array<int>, doc array<int>, tf array<int>")
HITS = "item int, doc_id long, score long"


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWER))


@dataclass
class Queries:
    """A block of items: their ids, the block's terms, and per item (term numbers, repeats)."""

    ids: list
    vocabulary: list[str]
    wanted: list[tuple[np.ndarray, np.ndarray]]


def query_blocks(items: DataFrame, max_items: int = MAX_ITEMS, max_chars: int = MAX_QUERY_CHARS) -> Iterator[Queries]:
    """The items in blocks; one block is on the driver at a time."""
    rows, chars = [], 0
    for r in items.toLocalIterator():
        if rows and (len(rows) >= max_items or chars + len(r[1] or "") > max_chars):
            yield _block(rows)
            rows, chars = [], 0
        rows.append((r[0], r[1]))
        chars += len(r[1] or "")
    if rows:
        yield _block(rows)


def _block(rows: list) -> Queries:
    counts = [Counter(terms(text)) for _, text in rows]
    vocabulary = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(vocabulary)}
    wanted = [(np.array([number[t] for t in sorted(c)], dtype=np.int64), np.array([c[t] for t in sorted(c)], dtype=np.int64))
              for c in counts]
    return Queries([r[0] for r in rows], vocabulary, wanted)


def index_segments(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """One row per slice of the documents that have a term: ids, lengths, and the postings of the vocabulary.

    The postings of ``term[i]`` are ``doc`` (positions in ``docs``, ascending) and
    ``tf`` from ``at[i]`` to ``at[i + 1]``.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_binary())
        for batch in rows:
            for part in TB.slices(batch):
                offsets, raw = TB.utf8(part.column("text"))
                data = LOWER[raw]
                starts, ends, n = TB.words(offsets, data, IS_TERM)
                keep = np.flatnonzero(n)
                if not len(keep):
                    continue
                size = np.zeros(len(starts) + 1, dtype=np.int64)
                np.cumsum(ends - starts, out=size[1:])
                coded = TB.strings(size, data[IS_TERM[data]]).dictionary_encode()
                number = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy().astype(np.int64)
                term = number[coded.indices.to_numpy()]
                doc = np.repeat(np.arange(len(keep)), n[keep])
                hit = term >= 0
                key, tf = np.unique(term[hit] * len(keep) + doc[hit], return_counts=True)
                of, first = np.unique(key // len(keep), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [_one(part.column("doc_id").take(pa.array(keep))), _one(pa.array(n[keep])), _one(pa.array(of.astype(np.int32))),
                     _one(pa.array(np.append(first, len(key)).astype(np.int32))),
                     _one(pa.array((key % len(keep)).astype(np.int32))), _one(pa.array(tf.astype(np.int32)))],
                    names=[c.split()[0] for c in SEGMENT.split(", ")])

    return map_arrow(doc_text(docs), run, SEGMENT)


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _flat(row: pa.RecordBatch, name: str) -> np.ndarray:
    return row.column(name).flatten().to_numpy(zero_copy_only=False)


def statistics(segments: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of each of the block's ``size`` terms."""
    total = segments.agg(F.sum(F.size("docs").cast("long")).alias("n"),
                         F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)).alias("l")).first()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in rows:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                df[_flat(row, "term")] += np.diff(_flat(row, "at"))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "df": pa.array(df[at])})

    df = np.zeros(size, dtype=np.int64)
    for r in map_arrow(segments.select("term", "at"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]                             # at most the block's terms
    return total["n"] or 0, total["l"] or 0, df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], dtype=np.int64)


@dataclass
class Lists:
    """A segment's postings with each posting's share of a score, and the greatest share per block of documents."""

    n_docs: int
    place: dict[int, int]
    at: np.ndarray
    doc: np.ndarray
    share: np.ndarray

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        i = self.place.get(term)
        if i is None:
            return self.doc[:0], self.share[:0]
        return self.doc[self.at[i]:self.at[i + 1]], self.share[self.at[i]:self.at[i + 1]]


def lists_of(row: pa.RecordBatch, n_docs: int, n_terms: int, weight: np.ndarray) -> Lists:
    n = _flat(row, "n")
    m = 75 + (25 * n * n_docs) // n_terms
    term, at, doc, tf = (_flat(row, c).astype(np.int64) for c in ("term", "at", "doc", "tf"))
    share = np.repeat(weight[term], np.diff(at)) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    return Lists(len(n), {t: i for i, t in enumerate(term.tolist())}, at, doc, share)


def block_bounds(doc: np.ndarray, share: np.ndarray, n_blocks: int) -> np.ndarray:
    """Greatest share in each block of documents; 0 where the list has none."""
    out = np.zeros(n_blocks, dtype=np.int64)
    np.maximum.at(out, doc // BLOCK_DOCS, share)
    return out


def accumulated(short: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time over the short lists: their documents, ascending, and summed scores."""
    if not short:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, back = np.unique(np.concatenate([d for d, _, _ in short]), return_inverse=True)
    score = np.zeros(len(doc), dtype=np.int64)
    done = 0
    for d, share, times in short:
        score[back[done:done + len(d)]] += share * times        # a list holds a document once
        done += len(d)
    return doc, score


class Best:
    """The k best (score, document id) of one item so far; ``least`` is what a newcomer must reach."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.null, self.least = np.zeros(0, bool), 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.null, null)))
        if len(score) > self.k:
            best = np.lexsort((doc, null, -score))[:self.k]
            score, doc, null = score[best], doc[best], null[best]
        self.score, self.doc, self.null = score, doc, null
        if len(score) == self.k:
            self.least = max(int(score.min()), 1)


def search_segment(lists: Lists, ids: np.ndarray, null: np.ndarray, wanted: tuple[np.ndarray, np.ndarray], best: Best,
                   bounds: dict) -> int:
    """Adds the segment's documents that can be among the best; returns how many blocks it has skipped."""
    n_blocks = -(-lists.n_docs // BLOCK_DOCS)
    short, long = [], []
    for t, times in zip(wanted[0].tolist(), wanted[1].tolist()):
        doc, share = lists.of(t)
        if not len(doc):
            continue
        if len(doc) <= SHORT_SHARE * lists.n_docs or lists.n_docs <= BLOCK_DOCS:
            short.append((doc, share, times))
        else:
            if t not in bounds:
                bounds[t] = block_bounds(doc, share, n_blocks)
            long.append((doc, share, times, bounds[t]))
    doc, score = accumulated(short)
    if not long:                                             # nothing to walk: the accumulators are the scores
        at = np.flatnonzero(score >= best.least)
        best.add(score[at], ids[doc[at]], null[doc[at]])
        return 0
    reach = block_bounds(doc, score, n_blocks) + sum(b * times for _, _, times, b in long)
    skipped = 0
    order = np.argsort(-reach, kind="stable")               # good blocks first: the bar rises early
    for block in order.tolist():
        if reach[block] < best.least:                        # and so do all blocks after it
            skipped = n_blocks - int(np.flatnonzero(order == block)[0])
            break
        low, high = block * BLOCK_DOCS, min((block + 1) * BLOCK_DOCS, lists.n_docs)
        total = np.zeros(high - low, dtype=np.int64)
        a, b = np.searchsorted(doc, (low, high))
        total[doc[a:b] - low] = score[a:b]
        for d, share, times, _ in long:
            a, b = np.searchsorted(d, (low, high))
            total[d[a:b] - low] += share[a:b] * times
        at = np.flatnonzero(total >= best.least)
        if len(at):
            best.add(total[at], ids[low + at], null[low + at])
    return skipped


def best_of(segments: DataFrame, queries: Queries, n_docs: int, n_terms: int, weight: np.ndarray, k: int) -> DataFrame:
    """item (position in the block), doc_id, score: each task's k best documents of each item."""
    wanted = queries.wanted

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in wanted]
        for batch in rows:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                lists = lists_of(row, n_docs, n_terms, weight)
                docs = row.column("docs").flatten()
                null = docs.is_null().to_numpy(zero_copy_only=False)
                ids = docs.fill_null(0).to_numpy()
                bounds: dict = {}
                for item, b in zip(wanted, best):
                    search_segment(lists, ids, null, item, b, bounds)
        for i, b in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.score), i, np.int32)),
                                              pa.array(b.doc.astype(np.int64), mask=b.null), pa.array(b.score)],
                                             names=["item", "doc_id", "score"])

    return map_arrow(segments, run, HITS)


def ranked(hits: DataFrame, ids: Sequence, k: int) -> DataFrame:
    """The k best of an item over all tasks, with ranks; ``ids`` are those of one block of items."""
    spark = hits.sparkSession
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "item int, item_id long")
    top = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for queries in query_blocks(items.select(F.col(item_id).cast("long"), F.col(text).cast("string"))):
        if not queries.vocabulary:
            continue
        segments = saved(index_segments(docs, queries.vocabulary), "segments")
        n_docs, n_terms, df = statistics(segments, len(queries.vocabulary))
        if n_terms:
            hits = best_of(segments, queries, n_docs, n_terms, weights(n_docs, df), k)
            out = out.unionByName(ranked(hits, queries.ids, k))
    return out
