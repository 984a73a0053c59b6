"""Token-id output as Re-Pair grammars.

Documents go in ascending doc_id order into shards. In each shard, frequent
pairs of ids are replaced by nonterminals, again and again; the shard stores
the rules, the expansion length of every rule, and the symbols left, with the
place of every document in them. Expansion lengths give random access: a range
of a document's tokens is decoded without what comes before it.

The first rounds run over the shard's distinct chunks, weighted by how often
each occurs (a pair inside a chunk occurs as often as the chunk does), the
others over the documents themselves; both go on until no pair occurs MIN_COUNT
times.

Defined results: a null or empty text is the end id alone; repeated rows are
stored as often as they are given; documents without doc_id come first; an
empty table gives an empty store; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.chunk_encoder import encoder, ragged
from propensity.llm.common import doc_text, map_arrow, saved

END_ID = 0
SHARD_BYTES = 8 << 20
PART_BYTES = 16 << 20
MIN_COUNT = 16

#: The columns of a store. Binary columns hold little-endian arrays.
STORE = ("part int, shard int, vocabulary int, n_docs int, n_tokens long, doc_ids binary, doc_ends binary, "
         "rules binary, lengths binary, symbols binary")
_KIND = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("vocabulary", pa.int32()), ("n_docs", pa.int32()),
                   ("n_tokens", pa.int64()), ("doc_ids", pa.binary()), ("doc_ends", pa.binary()),
                   ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())])
#: Marks a missing doc_id in a store.
NO_ID = -(1 << 63)


class Grammar:
    """Rules of a shard: symbol ``vocabulary + k`` stands for the pair ``rules[k]``."""

    def __init__(self, vocabulary: int):
        self.vocabulary = vocabulary
        self.rules = np.zeros((0, 2), dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)

    def length(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self.vocabulary
        out[rule] = self.lengths[symbols[rule] - self.vocabulary]
        return out

    def replace(self, symbols: np.ndarray, last: np.ndarray, weight: np.ndarray | None, min_count: int):
        """Rounds until no pair occurs ``min_count`` times. ``last``: the symbol and the next form no pair.

        (symbols, which of the old places stay). A pair's rank is its count, then a hash of the pair: of two that
        overlap the higher wins, everywhere alike, so that equal counts do not wait for each other. A pair that is too
        rare never becomes frequent again, since new symbols only take places away from it: each round looks only at
        pairs that were frequent or hold a new symbol.
        """
        end = len(symbols)
        sym = np.append(symbols, -1).astype(np.int32)
        # neighbours; ``end`` stands for none
        after, before = np.arange(1, end + 2, dtype=np.int32), np.arange(-1, end, dtype=np.int32)
        after[end] = end
        after[:-1][last] = end
        before[0] = end
        before[1:-1][last[:-1]] = end
        stay, live = np.ones(end, dtype=bool), ~last
        rank = np.zeros(end + 1, dtype=np.int32)                    # of the pair that begins at each place
        pairs, sizes = [], []
        bound = self.vocabulary + len(self.rules)
        lengths = np.concatenate([np.ones(self.vocabulary, dtype=np.int64), self.lengths])
        while len(at := np.flatnonzero(live)):
            left, right = sym[at], sym[after[at]]
            name, keys = pd.factorize(left * np.int64(bound) + right)
            counted = _every_other(at, left, right, before)
            del left, right
            count = np.bincount(name[counted], weights=None if weight is None else weight[at[counted]], minlength=len(keys))
            often = count >= min_count
            live[at[~often[name]]] = False
            many = np.flatnonzero(often)
            if not len(many):
                break
            order = np.zeros(len(keys), dtype=np.int32)
            mixed = keys[many].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            order[many[np.lexsort((mixed ^ (mixed >> np.uint64(29)), count[many]))]] = np.arange(1, len(many) + 1)
            asked = counted & often[name]
            at, name = at[asked], name[asked]
            mine = order[name]
            rank[at] = mine
            wins = (mine > rank[before[at]]) & (mine > rank[after[at]])
            rank[at] = 0
            at, name = at[wins], name[wins]
            used = np.bincount(name, weights=None if weight is None else weight[at], minlength=len(keys))
            made = np.flatnonzero(used >= min_count)        # holds the pair of the highest rank: no round is in vain
            new = np.full(len(keys), -1, dtype=np.int64)
            new[made] = bound + np.arange(len(made))
            pair = np.stack([keys[made] // bound, keys[made] % bound], axis=1)
            pairs.append(pair)
            lengths = np.concatenate([lengths, lengths[pair[:, 0]] + lengths[pair[:, 1]]])
            bound += len(made)
            put = at[new[name] >= 0]
            sym[put] = new[name[new[name] >= 0]]
            gone = after[put]
            stay[gone], live[gone] = False, False
            after[put] = after[gone]
            before[after[put]] = put
            live[put] = after[put] < end
            earlier = before[put]
            live[earlier[earlier < end]] = True
        if pairs:
            self.rules = np.concatenate([self.rules, *pairs])
            self.lengths = lengths[self.vocabulary:]
        return sym[:-1][stay], stay


def _every_other(at: np.ndarray, left: np.ndarray, right: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Which pairs count: all but every second one of a run of the same symbol, where they overlap."""
    counted = np.ones(len(at), dtype=bool)
    same = np.flatnonzero(left == right)
    if len(same):
        follows = np.zeros(len(same), dtype=bool)       # the pair before is live too, and of the same symbol
        follows[1:] = (at[same[:-1]] == before[at[same[1:]]]) & (left[same[:-1]] == left[same[1:]])
        step = np.arange(len(same))
        first = np.maximum.accumulate(np.where(follows, 0, step))
        counted[same[(step - first) % 2 == 1]] = False
    return counted


def _ends(n: int, ends: np.ndarray) -> np.ndarray:
    last = np.zeros(n, dtype=bool)
    last[ends[ends > 0] - 1] = True
    return last


def compress(entry: np.ndarray, per_doc: np.ndarray, ids: np.ndarray, start: np.ndarray, count: np.ndarray,
             vocabulary: int, end_id: int):
    """(grammar, symbols, end of each document in the symbols) of texts given as chunk entries."""
    grammar = Grammar(vocabulary)
    often = np.bincount(entry, minlength=len(count))
    kinds = np.flatnonzero(often)
    new = np.cumsum(often > 0) - 1
    entry, often = new[entry], often[kinds].astype(float)
    size = count[kinds]
    symbols = ids[ragged(start[kinds], size)]
    chunk = np.repeat(np.arange(len(kinds)), size)
    symbols, stay = grammar.replace(symbols, _ends(len(symbols), np.cumsum(size)), often[chunk], MIN_COUNT)
    chunk = chunk[stay]
    size = np.bincount(chunk, minlength=len(kinds))
    got = size[entry]
    flat = symbols[ragged((np.cumsum(size) - size)[entry], got)]
    ends = np.concatenate([[0], np.cumsum(got)])[np.cumsum(per_doc)]
    del entry, got, symbols, chunk
    flat = np.insert(flat, ends, end_id)
    ends = ends + np.arange(1, len(ends) + 1)
    flat, stay = grammar.replace(flat, _ends(len(flat), ends), None, MIN_COUNT)
    ends = np.cumsum(stay)[ends - 1]
    return grammar, flat, ends


def _write(rows: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, no, held = TaskContext.get().partitionId(), 0, []
    enc = encoder(path)

    def shard(held: list[pa.RecordBatch], no: int) -> pa.RecordBatch:
        texts = pa.concat_arrays([b.column("text") for b in held])
        doc_ids = np.concatenate([b.column("doc_id").fill_null(NO_ID).to_numpy() for b in held])
        grammar, symbols, ends = compress(*enc.entries(texts), enc.size, end_id)
        row = {"part": part, "shard": no, "vocabulary": enc.size, "n_docs": len(texts),
               "n_tokens": int(grammar.length(symbols).sum()), "doc_ids": doc_ids.astype("<i8").tobytes(),
               "doc_ends": ends.astype("<i8").tobytes(), "rules": grammar.rules.astype("<u4").tobytes(),
               "lengths": grammar.lengths.astype("<u4").tobytes(), "symbols": symbols.astype("<u4").tobytes()}
        return pa.RecordBatch.from_pylist([row], schema=_KIND)

    size = 0
    for batch in rows:
        for piece in TB.slices(batch):
            held.append(piece)
            size += piece.column("text").nbytes
            if size >= SHARD_BYTES:
                yield shard(held, no)
                held, size, no = [], 0, no + 1
    if held:
        yield shard(held, no)


def write_store(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """The store of all documents: one row per shard, parts and shards in ascending doc_id order."""
    given = doc_text(docs)
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = given.repartitionByRange(max(1, -(-int(size) // PART_BYTES)), F.col("doc_id").asc_nulls_first())
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return saved(map_arrow(dealt, lambda rows: _write(rows, path, end_id), STORE), "token-store")


class Shard:
    """A row of a store, decoded on demand."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind).astype(np.int64)
        self.doc_ids, self.ends = read("doc_ids", "<i8"), read("doc_ends", "<i8")
        self.symbols, self.vocabulary = read("symbols", "<u4"), row["vocabulary"]
        pair, lengths = read("rules", "<u4").reshape(-1, 2), read("lengths", "<u4")
        self.start = np.concatenate([np.arange(self.vocabulary), self.vocabulary + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([np.ones(self.vocabulary, dtype=np.int64), lengths])
        self.table = np.concatenate([np.arange(self.vocabulary), np.zeros(lengths.sum(), dtype=np.int64)])
        todo = 0
        while todo < len(pair):         # rules up to the first that needs one of them, at once
            deep = pair[todo:].max(axis=1) >= self.vocabulary + todo
            upto = todo + int(deep.argmax()) if deep.any() else len(pair)
            at = self.start[self.vocabulary + todo]
            made = self.expand(pair[todo:upto].ravel())
            self.table[at:at + len(made)] = made
            todo = upto

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.table[ragged(self.start[symbols], self.length[symbols])]

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the end of each document in them."""
        return self.expand(self.symbols), np.cumsum(self.length[self.symbols])[self.ends - 1]

    def read(self, doc: int, lo: int, hi: int) -> np.ndarray:
        """Tokens lo to hi of the shard's ``doc``-th document; only the symbols that hold them are expanded."""
        symbols = self.symbols[self.ends[doc - 1] if doc else 0:self.ends[doc]]
        ends = np.cumsum(self.length[symbols])
        a, b = np.searchsorted(ends, lo, side="right"), np.searchsorted(ends, hi, side="left")
        skip = lo - (ends[a - 1] if a else 0)
        return self.expand(symbols[a:b + 1])[skip:skip + hi - lo]


def read_store(store: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the shards."""

    def decoded(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                shard = Shard(row)
                ids, ends = shard.tokens()
                begin = np.concatenate([[0], ends[:-1]])
                raw = ids.astype("<u4").view(np.uint8).data
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), ends.tolist())]
                n = len(begin)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(n, row["part"], np.int32)), "shard": pa.array(np.full(n, row["shard"], np.int32)),
                    "doc_id": pa.array(shard.doc_ids, mask=shard.doc_ids == NO_ID), "begin": pa.array(begin),
                    "n_tokens": pa.array(ends - begin), "ids_crc32": pa.array(crc, pa.int64())})

    parts = store.groupBy("part").agg(F.sum("n_tokens").alias("all"))       # a row per part, 16 MB of text each
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("earlier"))
    sizes = store.select("part", "shard", "n_tokens")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    sizes = sizes.select("part", "shard", inside.alias("inside")).join(parts, "part")
    sizes = sizes.select("part", "shard", (F.col("inside") + F.col("earlier")).alias("before"))
    rows = map_arrow(store, decoded, "part int, shard int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return rows.join(sizes, ["part", "shard"]).select("doc_id", (F.col("begin") + F.col("before")).alias("start"),
                                                      "n_tokens", "ids_crc32")
