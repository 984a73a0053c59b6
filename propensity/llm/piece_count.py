"""Token counts by rank-synchronous merging of arrays.

A text's pieces never reach from a character into a space behind it (checked
when the model is read), so a text is cut before every run of spaces. The
distinct cuts of a slice are held as one ragged array of symbols, cut again
between characters that no piece holds side by side; in each step every sequence
joins its pair of lowest rank, from left to right wherever it stands, until no
pair of any sequence has a rank. Where a join brings in a pair of no higher
rank, what stands behind it waits for the next step, so the order is that of
joining one by one. What survives is counted, and a symbol outside the
vocabulary counts its bytes.

Defined results: a null or empty text has no bytes and no tokens; repeated rows
count alike; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from propensity.llm import textbatch as TB
from propensity.llm.common import doc_text, map_arrow
from propensity.llm.pair_table import NEVER, PairTable

LIMIT = 4096
#: Counts remembered by one worker; beyond that it starts anew, with equal results.
MAX_CUTS = 400_000
#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in rank):
            raise ValueError("a piece holds a space behind another character")
        probe = "a▁ bÅﬁⅠ"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model changes texts before it cuts them")
        symbols = {s: k for k, s in enumerate([*rank, *sorted({c for p in rank for c in p} - rank.keys())])}
        pairs = [(symbols[p[:k]], symbols[p[k:]], rank[p], symbols[p]) for p in rank for k in range(1, len(p))
                 if p[:k] in symbols and p[k:] in symbols]
        scores = {r: k for k, r in enumerate(sorted({x[2] for x in pairs}))}
        left, right, order, merged = (np.array(x, dtype=np.int64) for x in zip(*[(a, b, scores[r], m)
                                                                               for a, b, r, m in pairs]))
        self.table = PairTable(left, right, order, merged)
        near = sorted({(symbols[a], symbols[b]) for p in rank for a, b in zip(p, p[1:])})
        none = np.zeros(len(near), dtype=np.int64)
        self.near = PairTable(*np.array(near, dtype=np.int64).reshape(-1, 2).T, none, none)    # side by side in a piece
        self.first = np.full(0x110000, -1, dtype=np.int64)          # code point -> symbol
        for s, k in symbols.items():
            if len(s) == 1:
                self.first[ord(s)] = k
        self.first[ord(" ")] = self.first[ord(SPACE)]
        self.known = np.zeros(len(symbols) + 1, dtype=bool)          # its last is for symbol -1
        self.known[[symbols[p] for p in rank]] = True
        self.cuts: dict[bytes, int] = {}

    def count(self, points: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each sequence of code points (``size`` of them each, none empty)."""
        n = len(size)
        symbols = self.first[points]
        weight = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
        total = np.zeros(n, dtype=np.int64)
        given = np.repeat(np.arange(n), size)
        apart = np.ones(len(points), dtype=bool)
        apart[1:] = (given[1:] != given[:-1]) | (self.near.find(symbols[:-1], symbols[1:])[0] == NEVER)
        seq, given = np.cumsum(apart) - 1, given[apart]
        ranks, merged = self._pairs(symbols, seq)
        while len(symbols):
            start = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            low = np.minimum.reduceat(ranks, start)
            here = np.repeat(low, np.diff(np.concatenate([start, [len(seq)]])))
            on = here != NEVER
            if not on.all():        # finished sequences are counted and leave
                out = ~on
                total += np.bincount(given[seq[out]], weights=np.where(self.known[symbols[out]], 1, weight[out]),
                                     minlength=n).astype(np.int64)
                symbols, weight, seq, ranks, merged, here = (x[on] for x in (symbols, weight, seq, ranks, merged, here))
                if not len(symbols):
                    break
            hit = self._joins(symbols, seq, merged, np.flatnonzero(ranks == here), here)
            symbols[hit] = merged[hit]
            stay = np.ones(len(symbols), dtype=bool)
            stay[hit + 1] = False
            symbols, weight, seq, ranks, merged = (x[stay] for x in (symbols, weight, seq, ranks, merged))
            at = hit - np.arange(len(hit))
            at = np.unique(np.concatenate([at, at[at > 0] - 1]))
            ranks[at], merged[at] = self._pairs(symbols, seq, at)
        return total

    def _joins(self, symbols, seq, merged, hit, here) -> np.ndarray:
        """Which of the places ``hit`` of lowest rank are joined in this step: those that joining one by one would take next."""
        step = np.arange(len(hit))
        apart = np.ones(len(hit), dtype=bool)
        apart[1:] = np.diff(hit) != 1
        hit = hit[(step - np.maximum.accumulate(np.where(apart, step, 0))) % 2 == 0]    # every other of overlapping places
        if len(hit) < 2:
            return hit
        first = np.concatenate([[True], seq[hit][1:] != seq[hit][:-1]])
        if first.all():
            return hit
        new = merged[hit]
        left = np.where((hit > 0) & (seq[hit - 1] == seq[hit]), symbols[hit - 1], -1)
        touches = np.flatnonzero(~first[1:] & (np.diff(hit) == 2)) + 1
        left[touches] = new[touches - 1]
        after = np.minimum(hit + 2, len(symbols) - 1)
        right = np.where((hit + 2 < len(symbols)) & (seq[after] == seq[hit]), symbols[after], -1)
        sooner = (self.table.find(left, new)[0] <= here[hit]) | (self.table.find(new, right)[0] <= here[hit])
        before = np.cumsum(sooner) - sooner             # joins of the same sequence that let a pair go first
        return hit[before == np.maximum.accumulate(np.where(first, before, 0))]

    def _pairs(self, symbols: np.ndarray, seq: np.ndarray, at: np.ndarray | None = None):
        """Rank and result of the pair that begins at each place; NEVER at a sequence's end."""
        at = np.arange(len(symbols)) if at is None else at
        after = np.minimum(at + 1, len(symbols) - 1)
        inside = (at + 1 < len(symbols)) & (seq[after] == seq[at])
        return self.table.find(symbols[at], np.where(inside, symbols[after], -1))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, tokens) of every text."""
        given, _ = TB.utf8(column)
        n_bytes = np.diff(given)
        spaced = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), SPACE, " ")
        spaced = pc.if_else(pc.equal(spaced, ""), "", pc.binary_join_element_wise(
            pa.scalar("", pa.large_string()), spaced, pa.scalar(" ", pa.large_string())))
        offsets, data = TB.utf8(spaced)
        if not len(data):
            return n_bytes, np.zeros(len(n_bytes), dtype=np.int64)
        space = data == 32
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(head)
        coded = TB.strings(np.concatenate([start, [len(data)]]), data).dictionary_encode()
        kinds = coded.dictionary.to_pylist()
        if len(self.cuts) + len(kinds) > MAX_CUTS:
            self.cuts.clear()
        new = [k for k in kinds if k not in self.cuts]
        if new:
            points = np.frombuffer(b"".join(new).decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
            raw = np.frombuffer(b"".join(new), dtype=np.uint8)
            size = TB.per_doc(TB.IS_HEAD[raw], np.concatenate([[0], np.cumsum([len(k) for k in new])]))
            self.cuts.update(zip(new, self.count(points, size).tolist()))
        each = np.fromiter(map(self.cuts.__getitem__, kinds), dtype=np.int64, count=len(kinds))
        each = each[coded.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(each)])
        return n_bytes, np.diff(total[np.searchsorted(start, offsets)])


_KNOWN: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """The worker's counter for this model; it stays between tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = PieceCounter(path)
    return _KNOWN[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, one row per row of ``docs``."""

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in TB.slices(batch):
                n_bytes, n_tokens = counter(path).texts(part.column("text"))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_bytes": pa.array(n_bytes),
                                                  "n_tokens": pa.array(n_tokens),
                                                  "over_limit": pa.array(n_tokens > limit)})

    return map_arrow(doc_text(docs), counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
