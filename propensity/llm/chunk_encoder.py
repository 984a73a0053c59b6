"""Token ids by the tokenizers library, with equal chunks of text encoded once.

A text may be cut where the byte-level pattern always begins a new pre-token:
before a single space and on both sides of a single line break, if neither
touches other white space, and between a letter and a full stop or comma that
ends such a piece. Its ids are the ids of its chunks one after another. Texts in
which a space or line break touches other white space go to the library whole.

A tab between two chunks is a pre-token and a token of its own, so many new
chunks are encoded in one call, joined by tabs.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from propensity.llm import textbatch as TB

#: Chunks remembered by one worker (about 200 bytes each); beyond that it starts anew, with equal results.
MAX_CHUNKS = 1_200_000
#: Chunks in one call.
JOINED = 2048

#: Where texts are cut, and the marks that are chunks of their own behind an ASCII letter.
IS_CUT = TB.byte_set(b" \n")
MARKS = b".,"
IS_MARK = TB.byte_set(MARKS)
IS_LETTER = TB.byte_set(bytes([*range(65, 91), *range(97, 123)]))


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    shift = start - (np.cumsum(count) - count)
    return np.repeat(shift, count) + np.arange(int(count.sum()))


class Store:
    """Ids of many entries in a row, in arrays that grow by doubling."""

    def __init__(self):
        self.ids, self.start, self.count = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.edge = np.zeros(1 << 14, dtype=bool)       # white space at an end: not to be joined to a space
        self.n = self.used = 0

    def add(self, ids: np.ndarray, count: np.ndarray, edge: np.ndarray | bool = False) -> range:
        k = len(count)
        while self.n + k > len(self.start):
            self.start, self.count, self.edge = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count, self.edge))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        new = range(self.n, self.n + k)
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[self.n:self.n + k] = self.used + np.cumsum(count) - count
        self.count[self.n:self.n + k] = count
        self.edge[self.n:self.n + k] = edge
        self.n, self.used = self.n + k, self.used + len(ids)
        return new


class ChunkEncoder:
    def __init__(self, path: str, max_chunks: int = MAX_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tab = self.tokenizer.encode("\t", add_special_tokens=False).ids
        self.max_chunks = max_chunks
        self.clear()

    def clear(self) -> None:
        self.rest: dict[str, int] = {}          # chunk without its leading space -> entry
        self.first: dict[str, int] = {}         # chunk at the start of a text or line -> entry
        self.store = Store()
        each = self._encoded([chr(b) for b in b"\n" + MARKS])
        places = self.store.add(np.concatenate(each), np.array([len(x) for x in each]))
        self.marks = dict(zip(b"\n" + MARKS, places))
        self.of_mark = np.zeros(256, dtype=np.int64)
        self.of_mark[list(self.marks)] = list(self.marks.values())

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has; none holds a tab or ends in white space."""
        groups = [texts[k:k + JOINED] for k in range(0, len(texts), JOINED)]
        ids, counts = [], []
        for group, got in zip(groups, self._encoded(["\t".join(g) for g in groups])):
            cut = np.flatnonzero(got == self.tab[0])
            if len(cut) != len(group) - 1:      # not the case that the pattern promises: one by one
                each = self._encoded(group)
                ids.append(np.concatenate(each))
                counts.append(np.array([len(x) for x in each], dtype=np.int64))
                continue
            ids.append(np.delete(got, cut))
            counts.append(np.diff(np.concatenate([[-1], cut, [len(got)]])) - 1)
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([*ids, none]).astype(np.int32), np.concatenate([*counts, none])

    def _learn(self, known: dict[str, int], new: list[str], prefix: str) -> None:
        # strip() hands back the word itself where there is nothing to strip
        odd = [w for w in new if not w or w.strip() is not w or "\t" in w]
        if odd:
            apart = set(odd)
            plain = [w for w in new if w not in apart]
        else:
            plain = new
        known.update(zip(plain, self.store.add(*self._chunks([prefix + w for w in plain] if prefix else plain))))
        if odd:
            each = self._encoded([prefix + w for w in odd])
            edge = np.array([not w or w.strip() is not w for w in odd], dtype=bool)
            known.update(zip(odd, self.store.add(np.concatenate(each), np.array([len(x) for x in each]), edge)))

    def entries(self, column: pa.Array):
        """(entry of every chunk, chunks per text, ids of the store, first id and number of ids of each entry)."""
        offsets, data = TB.utf8(column)
        n = len(column)
        cut = IS_CUT[data]
        start, end, doc = TB.cuts(offsets, cut)
        # a mark that ends a piece is a chunk of its own
        size = end - start
        marked = size > 1
        at = end[marked] - 1
        marked[marked] = IS_MARK[data[at]] & IS_LETTER[data[at - 1]]
        mark = data[end[marked] - 1]
        keep = ~cut
        keep[end[marked] - 1] = False
        ends = np.concatenate([[0], np.cumsum(size - marked)])
        coded = TB.strings(ends, data[keep]).dictionary_encode()
        kinds, code = coded.dictionary.cast(pa.large_string()).to_pylist(), coded.indices.to_numpy()
        head = np.ones(len(start), dtype=bool)
        head[1:] = doc[1:] != doc[:-1]
        broken, spaced = np.zeros(len(start), dtype=bool), np.zeros(len(start), dtype=bool)
        spaced[~head] = data[start[~head] - 1] == 32
        broken[~head] = ~spaced[~head]
        if len(self.rest) + len(self.first) + len(kinds) > self.max_chunks:
            self.clear()
        entry = np.zeros(len(start), dtype=np.int64)
        for known, prefix, mine in ((self.rest, " ", spaced), (self.first, "", ~spaced)):
            used = np.flatnonzero(np.bincount(code[mine], minlength=len(kinds)))
            names = [kinds[k] for k in used.tolist()]
            new = [w for w in names if w not in known]
            if new:
                self._learn(known, new, prefix)
            place = np.zeros(len(kinds), dtype=np.int64)
            place[used] = np.fromiter(map(known.__getitem__, names), dtype=np.int64, count=len(names))
            entry[mine] = place[code[mine]]
        s = self.store
        alone = head.copy()
        alone[:-1] &= head[1:]
        bad = s.edge[entry] & ~(alone & (size == 0))
        # line break, chunk, mark
        per = 1 + broken + marked
        first = np.cumsum(per) - per
        out = np.zeros(int(per.sum()), dtype=np.int64)
        out[first + broken] = entry
        out[first[broken]] = self.marks[10]
        out[(first + broken)[marked] + 1] = self.of_mark[mark]
        whole = np.flatnonzero(np.bincount(doc[bad], minlength=n))
        chunks = np.bincount(doc, weights=per, minlength=n).astype(np.int64)
        if not len(whole):
            return out, chunks, s.ids[:s.used], s.start[:s.n], s.count[:s.n]
        # these texts become one chunk each
        each = self._encoded([column[int(i)].as_py() for i in whole])
        length = np.array([len(x) for x in each])
        begin = np.cumsum(chunks) - chunks
        stay = np.ones(len(out), dtype=bool)
        stay[ragged(begin[whole] + 1, chunks[whole] - 1)] = False
        out[begin[whole]] = s.n + np.arange(len(whole))
        chunks[whole] = 1
        return (out[stay], chunks, np.concatenate([s.ids[:s.used], *each]),
                np.concatenate([s.start[:s.n], s.used + np.cumsum(length) - length]), np.concatenate([s.count[:s.n], length]))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of each text in them."""
        entry, per, ids, start, count = self.entries(column)
        size = count[entry]
        ends = np.concatenate([[0], np.cumsum(size)])
        return ids[ragged(start[entry], size)], ends[np.concatenate([[0], np.cumsum(per)])]


_KNOWN: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for this file; it stays between tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = ChunkEncoder(path)
    return _KNOWN[path]
