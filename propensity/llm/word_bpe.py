"""Byte-pair encoding and decoding by a pair occurrence index.

A partition's distinct words (up to a bounded amount of text at a time) are one
array of symbols with links to their neighbours. An index maps every pair that
has a rank to all of its places; ranks are applied in ascending order, each to
all of its places at once, and the lists of the pairs that appear are updated.

Defined results: a null or empty text has no ids and decodes to nothing (both
digests are those of the empty string); repeated rows encode alike; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from propensity.llm import textbatch as TB
from propensity.llm.common import doc_text, map_arrow
from propensity.llm.pair_table import NEVER, PairTable

#: Text of a partition that is indexed together, and words remembered by one worker.
INDEX_BYTES = 32 << 20
MAX_WORDS = 250_000

#: What the vocabulary's format prescribes for cutting words; ASCII texts need no Unicode classes.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"


def byte_letters() -> list[str]:
    """The visible character that stands for each byte: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.end = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merged = [self.vocab[a + b] for a, b in pairs]
        if len(set(merged)) < len(merged):
            raise ValueError("two rules make one token: ascending ranks would not be exact")
        self.pair = np.array([(self.vocab[a], self.vocab[b]) for a, b in pairs], dtype=np.int64).reshape(-1, 2)
        self.made = np.array(merged, dtype=np.int64)
        self.table = PairTable(self.pair[:, 0], self.pair[:, 1], np.arange(len(pairs)), self.made)
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], dtype=np.int64)
        self.final = np.array([self.vocab[c + self.end] for c in letters], dtype=np.int64)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.find = regex.compile(WORD_PATTERN).findall
        self.find_ascii = re.compile(ASCII_PATTERN).findall
        self.clear()

    def clear(self) -> None:
        self.ids_of = {t: str(i) for t, i in self.special.items()}       # word -> its ids as text
        self.tokens_of = {t: t for t in self.special}                    # word -> its tokens as text

    # --- words ------------------------------------------------------------------------------------------------

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.find_ascii(text.lower())
        text = unicodedata.normalize("NFC", text)
        return self.find(text.replace("Σ", "σ").lower())      # no final sigma: letters one by one

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is a word of its own."""
        if self.cut_special is None or "<|" not in text:
            return self._plain(text)
        out = []
        for k, piece in enumerate(self.cut_special.split(text)):
            out += [piece] if k % 2 else self._plain(piece)
        return out

    # --- the index --------------------------------------------------------------------------------------------

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        last = np.cumsum(size) - 1
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym = self.inner[data]
        sym[last] = self.final[data[last]]
        n = len(sym)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[last] = -1
        prv[last + 1 - size] = -1
        begin = np.flatnonzero(nxt >= 0)
        ranks, _ = self.table.find(sym[begin], sym[begin + 1])
        places: dict[int, list[np.ndarray]] = {}
        few: dict[int, list[int]] = {}
        queue: list[int] = []

        def note(ranks: np.ndarray, at: np.ndarray) -> None:
            on = ranks != NEVER
            ranks, at = ranks[on], at[on]
            if len(ranks) <= 24:
                for r, p in zip(ranks.tolist(), at.tolist()):
                    if r not in few and r not in places:
                        heapq.heappush(queue, r)
                    few.setdefault(r, []).append(p)
                return
            order = np.argsort(ranks, kind="stable")
            kinds, cut = np.unique(ranks[order], return_index=True)
            for r, group in zip(kinds.tolist(), np.split(at[order], cut[1:])):
                if r not in few and r not in places:
                    heapq.heappush(queue, r)
                places.setdefault(r, []).append(group)

        note(ranks, begin)
        while queue:
            r = heapq.heappop(queue)
            got = places.pop(r, [])
            if r in few:
                got = [*got, np.array(few.pop(r), dtype=np.int64)]
            at = got[0] if len(got) == 1 else np.concatenate(got)
            a, b = self.pair[r]
            after = nxt[at]
            at = at[(sym[at] == a) & (after >= 0) & (sym[after] == b)]
            if not len(at):
                continue
            at = np.unique(at)
            if a == b and len(at) > 1:      # of places that overlap, every second one from the first
                linked = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
                run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = nxt[at]
            after = nxt[gone]
            sym[at], sym[gone] = self.made[r], -1
            nxt[at] = after
            follow = after >= 0
            prv[after[follow]] = at[follow]
            before = prv[at]
            lead = before[before >= 0]
            left, right = np.concatenate([lead, at[follow]]), np.concatenate([nxt[lead], after[follow]])
            if len(left):
                note(self.table.find(sym[left], sym[right])[0], left)
        alive = sym >= 0
        return sym[alive], np.diff(np.concatenate([[0], np.cumsum(alive)[last]])) if len(last) else size

    def learn(self, words: set[str]) -> None:
        """Encode what is not remembered; forget the rest when there is too much."""
        if len(self.ids_of) + len(words) > MAX_WORDS:
            self.clear()
        new = [w for w in words if w not in self.ids_of]
        if not new:
            return
        ids, size = self.merge(new)
        text = [str(i) for i in range(max(self.token) + 1)]
        end = 0
        ids = ids.tolist()
        for w, k in zip(new, size.tolist()):
            own = ids[end:end + k]
            end += k
            self.ids_of[w] = " ".join([text[i] for i in own])
            self.tokens_of[w] = " ".join([self.token[i] for i in own])

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.ids_of[w].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The tokens with a space between; the format names no other decoder."""
        return " ".join(self.token[i] for i in ids if i in self.token)


_KNOWN: dict[str, WordBpe] = {}


def bpe(path: str) -> WordBpe:
    """The worker's encoder for this file; it stays between tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = WordBpe(path)
    return _KNOWN[path]


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded), one row per row of ``docs``."""

    def digest(x: str) -> str:
        return hashlib.sha256(x.encode()).hexdigest()

    def flush(held: list, kinds: list[str], model: WordBpe) -> Iterator[pa.RecordBatch]:
        model.learn(set(kinds))
        ids_of, tokens_of = [model.ids_of[w] for w in kinds], [model.tokens_of[w] for w in kinds]
        for part, rows in held:
            rows = [row.tolist() for row in rows]
            ids = [" ".join([ids_of[k] for k in row]) for row in rows]
            decoded = [" ".join([tokens_of[k] for k in row]) for row in rows]
            out = {"doc_id": part,
                   "n_tokens": pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64()),
                   "ids_sha256": pa.array([digest(x) for x in ids], pa.string()),
                   "decoded_sha256": pa.array([digest(x) for x in decoded], pa.string())}
            if with_ids:
                out["ids"] = pa.array([[int(i) for i in x.split()] for x in ids], pa.list_(pa.int32()))
                out["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_pydict(out)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, size = bpe(path), [], 0
        number: dict[str, int] = {}
        for batch in batches:
            for part in TB.slices(batch):
                rows = []
                for text in part.column("text").to_pylist():
                    words = model.words(text)
                    for w in set(words):
                        number.setdefault(w, len(number))
                    rows.append(np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words)))
                held.append((part.column("doc_id"), rows))
                size += part.column("text").nbytes
                if size >= INDEX_BYTES:
                    yield from flush(held, list(number), model)
                    held, size, number = [], 0, {}
        if held:
            yield from flush(held, list(number), model)

    return map_arrow(doc_text(docs), coded, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                     + (", ids array<int>, decoded string" if with_ids else ""))
