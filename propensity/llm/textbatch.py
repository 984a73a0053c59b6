"""Vectorised views of a batch of UTF-8 texts.

A batch is one byte array plus document offsets, so words, lines and windows
are NumPy index arithmetic. Batches are cut into slices of a few MB (a longer
single text is a slice of its own), which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

#: White space that separates words, the symbols that are counted.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOL_BYTES = b"#*$%&|<>"


def byte_set(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


IS_WORD = ~byte_set(SPACE_BYTES)
IS_SYMBOL = byte_set(SYMBOL_BYTES)
IS_HEAD = (np.arange(256) & 0xC0) != 0x80          # first byte of a code point


def slices(batch: pa.RecordBatch, column: str = "text", target: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``target`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    cell = np.cumsum(sizes.astype(np.int64)) // target
    edges = np.flatnonzero(np.diff(cell)) + 1
    start = 0
    for stop in [*edges.tolist(), batch.num_rows]:
        if stop > start:
            yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (documents + 1) and bytes of a string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw


def strings(offsets: np.ndarray, data: np.ndarray, kind=None) -> pa.Array:
    return pa.Array.from_buffers(kind or pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data))])


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def words(offsets: np.ndarray, data: np.ndarray, is_word: np.ndarray = IS_WORD):
    """(starts, ends, words per document): maximal runs of word bytes within a document."""
    inside = is_word[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        before[offsets[:-1][offsets[:-1] < len(inside)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets, side="left"))
    return starts, ends, counts


def codes(array: pa.Array) -> np.ndarray:
    """Equal values get equal small integers."""
    if not len(array):
        return np.zeros(0, dtype=np.int64)
    return array.dictionary_encode().indices.to_numpy().astype(np.int64)


def word_codes(starts: np.ndarray, ends: np.ndarray, data: np.ndarray, is_word: np.ndarray = IS_WORD) -> np.ndarray:
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    return codes(strings(at, data[is_word[data]]))


def cuts(offsets: np.ndarray, cut: np.ndarray):
    """(starts, ends, document) of what lies between the bytes flagged in ``cut``; never across documents."""
    breaks = np.flatnonzero(cut)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    per = 1 + np.diff(np.searchsorted(breaks, offsets, side="left"))
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), per)


def lines(offsets: np.ndarray, data: np.ndarray):
    """(starts, ends, document) of the \\n-split lines."""
    return cuts(offsets, data == 10)


def line_codes(starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    return codes(strings(at, data[data != 10]))


def repeated_window_words(doc: np.ndarray, code: np.ndarray, n_docs: int, width: int = 8) -> np.ndarray:
    """Words per document that lie in a ``width``-word window found twice or more in it.

    Exact: windows get names by doubling (names of one word in its document,
    then of pairs of names), and only names that occur again go on.
    ``width`` is a power of two.
    """
    n = len(code)
    out = np.zeros(n_docs, dtype=np.int64)
    if n < width:
        return out
    at = np.arange(n)
    _, name, times = np.unique(doc * (code.max() + 1) + code, return_inverse=True, return_counts=True)
    full = np.where(times[name] > 1, name, -1)
    span = 1
    while span < width:
        at = np.flatnonzero(full[:n - span] >= 0) if span < n else np.zeros(0, np.int64)
        at = at[full[at + span] >= 0]
        nxt = np.full(n, -1, dtype=np.int64)
        if len(at):
            _, name, times = np.unique(full[at] * n + full[at + span], return_inverse=True, return_counts=True)
            again = times[name] > 1
            nxt[at[again]] = name[again]
        full, span = nxt, 2 * span
    hit = np.flatnonzero(full >= 0)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n_docs)[:n_docs].astype(np.int64)
