"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are counted per slice of texts in NumPy; the trees are fitted on
a bounded sample of labelled rows and flattened into arrays, which score every
document by vectorised traversal.

Defined results: a null or empty text has all statistics zero and gets the
score of that row; no usable labels give every row 0.5; labels of one kind
give a constant near it; repeated rows score alike; labels that are null are
not learnt from, and a doc_id with several labels counts with the lowest.
Only ``text`` enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.common import doc_text, held_out, map_arrow
from propensity.llm.hist_gbt import FlatTrees, constant, fit
from propensity.llm.line_rules import TERMINAL, base_counts

#: At most about so many labelled documents are learnt from, chosen by a hash of their id.
MAX_LABELLED = 20_000
THRESHOLD = 0.7

FEATURES = ("log_words", "word_length", "symbol_share", "upper_share", "digit_share", "mark_share", "shout_share",
            "bar_share", "non_ascii_share", "distinct_share", "top_word_share", "twin_share", "repeat_share",
            "dup_line_share", "line_words", "closed_line_share", "long_word_share", "number_word_share")

_SETS = {"upper": TB.byte_set(bytes(range(65, 91))), "letter": TB.byte_set(bytes([*range(65, 91), *range(97, 123)])),
         "digit": TB.byte_set(b"0123456789"), "mark": TB.byte_set(b".,;:!?"), "shout": TB.byte_set(b"!"),
         "bar": TB.byte_set(b"|")}


def statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of FEATURES per document of a slice."""
    n = len(offsets) - 1
    base = base_counts(offsets, data)
    starts, ends, code, doc = base["_starts"], base["_ends"], base["_code"], base["_word_doc"]
    nw = base["n_words"]
    by = np.maximum(nw, 1)
    chars = np.maximum(base["word_chars"], 1)
    got = {k: TB.per_doc(v[data], offsets) for k, v in _SETS.items()}
    size = ends - starts
    key = doc * (code.max() + 1 if len(code) else 1) + code
    kinds, times = np.unique(key, return_counts=True)
    kind_doc = kinds // (code.max() + 1 if len(code) else 1)
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, kind_doc, times)
    twin = np.zeros(len(code), dtype=bool)
    twin[1:] = key[1:] == key[:-1]
    of = lambda flags: np.bincount(doc, weights=flags, minlength=n)
    ls, le, ld = TB.lines(offsets, data)
    word_end = np.searchsorted(ends, le, side="right")
    has = word_end > np.searchsorted(starts, ls)
    closed = TERMINAL[data[ends[word_end[has] - 1] - 1]] if len(ends) else np.zeros(0)
    n_lines = np.maximum(np.bincount(ld[has], minlength=n), 1)
    digit_word = _SETS["digit"][data[starts]] if len(starts) else np.zeros(0)
    return np.stack([
        np.log1p(nw), base["word_chars"] / by, base["n_symbols"] / chars, got["upper"] / np.maximum(got["letter"], 1),
        got["digit"] / chars, got["mark"] / chars, got["shout"] / by, got["bar"] / by,
        TB.per_doc(data >= 128, offsets) / np.maximum(np.diff(offsets), 1), np.bincount(kind_doc, minlength=n) / by,
        top / by, of(twin) / by, base["n_repeat_words"] / by, base["n_dup_lines"] / n_lines, nw / n_lines,
        np.bincount(ld[has], weights=closed, minlength=n) / n_lines, of(size > 20) / by, of(digit_word) / by], axis=1)


def _slice_statistics(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for part in TB.slices(batch):
        yield part, statistics(*TB.utf8(part.column("text")))


def _features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part, x in _slice_statistics(batch):
            yield pa.RecordBatch.from_pydict({"label": part.column("label"),
                                              **{f: pa.array(x[:, j]) for j, f in enumerate(FEATURES)}})


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Statistics and label of the rows learnt from: held-out ids never, the ``max_labelled`` first in the order of a hash of the id."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    chosen = doc_text(docs).join(F.broadcast(sample), "doc_id")     # max_labelled rows of 12 bytes
    return map_arrow(chosen.select("label", "text"), _features,
                     "label int, " + ", ".join(f"{f} double" for f in FEATURES))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> FlatTrees:
    rows = training_rows(docs, labels, max_labelled).toPandas()
    if not len(rows):
        return constant(0.5)
    rows = rows.sort_values(list(rows.columns))                     # the order of arrival does not matter
    return fit(rows[list(FEATURES)].to_numpy(float), rows["label"].clip(0, 1).to_numpy(float))


def score(docs: DataFrame, model: FlatTrees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of ``docs``."""

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part, x in _slice_statistics(batch):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(model.score(x))})

    out = map_arrow(doc_text(docs), scored, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns."""
    model = train(docs, labels)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    given = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields)
    text = names["text"]

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in TB.slices(batch, text):
                x = statistics(*TB.utf8(part.column(text)))
                yield part.filter(pa.array(model.score(x) >= threshold))

    return map_arrow(given, keep, kinds).toDF(*docs.columns)
