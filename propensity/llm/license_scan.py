"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest licensed directory.

Every line of every text, alone and with its neighbours (a wrapped header), is
compared as a sparse TF-IDF vector (words and pairs of words) with the notices.
A cosine of ``min_line`` needs ``min_line`` squared of a notice's squared
weight, so lines that hold less of every notice need no vector; nothing else
decides what is compared. A notice made from a licence's name counts only where
the whole name stands. Every text is also held against the full licences in
``licenses/``, each term counted as often as both have it: it contains one if
it holds ``MIN_SHARE`` of its weight, and of several the one that overlaps most
(shared weight over the weight of both). Document frequencies of the templates'
terms are counted over all texts; a term outside the templates weighs like the
rarest. A file has the licence that it contains in full, else the one that an
SPDX line names, else that of its best line. A text is a licence file if a full
licence makes up ``MIN_TEXT`` of its weight, or a notice ``MIN_NOTICE`` of it:
it speaks for its directory, and files without a licence of their own take that
of the nearest directory above them, found by joining paths.

Defined results: a null or empty text has no licence of its own and may
inherit one; a null path is the root's; of equal similarities the first licence
name counts; repeated rows give equal rows; an empty table gives an empty
result; columns other than the path, ``text`` and those to keep are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm import textbatch as TB
from propensity.llm.common import map_arrow, saved

MIN_LINE = 0.6
#: Share of a full licence's weight that its text must hold.
MIN_SHARE = 0.75
#: Share of a licence file's weight that is a full licence, or a notice.
MIN_TEXT = 0.5
MIN_NOTICE = 0.8
#: Lines of a wrapped header.
WINDOW = 4

#: Short notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
)
#: How licences are called in headers, and the sentences that name them.
FAMILIES = (("GPL", ("2", "3"), ("GPL", "GNU GPL", "GNU General Public License")),
            ("LGPL", ("2.1", "3"), ("LGPL", "GNU LGPL", "GNU Lesser General Public License")),
            ("Apache", ("2.0",), ("Apache", "Apache License", "Apache Software License")),
            ("MPL", ("1.1", "2.0"), ("MPL", "Mozilla Public License")))
VERSIONS = ("{} {}", "{} v{}", "{}, version {}", "{}, v. {}", "{}v{}")
CALLED = (("MIT", "MIT License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
          ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("CC-BY-4.0", "CC BY 4.0"),
          ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"))
SENTENCES = ("{}", "Licensed under the {}", "Released under the {}", "Distributed under the terms of the {}",
             "This program is distributed under the {}", "Use of this source is governed by the {} license")
SPDX = re.compile(r"(?<![A-Za-z0-9])SPDX-License-Identifier:[ \t]*([^\r\n]+)", re.I)
LICENCE_NAMES = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"

_WORDS = re.compile("[A-Za-z0-9]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = TB.byte_set(bytes([*range(48, 58), *range(97, 123)]))


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    """(name, text) of the full licences."""
    return tuple((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licenses").glob("*.txt")))


def spdx_name(line: str) -> str | None:
    """The licence of an SPDX line; the first by name where it lists several."""
    found = SPDX.search(line)
    names = re.findall(r"[A-Za-z0-9][A-Za-z0-9.+-]*", re.sub(r"\bWITH\s+\S+", " ", found.group(1))) if found else []
    names = [re.sub(r"(-only|-or-later|\+)$", "", n) for n in names if n not in ("AND", "OR")]
    return min((_SPDX_NAMES.get(n.lower(), n) for n in names), default=None)


def terms(text: str) -> list[str]:
    """Words and pairs of neighbouring words."""
    words = [w.lower() for w in _WORDS.findall(text)]       # ASCII, as the counts are
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


_SPDX_NAMES = {name.lower(): name for name, _ in (*TEMPLATES, *full_texts())}


def _word_codes(data: np.ndarray, offsets: np.ndarray, known: dict[bytes, int]):
    """Words of a slice: starts, words per document, and the number in ``known`` of each (else -1)."""
    starts, ends, counts = TB.words(offsets, data, _ALNUM)
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    if not len(starts):
        return starts, counts, np.zeros(0, dtype=np.int64)
    coded = TB.strings(at, data[_ALNUM[data]]).dictionary_encode()
    number = np.array([known.get(w, -1) for w in coded.dictionary.to_pylist()], dtype=np.int64)
    return starts, counts, number[coded.indices.to_numpy()]


@cache
def notices() -> tuple[tuple[str, str, str], ...]:
    """(name, text, what must stand whole): the templates, and every name in every sentence."""
    called = [(f"{kind}-{v if '.' in v else v + '.0'}", form.format(family, v))
              for kind, versions, families in FAMILIES for v in versions for family in families for form in VERSIONS]
    return (*((name, text, "") for name, text in TEMPLATES),
            *((name, sentence.format(c), c) for name, c in (*CALLED, *called) for sentence in SENTENCES))


@cache
def vocabulary() -> tuple[list[str], dict[bytes, int], np.ndarray]:
    """The templates' terms (words, then pairs), numbers of the words, and numbers of the pairs by their words."""
    every = sorted({t for text in ("SPDX", *(n[1] for n in notices()), *(f[1] for f in full_texts())) for t in terms(text)})
    words = {w.encode(): k for k, w in enumerate(t for t in every if " " not in t)}
    pairs = [t for t in every if " " in t]
    pair = np.full((len(words), len(words)), -1, dtype=np.int32)
    for k, t in enumerate(pairs):
        a, b = t.split(" ")
        pair[words[a.encode()], words[b.encode()]] = len(words) + k
    return [w.decode() for w in words] + pairs, words, pair


def _term_codes(offsets: np.ndarray, data: np.ndarray):
    """For every word of a slice: start, document, its number, and that of its pair with the text's next word (else -1)."""
    _, words, pair = vocabulary()
    starts, counts, number = _word_codes(_LOWER[data], offsets, words)
    doc = np.repeat(np.arange(len(counts)), counts)
    two = np.full(len(number), -1, dtype=np.int64)
    at = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0) & (doc[:-1] == doc[1:]))
    two[at] = pair[number[at], number[at + 1]]
    return starts, doc, number, two


def _counted(group: np.ndarray, number: np.ndarray, two: np.ndarray, n_terms: int):
    """(group, term, times) of every term of the vocabulary in every group of words."""
    key = np.concatenate([(group * n_terms + term)[term >= 0] for term in (number, two)])
    key, times = np.unique(key, return_counts=True)
    return key // n_terms, key % n_terms, times


def document_frequencies(files: DataFrame) -> tuple[dict[str, int], int]:
    """In how many texts each term of the templates occurs, and the number of texts. Bounded by the templates."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = vocabulary()[0]
        total, n = np.zeros(len(names), dtype=np.int64), 0
        for batch in rows:
            for part in TB.slices(batch):
                _, doc, number, two = _term_codes(*TB.utf8(part.column("text")))
                total += np.bincount(_counted(doc, number, two, len(names))[1], minlength=len(names))
                n += part.num_rows
        yield pa.RecordBatch.from_pydict({"term": pa.array([*names, ""]), "df": pa.array([*total.tolist(), n])})

    got = map_arrow(files.select("text"), count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = {r["term"]: r["df"] for r in got.collect()}      # the terms of the templates, whatever the input
    return {t: found.get(t, 0) for t in vocabulary()[0]}, found.get("", 0)


class Scanner:
    """The templates as vectors under one corpus' term weights."""

    def __init__(self, df: dict[str, int], n: int, min_line: float):
        self.names = vocabulary()[0]
        self.at = {t: k for k, t in enumerate(self.names)}
        self.rarest, self.min_line = float(np.log(1 + n) + 1), min_line
        self.idf = np.array([np.log((1 + n) / (1 + df[t])) + 1 for t in self.names])
        self.kinds = np.array([name for name, _, _ in notices()])
        self.times = np.zeros((len(self.kinds), len(self.names)), dtype=np.int32)
        self.must = np.zeros((len(self.kinds), len(self.names)), dtype=bool)
        for k, (_, text, whole) in enumerate(notices()):
            for t, c in Counter(terms(text)).items():
                self.times[k, self.at[t]] = c
            self.must[k, [self.at[t] for t in terms(whole)]] = True
        raw = self.times * self.idf
        self.models = raw / np.sqrt((raw ** 2).sum(axis=1))[:, None]
        self.most = (self.models ** 2).max(axis=0)          # of a term's squared weight in any notice
        self.often = self.times.max(axis=0)
        self.full = []
        for name, text in full_texts():
            c = np.zeros(len(self.names))
            for t, k in Counter(terms(text)).items():
                c[self.at[t]] = k
            self.full.append((name, c, float((c * self.idf).sum())))

    def best(self, text: str) -> tuple[float, str | None, float]:
        """(cosine, name, share of the text's weight) of the most similar notice; the first name of equals."""
        own = Counter(terms(text))
        known = [t for t in own if t in self.at]
        at, n = np.array([self.at[t] for t in known], dtype=np.int64), np.array([own[t] for t in known], dtype=np.float64)
        weight = n * self.idf[at]
        beyond = [c * self.rarest for t, c in own.items() if t not in self.at]
        norm = float(((weight ** 2).sum() + sum(b * b for b in beyond)) ** 0.5)
        if not norm:
            return 0.0, None, 0.0
        score = np.round(self.models[:, at] @ weight / norm, 9)
        score[self.must[:, at].sum(axis=1) < self.must.sum(axis=1)] = 0.0
        k = min(np.flatnonzero(score == score.max()).tolist(), key=lambda i: self.kinds[i])
        held = float((np.minimum(n, self.times[k, at]) * self.idf[at]).sum())
        return float(score[k]), str(self.kinds[k]), held / float(weight.sum() + sum(beyond))

    def windows(self, ls, le, ld, starts, number, two) -> Iterator[tuple[int, int]]:
        """First and last line of every window that may reach ``min_line``; ends without a notice's term add nothing."""
        seen = [np.where((x >= 0) & (self.most[x] > 0), x, -1) for x in (number, two)]
        line, term, _ = _counted(np.searchsorted(ls, starts, side="right") - 1, *seen, len(self.names))
        held = np.bincount(line, self.most[term], minlength=len(ls))
        total = np.concatenate([[0.0], np.cumsum(held)])
        for more in range(min(WINDOW, len(ls))):
            a = np.arange(len(ls) - more)
            b = a + more
            on = (ld[a] == ld[b]) & (held[a] > 0) & (held[b] > 0) & (total[b + 1] - total[a] >= self.min_line ** 2 - 1e-6)
            yield from zip(a[on].tolist(), b[on].tolist())

    def scan(self, column: pa.Array):
        """(names, similarities, licence files) of a slice's texts."""
        offsets, data = TB.utf8(column)
        n_docs, n_terms, raw = len(offsets) - 1, len(self.names), data.tobytes()
        starts, doc, number, two = _term_codes(offsets, data)
        ls, le, ld = TB.lines(offsets, data)
        name: list[str | None] = [None] * n_docs
        score, whole = np.zeros(n_docs), np.zeros(n_docs, dtype=bool)
        seen: dict[bytes, tuple[float, str | None, float]] = {}
        for a, b in self.windows(ls, le, ld, starts, number, two):
            d, text = int(ld[a]), raw[ls[a]:le[b]]
            if text not in seen:
                seen[text] = self.best(text.decode())
            s, kind, _ = seen[text]
            if s >= self.min_line and (s > score[d] or (s == score[d] and kind < name[d])):
                score[d], name[d] = s, kind
        # texts that are little else than a notice
        d, t, times = _counted(doc, number, two, n_terms)
        weight = times * self.idf[t]
        tokens = np.maximum(2 * np.bincount(doc, minlength=n_docs) - 1, 0)
        known = np.bincount(d, weights=times, minlength=n_docs)
        total = np.bincount(d, weights=weight, minlength=n_docs) + (tokens - known) * self.rarest
        short = np.bincount(d, weights=np.minimum(times, self.often[t]) * self.idf[t], minlength=n_docs)
        for k in np.flatnonzero((tokens > 0) & (short >= MIN_NOTICE * total - 1e-6)).tolist():
            s, kind, share = self.best(raw[offsets[k]:offsets[k + 1]].decode())
            if s >= self.min_line and share >= MIN_NOTICE:
                whole[k] = True
                if s > score[k]:
                    score[k], name[k] = s, kind
        # SPDX lines
        named: dict[int, str] = {}
        spdx = np.searchsorted(ls, starts[number == self.at["spdx"]], side="right") - 1
        for k in np.unique(spdx).tolist():
            if (kind := spdx_name(raw[ls[k]:le[k]].decode())) is not None:
                named[int(ld[k])] = min(kind, named.get(int(ld[k]), kind))
        for k, kind in named.items():
            score[k], name[k] = 1.0, kind
        # full licences
        near = np.zeros(n_docs)
        for kind, c, all_of in self.full:
            both = np.bincount(d, weights=np.minimum(times, c[t]) * self.idf[t], minlength=n_docs)
            overlap = np.round(both / (total + all_of - both), 9)
            for k in np.flatnonzero((both >= MIN_SHARE * all_of) & (overlap > near)).tolist():
                near[k], name[k], score[k] = overlap[k], kind, min(both[k] / all_of, 1.0)
                whole[k] = both[k] >= MIN_TEXT * total[k]
        return name, score, whole


def similarities(files: DataFrame, min_line: float = MIN_LINE) -> DataFrame:
    """``files`` (path, text, others) without its text, with own_license, similarity and license_file."""
    df, n = document_frequencies(files)
    rest = [c for c in files.columns if c != "text"]

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(df, n, min_line)
        for batch in rows:
            for part in TB.slices(batch):
                name, score, whole = scanner.scan(part.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {c: part.column(c) for c in rest} | {"own_license": pa.array(name, pa.string()),
                                                         "similarity": pa.array(np.round(score, 6)),
                                                         "license_file": pa.array(whole)})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.select(*rest).schema.fields)
    return map_arrow(files, scan, f"{kinds}, own_license string, similarity double, license_file boolean")


def directory(path: Column) -> Column:
    return F.regexp_replace(F.coalesce(path, F.lit("")), "/?[^/]*$", "")


def inherit(scanned: DataFrame) -> DataFrame:
    """``scanned`` (path, own_license, similarity, license_file) with license and inherited_from.

    A directory's licence is that of its most similar licence file, or file
    with a licence file's name.
    """
    files = scanned.withColumn("dir", directory(F.col("path")))
    speaks = F.col("license_file") | F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_NAMES)
    declared = (files.where(speaks & F.col("own_license").isNotNull()).groupBy("dir", "own_license")
                .agg(F.max("similarity").alias("s")).groupBy("dir")
                .agg(F.min(F.struct((-F.col("s")).alias("s"), "own_license")).alias("best"))
                .select(F.col("dir").alias("above"), F.col("best.own_license").alias("given")))
    # every directory with all that lie above it: itself, its parents, the root ("")
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))),
                        lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    dirs = files.select("dir").distinct().select("dir", F.posexplode(above).alias("depth", "above"))
    nearest = (dirs.join(declared, "above").groupBy("dir")
               .agg(F.max(F.struct("depth", "above", "given")).alias("near")).select("dir", "near.above", "near.given"))
    out = files.join(nearest, "dir", "left")
    takes = F.col("own_license").isNull()
    return (out.withColumn("license", F.coalesce("own_license", "given"))
            .withColumn("inherited_from", F.when(takes, F.col("above"))).drop("dir", "above", "given"))


def license_scan(docs: DataFrame, path: Column, *keep: str) -> DataFrame:
    """``keep``, path, own_license, similarity, license_file, license, inherited_from; one row per row of ``docs``."""
    files = docs.select(*[F.col(c) for c in keep], path.cast("string").alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return inherit(saved(similarities(files), "licences"))
