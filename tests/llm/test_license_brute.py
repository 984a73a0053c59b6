"""The licence scan against a plain version that compares every window of every text."""
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from propensity.llm import license_scan as L

from .conftest import ODD
from .test_license_scan import APACHE, PROSE, scan

MIT = dict(L.full_texts())["MIT"]


def brute(texts):
    docs = [set(L.terms(t)) for t in texts]
    vocabulary = {t for text in ("SPDX", *(n[1] for n in L.notices()), *(f[1] for f in L.full_texts())) for t in L.terms(text)}
    rarest = math.log(1 + len(texts)) + 1
    df = Counter(t for d in docs for t in d if t in vocabulary)
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in vocabulary}

    def mass(c):
        return sum(k * idf.get(t, rarest) for t, k in c.items())

    def notice(text):
        own = Counter(L.terms(text))
        norm = math.sqrt(sum((k * idf.get(t, rarest)) ** 2 for t, k in own.items()))
        found = [(0.0, "", 0.0)]
        for name, words, must in L.notices():
            if norm and set(L.terms(must)) <= own.keys():
                c = Counter(L.terms(words))
                dot = sum(k * own[t] * idf[t] ** 2 for t, k in c.items() if t in own)
                cos = dot / norm / math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items()))
                found.append((-round(cos, 9), name, mass(c & own) / mass(own)))
        return min(found, key=lambda x: x[:2])

    out = []
    for text in texts:
        lines = text.split("\n")
        best, whole = (0.0, None), False
        for a in range(len(lines)):
            for b in range(a, min(a + L.WINDOW, len(lines))):
                s, name, _ = notice("\n".join(lines[a:b + 1]))
                if -s >= L.MIN_LINE:
                    best = min(best, (s, name), key=lambda x: (x[0], x[1] or "~"))
        s, name, share = notice(text)
        if -s >= L.MIN_LINE and share >= L.MIN_NOTICE:
            whole, best = True, (best if best[0] <= s else (s, name))
        spdx = [x for x in map(L.spdx_name, lines) if x]
        if spdx:
            best = (-1.0, min(spdx))
        near = 0.0
        own = Counter(L.terms(text))
        for name, words in L.full_texts():
            c = Counter(L.terms(words))
            share, overlap = mass(c & own) / mass(c), round(mass(c & own) / mass(c | own), 9)
            if share >= L.MIN_SHARE and overlap > near:
                near, best, whole = overlap, (-min(share, 1.0), name), mass(c & own) >= L.MIN_TEXT * mass(own)
        out.append((best[1], -best[0], whole))
    return out


HEADERS = [("This program is distributed under the GNU GPL v3.", "GPL-3.0"),
           ("Distributed under the terms of the GNU General Public License v2", "GPL-2.0"),
           ("Use of this source is governed by the Apache 2.0 license", "Apache-2.0"),
           ("Apache 2.0", "Apache-2.0"), ("CC0 1.0 Universal", "CC0-1.0"), ("GPLv3", "GPL-3.0"),
           ("Released under the LGPL, version 2.1", "LGPL-2.1"), ("Mozilla Public License, v. 2.0", "MPL-2.0")]
NOT_HEADERS = ["Version 2.0", "2.0", "the license of poets", "Apache warriors rode in 2.0 waves", "mit", "a general public",
               "This program is distributed under the counter", "BY 4.0"]


def test_headers_need_no_trigger_word(spark):
    rows = [(f"h{k}/x", f"{PROSE}\n// {t}\n{PROSE}") for k, (t, _) in enumerate(HEADERS)]
    rows += [(f"n{k}/x", f"{PROSE}\n{t}\n{PROSE}") for k, t in enumerate(NOT_HEADERS)]
    rows += [(f"p{k}/x", PROSE + f" {k} things") for k in range(30)]
    got = scan(spark, rows)
    for k, (_, name) in enumerate(HEADERS):
        assert got[f"h{k}/x"]["own_license"] == name, (k, got[f"h{k}/x"])
    assert [t for k, t in enumerate(NOT_HEADERS) if got[f"n{k}/x"]["own_license"]] == []
    assert not any(r["license_file"] for r in got.values())


def test_a_licence_file_is_mostly_a_licence(spark):
    apache = dict(L.full_texts())["Apache-2.0"]
    code = "\n".join(f"int value_{k} = compute({k} * {k + 1});" for k in range(20_000))
    prose = "\n".join(f"{PROSE} Chapter {k} of many." for k in range(4_000))
    short = "Rethhand thntnd.\nThis work is licensed under the GNU General Public License, version 3."
    got = scan(spark, [("a/x", prose + "\n" + MIT), ("b/x", code + "\n" + MIT), ("c/x", f"{PROSE}\n{apache}\n{PROSE}"),
                       ("d/x", short), ("e/x", APACHE), ("f/x", MIT), ("g/x", "")])
    assert {p: (r["own_license"], r["license_file"]) for p, r in got.items()} == {
        "a/x": ("MIT", False), "b/x": ("MIT", False), "c/x": ("Apache-2.0", True), "d/x": ("GPL-3.0", False),
        "e/x": ("Apache-2.0", True), "f/x": ("MIT", True), "g/x": (None, False)}


def test_long_window(spark):
    """A header behind blanks that make its lines longer than any fixed window."""
    blank = " " * 5_000
    got = scan(spark, [("x", f"Licensed under{blank}the\n{blank}Apache License,\n{blank} Version 2.0.{blank}\n{PROSE}")])
    assert got["x"]["own_license"] == "Apache-2.0"


def test_brute_force(spark, small):
    texts = [t or "" for _, t in ODD if len(t or "") < 50_000]
    texts += [f"{PROSE}\n{t}\n{PROSE}" for t, _ in HEADERS] + NOT_HEADERS + [MIT, PROSE + "\n" + MIT, MIT + "\n" + MIT]
    texts += [f"{t}\n# SPDX-License-Identifier: MIT" for t, _ in HEADERS[:2]]
    texts += [t.replace(" ", "\n", 2) for _, t in L.TEMPLATES] + [" ".join(t.split()[1:]) for _, t in L.TEMPLATES]
    texts += [r["text"] or "" for r in small.select("text").where("length(text) < 1500").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    got = {r["path"]: r for r in L.similarities(df).collect()}
    for k, (name, s, whole) in enumerate(brute(texts)):
        assert (got[k]["own_license"], got[k]["license_file"]) == (name, whole), (texts[k][:200], got[k], name, s, whole)
        assert got[k]["similarity"] == pytest.approx(s, abs=1.1e-6)
