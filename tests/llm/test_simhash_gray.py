import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from propensity.llm import simhash_gray as S

from .conftest import pairs


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """rows: (doc_id, fingerprint); the smallest reachable id of each row."""
    fps = list({f for _, f in rows})
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    arr = np.array(fps, dtype=np.uint64)
    for f in fps:
        for k in np.flatnonzero(np.bitwise_count(arr ^ np.uint64(f)) <= 2):
            a, b = find(f), find(fps[k])
            if a != b:
                up[a] = b
    low = {}
    for i, f in rows:
        r = find(f)
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    return [(i, f, low[find(f)]) for i, f in rows]


def sort(rows):
    return sorted(rows, key=str)


def test_equals_brute_force(small, odd, clash):
    for df in (small, odd, clash):
        want = plain_components([(i, plain_print(t)) for i, t in pairs(df)])
        got = [(r[0], int(r[1], 16), r[2]) for r in S.near_duplicates(df).collect()]
        assert sort(got) == sort(want)


@pytest.mark.parametrize("leaf", [8, 64])
def test_links_of_clustered_fingerprints(spark, leaf, monkeypatch):
    monkeypatch.setattr(S, "LEAF", leaf)
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = set()
    for c in centres:
        for _ in range(60):
            v = c
            for _ in range(rng.randrange(7)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    rows = list(enumerate(sorted(values, key=lambda v: v * 2654435761 % 1000003)))
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in rows]
    got = S.link_components(spark.createDataFrame(signed, "doc_id long, fp long")).collect()
    assert sort((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == sort(plain_components(rows))


def test_gray_order(spark):
    n = spark.range(256).withColumn("g", F.expr("id ^ shiftright(id, 1)"))
    assert n.orderBy(S.gray_rank(F.col("g"))).agg(F.collect_list("id")).first()[0] == list(range(256))


def test_one_document_of_each_group_stays(small, odd, none):
    assert S.representatives(none).count() == 0
    for df in (small, odd):
        want = {c for _, _, c in plain_components([(i, plain_print(t)) for i, t in pairs(df)])}
        got = S.representatives(df)
        assert got.columns == df.columns and sort(r["doc_id"] for r in got.collect()) == sort(want)
