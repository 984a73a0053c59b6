"""Fingerprints and personal data: brute force, planted cases, and plans without Python."""
import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from propensity.llm import cws_fingerprint as C
from propensity.llm import pii_boost as I

from .conftest import pairs


def sort(rows):
    return sorted(rows, key=str)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fingerprints ---------------------------------------------------------------------------------------------

def edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    return [(i, t, t[:len(t) - len(t) // 2] + rows[(k + 1) % len(rows)][1][:len(t) // 2], rows[(k + 1) % len(rows)][1])
            for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("size", [500, 3])
def test_edited_texts(small, odd, clash, none, size, monkeypatch):
    monkeypatch.setattr(C.dealt, "__defaults__", (size,))
    for df in (small, odd, clash, none):
        got = C.fingerprints(df, 4).select("doc_id", "n_chars", "edited_sha256").collect()
        assert sort(map(tuple, got)) == sort((i, len(t), sha(e)) for i, t, e, _ in edited(pairs(df)))


def jaccard(a, b):
    a, b = (Counter(re.split(r"[ \t\n\x0b\f\r]+", x.lower())) for x in (a, b))
    for c in (a, b):
        c.pop("", None)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_generalised_jaccard(small):
    rows = edited(pairs(small))
    want = {i: (jaccard(t, e), jaccard(t, n)) for i, t, e, n in rows}
    got = C.fingerprints(small, 128).select("doc_id", "near_edited", "near_next").collect()
    err = np.array([[r[1] - want[r[0]][0], r[2] - want[r[0]][1]] for r in got])
    assert np.abs(err.mean(0)).max() < 0.01 and (err ** 2).mean() ** 0.5 < 0.045


def test_equal_texts_have_equal_fingerprints(odd):
    rows = C.fingerprints(odd).collect()
    assert all(len(r["fingerprint"]) == 4 * C.SAMPLES and 0 <= r["near_edited"] <= 1 for r in rows)
    by = {}
    for (i, t, *_), r in zip(edited(pairs(odd)), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))):
        if i is not None:
            by.setdefault(t.split().__str__().lower(), set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by.values()) and len(by) > 8


# --- personal data --------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    double = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in double)) % 10 == 0


def base(text):
    out = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), no, m.end(), kind))
    return sorted(out)


TRICKY = ["a@b.c_x@d.e.f g@h", "x@y.z.", ".@a.b", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.4 1.2.3", "00000000255.1.1.1",
          "99999999999999999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111",
          "12--4111111111111111", "1-4111111111111111", "4111111111111111 4111111111111111", "+1 (269) 555-3296",
          "+1 (269) 555-3296 4524132264652876", "++12345678901 +", "+1)))(((234567890", "é+49 30 1234567.", "a" * 5000,
          "9" * 5000, "a@" * 800, "1." * 900, "- 5 " * 600, "a@b" + ".c" * 3000, "x@y.z x@y.z", "日本 a@b.jp 日本 10.0.0.1"]


def test_base_spans_equal_plain_regex(spark, small, odd, clash, none):
    tricky = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for df in (tricky, small, odd, clash, none):
        want = []
        for i, t in pairs(df):
            spans = base(t)
            n = Counter(s[3] for s in spans)
            text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
            want.append((i, *[n[k] for k in PATTERNS], sha(text), text))
        got = I.personal_data(df).collect()
        assert sort(tuple(r)[:6] for r in got) == sort(w[:6] for w in want)
        if df is not small:
            continue
        all_of = {r["doc_id"]: r["spans"].split(",") for r in got}
        assert all(set(w[6].split(",")) <= set(all_of[w[0]]) for w in want if w[6])


def test_adds_what_base_patterns_lose_in_each_other(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    phone, card = "+1 (269) 555-3296", "4524132264652876"
    text = f"Call or pay: {phone} {card} and nothing else."
    plus = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**9, text), (10**9 + 1, "Just 12 of 34567 in 1999, v4.0.1, no. 5-66.")],
                              "doc_id long, text string"))
    rows = {r["doc_id"]: r for r in I.personal_data(plus).where(f"doc_id >= {10**9}").collect()}
    a, b = text.index(phone), text.index(card)
    assert rows[10**9]["spans"] == f"phone:{a}:{a + len(phone)},card:{b}:{b + len(card)}"
    assert rows[10**9]["n_card"] == rows[10**9]["n_phone"] == 0 and rows[10**9 + 1]["spans"] == ""


def test_redaction(spark, odd, clash, none, small):
    for df in (odd, clash, none, small):
        out = I.redacted(df)
        assert out.columns == df.columns and out.count() == df.count()
        bare = {t for _, t in pairs(df) if not base(t)}
        assert bare >= {t for _, t in pairs(out) if "[" not in t}
    text = "mail a@b.example.com, or 10.0.0.1"
    df = spark.createDataFrame([(1, text, 7), (1, text, 7), (2, None, 0), (3, "no", 2)],
                               "doc_id long, text string, n_chars long")
    want = "mail [EMAIL], or [IP]"
    assert sort(map(tuple, I.redacted(df).collect())) == sort(
        [(1, want, len(want))] * 2 + [(2, None, None), (3, "no", 2)])


def test_plans_hold_no_python(small):
    for df in (C.fingerprints(small), I.personal_data(small), I.redacted(small)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian", plan)
