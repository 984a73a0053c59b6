from pyspark.sql import functions as F

from propensity.llm import license_scan as L

from .conftest import ODD

APACHE = "Licensed under the Apache License, Version 2.0."
PROSE = "Some words of prose that have nothing to say about it, line after line, and on they go."


def scan(spark, rows, keep=()):
    df = spark.createDataFrame(rows, "path string, text string")
    return {r["path"]: r for r in L.license_scan(df, F.col("path")).collect()}


def test_headers_files_and_inheritance(spark):
    got = scan(spark, [
        ("a/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("a/x.txt", PROSE), ("a/b/c/y.txt", PROSE), ("a/b/own.txt", f"{PROSE}\n{APACHE}\n{PROSE}"),
        ("a/b/c/d/NOTICE", f"{PROSE}\nReleased under the MIT License."), ("a/b/c/d/e/z.txt", PROSE), ("q/z.txt", PROSE),
        ("top.txt", PROSE), (None, None), ("a/b/c/d/empty", "")])
    of = {p: (r["own_license"], r["license"], r["inherited_from"]) for p, r in got.items()}
    assert of == {"a/LICENSE": ("GPL-3.0", "GPL-3.0", None), "a/x.txt": (None, "GPL-3.0", "a"),
                  "a/b/c/y.txt": (None, "GPL-3.0", "a"), "a/b/own.txt": ("Apache-2.0", "Apache-2.0", None),
                  "a/b/c/d/NOTICE": ("MIT", "MIT", None), "a/b/c/d/e/z.txt": (None, "MIT", "a/b/c/d"),
                  "q/z.txt": (None, None, None), "top.txt": (None, None, None), None: (None, None, None),
                  "a/b/c/d/empty": (None, "MIT", "a/b/c/d")}
    assert got["a/LICENSE"]["license_file"] and not got["a/b/own.txt"]["license_file"]


def test_root_licence_reaches_everything(spark):
    got = scan(spark, [("COPYING", APACHE), ("a/b/x", PROSE), ("y", "")])
    assert {p: (r["license"], r["inherited_from"]) for p, r in got.items()} == {
        "COPYING": ("Apache-2.0", None), "a/b/x": ("Apache-2.0", ""), "y": ("Apache-2.0", "")}


def test_every_template_finds_itself_and_frequencies_are_counted(spark):
    got = scan(spark, [(f"{k}/x", f"{PROSE}\n{t}\n{PROSE}") for k, (_, t) in enumerate(L.TEMPLATES)])
    for k, (name, _) in enumerate(L.TEMPLATES):
        assert got[f"{k}/x"]["own_license"] == name and got[f"{k}/x"]["similarity"] > 0.99
    texts = [t or "" for _, t in ODD] + [t for _, t in L.TEMPLATES]
    df, n = L.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = [set(L.terms(t)) for t in texts]
    assert n == len(texts) and all(v == sum(t in w for w in want) for t, v in df.items())


def test_documents(small, odd, clash, none):
    import re
    for df in (small, odd, clash, none):
        got = L.license_scan(df, F.col("doc_id").cast("string"), "doc_id").collect()
        assert len(got) == df.count()
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        for r in got:
            line = re.search(r"^(Licensed under|Released under|This work is licensed)[^\n]*\.$", texts[r["doc_id"]], re.M)
            assert bool(line) == (r["own_license"] is not None)
