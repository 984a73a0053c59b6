from propensity.llm.pii_boost import KINDS, _merged, all_spans, redacted


def test_overlapping_spans_become_one(spark):
    from pyspark.sql import functions as F
    rows = [(1, [(0, 2, 5), (3, 1, 9), (9, 4, 12)]), (2, []), (3, [(4, 3, 20), (5, 1, 7), (8, 1, 30), (30, 2, 31)])]
    df = spark.createDataFrame(rows, "k long, s array<struct<start:int,kind_no:int,end:int>>")
    got = {r["k"]: [tuple(x) for x in r["m"]] for r in df.select("k", _merged(F.col("s")).alias("m")).collect()}
    assert got == {1: [(0, 2, 9), (9, 4, 12)], 2: [], 3: [(4, 3, 30), (30, 2, 31)]}


def test_redaction_equals_plain_cutting(odd, small):
    for df in (odd, small):
        df = df.where("doc_id is not null").dropDuplicates(["doc_id"])
        spans = {}
        for r in all_spans(df).where("start is not null").collect():
            spans.setdefault(r["doc_id"], []).append((r["start"], r["kind_no"], r["end"]))
        want = {}
        for r in df.collect():
            text, out, at, runs = r["text"], "", 0, []
            for a, k, b in sorted(set(spans.get(r["doc_id"], []))):
                if runs and a < runs[-1][2]:
                    runs[-1] = (*runs[-1][:2], max(b, runs[-1][2]))
                else:
                    runs.append((a, k, b))
            for a, k, b in runs:
                out, at = f"{out}{text[at:a]}[{KINDS[k - 1].upper()}]", b
            want[r["doc_id"]] = out + text[at:] if runs else text
        assert {r["doc_id"]: r["text"] for r in redacted(df).collect()} == want
