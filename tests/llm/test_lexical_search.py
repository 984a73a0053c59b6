import math
import re
from collections import Counter

import numpy as np
import pytest

from propensity.llm import lexical_search as L
from propensity.llm.queries import ORACLES, QUERIES

from .conftest import pairs

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def plain(docs, items, k=20):
    """Every score of every document, in Python integers."""
    counted = [(i, Counter(tokens(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 75 + (25 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in tokens(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        scored.sort(key=lambda x: x[:3])
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def table(spark, items):
    return spark.createDataFrame([(i, t, 1, 2.0, "s") for i, t in items],
                                 "item_id long, text string, rank int, score double, doc_id string")


def test_whole_table_equals_brute_force(spark, small):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = plain(pairs(small), [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows(L.search(small, items)) == want
    assert rows(L.search(small.repartition(9), items)) == want == rows(QUERIES["op11_lexical_search"](spark, SMALL))


@pytest.mark.parametrize("blocks, share", [(7, 0.0), (16, 1.0), (4, 0.05)])
def test_skipping_loses_nothing(spark, small, monkeypatch, blocks, share):
    """Small blocks of documents and only long, only short, or both kinds of lists."""
    monkeypatch.setattr(L, "BLOCK_DOCS", blocks)
    monkeypatch.setattr(L, "SHORT_SHARE", share)
    texts = [(i, t) for i, t in pairs(small)]
    items = [(1, texts[3][1][:200]), (2, "the of the and the"), (3, texts[40][1][:400])]
    queries = next(L.query_blocks(table(spark, items)))
    rows_ = L.index_segments(small.coalesce(1), queries.vocabulary).toArrow()
    segment = rows_.combine_chunks().to_batches()[0]
    assert segment.num_rows == 1
    n, total, df = L.statistics(L.index_segments(small, queries.vocabulary), len(queries.vocabulary))
    lists = L.lists_of(segment, n, total, L.weights(n, df))
    ids = segment.column("docs").flatten().to_numpy()
    got, skipped = [], 0
    for (item, _), wanted in zip(items, queries.wanted):
        best = L.Best(5)
        skipped += L.search_segment(lists, ids, np.zeros(len(ids), bool), wanted, best, {})
        order = np.lexsort((best.doc, -best.score))
        got += [(item, r + 1, int(best.doc[i]), int(best.score[i])) for r, i in enumerate(order)]
    assert sorted(got, key=str) == plain(texts, items, 5)
    assert skipped > 0 or share == 1.0


def test_nulls_ties_repeats_and_long_texts(spark, odd, none):
    items = [(1, "QUICK fox fox 東京 naïve"), (2, None), (3, ""), (4, " .,!"), (5, "Wort12 line3 zzz"), (5, "be"), (None, "lazy dog"),
             (7, "absent xylophone")]
    got = rows(L.search(odd, table(spark, items)))
    assert got == plain(pairs(odd), items)
    assert {r[0] for r in got} == {1, 5, None}
    assert rows(L.search(none, table(spark, items))) == [] == rows(L.search(odd, table(spark, [])))
    assert L.search(none, table(spark, items)).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_give_the_same(spark, odd, clash, monkeypatch):
    items = [(i, f"quick word line{i} be two") for i in range(9)]
    for df in (odd, clash):
        whole = rows(L.search(df, table(spark, items)))
        with monkeypatch.context() as m:
            m.setattr(L.query_blocks, "__defaults__", (2, 1 << 20))
            assert rows(L.search(df, table(spark, items))) == whole == plain(pairs(df), items)


def test_many_equal_scores_keep_the_lowest_ids(spark):
    docs = spark.createDataFrame([(999 - i, "same words here") for i in range(700)], "doc_id long, text string")
    got = rows(L.search(docs.repartition(6), table(spark, [(1, "same words"), (2, "other")])))
    assert got == [] and plain(pairs(docs), [(1, "same words")]) == []      # a term in all documents weighs nothing
    docs = docs.union(spark.createDataFrame([(2000 + i, "unlike text") for i in range(900)], "doc_id long, text string"))
    got = L.search(docs.repartition(6), table(spark, [(1, "same words")])).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(300, 320)) and [r["rank"] for r in got] == list(range(1, 21))


def test_sql_gives_the_same(spark):
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLES['op11_lexical_search']})").fetchall()
    assert sorted(want, key=str) == rows(QUERIES["op11_lexical_search"](spark, SMALL))
