"""Each stage of the pipeline against what its own input demands."""
from collections import Counter

import corpus_pipeline as C
from propensity.llm import line_rules, quality_classifier, simhash_gray

from .test_line_rules import plain
from .test_native import base
from .test_simhash_gray import plain_components, plain_print

SF = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs
    results = {}
    for name, stage in C.STAGES:
        results[name] = (given, stage(spark, given, SF))
        given = results[name][1]
    for name in list(results)[:-1]:
        before, after = results[name]
        assert after.columns == docs.columns and 0 < after.count() <= before.count()
        assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    before, after = results["quality_classifier"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = quality_classifier.score(before, quality_classifier.train(before, labels)).where("predicted = 1")
    assert sorted(texts(after)) == sorted(r["doc_id"] for r in scores.collect())
    before, after = map(texts, results["quality_rules"])
    assert set(after) == {r["doc_id"] for r in line_rules.line_rules(results["quality_rules"][0]).where("kept").collect()}
    assert not any(plain(before[i])[-1] for i in after)
    assert all(not Counter(after[i].split("\n")) - Counter(before[i].split("\n")) for i in after)
    before, after = map(texts, results["simhash_near_dedup"])
    assert set(after) == {c for *_, c in plain_components([(i, plain_print(t)) for i, t in before.items()])}
    assert all(after[i] == before[i] for i in after)
    before, after = map(texts, results["personal_data"])
    assert set(after) == set(before) and not any(base(t) for t in after.values())
    assert all(after[i] == before[i] for i in after if not base(before[i]) and "[" not in after[i])
    before, after = results["best_fit_packing"]
    assert {r["doc_id"] for r in after.collect()} == set(texts(before))


def test_run_equals_its_stages_and_an_empty_table_passes(spark, tmp_path):
    rows = C.run(spark, SF).collect()
    assert rows and len({r["doc_id"] for r in rows}) > 100 and C.ORACLE_SQL is None
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_names_and_order():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "personal_data",
                                        "best_fit_packing"]
    assert simhash_gray.SHINGLE_WORDS == 3 and simhash_gray.MAX_BITS == 2
