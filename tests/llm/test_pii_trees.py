"""The boosted trees decide: spans that keep every rule and are no personal data go, planted personal ones stay."""
import pytest
from pyspark.sql import functions as F

from propensity.llm import pii_boost as I

NUMBERS = [f"{200 + 37 * k % 800}{300 + 53 * k % 700}{1000 + 911 * k % 9000}" for k in range(20)]
FORMATS = ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}")
#: None of these sentences is one of the contrast texts.
OTHER = ("Your invoice no. {} is due.", "We scored {} points.", "shipment {} left the harbour", "Sizes {} mm only", "Price list {} euros",
         "model {} replaces it", "the distance was {} km", "lot {} expires soon")
PERSONAL = ("Call us on {} now.", "Phone: {}", "Her mobile {} is off", "tel {} (office)", "Fax number {}.", "You may call {} at night")


def plant(spark, sentences, first):
    rows, k = [], first
    for s in sentences:
        for i, n in enumerate(NUMBERS):
            rows.append((k, s.format(FORMATS[i % 4].format(n[:3], n[3:6], n[6:]))))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string"), len(rows)


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    other, n_other = plant(spark, OTHER * 2, 10**9)
    personal, n_personal = plant(spark, PERSONAL * 2, 2 * 10**9)
    return docs.unionByName(other).unionByName(personal), n_other, n_personal


def shares(df, n_other, n_personal):
    hit = df.where("spans != ''").agg(F.count_if(F.col("doc_id") >= 2 * 10**9).alias("p"),
                                      F.count_if(F.col("doc_id").between(10**9, 2 * 10**9 - 1)).alias("o")).first()
    return hit["o"] / n_other, hit["p"] / n_personal


def test_trees_reject_rule_valid_numbers_and_keep_personal_ones(corpus):
    docs, n_other, n_personal = corpus
    assert n_other >= 200 and n_personal >= 200
    other, personal = shares(I.personal_data(docs), n_other, n_personal)
    assert other <= 0.2 and personal >= 0.95


def test_without_trees_the_same_numbers_would_stay(corpus, monkeypatch):
    docs, n_other, n_personal = corpus
    monkeypatch.setattr(I, "as_sql", lambda model: F.lit(50.0))
    other, personal = shares(I.personal_data(docs), n_other, n_personal)
    assert other > 0.9 and personal > 0.9


def test_sentences_beside_no_word_of_the_lists(spark, corpus):
    asked = spark.createDataFrame([(1, "sizes 100-200-3000 mm"), (2, "score 300 400 5000 today"), (3, "Invoice number 415 555 2671"),
                                   (4, "Tracking 123-456-7890"), (5, "Please call (269) 555-3296 today."),
                                   (6, "Summer house, (269) 555-3296, ask for Ann")], "doc_id long, text string")
    docs = corpus[0].where("doc_id < 1000000000").withColumn("doc_id", F.col("doc_id") + 100).unionByName(asked)
    got = {r["doc_id"]: r["spans"] for r in I.personal_data(docs).where("doc_id < 10").collect()}
    assert [got[k] != "" for k in range(1, 7)] == [False] * 4 + [True] * 2


def test_calibration_is_of_the_applied_trees(corpus):
    spans = I.related(I.candidates(corpus[0]))
    model, kinds = I.train(spans)
    assert set(kinds) == set(I.KINDS) and model.roots.size
    assert kinds["phone"]["precision"] >= 0.95 and kinds["phone"]["recall"] >= 0.8
    assert all(0.5 <= v["threshold"] <= 1 for v in kinds.values())


def test_words_for_at_and_numbers_behind_it(spark, corpus):
    asked = spark.createDataFrame([(1, "write to bob.lee [at] firm [dot] example today"), (2, "they sold (at) 12.50 then")],
                                  "doc_id long, text string")
    docs = corpus[0].where("doc_id < 1000000000").withColumn("doc_id", F.col("doc_id") + 100).unionByName(asked)
    got = {r["doc_id"]: r["spans"] for r in I.personal_data(docs).where("doc_id < 10").collect()}
    assert got[1].startswith("email:") and got[2] == ""


def test_redaction_of_copies_and_repeated_ids(spark, corpus):
    text = "mail a@b.example.com now"
    rows = [(1, text), (1, text), (1, "other"), (2, text), (None, text), (None, None)]
    got = I.redacted(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = "mail [EMAIL] now"
    assert sorted(map(str, got)) == sorted(str(type(got[0])(doc_id=i, text=want if t == text else t)) for i, t in rows)
