import numpy as np
from pyspark.sql import functions as F

from propensity.llm import quality_classifier as Q
from propensity.llm.common import held_out
from propensity.llm.hist_gbt import fit


def labels(spark, sf="sf0.01"):
    return spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Q.score(docs, Q.train(docs, labels(spark))).where("held_out").join(labels(spark), "doc_id").toPandas()
    pos, neg = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (pos[:, None] > neg[None]).mean() > 0.97
    assert (got.predicted == got.quality).mean() > 0.95 and len(got) > 60


def test_one_score_per_row_and_equal_texts_score_alike(spark, odd, none, clash):
    model = Q.train(odd, spark.createDataFrame([(1, 1), (5, 0), (10, 0), (13, 1), (None, 1), (14, None)],
                                               "doc_id long, quality int"))
    got = Q.score(odd, model).toPandas()
    assert len(got) == odd.count() and got.score.between(0, 1).all() and got.score.notna().all()
    assert got[got.doc_id == 8].score.nunique() == 1
    assert Q.score(none, model).count() == 0 and Q.score(clash, model).count() == clash.count()


def test_labels_missing_or_of_one_kind(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert set(Q.score(odd, Q.train(odd, empty)).toPandas().score.round(6)) == {0.5}
    ones = spark.createDataFrame([(1, 1), (13, 1)], "doc_id long, quality int")
    assert Q.score(odd, Q.train(odd, ones)).toPandas().score.nunique() == 1
    assert Q.accepted(none, empty).count() == 0


def test_never_learns_from_held_out_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = labels(spark, "sf0.001")
    flipped = known.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = (Q.score(docs, Q.train(docs, x)).toPandas().sort_values("doc_id").score.to_numpy() for x in (known, flipped))
    assert np.array_equal(a, b)


def test_accepted_keeps_columns(small, clash, spark):
    known = labels(spark, "sf0.001")
    got = Q.accepted(small, known)
    assert got.schema.names == small.schema.names and 100 < got.count() < small.count()
    assert Q.accepted(clash, known).columns == clash.columns


def test_trees_fit_a_step():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = ((x[:, 1] > 0.4) & (x[:, 2] < 0.7)).astype(float)
    model = fit(x, y, n_trees=30, depth=3)
    assert ((model.score(x) > 0.5) == y).mean() > 0.99


def test_the_bounded_sample_does_not_depend_on_the_order_of_labels(spark, small):
    known = labels(spark, "sf0.001")
    some = [sorted(map(tuple, Q.training_rows(small, df, 30).collect())) for df in (known, known.orderBy(F.desc("doc_id")).repartition(5))]
    assert some[0] == some[1] and len(some[0]) == 30
