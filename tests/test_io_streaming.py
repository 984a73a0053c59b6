import os

import pytest
from pyspark.sql import functions as F

from propensity.operators.artifact import Artifact
from propensity.operators.models import generative as G
from propensity.operators.models import linear as LIN
from propensity.plans import fixtures as FX
from propensity.plans.q_features import V_SPEC, visit_artifact
from propensity.sources import io
from propensity.streaming import score_stream as SS
from tests.conftest import SMALL


def test_artifact_round_trip(spark, tmpdir_path):
    v, art = visit_artifact(spark, SMALL)
    art.save(os.path.join(tmpdir_path, "art"))
    back = Artifact.load(spark, os.path.join(tmpdir_path, "art"))
    assert back.means == art.means and back.onehot_levels == art.onehot_levels
    a = art.transform(v).orderBy("visit_id").collect()
    b = back.transform(v).orderBy("visit_id").collect()
    assert a == b


def test_split_write_read_prunes(spark, tmpdir_path):
    v = FX.visits(spark, SMALL).withColumnRenamed("period", "split")
    path = os.path.join(tmpdir_path, "prepared")
    io.write_split(v, path)
    t = io.read_split(spark, path, "test")
    assert t.count() == v.where("split = 'test'").count()
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan


def test_result_csv_and_packets(spark, tmpdir_path):
    df = spark.createDataFrame([("a", 1.0)], "model string, pr_auc double")
    io.write_result_csv(df, os.path.join(tmpdir_path, "cmp"))
    back = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "cmp"))
    assert back.first().model == "a"
    v, art = visit_artifact(spark, SMALL)
    prep = art.transform(v)
    nb = G.fit_gaussian_nb(prep.where("period = 'train'"), art.feature_names())
    io.save_packet(nb, tmpdir_path, "nb", 0.42, {"kind": "gaussian"})
    from propensity.operators.features import design_matrix
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(maxIter=5).fit(design_matrix(prep.where("period = 'train'"), ["adm", "prd"]))
    io.save_packet(lr, tmpdir_path, "logit", 0.5)
    with pytest.warns(UserWarning):
        got = io.load_packets(spark, tmpdir_path, ["nb", "logit", "missing"])
    assert set(got) == {"nb", "logit"} and got["nb"]["threshold"] == 0.42
    assert got["logit"]["model"].coefficients.size == 2
    back = got["nb"]["model"]
    assert back.means == nb.means and back.sds == nb.sds and back.priors == nb.priors
    lda = G.fit_lda(prep.where("period = 'train'"), ["prd", "prd_value"])
    again = G.LinearDiscriminant.from_frame(lda.to_frame(spark))
    assert again == lda
    with pytest.raises(ValueError):
        io.save_packet("text", tmpdir_path, "odd", 0.5)
    os.makedirs(os.path.join(tmpdir_path, "broken", "manifest"))
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA|schema"):
        io.load_packets(spark, tmpdir_path, ["broken"])
    with pytest.raises(RuntimeError):
        io.load_packets(spark, tmpdir_path, ["nothing"])


def test_streaming_scoring_equals_batch(spark, tmpdir_path):
    v, art = visit_artifact(spark, SMALL)
    src = os.path.join(tmpdir_path, "incoming")
    v.repartition(3).write.parquet(src)
    stream = SS.stream_source(spark, src, v.schema, max_files=1)
    q = SS.start_scoring(stream, art, os.path.join(tmpdir_path, "scored"), os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(tmpdir_path, "scored"))
    want = SS.score_frame(v, art)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0
