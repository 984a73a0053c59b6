import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from propensity.operators import segment as SG


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0, 0], [8, 8, 0, 0], [0, 8, 8, 8]], dtype=float)
    rows = []
    for g, c in enumerate(centres):
        for i in range(300):
            rows.append((g * 1000 + i, g, [float(v) for v in c + rng.normal(scale=0.5, size=4)]))
    return spark.createDataFrame(rows, "id long, truth int, x array<double>")


def test_kmeans_recovers_blobs(spark, blobs):
    data = blobs.withColumn("features", array_to_vector("x"))
    model = SG.kmeans_best(data, 3, n_start=3)
    out, _ = SG.relabel_clusters(model, data)
    purity = out.groupBy("truth", "cluster").count().groupBy("truth").agg(F.max("count").alias("m")) \
        .agg(F.sum("m")).first()[0]
    assert purity == 900


def test_elbow_and_wss_k1(spark, blobs):
    data = blobs.withColumn("features", array_to_vector("x"))
    e = {r.k: r.wss for r in SG.elbow(data, 4, n_start=2).collect()}
    X = np.array([r.x for r in blobs.collect()])
    assert e[1] == pytest.approx(((X - X.mean(0)) ** 2).sum())
    assert e[3] < e[2] < e[1]


def test_assign_nearest_ties_first(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0])], "id int, x array<double>")
    out = {r.id: r.cluster for r in SG.assign_nearest(df, F.col("x"), {5: [1.0, 0.0], 3: [1.0, 0.0], 9: [2.0, 0.0]})
           .collect()}
    assert out == {1: 3, 2: 9}


def test_pca_variance_and_signs(spark, blobs):
    _, pca, cdata = SG.fit_pca(blobs, k=4, vector_col="x")
    v = SG.pca_variance(pca).toPandas()
    assert v["cumulative"].iloc[-1] == pytest.approx(1.0)
    X = np.array([r.x for r in blobs.collect()])
    ev = np.sort(np.linalg.eigvalsh(np.cov(X.T)))[::-1]
    assert np.allclose(v["proportion"], ev / ev.sum(), atol=1e-8)
    load = SG.pca_loadings(pca, ["a", "b", "c", "d"]).toPandas()
    for _, g in load.groupby("component"):
        assert g.loc[g["loading"].abs().idxmax(), "loading"] > 0
    sc = SG.pca_scores(pca, cdata, ["id"], 2).toPandas()
    assert abs(sc["pc1"].mean()) < 1e-9


def test_fast_ica_recovers_sources(spark):
    rng = np.random.default_rng(9)
    n = 2000
    S_ = rng.uniform(-1, 1, size=(n, 2))
    A = np.array([[1.0, 0.6], [0.4, 1.0]])
    Xm = S_ @ A.T
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(Xm)], "id long, a double, b double")
    scores, _ = SG.fast_ica(df, ["a", "b"], n_comp=2, keep=["id"], seed=1)
    got = np.array([[r.ic1, r.ic2] for r in scores.orderBy("id").collect()])
    c = np.abs(np.corrcoef(np.c_[got, S_].T)[:2, 2:])
    assert max(c[0, 0] * c[1, 1], c[0, 1] * c[1, 0]) > 0.95 ** 2


def test_crosstab_and_profile(spark):
    a = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 2, 0)], "k int, cluster int, label int")
    ct = {(r.cluster, r.label): (r.n, r.share) for r in SG.crosstab(a, "cluster", "label").collect()}
    assert ct[(2, 1)] == (0, 0.0) and ct[(1, 1)] == (1, 0.5)
    raw = spark.createDataFrame([(1, 1, 10.0), (2, 0, 20.0), (3, 0, 5.0)], "k int, label int, v double")
    prof = {r.cluster: r for r in SG.cluster_profile(a, raw, "k", ["v"]).collect()}
    assert prof[1].v == 15.0 and prof[1].positive_rate == 0.5 and prof[2].n == 1


def points(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id long, x array<double>").select("id", array_to_vector("x").alias("features"))


@pytest.mark.parametrize("offset, scale", [(0.0, 1.0), (1e8, 1.0), (-3e6, 1e-3), (5.0, 1e6)])
def test_kmeans_off_the_origin(spark, offset, scale):
    """Three groups 3 apart, moved and scaled: the same clusters, and the cost is the sum of the assigned distances."""
    rng = np.random.default_rng(2)
    base = np.concatenate([rng.normal(c, 0.1, size=(40, 2)) for c in (0.0, 3.0, 6.0)])
    x = base * scale + offset
    got = SG.kmeans_best(points(spark, x.tolist()), 3, n_start=6)
    want = ((base.reshape(3, 40, 2) - base.reshape(3, 40, 2).mean(axis=1, keepdims=True)) ** 2).sum() * scale ** 2
    assert got.cost == pytest.approx(want, rel=1e-4)
    centres = sorted(((got.centres - offset) / scale).mean(axis=1))
    assert np.allclose(centres, [0, 3, 6], atol=0.1)
    df = points(spark, x.tolist())
    near = SG.assign_nearest(df, vector_to_array("features"), dict(enumerate(got.centres.tolist())), "c")
    total = near.agg(F.sum("dist")).first()[0]
    assert got.cost == pytest.approx(total if near.where("dist > 0").count() else 0.0, rel=1e-4)


def test_kmeans_with_rows_that_are_no_points_and_without_rows(spark):
    good = [[0.0, 0.0], [0.1, 0.0], [9.0, 9.0], [9.1, 9.0]]
    df = points(spark, good + [[float("nan"), 1.0], [float("inf"), 0.0]])
    got = SG.kmeans_best(df, 2, n_start=4)
    assert got.cost == pytest.approx(0.01) and np.isfinite(got.centres).all()
    named, _ = SG.relabel_clusters(got, df)
    told = {r["id"]: r["cluster"] for r in named.collect()}
    assert told[0] == told[1] != told[2] == told[3] and told[4] is None and told[5] is None
    none = points(spark, [])
    empty = SG.kmeans_best(none, 3)
    assert len(empty.centres) == 0 and empty.cost == 0.0 and SG.elbow(none).count() == 0
    assert SG.relabel_clusters(empty, none)[0].columns == ["id", "features", "cluster"]
    assert SG.elbow(df, k_max=3, n_start=2).count() == 3
