"""Registered segmentation queries (E*)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from propensity.operators import segment as SG
from propensity.plans import fixtures as FX
from propensity.plans.q_features import ART_SQL, visit_artifact
from propensity.plans.q_models import VPREP
from propensity.plans.registry import register
from propensity.plans.sql import VISITS, rounded, with_

DIM = 64


def _emb(spark, base):
    return FX.embeddings(spark, base)


# ------------------------------------------------------------------ E1-E3

@register("pca_scores")
def pca_scores(spark, base):
    """Centred PCA of the embeddings, first two scores (sign-fixed)."""
    _, pca, cdata = SG.fit_pca(_emb(spark, base), k=2, vector_col="embedding")
    return SG.pca_scores(pca, cdata, ["vec_id", "label"], 2)


@register("pca_variance")
def pca_variance(spark, base):
    """Variance explained by the first 10 components, and cumulative."""
    _, pca, _ = SG.fit_pca(_emb(spark, base), k=10, vector_col="embedding")
    return SG.pca_variance(pca)


@register("pca_variance_2d", rounded("""
WITH m AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount) AS c, covar_samp(l_quantity, l_discount) AS b
           FROM lineitem),
e AS (SELECT a + c AS tr, sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS disc FROM m),
l AS (SELECT 1 AS component, tr / 2 + disc AS variance, tr FROM e UNION ALL SELECT 2, tr / 2 - disc, tr FROM e)
SELECT component, variance, variance / tr AS proportion,
       sum(variance) OVER (ORDER BY component ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / tr AS cumulative
FROM l""", ["variance", "proportion", "cumulative"]))
def pca_variance_2d(spark, base):
    """E2 with a closed form: PCA of (quantity, discount): eigenvalues, proportions, cumulative."""
    li = FX.lineitem(spark, base)
    cols = ["l_quantity", "l_discount"]
    _, pca, _ = SG.fit_pca(li, cols, k=2)
    tr = li.agg(sum((F.var_samp(c) for c in cols), F.lit(0.0)).alias("tr")).first()["tr"]
    v = SG.pca_variance(pca)
    return v.select("component", (F.col("proportion") * F.lit(tr)).alias("variance"), "proportion", "cumulative")


@register("pca_loadings")
def pca_loadings(spark, base):
    """Loadings of the first two components (biplot data), sign-fixed."""
    _, pca, _ = SG.fit_pca(_emb(spark, base), k=2, vector_col="embedding")
    return SG.pca_loadings(pca, [f"e{i}" for i in range(DIM)])


# ------------------------------------------------------------------ E4-E7

@register("ica_scores")
def ica_scores(spark, base):
    """Two FastICA components of the embeddings (logcosh, symmetric)."""
    scores, _ = SG.fast_ica(_emb(spark, base), vector_col="embedding", n_comp=2, keep=["vec_id", "label"],
                            max_iter=200, seed=0)
    return scores


def _visit_vectors(spark, base):
    v, art = visit_artifact(spark, base)
    prep = art.transform(v)
    return prep.withColumn("features", array_to_vector(F.array(*FX.V_NUMERIC)))


@register("kmeans_clusters")
def kmeans_clusters(spark, base):
    """E5: k-means (k = 3, best of 25 starts) on prepared visit numerics; ids by size."""
    data = _visit_vectors(spark, base).where(F.col("period") == "train").cache()
    out, _ = SG.relabel_clusters(SG.kmeans_best(data, 3, n_start=25, seed=1), data)
    data.unpersist()
    return out.select("visit_id", "cluster", "label")


@register("kmeans_ica")
def kmeans_ica(spark, base):
    """K-means (k = 3) on the two ICA components of the embeddings."""
    scores, _ = SG.fast_ica(_emb(spark, base), vector_col="embedding", n_comp=2, keep=["vec_id", "label"], seed=0)
    data = scores.withColumn("features", array_to_vector(F.array("ic1", "ic2"))).cache()
    out, _ = SG.relabel_clusters(SG.kmeans_best(data, 3, n_start=25, seed=1), data)
    data.unpersist()
    return out.select("vec_id", "label", "cluster")


@register("kmeans_elbow")
def kmeans_elbow(spark, base):
    """Within-cluster sum of squares for k = 1..10 (k = 1 in closed form)."""
    data = _visit_vectors(spark, base).where(F.col("period") == "train").select("features").cache()
    out = SG.elbow(data, 10, n_start=20, seed=1)
    data.unpersist()
    return out


@register("wss_k1", rounded("""
WITH u AS (SELECT vec_id, unnest(range(0, len(embedding))) AS i, unnest(embedding) AS x FROM embeddings),
d AS (SELECT i, var_pop(CAST(x AS DOUBLE)) * count(*) AS ss FROM u GROUP BY i)
SELECT (SELECT count(*) FROM embeddings) AS n, sum(ss) AS wss FROM d""", ["wss"]))
def wss_k1(spark, base):
    """E7, k = 1: total sum of squares of the embeddings."""
    e = _emb(spark, base).select(F.col("embedding").cast("array<double>").alias("a"))
    cols = [F.col("a")[i].alias(f"x{i}") for i in range(DIM)]
    return SG.wss_k1(e.select(*cols), [f"x{i}" for i in range(DIM)])


# ------------------------------------------------------------------ E8-E10

@register("assign_nearest", rounded("""
WITH u AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
           FROM embeddings),
c AS (SELECT label AS cid, i, avg(x) AS m FROM u GROUP BY label, i),
d AS (SELECT u.vec_id, c.cid, sum((u.x - c.m) * (u.x - c.m) ORDER BY u.i) AS dist FROM u JOIN c ON u.i = c.i
      GROUP BY u.vec_id, c.cid)
SELECT vec_id, cluster, dist FROM (
  SELECT vec_id, cid AS cluster, dist, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rk FROM d)
WHERE rk = 1""", ["dist"]))
def assign_nearest(spark, base):
    """Each embedding to its nearest class-mean centre (ties -> smallest id)."""
    e = _emb(spark, base).withColumn("x", F.col("embedding").cast("array<double>"))
    centres = {int(k): v for k, v in SG.class_centres(e, "x", "label").items()}
    return SG.assign_nearest(e, F.col("x"), centres).select("vec_id", "cluster", "dist")


_VCENT = VPREP + """,
vc AS (SELECT CAST(label AS INTEGER) AS cid, """ + ", ".join(f"avg({c}) AS c_{c}" for c in FX.V_NUMERIC) + """
       FROM vprep WHERE period = 'train' GROUP BY label),
vd AS (SELECT v.visit_id, v.label, vc.cid, """ + "0.0 + " + " + ".join(
    f"(v.{c} - vc.c_{c}) * (v.{c} - vc.c_{c})" for c in FX.V_NUMERIC) + """ AS dist FROM vprep v JOIN vc ON TRUE),
va AS (SELECT visit_id, label, cid AS cluster FROM (
         SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY dist, cid) AS rk FROM vd) WHERE rk = 1)"""


def _visit_clusters(spark, base):
    v, art = visit_artifact(spark, base)
    prep = art.transform(v).withColumn("x", F.array(*FX.V_NUMERIC))
    centres = {int(k): c for k, c in SG.class_centres(prep.where(F.col("period") == "train"), "x", "label").items()}
    return v, SG.assign_nearest(prep, F.col("x"), centres)


@register("cluster_crosstab", rounded(with_(VISITS, ART_SQL, _VCENT, """
ct AS (SELECT cluster, CAST(label AS INTEGER) AS label, count(*) AS n FROM va GROUP BY ALL),
cl AS (SELECT DISTINCT cluster FROM va), lb AS (SELECT DISTINCT CAST(label AS INTEGER) AS label FROM va),
fulltab AS (SELECT cl.cluster, lb.label, coalesce(ct.n, 0) AS n FROM cl JOIN lb ON TRUE
         LEFT JOIN ct ON ct.cluster = cl.cluster AND ct.label = lb.label)""", body="""
SELECT cluster, label, CAST(n AS BIGINT) AS n,
       CASE WHEN sum(n) OVER (PARTITION BY cluster) <> 0 THEN n / sum(n) OVER (PARTITION BY cluster) END AS share
FROM fulltab"""), ["share"]))
def cluster_crosstab(spark, base):
    """Nearest-class-mean cluster x label counts and row shares (all visits)."""
    _, a = _visit_clusters(spark, base)
    return SG.crosstab(a.select("cluster", F.col("label").cast("int").alias("label")), "cluster", "label")


@register("cluster_profile", rounded(with_(VISITS, ART_SQL, _VCENT, body="""
SELECT a.cluster, count(*) AS n, """ + ", ".join(f"avg(CAST(v.{c} AS DOUBLE)) AS {c}" for c in FX.V_NUMERIC) + """,
       avg(CAST(v.label AS DOUBLE)) AS positive_rate
FROM va a JOIN visits v ON a.visit_id = v.visit_id GROUP BY a.cluster"""), FX.V_NUMERIC + ["positive_rate"]))
def cluster_profile(spark, base):
    """Unscaled numeric means and purchase rate per cluster (joined back on the visit key)."""
    v, a = _visit_clusters(spark, base)
    return SG.cluster_profile(a, v, "visit_id", FX.V_NUMERIC, "label", "cluster")
