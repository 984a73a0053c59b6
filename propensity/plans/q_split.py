"""Registered split / sampling / weighting queries (C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.operators import features as FE
from propensity.operators import split as S
from propensity.plans import fixtures as FX
from propensity.plans.registry import register
from propensity.plans.sql import DOCS, ORDERS, VISITS, rounded, with_

FOLD_PRIME = 1_000_003
N_FOLDS = 5


def visit_key(df):
    """Unique integer key of a visit: user_id * 1000 + day number since 2024-01-01."""
    return df.withColumn("vkey", F.col("user_id") * 1000 + F.datediff("day", F.lit("2024-01-01").cast("date")))


VKEY_SQL = "(user_id * 1000 + date_diff('day', DATE '2024-01-01', day))"


@register("split_chrono", with_(ORDERS, body="""
SELECT o_orderkey, month, CASE WHEN month IN (11, 12) THEN 'test' ELSE 'train' END AS split FROM ords"""))
def split_chrono(spark, base):
    """test = November/December orders, train = the rest."""
    o = S.split_by_period(FX.orders(spark, base), "month", FX.TEST_MONTHS)
    return o.select("o_orderkey", "month", "split")


@register("split_temporal_holdout", with_(ORDERS, body="""
SELECT o_orderkey, CASE WHEN period = 'test' THEN 'test'
                        WHEN month BETWEEN 1 AND 6 THEN 'fit'
                        WHEN month BETWEEN 7 AND 9 THEN 'validate'
                        ELSE 'unused' END AS role FROM ords"""))
def split_temporal_holdout(spark, base):
    """Fit on Q1+Q2, validate on Q3, Q4 train rows unused."""
    o = FX.orders(spark, base).withColumn("quarter", FE.quarter("month"))
    return S.temporal_holdout(o, "period", "quarter", ["Q1", "Q2"], ["Q3"]).select("o_orderkey", "role")


@register("split_folds", with_(VISITS, body=f"""
SELECT visit_id, CAST(({VKEY_SQL} * {FOLD_PRIME}) % {N_FOLDS} AS INTEGER) AS fold FROM visits"""))
def split_folds(spark, base):
    """Deterministic 5-fold assignment of visits."""
    v = visit_key(FX.visits(spark, base))
    return v.select("visit_id", S.fold_column("vkey", N_FOLDS, FOLD_PRIME).alias("fold"))


@register("sample_balanced", with_(VISITS, f"""
t AS (SELECT *, {VKEY_SQL} AS vkey FROM visits WHERE period = 'train'),
cnt AS (SELECT label, count(*) AS n FROM t GROUP BY label),
mn AS (SELECT label AS minority, n AS n_min FROM cnt ORDER BY n, label LIMIT 1),
r AS (SELECT t.visit_id, t.label, row_number() OVER (PARTITION BY t.label ORDER BY t.vkey) AS rn FROM t)""",
    body="""
SELECT r.visit_id, r.label FROM r JOIN cnt ON r.label = cnt.label, mn
WHERE r.rn <= CASE WHEN r.label = mn.minority THEN mn.n_min ELSE least(cnt.n, floor(mn.n_min * 1.0)) END"""))
def sample_balanced(spark, base):
    """C4: balanced per-class sample of train visits (ratio 1), lowest keys first."""
    v = visit_key(FX.visits(spark, base)).where(F.col("period") == "train")
    return S.sample_balanced(v, "label", "vkey", 1.0).select("visit_id", "label")


@register("weight_balanced", rounded(with_(DOCS, body="""
SELECT doc_id, quality AS label,
       count(*) OVER () / (2 * count(*) OVER (PARTITION BY quality)) AS weight FROM docs"""), ["weight"]))
def weight_balanced(spark, base):
    """Inverse-frequency class weights on document quality."""
    d = FX.documents(spark, base).select("doc_id", F.col("quality").alias("label"))
    return S.balanced_weights(d, "label")


@register("weight_scale_pos", rounded(with_(DOCS, body="""
SELECT doc_id, toxic,
       CASE WHEN toxic = 1 THEN (SELECT count(*) FILTER (WHERE toxic <> 1) / count(*) FILTER (WHERE toxic = 1) FROM docs)
            ELSE 1.0 END AS weight FROM docs"""), ["weight"]))
def weight_scale_pos(spark, base):
    """Positive weight n_neg / n_pos for toxic documents."""
    d = FX.documents(spark, base).select("doc_id", "toxic")
    return S.scale_pos_weight(d, "toxic", 1)
