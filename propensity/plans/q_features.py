"""Registered feature-preparation queries (D*, A2, A7)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from propensity.functions.columns import safe_div
from propensity.operators import features as FE
from propensity.operators.artifact import PrepSpec, fit_artifact
from propensity.plans import fixtures as FX
from propensity.plans.q_split import visit_key
from propensity.plans.registry import register
from propensity.plans.sql import DOCS, ORDERS, VISITS, rounded, with_

V_SPEC = PrepSpec(numeric=FX.V_NUMERIC, lump=["nation"], onehot=["segment", "weekend"],
                  visitor="visitor", label="label", keep=["visit_id", "period"])
V_CATS = ["nation", "segment", "weekend"]


def visit_artifact(spark, base, spec: PrepSpec = V_SPEC, visits=None):
    """Visits (``visits``, if a query has them already) and the artifact fitted on their train rows (cached only while
    the fit reads them twice)."""
    v = visit_key(FX.visits(spark, base)) if visits is None else visits
    train = v.where(F.col("period") == "train").persist(StorageLevel.MEMORY_AND_DISK)
    art = fit_artifact(train, spec)
    train.unpersist()
    return v, art


# ------------------------------------------------------------------ SQL: the artifact fit on train

def _m(c):
    return f"m_{c}"


def _s(c):
    return f"s_{c}"


ART_SQL = f"""
vtrain AS (SELECT * FROM visits WHERE period = 'train'),
art_num AS (SELECT {', '.join(f'avg(ln(1 + {c})) AS {_m(c)}, stddev_samp(ln(1 + {c})) AS {_s(c)}' for c in FX.V_NUMERIC)}
            FROM vtrain),
art_p AS (SELECT avg(CASE WHEN visitor = 'Returning_Visitor' THEN 1.0 WHEN visitor = 'New_Visitor' THEN 0.0 END) AS p
          FROM vtrain),
art_share AS (SELECT 'nation' AS feature, nation AS level, count(*) AS n,
                     count(*) / sum(count(*)) OVER () AS share FROM vtrain GROUP BY nation),
art_keep AS (SELECT level FROM art_share WHERE share >= 0.05 AND level IS NOT NULL),
lumped AS (SELECT visit_id, period,
                  CASE WHEN nation IN (SELECT level FROM art_keep) THEN nation ELSE 'Other' END AS nation,
                  segment, CAST(weekend AS VARCHAR) AS weekend FROM visits),
art_levels AS (SELECT 'nation' AS col, level FROM art_keep UNION SELECT 'nation', 'Other'
               UNION SELECT DISTINCT 'segment', segment FROM lumped WHERE period = 'train' AND segment IS NOT NULL
               UNION SELECT DISTINCT 'weekend', weekend FROM lumped WHERE period = 'train'),
art_dummies AS (SELECT col, level FROM (
                  SELECT *, row_number() OVER (PARTITION BY col ORDER BY level) AS rk FROM art_levels) WHERE rk > 1)"""

_Z_SQL = ", ".join(f"(ln(1 + {c}) - {_m(c)}) / {_s(c)} AS {c}" for c in FX.V_NUMERIC)
_IMPUTE_SQL = ("CASE WHEN visitor = 'Returning_Visitor' THEN 1.0 WHEN visitor = 'New_Visitor' THEN 0.0 "
               "ELSE p END")


# ------------------------------------------------------------------ A2 / A1

@register("src_sessions", rounded(with_(VISITS, body="""
SELECT visit_id, user_id, CAST(day AS VARCHAR) AS day, period, adm, adm_value, inf, inf_value, prd, prd_value,
       err_rate, visitor, nation, segment, weekend, label FROM visits"""),
    ["adm_value", "inf_value", "prd_value", "err_rate"]))
def src_sessions(spark, base):
    """A1: the session table (fixture V) read from the given tables."""
    return FX.visits(spark, base).withColumn("day", F.col("day").cast("string"))


@register("src_features_target", rounded(with_(DOCS, body="SELECT * FROM docs"), ["distinct_share", "digit_share"]))
def src_features_target(spark, base):
    """A2: features and target held apart, bound by key (labels join documents)."""
    return FX.documents(spark, base)


# ------------------------------------------------------------------ D1, D2, D4

@register("feat_prob_impute", rounded(with_(VISITS, ART_SQL, body=f"""
SELECT visit_id, visitor, {_IMPUTE_SQL} AS is_returning FROM visits, art_p"""), ["is_returning"]))
def feat_prob_impute(spark, base):
    """Visitor type -> 1 / 0 / P(returning) fitted on train."""
    v = FX.visits(spark, base)
    p = FE.fit_prob_returning(v.where(F.col("period") == "train"), "visitor")
    return v.select("visit_id", "visitor", FE.prob_impute("visitor", p).alias("is_returning"))


@register("feat_quarter", with_(ORDERS, body="""
SELECT o_orderkey, month_name, CASE WHEN month BETWEEN 1 AND 3 THEN 'Q1' WHEN month BETWEEN 4 AND 6 THEN 'Q2'
                                    WHEN month BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS quarter FROM ords"""))
def feat_quarter(spark, base):
    """Month name -> quarter; anything outside Q1-Q3 is Q4."""
    o = FX.orders(spark, base)
    return o.select("o_orderkey", "month_name", FE.quarter("month_name").alias("quarter"))


@register("feat_lump_fit", rounded(with_(VISITS, ART_SQL, body="""
SELECT feature, level, n, share, CASE WHEN share >= 0.05 THEN 1 ELSE 0 END AS keep FROM art_share"""), ["share"]))
def feat_lump_fit(spark, base):
    """D4 fit: train share of each nation and whether it is kept (>= 5%)."""
    v = FX.visits(spark, base).where(F.col("period") == "train")
    s = FE.level_shares(v, ["nation"])
    return s.select("feature", "level", F.col("n").cast("long").alias("n"), "share",
                    (F.col("share") >= 0.05).cast("int").alias("keep"))


@register("feat_lump_apply", with_(VISITS, ART_SQL, body="SELECT visit_id, nation FROM lumped"))
def feat_lump_apply(spark, base):
    """D4 apply: nations below 5% of train, and unseen ones, become 'Other' (all rows)."""
    v = FX.visits(spark, base)
    keep = FE.fit_lump(v.where(F.col("period") == "train"), ["nation"], 0.05)
    return v.select("visit_id", FE.lump("nation", keep["nation"]).alias("nation"))


# ------------------------------------------------------------------ D5

@register("feat_onehot", rounded(with_(VISITS, ART_SQL, body="""
SELECT l.visit_id, d.col || '_' || d.level AS dummy,
       CASE WHEN (CASE d.col WHEN 'nation' THEN l.nation WHEN 'segment' THEN l.segment ELSE l.weekend END) IS NULL
            THEN NULL
            WHEN (CASE d.col WHEN 'nation' THEN l.nation WHEN 'segment' THEN l.segment ELSE l.weekend END)
                 NOT IN (SELECT a.level FROM art_levels a WHERE a.col = d.col) THEN NULL
            WHEN (CASE d.col WHEN 'nation' THEN l.nation WHEN 'segment' THEN l.segment ELSE l.weekend END) = d.level
            THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS value
FROM lumped l JOIN art_dummies d ON TRUE"""), ["value"]))
def feat_onehot(spark, base):
    """Full-rank dummies (first string-sorted level dropped), long form (visit, dummy, value)."""
    v, art = visit_artifact(spark, base)
    wide = art.transform(v)
    dummies = [c for c in wide.columns if any(c.startswith(p + "_") for p in V_CATS)]
    if not dummies:
        return spark.createDataFrame([], "visit_id string, dummy string, value double")
    return wide.select("visit_id", *dummies).unpivot(["visit_id"], dummies, "dummy", "value")


# ------------------------------------------------------------------ D6, D7

_LZ = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("feat_log1p", rounded(f"""
SELECT l_orderkey, l_linenumber, {', '.join(f'ln(1 + {c}) AS {c}' for c in _LZ)} FROM lineitem""", _LZ))
def feat_log1p(spark, base):
    """log1p of the lineitem numerics."""
    li = FX.lineitem(spark, base)
    return li.select("l_orderkey", "l_linenumber", *FE.log1p_columns(_LZ))


@register("feat_zscore", rounded(f"""
WITH s AS (SELECT *, CASE WHEN month(l_shipdate) IN (11, 12) THEN 'test' ELSE 'train' END AS split FROM lineitem),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in _LZ)} FROM s WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in _LZ)} FROM s, m""", _LZ))
def feat_zscore(spark, base):
    """Z-score with train (non Nov/Dec ship month) sample mean and sd, applied to all rows."""
    li = FX.lineitem(spark, base).withColumn(
        "split", F.when(F.month("l_shipdate").isin(*FX.TEST_MONTHS), "test").otherwise("train"))
    means, sds = FE.fit_moments(li.where(F.col("split") == "train"), _LZ)
    return li.select("l_orderkey", "l_linenumber", "split",
                     *[FE.zscore(c, means[c], sds[c], c) for c in _LZ])


# ------------------------------------------------------------------ D8, D9, D11

@register("feat_target", with_(VISITS, body="""
SELECT visit_id, CASE WHEN label = 1 THEN 'Yes' ELSE 'No' END AS target,
       CAST(CASE WHEN label = 1 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM visits"""))
def feat_target(spark, base):
    """Label -> Yes/No and 1.0/0.0."""
    v = FX.visits(spark, base)
    return v.select("visit_id", FE.target_yes_no("label").alias("target"), FE.target_label("label").alias("label"))


@register("feat_safe_ratio", rounded(with_(VISITS, body="""
SELECT visit_id,
       CASE WHEN adm = 0 THEN 0.0 ELSE adm_value / adm END AS adm_avg,
       CASE WHEN inf = 0 THEN 0.0 ELSE inf_value / inf END AS inf_avg,
       CASE WHEN prd = 0 THEN 0.0 ELSE prd_value / prd END AS prd_avg FROM visits"""),
    ["adm_avg", "inf_avg", "prd_avg"]))
def feat_safe_ratio(spark, base):
    """Value per event, 0 where there is no event."""
    v = FX.visits(spark, base)
    return v.select("visit_id", safe_div("adm_value", "adm").alias("adm_avg"),
                    safe_div("inf_value", "inf").alias("inf_avg"), safe_div("prd_value", "prd").alias("prd_avg"))


COLLINEAR = {"drop": ["err_rate"], "ratios": {"adm_avg": ("adm_value", "adm")}}


@register("feat_collinear", rounded(with_(VISITS, body="""
SELECT visit_id, inf, inf_value, prd, prd_value, CASE WHEN adm = 0 THEN 0.0 ELSE adm_value / adm END AS adm_avg
FROM visits"""), ["inf_value", "prd_value", "adm_avg"]))
def feat_collinear(spark, base):
    """Drop the bounce-like rate, replace one count/value pair by its ratio."""
    v = FX.visits(spark, base).select("visit_id", *FX.V_NUMERIC)
    return FE.collinearity_treatment(v, **COLLINEAR)


# ------------------------------------------------------------------ D13, D14, A7

@register("feat_apply_artifact", rounded(with_(VISITS, ART_SQL, body=f"""
SELECT visit_id, period, {_Z_SQL}, {_IMPUTE_SQL} AS is_returning, CAST(label AS DOUBLE) AS label
FROM visits, art_num, art_p"""), FX.V_NUMERIC + ["is_returning", "label"]))
def feat_apply_artifact(spark, base):
    """The train-fitted artifact applied to every visit (numeric part; dummies in feat_onehot)."""
    v, art = visit_artifact(spark, base)
    return art.transform(v).select("visit_id", "period", *FX.V_NUMERIC, "is_returning", "label")


@register("artifact_bundle", rounded(with_(VISITS, ART_SQL, body=f"""
SELECT 'prob_returning' AS kind, 'visitor' AS col, '' AS key, p AS value FROM art_p
UNION ALL SELECT 'keep_level', 'nation', level, 1.0 FROM art_keep
UNION ALL SELECT 'onehot_level', col, level, CAST(row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS DOUBLE)
          FROM art_levels
{''.join(f"UNION ALL SELECT 'mean', '{c}', '', {_m(c)} FROM art_num " for c in FX.V_NUMERIC)}
{''.join(f"UNION ALL SELECT 'sd', '{c}', '', {_s(c)} FROM art_num " for c in FX.V_NUMERIC)}"""), ["value"]))
def artifact_bundle(spark, base):
    """The fitted preprocessing bundle in long form (kind, col, key, value)."""
    _, art = visit_artifact(spark, base)
    return art.to_frame(spark)
