"""Preprocessing artifact: fit on train, apply anywhere.

``fit_artifact`` needs two aggregation jobs over the train rows (moments +
imputation probability in one, level shares in the other); the fitted
parameters are a few numbers per column. ``Artifact.transform`` is a single
narrow projection, valid for batch and streaming DataFrames alike.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions.columns import isin_safe, unpivot_long
from propensity.operators import features as FE


@dataclass
class PrepSpec:
    """Which columns get which treatment. Nothing is tied to one dataset."""
    numeric: list[str]
    lump: list[str] = field(default_factory=list)          # D4, then one-hot
    onehot: list[str] = field(default_factory=list)        # D5 without lumping
    visitor: str | None = None                             # D1
    visitor_yes: str = "Returning_Visitor"                 # fixed values: the two types that count
    visitor_no: str = "New_Visitor"
    imputed_name: str = "is_returning"
    month: str | None = None                               # D2 -> 'quarter', one-hot
    label: str | None = None                               # D8
    positive: int = 1
    min_share: float = 0.05
    log1p: bool = True
    keep: list[str] = field(default_factory=list)          # passed through (ids, split)


@dataclass
class Artifact:
    spec: PrepSpec
    prob_returning: float | None
    keep_levels: dict
    onehot_levels: dict
    means: dict
    sds: dict

    # -------------------------------------------------------------- apply
    def transform(self, df: DataFrame) -> DataFrame:
        s = self.spec
        cols = [F.col(c) for c in s.keep]
        for c in s.numeric:
            x = F.log1p(F.col(c).cast("double")) if s.log1p else F.col(c).cast("double")
            cols.append(FE.zscore(x, self.means[c], self.sds[c], c))
        if s.visitor:
            cols.append(FE.prob_impute(s.visitor, self.prob_returning, s.visitor_yes, s.visitor_no)
                        .alias(s.imputed_name))
        for c, e in self._categoricals().items():
            levels = sorted(self.onehot_levels[c])
            cols += [FE.dummy(e, levels, level).alias(f"{c}_{level}") for level in levels[1:]]
        if s.label:
            cols.append(FE.target_label(s.label, s.positive).alias("label"))
        return df.select(*cols)

    def _categoricals(self) -> dict:
        s = self.spec
        cat = {c: FE.lump(c, self.keep_levels[c]) for c in s.lump}
        cat.update({c: F.col(c).cast("string") for c in s.onehot})
        if s.month:
            cat["quarter"] = FE.quarter(s.month)
        return cat

    def feature_names(self) -> list[str]:
        s = self.spec
        names = list(s.numeric) + ([s.imputed_name] if s.visitor else [])
        for c in self._categoricals():
            names += [f"{c}_{lv}" for lv in sorted(self.onehot_levels[c])[1:]]
        return names

    # -------------------------------------------------------------- A7 long form
    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        if self.prob_returning is not None:
            rows.append(("prob_returning", self.spec.visitor, "", float(self.prob_returning)))
        for c, lv in self.keep_levels.items():
            rows += [("keep_level", c, x, 1.0) for x in lv]
        for c, lv in self.onehot_levels.items():
            rows += [("onehot_level", c, x, float(i)) for i, x in enumerate(lv)]
        rows += [("mean", c, "", float(v)) for c, v in self.means.items()]
        rows += [("sd", c, "", float(v)) for c, v in self.sds.items()]
        return spark.createDataFrame(rows, "kind string, col string, key string, value double")

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "params"))
        spec = spark.createDataFrame([(json.dumps(asdict(self.spec)),)], "spec string")
        spec.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "spec"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Artifact:
        spec = PrepSpec(**json.loads(spark.read.parquet(os.path.join(path, "spec")).first().spec))
        rows = spark.read.parquet(os.path.join(path, "params")).collect()
        p, keep, oh, means, sds = None, {c: [] for c in spec.lump}, {}, {}, {}
        ordered: dict[str, list] = {}
        for r in rows:
            if r.kind == "prob_returning":
                p = r.value
            elif r.kind == "keep_level":
                keep.setdefault(r.col, []).append(r.key)
            elif r.kind == "onehot_level":
                ordered.setdefault(r.col, []).append((r.value, r.key))
            elif r.kind == "mean":
                means[r.col] = r.value
            elif r.kind == "sd":
                sds[r.col] = r.value
        oh = {c: [k for _, k in sorted(v)] for c, v in ordered.items()}
        for c in list(spec.lump) + list(spec.onehot) + (["quarter"] if spec.month else []):
            oh.setdefault(c, [])
        return Artifact(spec, p, {c: sorted(v) for c, v in keep.items()}, oh, means, sds)


def fit_artifact(train: DataFrame, spec: PrepSpec) -> Artifact:
    """Fit imputation probability, kept levels, one-hot levels, means and sds on train."""
    # job 1: moments and the imputation probability in one aggregation
    ex = [F.log1p(F.col(c).cast("double")) if spec.log1p else F.col(c).cast("double") for c in spec.numeric]
    aggs = [F.avg(e).alias(f"m{i}") for i, e in enumerate(ex)] + \
           [F.stddev_samp(e).alias(f"s{i}") for i, e in enumerate(ex)] + [F.count(F.lit(1)).alias("n")]
    if spec.visitor:
        v = F.col(spec.visitor)
        aggs.append(F.avg(F.when(v == spec.visitor_yes, 1.0).when(v == spec.visitor_no, 0.0)).alias("p"))
    r = train.agg(*aggs).first()
    means = {c: float(r[f"m{i}"] or 0.0) for i, c in enumerate(spec.numeric)}
    sds = {c: float(r[f"s{i}"] or 0.0) for i, c in enumerate(spec.numeric)}
    p = float(r["p"] if r["p"] is not None else 0.0) if spec.visitor else None
    # job 2: (feature, level) counts of all categoricals in one pass. Rare levels
    # of lumped columns stay in Spark; "Other" is always there for them and for
    # levels that train has not seen.
    cat_cols = {c: F.col(c).cast("string") for c in list(spec.lump) + list(spec.onehot)}
    if spec.month:
        cat_cols["quarter"] = FE.quarter(spec.month)
    keep, levels = {c: [] for c in spec.lump}, {c: [] for c in cat_cols}
    if cat_cols:
        staged = train.select(*[e.alias(c) for c, e in cat_cols.items()])
        long = unpivot_long(staged, [], list(cat_cols), "feature", "level")
        frequent = F.col("count") >= F.lit(spec.min_share * r["n"])
        counted = long.groupBy("feature", "level").count().where(F.col("level").isNotNull())
        for row in FE.collect_levels(counted.where(~isin_safe("feature", spec.lump) | frequent)):
            (keep if row.feature in keep else levels)[row.feature].append(row.level)
        levels = {c: sorted({*keep[c], "Other"}) if c in keep else sorted(lv) for c, lv in levels.items()}
        keep = {c: sorted(lv) for c, lv in keep.items()}
    return Artifact(spec, p, keep, levels, means, sds)
