"""Closed-form generative classifiers.

Fitting is one ``groupBy(label)`` aggregation -- per-class counts, sums and
(for LDA) sums of cross products -- whose result is a few numbers per class
and feature. Scoring is a literal column expression: no UDF, no join, no
model broadcast; it runs inside whole-stage codegen and on streams.

Spark's ``NaiveBayes(modelType="gaussian")`` uses the population variance;
the reference's naive Bayes uses the sample variance with floors (sd <= 0
-> 0.001, density <= 0 -> 0.001), so it is written out here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SD_FLOOR = 0.001        # fixed value: sd <= 0 is replaced by this
DENSITY_FLOOR = 0.001   # fixed value: a density <= 0 is replaced by this


# ------------------------------------------------------------------ Gaussian naive Bayes

@dataclass
class GaussianNB:
    features: list[str]
    classes: list            # sorted class values
    priors: dict             # class -> prior
    means: dict              # (class, feature) -> mean
    sds: dict                # (class, feature) -> sd (floored)

    def log_joint(self, c) -> Column:
        """ln prior_c + sum_j ln density_cj(x_j)."""
        total = F.lit(math.log(self.priors[c]))
        for f in self.features:
            m, s = self.means[(c, f)], self.sds[(c, f)]
            z = (F.col(f).cast("double") - F.lit(m)) / F.lit(s)
            dens = F.exp(F.lit(-0.5) * z * z) / F.lit(s * math.sqrt(2 * math.pi))
            total = total + F.log(F.when(dens <= 0, F.lit(DENSITY_FLOOR)).otherwise(dens))
        return total

    def posterior(self, positive=1) -> Column:
        """P(class = positive | x) for two classes: 1 / (1 + exp(L_neg - L_pos))."""
        neg = [c for c in self.classes if c != positive][0]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(self.log_joint(neg) - self.log_joint(positive)))

    def transform(self, df: DataFrame, out: str = "score", positive=1) -> DataFrame:
        return df.withColumn(out, self.posterior(positive))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, f, float(self.means[(c, f)]), float(self.sds[(c, f)]), float(self.priors[c]))
                for c in self.classes for f in self.features]
        return spark.createDataFrame(rows, "label double, feature string, mean double, sd double, prior double")

    @staticmethod
    def from_frame(table: DataFrame) -> GaussianNB:
        """The model that ``to_frame`` wrote; features in name order."""
        rows = table.collect()      # classes x features
        return GaussianNB(sorted({r.feature for r in rows}), sorted({r.label for r in rows}),
                          {r.label: r.prior for r in rows}, {(r.label, r.feature): r["mean"] for r in rows},
                          {(r.label, r.feature): r.sd for r in rows})


def fit_gaussian_nb(train: DataFrame, features: Sequence[str], label: str = "label") -> GaussianNB:
    """class priors from class frequencies; per class mean and sample sd (n-1)."""
    feats = list(features)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(feats):
        x = F.col(f).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    rows = train.groupBy(label).agg(*aggs).collect()   # one row per class
    n = sum(r["_n"] for r in rows)
    classes = sorted(r[label] for r in rows)
    priors, means, sds = {}, {}, {}
    for r in rows:
        c = r[label]
        priors[c] = r["_n"] / n
        for i, f in enumerate(feats):
            means[(c, f)] = float(r[f"m{i}"]) if r[f"m{i}"] is not None else 0.0
            s = r[f"s{i}"]
            sds[(c, f)] = float(s) if s is not None and s > 0 and not math.isnan(s) else SD_FLOOR
    return GaussianNB(feats, classes, priors, means, sds)


def nb_insights(model: GaussianNB, positive=1, top: int = 10, digits: int = 4,
                eps: float = 1e-9) -> DataFrame:
    """class means per feature, ratio mean_yes / (mean_no + eps), rounded, sorted, top n."""
    spark = SparkSession.getActiveSession()
    neg = [c for c in model.classes if c != positive][0]
    df = spark.createDataFrame(
        [(f, model.means[(neg, f)], model.means[(positive, f)]) for f in model.features],
        "feature string, mean_no double, mean_yes double")
    ratio = F.col("mean_yes") / (F.col("mean_no") + F.lit(eps))
    out = df.select("feature", F.bround("mean_no", digits).alias("mean_no"),
                    F.bround("mean_yes", digits).alias("mean_yes"), F.bround(ratio, digits).alias("ratio"))
    from pyspark.sql import Window
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("ratio").desc(), F.col("feature"))
    return out.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)


# ------------------------------------------------------------------ LDA

@dataclass
class LinearDiscriminant:
    features: list[str]
    coef: list[float]          # W^-1 (m1 - m0)
    intercept: float           # -(m0 + m1)' w / 2 + ln(pi1 / pi0)
    center: list[float]        # (m0 + m1) / 2
    scale: float               # sqrt(w' W w): LD1 has unit within-class variance

    def margin(self) -> Column:
        e = F.lit(self.intercept)
        for f, w in zip(self.features, self.coef):
            e = e + F.col(f).cast("double") * F.lit(float(w))
        return e

    def posterior(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))

    def ld1(self) -> Column:
        e = F.lit(0.0)
        for f, w, c in zip(self.features, self.coef, self.center):
            e = e + (F.col(f).cast("double") - F.lit(float(c))) * F.lit(float(w))
        return e / F.lit(self.scale)

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        return df.withColumn(out, self.posterior())

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per feature, and one (feature null) with intercept and scale."""
        rows = [(f, i, w, c) for i, (f, w, c) in enumerate(zip(self.features, self.coef, self.center))]
        return spark.createDataFrame([*rows, (None, -1, self.intercept, self.scale)],
                                     "feature string, place int, weight double, center double")

    @staticmethod
    def from_frame(table: DataFrame) -> LinearDiscriminant:
        head, *rows = sorted(table.collect(), key=lambda r: r.place)
        return LinearDiscriminant([r.feature for r in rows], [r.weight for r in rows], head.weight,
                                  [r.center for r in rows], head.center)


def class_moments(train: DataFrame, features: Sequence[str], label: str = "label") -> dict:
    """Per class: n, sums, sums of cross products -- one aggregation, p(p+1)/2 + p sums per class."""
    feats = list(features)
    p = len(feats)
    x = [F.col(f).cast("double") for f in feats]
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(x[i]).alias(f"s{i}") for i in range(p)]
    aggs += [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i, p)]
    out = {}
    for r in train.groupBy(label).agg(*aggs).collect():   # one row per class
        s = np.array([r[f"s{i}"] for i in range(p)], dtype=float)
        q = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        out[r[label]] = (r["_n"], s, q)
    return out


def fit_lda(train: DataFrame, features: Sequence[str], label: str = "label",
            priors: tuple[float, float] | None = (0.5, 0.5), positive=1) -> LinearDiscriminant:
    """F8: two-class LDA with pooled within-class covariance (divisor N - K).

    ``priors=None`` uses class frequencies. A singular covariance is an error.
    """
    mom = class_moments(train, features, label)
    neg = [c for c in mom if c != positive][0]
    (n0, s0, q0), (n1, s1, q1) = mom[neg], mom[positive]
    m0, m1 = s0 / n0, s1 / n1
    within = (q0 - n0 * np.outer(m0, m0)) + (q1 - n1 * np.outer(m1, m1))
    W = within / (n0 + n1 - 2)
    if np.linalg.matrix_rank(W) < W.shape[0]:
        raise ValueError("within-class covariance is singular; drop constant or collinear columns")
    w = np.linalg.solve(W, m1 - m0)
    pi0, pi1 = priors if priors else (n0 / (n0 + n1), n1 / (n0 + n1))
    c = -float((m0 + m1) @ w) / 2 + math.log(pi1 / pi0)
    return LinearDiscriminant(list(features), [float(v) for v in w], c,
                              [float(v) for v in (m0 + m1) / 2], float(math.sqrt(w @ W @ w)))
