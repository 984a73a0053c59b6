"""Model explanation.

* Permutation importance: every row also carries the values of another row
  (one numbering, one join); one job scores all variants, and the accuracy
  drop per feature is recorded.
* Partial dependence: every row is replicated over a small fixed grid of
  values for one feature (an ``explode`` of a literal array, no join),
  scored, and averaged per grid value on the half-log-odds scale.
* TreeSHAP for boosted trees: the node table of the fitted model (bounded by
  trees x nodes) is read once on the driver and shipped to ``mapInPandas``;
  each task computes exact path-dependent SHAP values for its rows with
  NumPy, vectorised over rows (per leaf the value function is a product
  over the features on its path, so Shapley values need only the <= 2^depth
  subsets of those features). The mean |SHAP| per feature is a Spark
  aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions.cumulative import running_totals
from propensity.operators.models.trees import score_model

EPS = 2.220446049250313e-16   # fixed value: machine epsilon used for log(0)

def numbered(df: DataFrame, key: str, seed: int, out: str = "_i") -> DataFrame:
    """``df`` with ``out``: 1..n in the order of a seeded hash of the (unique) key, over all rows."""
    hashed = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))).withColumn("_one", F.lit(1))
    return running_totals(hashed, "_h", ["_one"]).withColumn(out, F.col("_one_cum")).drop("_h", "_one", "_one_cum")


def permutation_importance(model, df: DataFrame, features: Sequence[str], key: str, label: str = "label",
                           seed: int = 7, threshold: float = 0.5) -> DataFrame:
    """accuracy on ``df`` minus accuracy with one feature permuted, per feature.

    The rows are numbered once in a random order; a row's permuted values are
    those of the next row in that order (the first follows the last), carried
    over by one join. All variants, one per feature and one unchanged, are
    scored by one job.
    """
    rows = numbered(df.select(key, label, *features), key, seed)
    n = df.count()
    swap = rows.select(F.when(F.col("_i") == 1, F.lit(n)).otherwise(F.col("_i") - 1).alias("_i"),
                       F.struct(*[F.col(f).alias(f"c{j}") for j, f in enumerate(features)]).alias("_other"))
    both = rows.join(swap, "_i").withColumn("_variant", F.explode(F.array(*[F.lit(j) for j in range(-1, len(features))])))
    tried = both.select(label, "_variant", *[
        F.when(F.col("_variant") == j, F.col(f"_other.c{j}")).otherwise(F.col(f)).alias(f) for j, f in enumerate(features)])
    hit = ((F.col("score") >= threshold).cast("double") == F.col(label)).cast("double")
    got = {r["_variant"]: r["a"] for r in score_model(model, tried, features).groupBy("_variant")
           .agg(F.avg(hit).alias("a")).collect()}       # features + 1 numbers
    return df.sparkSession.createDataFrame([(f, float(got.get(-1, 0.0) - got.get(j, 0.0)))
                                            for j, f in enumerate(features)], "feature string, importance double")


def partial_dependence(model, df: DataFrame, features: Sequence[str], targets: Sequence[str],
                       n_grid: int = 51) -> DataFrame:
    """mean over rows of 0.5 * (log p1 - log p0) with one feature set to each grid value.

    Grid: ``min(n_grid, distinct values)`` equally spaced points between the
    feature's min and max (as R's ``partialPlot``). ``model`` is a fitted Spark
    ML model, or a function ``df -> df with a 'score' column`` (closed-form models).
    """
    out = None
    for f in targets:
        st = df.agg(F.min(f).alias("lo"), F.max(f).alias("hi"), F.countDistinct(f).alias("nd")).first()
        k = max(1, min(n_grid, int(st["nd"])))
        lo, hi = float(st["lo"]), float(st["hi"])
        grid = [lo + (hi - lo) * i / (k - 1) for i in range(k)] if k > 1 else [lo]
        rep = df.select(*features).withColumn("_g", F.explode(F.array(*[F.lit(g) for g in grid]))) \
            .withColumn(f, F.col("_g"))
        s = model(rep) if callable(model) and not hasattr(model, "transform") else score_model(model, rep, features)
        p1 = F.greatest(F.col("score"), F.lit(EPS))
        p0 = F.greatest(F.lit(1.0) - F.col("score"), F.lit(EPS))
        pd_ = s.groupBy("_g").agg(F.avg(F.lit(0.5) * (F.log(p1) - F.log(p0))).alias("pd")) \
            .select(F.lit(f).alias("feature"), F.col("_g").alias("value"), "pd")
        out = pd_ if out is None else out.unionByName(pd_)
    return out


# ------------------------------------------------------------------ TreeSHAP

def tree_leaves(model) -> tuple[list, list[float]]:
    """Leaves of every tree: (tree weight, value, [(feature, threshold, goes_left, cover_ratio), ...]).

    Read through the model's node objects (continuous splits: left when x <= threshold).
    """
    weights = list(model.treeWeights)
    trees = []
    for t, w in zip(model.trees, weights):
        leaves = []
        stack = [(t._java_obj.rootNode(), [])]
        while stack:
            node, path = stack.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                leaves.append((float(node.prediction()), path))
                continue
            split = node.split()
            fi, thr = int(split.featureIndex()), float(split.threshold())
            c = float(node.impurityStats().count())
            lc, rc = node.leftChild(), node.rightChild()
            cl, cr = float(lc.impurityStats().count()), float(rc.impurityStats().count())
            stack.append((lc, path + [(fi, thr, True, cl / c if c > 0 else 0.5)]))
            stack.append((rc, path + [(fi, thr, False, cr / c if c > 0 else 0.5)]))
        trees.append((float(w), leaves))
    return trees, weights


def _shap_batch(X: np.ndarray, trees: list) -> tuple[np.ndarray, float]:
    """Exact path-dependent SHAP values for rows X (n x p) of an additive tree ensemble."""
    n, p = X.shape
    phi = np.zeros((n, p))
    expected = 0.0
    for w, leaves in trees:
        for value, path in leaves:
            feats = sorted({f for f, _, _, _ in path})
            A = np.ones((n, len(feats)))
            r = np.ones(len(feats))
            for f, thr, left, ratio in path:
                j = feats.index(f)
                A[:, j] *= (X[:, f] <= thr) if left else (X[:, f] > thr)
                r[j] *= ratio
            expected += w * value * float(np.prod(r))
            m = len(feats)
            wts = [math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)]
            for i in range(m):
                # coefficients of prod_{j != i} (r_j + A_j x): the x^k term sums the
                # value products over all subsets of size k of the other path features
                poly = [np.ones(n)]
                for j in range(m):
                    if j == i:
                        continue
                    nxt = [poly[0] * r[j]]
                    for k in range(1, len(poly)):
                        nxt.append(poly[k] * r[j] + poly[k - 1] * A[:, j])
                    nxt.append(poly[-1] * A[:, j])
                    poly = nxt
                acc = sum(wts[k] * poly[k] for k in range(m))
                phi[:, feats[i]] += w * value * acc * (A[:, i] - r[i])
    return phi, expected


def tree_shap(model, df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """per-row SHAP contributions of a gradient-boosted model's margin (sum of weighted trees).

    Output: key, one ``phi_<feature>`` column per feature, ``expected`` and
    ``margin`` (sum of contributions + expected = margin, checked in tests).
    """
    trees, _ = tree_leaves(model)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(trees)   # bounded by the model: trees x leaves x depth
    feats = list(features)
    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, " + ", ".join(f"phi_{i} double" for i in range(len(feats))) + \
        ", expected double, margin double"

    def run(batches):
        tr = bc.value
        for pdf in batches:
            X = pdf[feats].to_numpy(dtype=float)
            phi, ev = _shap_batch(X, tr)
            out = pd.DataFrame(phi, columns=[f"phi_{i}" for i in range(len(feats))])
            out.insert(0, key, pdf[key].to_numpy())
            out["expected"] = ev
            out["margin"] = phi.sum(axis=1) + ev
            yield out

    res = df.select(key, *feats).mapInPandas(run, schema)
    return res.select(key, *[F.col(f"phi_{i}").alias(f"phi_{f}") for i, f in enumerate(feats)], "expected", "margin")


def shap_summary(contrib: DataFrame, features: Sequence[str]) -> DataFrame:
    """mean |SHAP| per feature (one aggregation, long output)."""
    row = contrib.agg(*[F.avg(F.abs(F.col(f"phi_{f}"))).alias(f"m{i}") for i, f in enumerate(features)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean_abs_shap"))
                                          for i, f in enumerate(features)])).alias("e")).select("e.*")
