"""Trees, forests and boosting on Spark ML.

Substitutions (documented in the README):
* rpart's cost-complexity pruning -> cross-validated ``minInfoGain`` grid;
* per-tree balanced draws -> balanced class weights, or an exact balanced
  sample (``split.sample_balanced``) once per fit;
* out-of-bag votes (Spark keeps none) -> out-of-fold scores;
* xgboost's leaf L1/L2/gamma penalties -> nearest Spark GBT parameters.
Every fit is a Spark ML job (distributed tree induction on binned
features); the driver only loops over a handful of candidate settings.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.operators import evaluate as EV
from propensity.operators.features import design_matrix
from propensity.session import checkpoint_dir

PRUNE_GRID = [0.0, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05]


def _score(model, df: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    s = model.transform(design_matrix(df, features))
    return s.withColumn(out, vector_to_array("probability")[1]) \
        .drop("features", "rawPrediction", "probability", "prediction")


score_model = _score


# ------------------------------------------------------------------ F4, F5

def fit_tree_cv(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None,
                grid: Sequence[float] = PRUNE_GRID, fold_col: str = "fold", max_depth: int = 10,
                min_leaf: int = 7, seed: int = 123, n_folds: int = 5, parallelism: int = 4):
    """F4 + F5: weighted Gini tree; complexity chosen by least cross-validated weighted error.

    Returns (tree refit on all train rows, path table (min_info_gain, cv_error)).
    """
    dt = DecisionTreeClassifier(featuresCol="features", labelCol=label, impurity="gini", maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, seed=seed)
    if weight:
        dt.setWeightCol(weight)
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    if weight:
        ev.setWeightCol(weight)
    pg = ParamGridBuilder().addGrid(dt.minInfoGain, list(grid)).build()
    cv = CrossValidator(estimator=dt, estimatorParamMaps=pg, evaluator=ev, foldCol=fold_col,
                        numFolds=n_folds, parallelism=parallelism)
    fitted = cv.fit(design_matrix(train, features))
    spark = train.sparkSession
    path = spark.createDataFrame([(float(g), 1.0 - float(a)) for g, a in zip(grid, fitted.avgMetrics)],
                                 "min_info_gain double, cv_error double")
    return fitted.bestModel, path


# ------------------------------------------------------------------ F10, F11

def fit_forest(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None,
               num_trees: int = 500, mtry: int | None = None, nodesize: int = 1, max_depth: int = 10,
               seed: int = 42, subsampling: float = 1.0):
    """random forest, ``mtry`` features per split (default floor(sqrt(p)))."""
    p = len(features)
    mtry = mtry or max(1, int(p ** 0.5))
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees,
                                featureSubsetStrategy=str(min(mtry, p)), minInstancesPerNode=nodesize,
                                maxDepth=max_depth, seed=seed, subsamplingRate=subsampling)
    if weight:
        rf.setWeightCol(weight)
    return rf.fit(design_matrix(train, features))


def side_by_side(jobs: Sequence, workers: int = 4) -> list:
    """Results of independent fits, run at the same time: Spark interleaves their jobs."""
    with ThreadPoolExecutor(workers) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def out_of_fold_scores(train: DataFrame, features: Sequence[str], fit_fn, fold_col: str = "fold",
                       k: int = 5, out: str = "score") -> DataFrame:
    """score each fold with a model fitted on the other folds; union of the k folds.

    Stands in for out-of-bag votes. ``fit_fn(df) -> model``.
    """
    models = side_by_side([lambda f=f: fit_fn(train.where(F.col(fold_col) != f)) for f in range(k)])
    parts = [_score(m, train.where(F.col(fold_col) == f), features, out) for f, m in enumerate(models)]
    return reduce(DataFrame.unionByName, parts)


@dataclass
class ForestArrays:
    """Nodes of all trees of a forest in one numbering; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    depth: int

    def votes(self, x: np.ndarray, tree: int) -> np.ndarray:
        node = np.full(len(x), self.roots[tree])
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.prediction[node]


def forest_arrays(forest) -> ForestArrays:
    """The nodes of a fitted forest (continuous splits), read from its saved form; bounded by the model."""
    spark = SparkSession.getActiveSession()
    path = f"{checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    forest.save(path)
    n = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "prediction", "leftChild", "rightChild", F.col("split.featureIndex").alias("f"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("t")).orderBy("treeID", "id").toPandas()
    first = n.groupby("treeID")["id"].transform("size").groupby(n["treeID"]).first().cumsum().shift(fill_value=0)
    base = n["treeID"].map(first).to_numpy()
    at = base + n["id"].to_numpy()                          # ids count from 0 in every tree
    leaf = n["leftChild"].to_numpy() < 0
    out = ForestArrays(first.to_numpy(), *[np.zeros(len(n), dtype=d) for d in (int, float, int, int, float)],
                       max(t.depth for t in forest.trees))
    out.feature[at] = np.where(leaf, 0, n["f"].to_numpy())
    out.threshold[at] = np.where(leaf, np.inf, n["t"].fillna(0).to_numpy())
    out.left[at] = np.where(leaf, at, base + n["leftChild"].to_numpy())
    out.right[at] = np.where(leaf, at, base + n["rightChild"].to_numpy())
    out.prediction[at] = n["prediction"].to_numpy()
    return out


def tree_error_path(forest, df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Error of the forest made of its first n trees, n = 1..T, from one pass over ``df``.

    The plan does not grow with the trees: each task sends its rows through the
    flattened trees one after another, keeps the running votes, and emits T
    error counts; Spark sums them per n.
    """
    trees = forest_arrays(forest)
    total = len(trees.roots)
    rows = df.select(F.col(label).cast("double").alias("y"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))

    def run(batches):
        wrong, n = np.zeros(total), 0
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            yes = np.zeros(len(x))
            for t in range(total):
                yes += trees.votes(x, t)
                wrong[t] += ((yes / (t + 1) > 0.5) != (y > 0.5)).sum()
            n += len(x)
        yield pa.RecordBatch.from_pydict({"n_trees": pa.array(np.arange(1, total + 1)), "n_wrong": pa.array(wrong),
                                          "n_rows": pa.array(np.full(total, float(n)))})

    counts = rows.mapInArrow(run, "n_trees long, n_wrong double, n_rows double")
    return counts.groupBy("n_trees").agg((F.sum("n_wrong") / F.sum("n_rows")).alias("error")).orderBy("n_trees")


def stable_iteration(series: DataFrame, order_col: str, value_col: str, tol: float = 0.0005,
                     run: int = 50, fallback: int | None = None) -> DataFrame:
    """first n at which ``run`` successive |error change| < tol have been seen; else ``fallback``.

    Gaps and islands: a running count of "big" changes numbers the runs of
    small ones; ``row_number`` inside a run gives its length. The series is
    one row per iteration (tree count / day), so its window is small.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("n")
    s = series.select(F.col(order_col).alias("n"), F.col(value_col).alias("v")) \
        .withColumn("d", F.abs(F.col("v") - F.lag("v").over(w))) \
        .withColumn("small", F.coalesce(F.col("d") < tol, F.lit(False)).cast("int"))
    run_id = F.sum(1 - F.col("small")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    s = s.withColumn("grp", run_id)
    s = s.withColumn("len", F.sum("small").over(
        Window.partitionBy("grp").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)))
    fb = F.lit(fallback) if fallback is not None else F.max("n")
    return s.agg(F.coalesce(F.min(F.when(F.col("len") >= run, F.col("n"))), fb).cast("long").alias("stable_n"))


# ------------------------------------------------------------------ F13, F14

def forest_tuning(train: DataFrame, features: Sequence[str], label: str = "label", fold_col: str = "fold",
                  k: int = 5, num_trees: int = 500, mtry_grid: Sequence[int] | None = None,
                  node_grid: Sequence[int] = (1, 5, 10, 20, 50), ratios: Sequence[float] = (1.0, 1.5, 2.0),
                  seed: int = 42) -> DataFrame:
    """F13 + F14: coordinate search mtry -> nodesize -> class ratio -> mtry, by out-of-fold PR-AUC.

    The class ratio r weighs the majority class so that it carries r times
    the minority's total weight (the expected effect of a 1:r draw).
    Returns the sensitivity table: parameter, value, oof_error, pr_auc, precision,
    recall, f1, balanced_accuracy.
    """
    p = len(features)
    mtry_grid = list(mtry_grid or range(2, max(3, p // 2 + 1), 2))
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    n_pos, n_neg = counts.get(1.0, counts.get(1, 0)), sum(v for kk, v in counts.items() if kk not in (1, 1.0))

    def evaluate(mtry, nodesize, ratio):
        data = ratio_weights(train, label, n_pos, n_neg, ratio)
        oof = out_of_fold_scores(
            data, features,
            lambda d: fit_forest(d, features, label, "_w", num_trees, mtry, nodesize, seed=seed),
            fold_col, k).select("score", label).cache()
        pr = EV.pr_auc(oof, (), "score", label).first()["pr_auc"] or 0.0
        conf = EV.confusion(oof.withColumn("_g", F.lit("m")), 0.5, ["_g"], "score", label)
        m = EV.metrics(conf, ["_g"]).first()
        oof.unpersist()
        return {"pr_auc": pr, "oof_error": 1 - (m["accuracy"] or 0.0), "precision": m["precision"],
                "recall": m["sensitivity"], "f1": m["f1"], "balanced_accuracy": m["balanced_accuracy"]}

    rows = []
    best = {"mtry": max(1, int(p ** 0.5)), "nodesize": 1, "ratio": 1.0}

    def step(name, key, grid):
        tried = side_by_side([lambda v=v: evaluate(**{**best, key: v}) for v in grid], 2)
        results = list(zip(grid, tried))
        v, r = max(results, key=lambda t: (t[1]["pr_auc"], -grid.index(t[0])))
        best[key] = v
        rows.append((name, str(v), r))

    base = evaluate(**best)
    rows.append(("base", str(best["mtry"]), base))
    step("mtry", "mtry", mtry_grid)
    step("nodesize", "nodesize", list(node_grid))
    step("ratio", "ratio", list(ratios))
    step("refinement", "mtry", mtry_grid)
    spark = train.sparkSession
    return spark.createDataFrame(
        [(n, v, float(r["oof_error"]), float(r["pr_auc"]), _f(r["precision"]), _f(r["recall"]), _f(r["f1"]),
          _f(r["balanced_accuracy"])) for n, v, r in rows],
        "parameter string, selected_value string, oof_error double, pr_auc double, precision double, "
        "recall double, f1 double, balanced_accuracy double")


def ratio_weights(df: DataFrame, label: str, n_pos: int, n_neg: int, ratio: float) -> DataFrame:
    """``_w``: positives weigh 1, negatives so much that they carry ``ratio`` times the positives' total."""
    return df.withColumn("_w", F.when(F.col(label) == 1, F.lit(1.0)).otherwise(F.lit(ratio * n_pos / n_neg if n_neg else 1.0)))


def tuned_parameters(table: DataFrame) -> dict:
    """mtry, nodesize and ratio that the search ended with."""
    got = {r["parameter"]: r["selected_value"] for r in table.collect()}       # five rows
    return {"mtry": int(got["refinement"]), "nodesize": int(got["nodesize"]), "ratio": float(got["ratio"])}


def _f(x):
    return None if x is None else float(x)


# ------------------------------------------------------------------ F15-F19

def fit_boost(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None,
              max_iter: int = 30, step_size: float = 0.3, max_depth: int = 6, min_leaf: int = 1,
              min_gain: float = 0.0, subsampling: float = 1.0, feature_share: float = 1.0, seed: int = 42,
              validation_col: str | None = None, validation_tol: float = 0.01):
    """Gradient-boosted trees (logistic loss)."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, stepSize=step_size,
                        maxDepth=max_depth, minInstancesPerNode=min_leaf, minInfoGain=min_gain,
                        subsamplingRate=subsampling, seed=seed, lossType="logistic",
                        featureSubsetStrategy="all" if feature_share >= 1 else str(feature_share))
    if weight:
        gbt.setWeightCol(weight)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col).set(gbt.validationTol, validation_tol)
    return gbt.fit(design_matrix(train, features))


#: The bounded parameters of the search: depth, step, row and column shares, leaf size, least gain.
BOOST_SPACE = {"max_depth": (2, 8), "step_size": (0.01, 0.3), "subsampling": (0.5, 1.0), "feature_share": (0.5, 1.0),
               "min_leaf": (1, 20), "min_gain": (0.0, 0.2)}
BOOST_INTEGERS = ("max_depth", "min_leaf")


def boost_tuning(train: DataFrame, role_col: str, features: Sequence[str], label: str = "label",
                 weight: str | None = None, n_init: int = 5, n_iter: int = 10, seed: int = 42,
                 space: dict | None = None, max_rounds: int = 100) -> DataFrame:
    """F16: seeded random search (n_init) then local steps around the best (n_iter), by hold-out PR-AUC.

    ``role_col`` (C2) marks the rows to fit and those of the later period to
    ``validate`` on. Each trial is one GBT fit that stops early on the validation
    rows (F17), scored there. Returns the trial table with ranks; ``rounds`` is
    where a trial stopped.
    """
    rng = random.Random(seed)
    space = space or BOOST_SPACE
    rows = train.where(F.col(role_col).isin("fit", "validate")).withColumn("_held", F.col(role_col) == "validate")
    held = rows.where("_held")

    def draw(center=None, scale=1.0):
        out = {}
        for k, (lo, hi) in space.items():
            v = rng.uniform(lo, hi) if center is None else \
                min(hi, max(lo, center[k] + rng.gauss(0, scale * (hi - lo) / 4)))
            out[k] = int(round(v)) if k in BOOST_INTEGERS else v
        return out

    def run(params):
        m = fit_boost(rows, features, label, weight, max_iter=max_rounds, **params, seed=seed, validation_col="_held")
        pr = EV.pr_auc(_score(m, held, features).select("score", label), (), "score", label).first()
        return params, float((pr["pr_auc"] if pr else None) or 0.0), m.getNumTrees

    first = [draw() for _ in range(n_init)]
    trials = side_by_side([lambda p=p: run(p) for p in first])
    for i in range(n_iter):
        best = max(trials, key=lambda t: t[1])[0]
        trials.append(run(draw(best, scale=1.0 - i / max(n_iter, 1) * 0.8)))
    names = list(space)
    kinds = ", ".join(f"{k} {'int' if k in BOOST_INTEGERS else 'double'}" for k in names)
    df = train.sparkSession.createDataFrame(
        [(i + 1, *[p[k] for k in names], n, pr) for i, (p, pr, n) in enumerate(trials)],
        f"trial int, {kinds}, rounds int, pr_auc double")
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("pr_auc").desc(), "trial")
    return df.withColumn("rank", F.row_number().over(w).cast("long"))


def best_trial(trials: DataFrame) -> dict:
    """Parameters of the first-ranked trial, as ``fit_boost`` takes them."""
    row = trials.where(F.col("rank") == 1).drop("trial", "rounds", "pr_auc", "rank").first()
    return row.asDict()


def boost_rounds(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None,
                 fold_col: str = "fold", k: int = 5, max_rounds: int = 300, patience: int = 30,
                 **params) -> DataFrame:
    """rounds by cross-validated log-loss (``evaluateEachIteration``), with patience.

    For each fold a GBT is fitted on the other folds and its held-out loss after
    every round is read in one pass; losses are averaged over folds. Rounds come
    in growing stretches (a longer fit begins with the same trees), until
    ``patience`` rounds bring no improvement or ``max_rounds`` are reached.
    Returns (round, cv_loss, chosen).
    """
    def losses(fold: int, rounds: int) -> np.ndarray:
        m = fit_boost(train.where(F.col(fold_col) != fold), features, label, weight, max_iter=rounds, **params)
        got = m.evaluateEachIteration(design_matrix(train.where(F.col(fold_col) == fold), features))
        return np.array([*got, *[got[-1]] * (rounds - len(got))])

    rounds = min(max_rounds, patience + 10)
    while True:
        mean = np.mean(side_by_side([lambda f=f: losses(f, rounds) for f in range(k)]), axis=0)
        best = int(mean.argmin())
        if rounds - 1 - best >= patience or rounds == max_rounds:
            break
        rounds = min(max_rounds, 2 * rounds)
    # what stopping at the first pause of ``patience`` rounds would have chosen
    low = np.minimum.accumulate(mean)
    since = np.arange(rounds) - np.array([int(np.flatnonzero(mean[:i + 1] == low[i])[0]) for i in range(rounds)])
    stop = int(np.flatnonzero(since >= patience)[0]) if (since >= patience).any() else rounds - 1
    best = int(mean[:stop + 1].argmin())
    return train.sparkSession.createDataFrame([(i + 1, float(v), int(i == best)) for i, v in enumerate(mean)],
                                              "round int, cv_loss double, chosen int")


def model_pick(cmp: DataFrame, default: str, tuned: str, model_col: str = "model") -> DataFrame:
    """the tuned model wins only with a strictly higher PR-AUC; ties keep the default."""
    m = F.col(model_col)
    two = cmp.where(m.isin(default, tuned)).agg(
        F.max(F.when(m == default, F.col("pr_auc"))).alias("default_pr_auc"),
        F.max(F.when(m == tuned, F.col("pr_auc"))).alias("tuned_pr_auc"))
    return two.select(F.lit(default).alias("default_model"), F.lit(tuned).alias("tuned_model"),
                      "default_pr_auc", "tuned_pr_auc",
                      F.when(F.col("tuned_pr_auc") > F.col("default_pr_auc"), F.lit(tuned))
                       .otherwise(F.lit(default)).alias("picked"))
