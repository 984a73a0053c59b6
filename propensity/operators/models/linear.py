"""Penalised logistic regression.

The lambda path starts at the smallest penalty that zeroes every coefficient
and is log-spaced down to 1e-4 of it. Cross-validation fits all folds together and
the penalties of a path in two passes, one job per Newton step; the final fit
is Spark ML's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.operators.features import design_matrix
from propensity.session import ship


def positive_score(df: DataFrame, prob_col: str = "probability", out: str = "score") -> DataFrame:
    """P(label = 1) out of Spark ML's probability vector."""
    return df.withColumn(out, vector_to_array(prob_col)[1])


def weighted_moments(train: DataFrame, features: Sequence[str], label: str, weight: str | None) -> dict:
    """Total weight, weighted label mean, and weighted mean and sd (1/N) of each feature: one aggregation."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = [F.col(f).cast("double") for f in features]
    r = train.agg(F.sum(w).alias("w"), F.sum(w * F.col(label)).alias("y"),
                  *[F.sum(w * v).alias(f"a{i}") for i, v in enumerate(x)]).first()
    mean = np.array([r[f"a{i}"] / r["w"] for i in range(len(x))])
    sq = train.agg(*[F.sum(w * (v - F.lit(float(m))) * (v - F.lit(float(m)))).alias(f"q{i}")
                     for i, (v, m) in enumerate(zip(x, mean))]).first() if x else []
    sd = np.sqrt(np.array([sq[f"q{i}"] for i in range(len(x))]) / r["w"])
    return {"weight": float(r["w"]), "label": float(r["y"] / r["w"]), "mean": mean, "sd": sd}


def lambda_max(train: DataFrame, features: Sequence[str], label: str = "label",
               weight: str | None = None, alpha: float = 0.5, moments: dict | None = None) -> float:
    """max_j |sum_i w_i z_ij (y_i - ybar_w)| / (sum_i w_i * alpha), z standardised by weighted moments.

    The least penalty that zeroes every coefficient; alpha is floored at 0.001
    so ridge gets a finite start.
    """
    m = moments or weighted_moments(train, features, label, weight)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    grads = [F.abs(F.sum(w * (F.col(f).cast("double") - F.lit(float(a))) / F.lit(float(s)) * (F.col(label) - F.lit(m["label"]))))
             .alias(f"g{i}") for i, (f, a, s) in enumerate(zip(features, m["mean"], m["sd"])) if s > 0]
    g = train.agg(*grads).first() if grads else []
    return max((float(v or 0.0) for v in g), default=0.0) / (m["weight"] * max(alpha, 0.001))


def lambda_path(lmax: float, n: int = 100, ratio: float = 1e-4) -> list[float]:
    if lmax <= 0:
        return [0.0]
    return [lmax * math.exp(math.log(ratio) * i / (n - 1)) for i in range(n)]


def _descend(grad: np.ndarray, hess: np.ndarray, beta: np.ndarray, lam: np.ndarray, alpha: np.ndarray,
             sweeps: int = 200) -> np.ndarray:
    """Coordinate descent on the quadratic models of a Newton step, one per row of ``beta`` (intercept first)."""
    new = beta.copy()
    diag = np.einsum("mjj->mj", hess)
    slope = grad.copy()                                     # of the quadratic model at ``new``
    for _ in range(sweeps):
        shift = 0.0
        for j in range(beta.shape[1]):
            d = np.maximum(diag[:, j], 1e-12)
            target = d * new[:, j] - slope[:, j]
            if j:
                target = np.sign(target) * np.maximum(np.abs(target) - lam * alpha, 0)
                d = d + lam * (1 - alpha)
            step = target / d - new[:, j]
            new[:, j] += step
            slope += hess[:, :, j] * step[:, None]
            shift = max(shift, float(np.abs(step).max()))
        if shift < 1e-8:
            break
    return new


#: A screened feature joins a fit's curvature sums once its slope is within this share of its penalty.
NEAR_PENALTY = 0.9


#: Cells of rows x fits that a task holds at once; a Newton step keeps several arrays of them.
BLOCK_CELLS = 400_000


def _blocks(batch, mean: np.ndarray, sd: np.ndarray, fits: int):
    """Standardised features behind a one, labels, weights and folds, in blocks that suit so many fits."""
    raw = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean))
    y, w, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "f"))
    size = max(1, BLOCK_CELLS // fits)
    for a in range(0, len(raw), size):
        x = np.concatenate([np.ones((len(raw[a:a + size]), 1)), (raw[a:a + size] - mean) / sd], axis=1)
        yield x, y[a:a + size, None], w[a:a + size, None], f[a:a + size, None]


class _PathFits:
    """Sums over ``rows`` (y, w, f, x) for many fits at once, merged in at most ``tasks`` tasks.

    A fit is one fold left out at one (alpha, lambda). What a task sends is bounded by the fits still running and
    their active features, and the number of tasks by ``tasks``: not by the rows, nor by the partitions they come in.
    """

    def __init__(self, rows: DataFrame, mean: np.ndarray, sd: np.ndarray, tasks: int):
        self.rows, self.mean, self.sd = rows.coalesce(tasks), mean, sd
        self.q = len(mean) + 1
        self.up = np.triu_indices(self.q)

    def _sum(self, sums, shape: tuple[int, int]) -> np.ndarray:
        got = self.rows.mapInArrow(sums, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
        out = np.zeros(shape[0] * shape[1])
        out[got["at"].to_numpy()] = got["v"].to_numpy()
        return out.reshape(shape)

    def step(self, beta: np.ndarray, fold: np.ndarray, active: np.ndarray):
        """Mean gradient (all features) and mean Hessian (active features only) of each fit at ``beta``."""
        q, (a, b), m, mean, sd = self.q, self.up, len(fold), self.mean, self.sd
        sent = np.concatenate([np.ones((m, q), bool), active[:, a] & active[:, b], np.ones((m, 1), bool)], axis=1)
        at = np.flatnonzero(sent.ravel())
        used = np.flatnonzero(sent[:, q:-1].any(axis=0))        # products that some fit asks for

        def sums(batches):
            out = np.zeros(sent.shape)
            for batch in batches:
                for x, y, w, f in _blocks(batch, mean, sd, m):
                    prob = 1 / (1 + np.exp(-np.clip(x @ beta.T, -35, 35)))
                    own = w * (f != fold)
                    out[:, :q] += (own * (prob - y)).T @ x
                    curve = own * np.maximum(prob * (1 - prob), 1e-5)
                    out[:, q + used] += curve.T @ (x[:, a[used]] * x[:, b[used]])
                    out[:, -1] += own.sum(0)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at), "v": pa.array(out.ravel()[at])})

        got = self._sum(sums, sent.shape)
        total = np.maximum(got[:, -1:], 1e-12)
        hess = np.zeros((m, q, q))
        hess[:, a, b] = got[:, q:-1] / total
        hess[:, b, a] = hess[:, a, b]
        return got[:, :q] / total, hess

    def deviance(self, beta: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Mean deviance of each fit on the fold it has left out."""
        mean, sd = self.mean, self.sd

        def sums(batches):
            out = np.zeros((len(fold), 2))
            for batch in batches:
                for x, y, w, f in _blocks(batch, mean, sd, len(fold)):
                    p = np.clip(1 / (1 + np.exp(-np.clip(x @ beta.T, -35, 35))), 1e-15, 1 - 1e-15)
                    own = w * (f == fold)
                    out[:, 0] += (-2 * own * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum(0)
                    out[:, 1] += own.sum(0)
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(out.size)), "v": pa.array(out.ravel())})

        got = self._sum(sums, (len(fold), 2))
        return got[:, 0] / np.maximum(got[:, 1], 1e-12)

    def solve(self, beta: np.ndarray, fold: np.ndarray, lam: np.ndarray, alpha: np.ndarray, max_iter: int,
              tol: float) -> np.ndarray:
        """Newton steps from ``beta``; a fit leaves once it moves less than ``tol`` and no screened feature wants in."""
        beta = beta.copy()
        active = np.concatenate([np.ones((len(beta), 1), bool), beta[:, 1:] != 0], axis=1)
        on = np.arange(len(beta))
        for _ in range(max_iter):
            grad, hess = self.step(beta[on], fold[on], active[on])
            was, bound = active[on], (lam[on] * alpha[on])[:, None]
            held = np.where(was, 1.0, 0.0)
            # a screened feature keeps its zero: no slope, no curvature, no step
            new = _descend(grad * held, hess, beta[on], lam[on], alpha[on])
            new = np.where(was, new, 0.0)
            late = ~was[:, 1:] & (np.abs(grad[:, 1:]) > bound * (1 + 1e-9))
            moved = np.abs(new - beta[on]).max(axis=1)
            beta[on] = new
            near = np.abs(grad[:, 1:]) > bound * NEAR_PENALTY
            active[on, 1:] = (new[:, 1:] != 0) | near
            on = on[(moved >= tol) | late.any(axis=1)]
            if not len(on):
                break
        return beta


def _between(knots: np.ndarray, n: int) -> np.ndarray:
    """Rows 0..n-1 with ``knots`` (row, column...) at every ``WARM_EVERY``-th, in a straight line between them."""
    place = np.arange(n) / WARM_EVERY
    low = np.minimum(place.astype(int), len(knots) - 1)
    high = np.minimum(low + 1, len(knots) - 1)
    share = (place - low).reshape(-1, *[1] * (knots.ndim - 1))
    return knots[low] * (1 - share) + knots[high] * share


#: Every so many penalties of a path one is fitted first; the rest start from a line between their neighbours.
WARM_EVERY = 8


def penalty_path_cv(train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None,
                    alphas: Sequence[float] = (0.5,), n_lambda: int = 100, fold_col: str = "fold", n_folds: int = 10,
                    max_iter: int = 25, tol: float = 1e-6, tasks: int | None = None) -> DataFrame:
    """Cross-validated deviance of elastic-net logistic regression: (alpha, reg_param, cv_deviance).

    All alphas and folds are fitted together, the penalties of a path in two
    passes: every ``WARM_EVERY``-th from zero, then the others from a line
    between their fitted neighbours. A Newton step is one job: every task sums
    the gradients of the fits still running and the curvature of their active
    features, and the small penalised quadratic problems are solved on the
    driver, whose data are bounded by fits x features^2. A feature is screened
    while its slope stays below its penalty; a fit only ends when none of its
    screened features breaks that (the optimality check). Rows are read in at
    most ``tasks`` tasks (default: the session's parallelism), so a step's
    shuffle does not grow with the partitions of ``train``. One more job reads
    the held-out deviance.
    """
    ship(train.sparkSession)
    feats = list(features)
    m = weighted_moments(train, feats, label, weight)
    paths = {a: lambda_path(lambda_max(train, feats, label, weight, a, m), n_lambda) for a in alphas}
    if tasks is None:
        spark = train.sparkSession
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = train.select(F.col(label).cast("double").alias("y"),
                        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                        F.col(fold_col).cast("int").alias("f"), F.array(*[F.col(x).cast("double") for x in feats]).alias("x"))
    fits = _PathFits(rows, m["mean"], np.where(m["sd"] > 0, m["sd"], np.inf), tasks)
    steps = len(next(iter(paths.values())))
    lam = np.array([paths[a] for a in alphas]).T[:, :, None] * np.ones(n_folds)       # penalty, alpha, fold
    alpha = np.broadcast_to(np.array(alphas, dtype=float)[None, :, None], lam.shape)
    fold = np.broadcast_to(np.arange(n_folds), lam.shape)
    beta = np.zeros((*lam.shape, fits.q))
    start = min(max(m["label"], 1e-9), 1 - 1e-9)
    beta[..., 0] = math.log(start / (1 - start))

    def solve(at: np.ndarray) -> None:
        got = fits.solve(beta[at].reshape(-1, fits.q), fold[at].ravel(), lam[at].ravel(), alpha[at].ravel(), max_iter, tol)
        beta[at] = got.reshape(beta[at].shape)

    knots = np.arange(0, steps, WARM_EVERY)
    solve(knots)
    rest = np.setdiff1d(np.arange(steps), knots)
    if len(rest):
        beta[rest] = _between(beta[knots], steps)[rest]
        solve(rest)
    mean = fits.deviance(beta.reshape(-1, fits.q), fold.ravel()).reshape(lam.shape).mean(axis=2)
    out = [(float(a), float(v), float(mean[k, i])) for i, a in enumerate(alphas) for k, v in enumerate(paths[a])]
    return train.sparkSession.createDataFrame(out, "alpha double, reg_param double, cv_deviance double")


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, weight: str | None, alpha: float,
                 reg_param: float, max_iter: int = 100):
    """One elastic-net logistic regression on all rows."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, elasticNetParam=alpha, regParam=reg_param,
                            maxIter=max_iter, standardization=True, family="binomial")
    if weight:
        lr.setWeightCol(weight)
    return lr.fit(design_matrix(train, features))


def best_penalties(table: DataFrame) -> dict[float, float]:
    """The penalty of least deviance for each alpha (the larger one of equals)."""
    order = F.struct("cv_deviance", (-F.col("reg_param")).alias("r"))
    return {r["alpha"]: r["best"] for r in table.groupBy("alpha").agg(F.min_by("reg_param", order).alias("best")).collect()}


def fit_logistic_cv(train: DataFrame, features: Sequence[str], label: str = "label",
                    weight: str | None = None, alpha: float = 0.5, n_lambda: int = 100,
                    fold_col: str = "fold", n_folds: int = 10, max_iter: int = 100):
    """elastic-net logistic regression, lambda = argmin CV deviance (``lambda.min``).

    ``train`` must carry ``fold_col`` (see ``split.fold_column``).
    Returns (fitted model on all train rows, CV table (alpha, reg_param, cv_deviance)).
    """
    table = penalty_path_cv(train, features, label, weight, [alpha], n_lambda, fold_col, n_folds)
    return fit_logistic(train, features, label, weight, alpha, best_penalties(table)[alpha], max_iter), table


def score_logistic(model, df: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    """Positive-class probability of a fitted logistic model."""
    s = model.transform(design_matrix(df, features))
    return positive_score(s, "probability", out).drop("features", "rawPrediction", "probability", "prediction")


def odds_ratios(model, features: Sequence[str]) -> DataFrame:
    """exp(beta) of non-zero coefficients, largest first (intercept excluded)."""
    return ranked_odds(SparkSession.getActiveSession(), features, model.coefficients.toArray())


def ranked_odds(spark: SparkSession, features: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """(feature, coefficient, odds_ratio, rank) of the coefficients that are not zero."""
    rows = [(f, float(b), float(math.exp(b))) for f, b in zip(features, coefficients) if b != 0.0]
    df = spark.createDataFrame(rows, "feature string, coefficient double, odds_ratio double")
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("odds_ratio").desc(), F.col("feature"))
    return df.withColumn("rank", F.row_number().over(w).cast("long"))


def odds_head_tail(odds: DataFrame, head: int = 10, tail: int = 5) -> DataFrame:
    """top ``head`` drivers and the bottom ``tail`` (by odds ratio)."""
    n = odds.count()
    return odds.where((F.col("rank") <= head) | (F.col("rank") > n - tail)) \
        .withColumn("part", F.when(F.col("rank") <= head, "top").otherwise("bottom"))
