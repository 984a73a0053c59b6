"""Dimension reduction and segmentation.

PCA is Spark ML (distributed covariance). K-means runs all of its restarts in
one job per Lloyd iteration; a task sends back one row per centre.
FastICA is written as an iteration of single aggregations over the
whitened rows: each step sums E[z g(w'z)] and E[g'(w'z)] -- 6 numbers for
two components -- and the 2x2 update happens on the driver. Assignment to
centres is an array expression (no UDF, no join); cross-tabs and profiles
are group-bys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.operators.features import design_matrix
from propensity.session import ship


def array_to_vector_df(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


# ------------------------------------------------------------------ E1-E3 PCA

def fit_pca(df: DataFrame, cols: Sequence[str] | None = None, k: int = 2, vector_col: str | None = None):
    """Centred, unscaled PCA (``prcomp`` default).

    Spark's PCA does not centre its scores, so a mean-only StandardScaler runs first.
    Returns (scaler model, pca model, input with a centred ``cfeatures`` vector).
    """
    data = array_to_vector_df(df, vector_col) if vector_col else design_matrix(df, cols)
    sc = StandardScaler(inputCol="features", outputCol="cfeatures", withMean=True, withStd=False).fit(data)
    cdata = sc.transform(data)
    pca = PCA(k=k, inputCol="cfeatures", outputCol="pcs").fit(cdata)
    return sc, pca, cdata


def _signs(pc: np.ndarray) -> np.ndarray:
    """+1/-1 per component so that its largest absolute loading is positive."""
    idx = np.abs(pc).argmax(axis=0)
    return np.where(pc[idx, np.arange(pc.shape[1])] < 0, -1.0, 1.0)


def pca_scores(pca, cdata: DataFrame, keep: Sequence[str], k: int = 2) -> DataFrame:
    """First k principal-component scores per row (sign-fixed)."""
    s = _signs(pca.pc.toArray())
    out = pca.transform(cdata).withColumn("_pc", vector_to_array("pcs"))
    return out.select(*keep, *[(F.col("_pc")[i] * float(s[i])).alias(f"pc{i + 1}") for i in range(k)])


def pca_variance(pca) -> DataFrame:
    """Proportion of variance explained and its running total per component."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    ev = [float(x) for x in pca.explainedVariance.toArray()]
    cum = np.cumsum(ev).tolist()
    return spark.createDataFrame([(i + 1, ev[i], float(cum[i])) for i in range(len(ev))],
                                 "component int, proportion double, cumulative double")


def pca_loadings(pca, names: Sequence[str]) -> DataFrame:
    """Loadings in long form (feature, component, loading), sign-fixed."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    pc = pca.pc.toArray()
    s = _signs(pc)
    rows = [(names[i], j + 1, float(pc[i, j] * s[j])) for i in range(pc.shape[0]) for j in range(pc.shape[1])]
    return spark.createDataFrame(rows, "feature string, component int, loading double")


# ------------------------------------------------------------------ E4 FastICA

def fast_ica(df: DataFrame, cols: Sequence[str] | None = None, n_comp: int = 2, vector_col: str | None = None,
             keep: Sequence[str] = (), max_iter: int = 200, tol: float = 1e-4, seed: int = 0,
             alpha: float = 1.0) -> tuple[DataFrame, np.ndarray]:
    """Symmetric FastICA with the logcosh contrast (Hyvarinen 1999).

    Whitening: centre, project on the top ``n_comp`` principal axes, scale to
    unit variance. Each iteration is ONE aggregation over the whitened rows
    (E[z g(Wz)'] and E[g'(Wz)]); the unmixing update and the symmetric
    decorrelation W <- (W W')^(-1/2) W are n_comp x n_comp driver algebra.
    Returns (scores with ic1..icK, unmixing matrix).
    """
    sc, pca, cdata = fit_pca(df, cols, n_comp, vector_col)
    ev = np.array(pca.explainedVariance.toArray())
    # eigenvalues of the sample covariance: proportion x total variance
    n, tot = cdata.select(vector_to_array("cfeatures").alias("a")).select(
        F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x * x).alias("ss")).agg(F.count("*"), F.sum("ss")).first()
    lam = ev * (tot / (n - 1))   # explainedVariance is eigenvalue / trace
    scale = 1.0 / np.sqrt(np.maximum(lam, 1e-300))
    z = pca.transform(cdata).withColumn("_pc", vector_to_array("pcs")) \
        .select(*keep, *[(F.col("_pc")[i] * float(scale[i])).alias(f"z{i}") for i in range(n_comp)])
    z = z.persist()
    rng = np.random.default_rng(seed)
    W = _sym_decorrelate(rng.standard_normal((n_comp, n_comp)))
    zc = [F.col(f"z{i}") for i in range(n_comp)]
    for _ in range(max_iter):
        u = [sum((zc[j] * float(W[i, j]) for j in range(n_comp)), F.lit(0.0)) for i in range(n_comp)]
        g = [F.tanh(F.lit(alpha) * ui) for ui in u]
        aggs = [F.avg(zc[a] * g[b]).alias(f"e{a}_{b}") for a in range(n_comp) for b in range(n_comp)]
        aggs += [F.avg(F.lit(alpha) * (F.lit(1.0) - g[b] * g[b])).alias(f"d{b}") for b in range(n_comp)]
        r = z.agg(*aggs).first()
        Ezg = np.array([[r[f"e{a}_{b}"] for a in range(n_comp)] for b in range(n_comp)])  # rows: component b
        Edg = np.array([r[f"d{b}"] for b in range(n_comp)])
        W1 = _sym_decorrelate(Ezg - Edg[:, None] * W)
        lim = np.max(np.abs(np.abs(np.diag(W1 @ W.T)) - 1))
        W = W1
        if lim < tol:
            break
    z.unpersist()
    # components are defined up to sign: make each row's largest absolute weight positive
    W = W * np.where(W[np.arange(n_comp), np.abs(W).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    scores = z.select(*keep, *[sum((zc[j] * float(W[i, j]) for j in range(n_comp)), F.lit(0.0)).alias(f"ic{i + 1}")
                               for i in range(n_comp)])
    return scores, W


def _sym_decorrelate(W: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(W @ W.T)
    return u @ np.diag(1.0 / np.sqrt(np.maximum(s, 1e-300))) @ u.T @ W


# ------------------------------------------------------------------ E5-E7 k-means

def is_point(x: Column) -> Column:
    """Whether an array is there and all of its entries are finite numbers."""
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & fine, F.lit(False))


@dataclass
class Clusters:
    """Centres of a k-means run and its within-cluster sum of squares (no centres: nothing to fit on)."""

    centres: np.ndarray
    cost: float

    def assign(self, data: DataFrame, features_col: str = "features", out: str = "prediction") -> DataFrame:
        """The nearest centre's number; null for a row that is no point, and without centres."""
        x = vector_to_array(features_col)
        if not len(self.centres):
            return data.withColumn(out, F.lit(None).cast("int"))
        near = assign_nearest(data, x, dict(enumerate(self.centres.tolist())), out).drop("dist")
        return near.withColumn(out, F.when(is_point(x), F.col(out)))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 from 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54


def _spread(rows: DataFrame, runs: Sequence[int], seed: int) -> list[np.ndarray]:
    """The starts of all runs (k of each): k-means++ over all rows, every centre one job for all runs together.

    Each distinct vector draws a waiting time with its number of rows times the
    squared distance to the run's centres so far as rate, made from its hash; the
    first one is the next centre. So copies count as often as they are there,
    and the draw depends neither on partitions nor on the table's size. Distances
    are taken only for vectors that could still be first: a waiting time is at
    least 1 - u over the rate, for its number u, and no distance to the nearest
    centre exceeds that to one centre and on to the farthest of the others.
    """
    ship(rows.sparkSession)
    each = rows.groupBy("x").agg(F.count(F.lit(1)).alias("w")).withColumn("h", F.xxhash64("x", F.lit(seed))).persist()
    starts: list[list] = [[] for _ in runs]
    for no in range(max(runs)):
        open_runs = [i for i, k in enumerate(runs) if k > no]
        known = np.array([starts[i] for i in open_runs])        # open runs x centres so far x columns
        salt = np.array([(i * 1_000_003 + no + 1) * 0x9E3779B97F4A7C15 % 2 ** 64 for i in open_runs], dtype=np.uint64)

        def first(batches, no=no, open_runs=open_runs, known=known, salt=salt):
            time, place = np.full(len(open_runs), np.inf), [None] * len(open_runs)
            reach = np.sqrt(((known - known[0, 0]) ** 2).sum(-1)).max() if no else 0.0
            for batch in batches:
                flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
                x = flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0))
                w, h = batch.column("w").to_numpy().astype(float), batch.column("h").to_numpy().view(np.uint64)
                ends = [0, *range(64, len(x), 512), len(x)]         # a few first: then there are times to beat
                for lo, hi in zip(ends, ends[1:]):
                    part, u = x[lo:hi], _mixed(h[lo:hi, None] ^ salt)
                    with np.errstate(all="ignore"):
                        most = w[lo:hi] * ((np.sqrt(((part - known[0, 0]) ** 2).sum(1)) + reach) ** 2 if no else 1.0) * (1 + 1e-6)
                        r, run = np.nonzero(1 - u <= time * most[:, None])
                        gap = np.ones(len(r))
                        for c in range(no):
                            far = sum((part[r, j] - known[run, c, j]) ** 2 for j in range(part.shape[1]))
                            gap = far if c == 0 else np.minimum(gap, far)
                        wait = -np.log(u[r, run]) / (w[lo + r] * gap)
                    order = np.argsort(wait, kind="stable")
                    for i, at in zip(*np.unique(run[order], return_index=True)):
                        if wait[order[at]] < time[i]:
                            time[i], place[i] = wait[order[at]], part[r[order[at]]].tolist()
            got = [k for k, x in enumerate(place) if x is not None]
            yield pa.RecordBatch.from_pydict({
                "run": pa.array([open_runs[k] for k in got], pa.int64()), "t": pa.array(time[got], pa.float64()),
                "x": pa.array([place[k] for k in got], pa.list_(pa.float64()))})

        found = each.mapInArrow(first, "run long, t double, x array<double>")
        drawn = {r["run"]: r["m"]["x"] for r in found.groupBy("run").agg(F.min(F.struct("t", "x")).alias("m")).collect()}
        if not no and not drawn:
            break
        for i in open_runs:         # fewer distinct vectors than centres: the first one again
            starts[i].append(drawn.get(i) or starts[i][0])
    each.unpersist()
    return [np.array(s) for s in starts if s]


def kmeans_runs(data: DataFrame, ks: Sequence[int], n_start: int, max_iter: int = 20, seed: int = 1,
                features_col: str = "features") -> dict[int, Clusters]:
    """The best of ``n_start`` k-means runs (Lloyd) for each k, all runs at once.

    Every iteration is one job: each task sums its rows by nearest centre for
    all runs together and sends one row per centre, so 25 starts cost hardly
    more passes than one. Starts are spread by distance (k-means++) over all
    rows, and every iteration runs over all rows, for the runs whose centres still move.
    A centre that loses all of its rows stays where it is.
    Rows with a null, NaN or infinite entry take no part; without rows there is no result. Distances are taken from
    the rows' mean, and costs from differences, so that points far from the origin lose no digits.
    """
    rows = data.select(vector_to_array(features_col).alias("x")).where(is_point(F.col("x")))
    runs = [k for k in ks for _ in range(n_start)]
    starts = _spread(rows, runs, seed)
    if not starts:
        return {}
    p = starts[0].shape[1]
    middle = rows.agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(p)]).first()
    shift = np.array([middle[f"m{j}"] for j in range(p)])
    centres = [start - shift for start in starts]
    names = [f"s{j}" for j in range(p)]
    ship(data.sparkSession)

    def step(open_runs: Sequence[int], cost: bool = False) -> dict[int, np.ndarray]:
        """Per run and centre: rows and their sums; for ``cost`` the squared distances to it instead of the sums."""
        groups = [[i for i in open_runs if runs[i] == k] for k in sorted({runs[i] for i in open_runs})]
        known = [np.stack([centres[i] for i in group]) for group in groups]        # runs x centres x columns
        edges = np.cumsum([0] + [c.shape[0] * c.shape[1] for c in known])

        def sums(batches):
            total = np.zeros((edges[-1], 1 + (1 if cost else p)))
            for batch in batches:
                flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
                for x in np.array_split(flat.reshape(-1, p) - shift, max(1, len(flat) // p // 512)):
                    own = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                    for a, b, c in zip(edges, edges[1:], known):
                        flat_c = c.reshape(-1, p)
                        gap = flat_c @ (2 * x).T
                        np.subtract((x * x).sum(1), gap, out=gap)
                        gap += (flat_c * flat_c).sum(1)[:, None]
                        gap = gap.reshape(*c.shape[:2], len(x))
                        near = gap == gap.min(axis=1)[:, None]
                        if np.count_nonzero(near) > len(c) * len(x):        # several as near: the first one
                            near &= np.cumsum(near, axis=1) == 1
                        near = near.reshape(-1, len(x)).astype(float)
                        if cost:
                            far = sum((x[:, j] - flat_c[:, j, None]) ** 2 for j in range(p))
                            total[a:b] += np.stack([near.sum(1), (near * far).sum(1)], axis=1)
                        else:
                            total[a:b] += near @ own
            yield pa.RecordBatch.from_pydict({"c": pa.array(np.arange(len(total))), "n": pa.array(total[:, 0]),
                                              **{m: pa.array(total[:, 1 + j]) for j, m in enumerate(given)}})

        given = ["d"] if cost else names
        found = rows.mapInArrow(sums, "c long, n double, " + ", ".join(f"{m} double" for m in given))
        total = found.groupBy("c").agg(*[F.sum(m).alias(m) for m in ("n", *given)]).orderBy("c").toPandas()[["n", *given]].to_numpy()
        each = [part for a, b, c in zip(edges, edges[1:], known) for part in total[a:b].reshape(len(c), c.shape[1], -1)]
        return dict(zip([i for group in groups for i in group], each))

    moving = list(range(len(runs)))
    for _ in range(max_iter):
        for i, got in step(moving).items():
            n, s = got[:, :1], got[:, 1:]
            moved = np.where(n > 0, s / np.maximum(n, 1), centres[i])
            if np.allclose(moved, centres[i], rtol=0, atol=1e-9):
                moving.remove(i)
            centres[i] = moved
        if not moving:
            break
    costs = step(range(len(runs)), cost=True)
    out: dict[int, Clusters] = {}
    for i, k in enumerate(runs):
        cost = float(costs[i][:, 1].sum())
        if k not in out or cost < out[k].cost:
            out[k] = Clusters(centres[i] + shift, cost)
    return out


def kmeans_best(data: DataFrame, k: int, n_start: int = 25, max_iter: int = 20, seed: int = 1,
                features_col: str = "features") -> Clusters:
    """E5: best of ``n_start`` k-means runs (least within-cluster sum of squares); no centres without rows."""
    return kmeans_runs(data, [k], n_start, max_iter, seed, features_col).get(k) or Clusters(np.zeros((0, 0)), 0.0)


def relabel_clusters(model, data: DataFrame, features_col: str = "features") -> tuple[DataFrame, dict]:
    """Cluster ids by descending size, then first centre coordinate (ids are otherwise arbitrary)."""
    pred = model.assign(data, features_col)
    sizes = {r[0]: r[1] for r in pred.where("prediction IS NOT NULL").groupBy("prediction").count().collect()}   # k rows
    if not sizes:
        return pred.withColumn("cluster", F.lit(None).cast("int")).drop("prediction"), {}
    centers = model.centres
    order = sorted(sizes, key=lambda c: (-sizes[c], float(centers[c][0])))
    mapping = {old: new + 1 for new, old in enumerate(order)}
    m = F.create_map(*[x for o, nw in mapping.items() for x in (F.lit(o), F.lit(nw))])
    return pred.withColumn("cluster", F.element_at(m, F.col("prediction"))).drop("prediction"), mapping


def wss_k1(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E7, k = 1: total sum of squares = sum_j n * var_pop(x_j)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"),
                  sum((F.var_pop(F.col(c).cast("double")) * F.count(F.lit(1)) for c in cols), F.lit(0.0))
                  .alias("wss"))


def elbow(data: DataFrame, k_max: int = 10, n_start: int = 20, seed: int = 1,
          features_col: str = "features") -> DataFrame:
    """Within-cluster sum of squares for k = 1..k_max; an empty table without rows."""
    arr = data.select(vector_to_array(features_col).alias("a")).where(is_point(F.col("a")))
    first = arr.first()
    if first is None:
        return data.sparkSession.createDataFrame([], "k int, wss double")
    p = len(first["a"])
    cols = [F.col("a")[i].alias(f"x{i}") for i in range(p)]
    w1 = wss_k1(arr.select(*cols), [f"x{i}" for i in range(p)]).first()["wss"]
    runs = kmeans_runs(data, range(2, k_max + 1), n_start, seed=seed, features_col=features_col)
    rows = [(1, float(w1))] + [(k, c.cost) for k, c in sorted(runs.items())]
    return data.sparkSession.createDataFrame(rows, "k int, wss double")


# ------------------------------------------------------------------ E8-E10

def squared_distance(x: Column, centre: Sequence[float]) -> Column:
    """sum_j (x_j - c_j)^2 for an array column x and a literal centre."""
    c = F.array(*[F.lit(float(v)) for v in centre])
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)


def assign_nearest(df: DataFrame, x: Column, centres: dict, out: str = "cluster") -> DataFrame:
    """Nearest centre by squared distance; ties go to the smallest centre id (``which.min``).

    ``centres`` maps id -> coordinates (k x p numbers, bounded by the model).
    """
    cands = F.array(*[F.struct(squared_distance(x, c).alias("d"), F.lit(cid).alias("id"))
                      for cid, c in sorted(centres.items())])
    best = F.array_min(cands)
    return df.withColumn("_best", best).withColumn(out, F.col("_best.id")) \
        .withColumn("dist", F.col("_best.d")).drop("_best")


def class_centres(df: DataFrame, x: str, label: str) -> dict:
    """Mean vector per class (one row per class back to the driver)."""
    vec = array_to_vector(F.col(x).cast("array<double>"))
    rows = df.groupBy(label).agg(Summarizer.mean(vec).alias("m")).collect()
    return {r[0]: r["m"].toArray().tolist() for r in rows}


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts per (row, col) with zero cells filled, and row proportions.

    One pass over the rows; every row level meets every column level because
    that is the table asked for.
    """
    c = df.groupBy(row, col).agg(F.count(F.lit(1)).cast("long").alias("n"))
    rows = c.select(row).distinct().withColumn("_k", F.lit(0))
    cols = c.select(col).distinct().withColumn("_k", F.lit(0))
    full = rows.join(cols, "_k").drop("_k")
    j = full.join(c, [row, col], "left").select(row, col, F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    tot = F.sum("n").over(Window.partitionBy(row))
    return j.withColumn("share", F.when(tot != 0, F.col("n") / tot))


def cluster_profile(assign: DataFrame, unscaled: DataFrame, key: str, cols: Sequence[str],
                    label: str = "label", cluster: str = "cluster") -> DataFrame:
    """Mean of the unscaled numerics and the positive rate per cluster (join on the row key)."""
    j = assign.select(key, cluster).join(unscaled.select(key, label, *cols), key)
    return j.groupBy(cluster).agg(F.count(F.lit(1)).cast("long").alias("n"),
                                  *[F.avg(F.col(c).cast("double")).alias(c) for c in cols],
                                  F.avg(F.col(label).cast("double")).alias("positive_rate"))
