"""Evaluation of scored rows.

Input is a long table of scored rows: (group cols e.g. model/split, score,
label[, weight]). Every curve metric starts from a *score histogram* --
positives and negatives per distinct score, built with partial aggregation
-- and running sums over it come from ``running_totals`` (range-partitioned
windows), so neither a hot score value nor a billion distinct scores ever
lands in one task. Confusion counts are one aggregation over the rows.
Results are one row per group (model) or per distinct score.

Rows whose score is null or NaN, or whose label is null, are unscored: no
curve, confusion or metric counts them; ``confusion`` reports their number.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions.binomial import binomial_upper_tail, exact_interval
from propensity.functions.cumulative import running_totals

METRICS = ["accuracy", "kappa", "sensitivity", "specificity", "precision", "f1", "balanced_accuracy"]


def _div(a: Column, b: Column) -> Column:
    """a / b, null when b = 0 (undefined metric)."""
    return F.when(b != 0, a / b)


def is_scored(score: str | Column = "score", label: str | Column | None = "label") -> Column:
    """Whether a row takes part: a score that is a number, and a label."""
    s = F.col(score) if isinstance(score, str) else score
    ok = s.isNotNull() & ~F.isnan(s.cast("double"))
    if label is None:
        return ok
    return ok & (F.col(label) if isinstance(label, str) else label).isNotNull()


# ------------------------------------------------------------------ histogram and curves

def score_histogram(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
                    label: str = "label", weight: str | None = None) -> DataFrame:
    """(group..., score, pos, neg): label mass per distinct score (weights sum instead of counts)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    pos = F.when(F.col(label) == 1, w).otherwise(F.lit(0.0))
    neg = F.when(F.col(label) == 1, F.lit(0.0)).otherwise(w)
    return (scored.where(is_scored(score, label))
            .groupBy(*group_cols, F.col(score).cast("double").alias("score"))
            .agg(F.sum(pos).alias("pos"), F.sum(neg).alias("neg")))


def _with_totals(hist: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    g = list(group_cols)
    tot = hist.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return hist.join(tot, g)


def grouped(fn):
    """Run a per-group evaluator on ungrouped input via a constant group key."""
    import functools

    @functools.wraps(fn)
    def run(scored, group_cols=(), *args, **kw):
        if group_cols:
            return fn(scored, list(group_cols), *args, **kw)
        return fn(scored.withColumn("_g0", F.lit(0)), ["_g0"], *args, **kw).drop("_g0")
    return run


@grouped
def roc_points(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
               label: str = "label", weight: str | None = None,
               n_ranges: int | None = None) -> DataFrame:
    """One point per distinct score, classifying ``score >= threshold`` as positive.

    Columns: group..., threshold, pos, neg, tp, fp, tpr, fpr, P, N.
    """
    g = list(group_cols)
    h = score_histogram(scored, g, score, label, weight)
    cum = running_totals(h, "score", ["pos", "neg"], g, descending=True, n_ranges=n_ranges)
    cum = _with_totals(cum, g)
    return cum.select(*g, F.col("score").alias("threshold"), "pos", "neg",
                      F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                      _div(F.col("pos_cum"), F.col("P")).alias("tpr"),
                      _div(F.col("neg_cum"), F.col("N")).alias("fpr"), "P", "N")


def _roc_auc_agg():
    # step area: dFP * (TP_before + TP_after) / 2, normalised by P * N
    step = F.col("neg") * (F.lit(2.0) * F.col("tp") - F.col("pos")) / F.lit(2.0)
    return _div(F.sum(step), F.first("P") * F.first("N")).alias("roc_auc")


def _pr_auc_agg():
    tp1, dtp, dfp = F.col("tp"), F.col("pos"), F.col("neg")
    tp0, fp0 = tp1 - dtp, F.col("fp") - dfp
    h = dfp / dtp
    a = F.lit(1.0) + h
    b = fp0 - h * tp0

    def prim(t):
        return t / a - b / (a * a) * F.log(a * t + b)

    seg = (F.when(dtp <= 0, F.lit(0.0))
           .when(b == 0, dtp / a)
           .otherwise(prim(tp1) - prim(tp0)))
    return _div(F.sum(seg), F.first("P")).alias("pr_auc")


@grouped
def curve_areas(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
                label: str = "label", weight: str | None = None,
                n_ranges: int | None = None) -> DataFrame:
    """G6 + G7 from one pass over the curve: (group..., roc_auc, pr_auc)."""
    g = list(group_cols)
    pts = roc_points(scored, g, score, label, weight, n_ranges)
    return pts.groupBy(*g).agg(_roc_auc_agg(), _pr_auc_agg())


@grouped
def roc_auc(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
            label: str = "label", weight: str | None = None,
            n_ranges: int | None = None) -> DataFrame:
    """Trapezoid area under the ROC points (= rank-sum AUC, ties count half)."""
    g = list(group_cols)
    pts = roc_points(scored, g, score, label, weight, n_ranges)
    return pts.groupBy(*g).agg(_roc_auc_agg())


@grouped
def pr_points(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
              label: str = "label", weight: str | None = None,
              n_ranges: int | None = None) -> DataFrame:
    """Recall and precision per distinct score threshold (weighted if ``weight``)."""
    g = list(group_cols)
    pts = roc_points(scored, g, score, label, weight, n_ranges)
    return pts.select(*g, "threshold", _div(F.col("tp"), F.col("P")).alias("recall"),
                      _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


@grouped
def pr_auc(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
           label: str = "label", weight: str | None = None,
           n_ranges: int | None = None) -> DataFrame:
    """Area under the precision-recall curve with non-linear interpolation.

    Between two adjacent points (TP0, FP0) -> (TP1, FP1) precision is
    interpolated along the straight line in (TP, FP) space (Davis & Goadrich
    2006); with h = dFP/dTP, a = 1 + h, b = FP0 - h*TP0 the segment area is
    (1/P) * [t/a - b/a^2 * ln(a t + b)] from TP0 to TP1, or dTP/(a P) when b = 0.
    """
    g = list(group_cols)
    pts = roc_points(scored, g, score, label, weight, n_ranges)
    return pts.groupBy(*g).agg(_pr_auc_agg())


@grouped
def youden(scored: DataFrame, group_cols: Sequence[str] = (), score: str = "score",
           label: str = "label", n_ranges: int | None = None) -> DataFrame:
    """Threshold maximising sensitivity + specificity - 1.

    Candidates are midpoints between adjacent distinct scores (and -inf below
    the lowest); classifying ``score >= t`` at the midpoint below score s is
    the ROC point of s. Ties in J go to the least threshold. The curve is
    evaluated once; the next lower score comes from the histogram.
    """
    g = list(group_cols)
    pts = roc_points(scored, g, score, label, None, n_ranges)
    j = F.col("tp") / F.col("P") + (F.col("N") - F.col("fp")) / F.col("N") - F.lit(1.0)
    order = F.struct(j.alias("j"), (-F.col("threshold")).alias("least"))     # the best, then the least threshold
    best = pts.groupBy(*g).agg(F.max_by(F.struct(F.col("threshold").alias("s"), "tpr", "fpr", j.alias("j")), order)
                               .alias("b")).select(*g, "b.*")
    hist = score_histogram(scored, g, score, label)
    below = (hist.join(best.select(*g, "s"), g).where(F.col("score") < F.col("s"))
             .groupBy(*g).agg(F.max("score").alias("below")))
    return best.join(below, g, "left").select(
        *g, F.when(F.col("below").isNull(), F.lit(float("-inf"))).otherwise((F.col("s") + F.col("below")) / 2)
        .alias("threshold"), F.col("tpr").alias("sensitivity"), (F.lit(1.0) - F.col("fpr")).alias("specificity"), "j")


# ------------------------------------------------------------------ confusion-based

def classify(score: str | Column, threshold, inclusive: bool = True) -> Column:
    """G1: 1 when score >= t (``inclusive``) or score > t, else 0; null for a score that is null or NaN."""
    s = F.col(score) if isinstance(score, str) else score
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    return F.when(is_scored(s, None), F.when(s >= t if inclusive else s > t, 1).otherwise(0))


def _thresholded(scored: DataFrame, thresholds, group_cols: Sequence[str]) -> DataFrame:
    if isinstance(thresholds, DataFrame):   # (model, threshold): one row per model
        return scored.join(thresholds, list(group_cols))
    if isinstance(thresholds, Mapping):
        key = group_cols[0]
        m = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
        return scored.withColumn("threshold", F.element_at(m, F.col(key)))
    return scored.withColumn("threshold", F.lit(float(thresholds)))


def confusion(scored: DataFrame, thresholds, group_cols: Sequence[str] = ("model",),
              score: str = "score", label: str = "label", inclusive: bool = True) -> DataFrame:
    """TP, FP, TN, FN and the unscored rows per group at the group's threshold (one aggregation)."""
    g = list(group_cols)
    t = _thresholded(scored, thresholds, g)
    pred = classify(score, "threshold", inclusive)
    y = F.col(label) == 1
    return t.groupBy(*g).agg(
        F.first("threshold").alias("threshold"),
        F.count_if((pred == 1) & y).alias("tp"), F.count_if((pred == 1) & ~y).alias("fp"),
        F.count_if((pred == 0) & ~y).alias("tn"), F.count_if((pred == 0) & y).alias("fn"),
        F.count_if(~is_scored(score, label)).alias("n_unscored"))


def metrics(conf: DataFrame, group_cols: Sequence[str] = ("model",), digits: int | None = None) -> DataFrame:
    """Accuracy, Cohen's kappa, sensitivity, specificity, precision, F1, balanced accuracy.

    Undefined ratios (zero denominators) are null. ``digits`` rounds half-even.
    """
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    po = _div(tp + tn, n)
    pe = _div((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    sens, spec, prec = _div(tp, tp + fn), _div(tn, tn + fp), _div(tp, tp + fp)
    vals = {
        "accuracy": po,
        "kappa": _div(po - pe, F.lit(1.0) - pe),
        "sensitivity": sens, "specificity": spec, "precision": prec,
        "f1": _div(F.lit(2.0) * prec * sens, prec + sens),
        "balanced_accuracy": (sens + spec) / 2,
    }
    r = (lambda c: F.bround(c, digits)) if digits is not None else (lambda c: c)
    return conf.select(*group_cols, "threshold", *[r(v).alias(k) for k, v in vals.items()])


def report(conf: DataFrame, group_cols: Sequence[str] = ("model",)) -> DataFrame:
    """NPV, prevalence, detection rate / prevalence, no-information rate, McNemar statistic."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    yates = F.when(fp != fn, F.lit(1.0)).otherwise(F.lit(0.0))
    return conf.select(
        *group_cols, "threshold",
        _div(tn, tn + fn).alias("npv"),
        _div(tp + fn, n).alias("prevalence"),
        _div(tp, n).alias("detection_rate"),
        _div(tp + fp, n).alias("detection_prevalence"),
        _div(F.greatest(tp + fn, tn + fp), n).alias("no_information_rate"),
        _div(F.pow(F.abs(fp - fn) - yates, 2), fp + fn).alias("mcnemar_statistic"))


def accuracy_interval(conf: DataFrame, group_cols: Sequence[str] = ("model",), confidence: float = 0.95) -> DataFrame:
    """Accuracy with its exact binomial interval, and P(at least so many right) at the no-information rate.

    A group without rows has null bounds and a null p-value.
    """
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    counts = conf.select(*group_cols, "threshold", (tp + tn).alias("right"), (tp + fp + tn + fn).alias("n"),
                         _div(F.greatest(tp + fn, tn + fp), tp + fp + tn + fn).alias("no_information_rate"))
    low, high = exact_interval("right", "n", confidence)
    return counts.select(*group_cols, "threshold", _div(F.col("right"), F.col("n")).alias("accuracy"),
                         low.alias("accuracy_low"), high.alias("accuracy_high"), "no_information_rate",
                         binomial_upper_tail("right", "n", "no_information_rate").alias("accuracy_p_value"))


def threshold_grid(scored: DataFrame, group_cols: Sequence[str] = ("model",), score: str = "score",
                   label: str = "label", start: float = 0.10, stop: float = 0.70, step: float = 0.01,
                   strict: bool = True) -> DataFrame:
    """Balanced accuracy over a threshold grid; best first (smallest threshold on ties).

    Grid values are ``start + i*step`` (as R's ``seq``). Rows are not
    replicated per threshold: each distinct score gets the index of the grid
    cell it falls in (an array count, JVM-side), counts are summed per
    (group, cell) -- at most grid+1 rows per group -- and a running sum over
    those cells gives the confusion at every threshold.
    Returns all grid rows with ``best`` = 1 on the chosen one.
    """
    g = list(group_cols)
    k = int(round((stop - start) / step)) + 1
    grid = [start + i * step for i in range(k)]
    h = score_histogram(scored, g, score, label)
    arr = F.array(*[F.lit(t) for t in grid])
    s = F.col("score")
    cell = F.size(F.filter(arr, lambda t: (t < s) if strict else (t <= s)))   # thresholds passed
    cells = h.groupBy(*g, cell.alias("cell")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    tot = cells.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # every cell 0..k for every group, then suffix sums: predicted positive at
    # grid i <=> cell >= i + 1
    allc = tot.select(*g, "P", "N", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("cell"))
    filled = allc.join(cells, g + ["cell"], "left").select(
        *g, "P", "N", "cell", F.coalesce("pos", F.lit(0.0)).alias("pos"), F.coalesce("neg", F.lit(0.0)).alias("neg"))
    w = Window.partitionBy(*g).orderBy(F.col("cell").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suf = filled.select(*g, "P", "N", "cell", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"))
    full = suf.where(F.col("cell") >= 1).select(
        *g, (F.col("cell") - 1).alias("i"), "tp", "fp", "P", "N")
    full = full.withColumn("threshold", F.element_at(arr, F.col("i") + 1))
    sens = _div(F.col("tp"), F.col("P"))
    spec = _div(F.col("N") - F.col("fp"), F.col("N"))
    full = full.select(*g, "i", "threshold", sens.alias("sensitivity"), spec.alias("specificity"),
                       ((sens + spec) / 2).alias("balanced_accuracy"))
    wb = Window.partitionBy(*g).orderBy(F.col("balanced_accuracy").desc_nulls_last(), F.col("i"))
    return full.withColumn("best", (F.row_number().over(wb) == 1).cast("int")).drop("i")


# ------------------------------------------------------------------ comparison table

def compare_models(scored: DataFrame, thresholds, group_cols: Sequence[str] = ("model",),
                   score: str = "score", label: str = "label", inclusive: bool = True,
                   n_ranges: int | None = None) -> DataFrame:
    """One row per model: threshold, G3 metrics, PR-AUC, ROC-AUC."""
    g = list(group_cols)
    conf = confusion(scored, thresholds, g, score, label, inclusive)
    m = metrics(conf, g)
    areas = curve_areas(scored, g, score, label, n_ranges=n_ranges)
    return m.join(areas, g)


def rank_models(cmp: DataFrame, model_col: str = "model") -> DataFrame:
    """Rank by PR-AUC desc, balanced accuracy desc, model name (total order)."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("pr_auc").desc_nulls_last(),
                                             F.col("balanced_accuracy").desc_nulls_last(), F.col(model_col))
    return cmp.withColumn("rank", F.row_number().over(w).cast("long"))


def best_model(cmp: DataFrame, model_col: str = "model") -> DataFrame:
    """The top-ranked row."""
    return rank_models(cmp, model_col).where(F.col("rank") == 1)


def baseline(scored: DataFrame, group_cols: Sequence[str] = ("model",), label: str = "label") -> DataFrame:
    """Prevalence, the PR-AUC of a random ranking."""
    return scored.groupBy(*group_cols).agg(F.avg(F.col(label).cast("double")).alias("baseline"))


def profile_long(cmp: DataFrame, model_col: str = "model",
                 cols: Sequence[str] = tuple(METRICS) + ("pr_auc", "roc_auc")) -> DataFrame:
    """Metric profile in long form (model, metric, value)."""
    return cmp.select(model_col, *[F.col(c).cast("double") for c in cols]) \
        .unpivot([model_col], list(cols), "metric", "value")


def fourfold(conf: DataFrame, group_cols: Sequence[str] = ("model",)) -> DataFrame:
    """Confusion cells with the share of each actual class (rows sum to 1)."""
    g = list(group_cols)
    cells = F.explode(F.array(
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n"))))
    long = conf.select(*g, cells.alias("c")).select(*g, "c.actual", "c.predicted", F.col("c.n").cast("long").alias("n"))
    row_tot = F.sum("n").over(Window.partitionBy(*g, "actual"))
    return long.withColumn("share", _div(F.col("n").cast("double"), row_tot.cast("double")))


def mcnemar_p_value(rep: DataFrame, statistic: str = "mcnemar_statistic", out: str = "mcnemar_p_value") -> DataFrame:
    """P-value of the McNemar statistic, P(chi2 with 1 df > x) = erfc(sqrt(x / 2)).

    Spark SQL has no erfc, so an Arrow-batched pandas UDF evaluates it on the
    report table (one row per model).
    """
    return rep.withColumn(out, F.pandas_udf(_chi2_1_sf, "double")(F.col(statistic)))


def _chi2_1_sf(x: pd.Series) -> pd.Series:
    return x.map(lambda v: math.erfc(math.sqrt(v / 2.0)) if v is not None and v == v and v >= 0 else None)
