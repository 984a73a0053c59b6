import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.functions.cumulative import order_statistics, running_totals
from propensity.operators import profile as P


@pytest.fixture(scope="module")
def hist(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v), float(rng.integers(1, 5))) for g in ("a", "b") for v in rng.permutation(3000)]
    return spark.createDataFrame(rows, "g string, v double, c double")


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("rpb", [1, 250])
def test_running_totals_match_pandas(spark, hist, desc, rpb):
    out = running_totals(hist, "v", ["c"], ["g"], descending=desc, n_ranges=rpb).toPandas()
    pdf = hist.toPandas().sort_values(["g", "v"], ascending=[True, not desc])
    pdf["want"] = pdf.groupby("g")["c"].cumsum()
    m = out.merge(pdf, on=["g", "v"])
    assert len(m) == 6000
    assert np.allclose(m["c_cum"], m["want"])


def test_running_totals_without_groups(spark, hist):
    one = hist.where("g = 'a'").drop("g")
    out = running_totals(one, "v", ["c"], n_ranges=100).toPandas().sort_values("v")
    assert np.allclose(out["c_cum"].to_numpy(), out["c"].cumsum().to_numpy())


def test_order_statistics_and_quantiles(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=2001), 2)          # many ties
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    long = df.select(F.lit("x").alias("feature"), F.col("x").alias("value"))
    pos = spark.createDataFrame([("x", str(k), k) for k in (0, 1, 500, 1000, 2000)], "feature string, key string, k long")
    got = {r.key: r.x for r in order_statistics(long, ["feature"], "value", pos, n_ranges=50).collect()}
    s = np.sort(x)
    assert all(got[str(k)] == s[k] for k in (0, 1, 500, 1000, 2000))
    q = P.quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9], n_ranges=50).first()
    want = np.percentile(x, [10, 25, 50, 90])
    assert np.allclose([q.q0, q.q1, q.q2, q.q3], want)


def fivenum(x):
    x = np.sort(x)
    n = len(x)
    n4 = np.floor((n + 3) / 2) / 2
    d = np.array([1, n4, (n + 1) / 2, n + 1 - n4, n]) - 1
    return 0.5 * (x[np.floor(d).astype(int)] + x[np.ceil(d).astype(int)])


@pytest.mark.parametrize("n", [1, 2, 5, 10, 101])
def test_boxplot_tukey_hinges(spark, n):
    rng = np.random.default_rng(n)
    x = rng.exponential(size=n)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = P.boxplot_stats(df, ["x"], n_ranges=7).first()
    f = fivenum(x)
    assert np.allclose([r.ymin, r.q1, r.med, r.q3, r.ymax], f)
    iqr = f[3] - f[1]
    lo, hi = f[1] - 1.5 * iqr, f[3] + 1.5 * iqr
    assert r.n_out == int(((x < lo) | (x > hi)).sum())
    assert r.whisker_hi == x[x <= hi].max() and r.whisker_lo == x[x >= lo].min()


def test_boxplot_approx_path_close_to_exact(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=5001)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    a = P.boxplot_stats(df, ["x"], approx_accuracy=100_000).first()
    f = fivenum(x)
    assert abs(a.med - f[2]) < 0.01 and abs(a.q1 - f[1]) < 0.01 and abs(a.q3 - f[3]) < 0.01
    assert a.n == 5001 and a.ymin == x.min()


def test_carriers_do_not_grow_with_the_groups(spark):
    """Rows sent between ranges: the histogram and at most one carrier per pair of ranges."""
    n, groups, ranges = 4000, 900, 12
    hist = spark.range(n).select((F.col("id") % groups).alias("g"), F.col("id").alias("v"), F.lit(1.0).alias("c"))
    out = running_totals(hist, "v", ["c"], ["g"], n_ranges=ranges)
    got = out.toPandas().sort_values(["g", "v"])
    assert (got["c_cum"] == got.groupby("g").cumcount() + 1).all() and len(got) == n
    plan = out._jdf.queryExecution().optimizedPlan()
    node = plan
    while "Generate" not in node.nodeName():
        node = node.children().apply(0)
    from pyspark.sql import DataFrame
    sent = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node), spark).count()
    assert n <= sent <= n + ranges * (ranges - 1) // 2
