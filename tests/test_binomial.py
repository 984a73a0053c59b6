"""Exact binomial tails and intervals against sums of whole terms in exact arithmetic."""

from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from propensity.functions.binomial import beta_quantile, beta_share, binomial_upper_tail, exact_interval
from propensity.operators import evaluate as EV

CASES = [(0, 5, 0.3), (1, 1, 0.5), (3, 10, 0.5), (10, 10, 0.9), (57, 100, 0.5), (900, 1000, 0.88), (1, 1000, 0.001),
         (1999, 2000, 0.99), (700, 2000, 0.2)]


def tail(k, n, p):
    p = Fraction(p)
    return float(sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k, n + 1)))


def test_tail_equals_the_sum_of_its_terms(spark):
    df = spark.createDataFrame(CASES, "k long, n long, p double")
    for r in df.withColumn("t", binomial_upper_tail("k", "n", "p")).collect():
        want = tail(r["k"], r["n"], r["p"])
        assert r["t"] == pytest.approx(want, rel=1e-8, abs=1e-300), r


def test_bounds_leave_the_tails_they_promise(spark):
    low, high = exact_interval("k", "n")
    df = spark.createDataFrame(CASES, "k long, n long, p double").select("k", "n", low.alias("a"), high.alias("b"))
    for r in df.collect():
        assert 0 <= r["a"] <= r["k"] / r["n"] <= r["b"] <= 1
        assert r["a"] == 0 if r["k"] == 0 else tail(r["k"], r["n"], r["a"]) == pytest.approx(0.025, rel=1e-8)
        assert r["b"] == 1 if r["k"] == r["n"] else tail(r["k"] + 1, r["n"], r["b"]) == pytest.approx(0.975, rel=1e-8)


def test_known_values(spark):
    """Closed forms: I_x(1, b) = 1 - (1 - x)^b, I_x(a, 1) = x^a, and the middle of a symmetric density."""
    r = spark.range(1).select(beta_share(F.lit(1), F.lit(7), F.lit(0.2)).alias("p"), beta_share(F.lit(9), F.lit(1), F.lit(0.7)).alias("q"),
                              beta_quantile(F.lit(5e9), F.lit(5e9), F.lit(0.5)).alias("m"),
                              beta_quantile(F.lit(1), F.lit(40), F.lit(0.975)).alias("e")).first()
    assert r["p"] == pytest.approx(1 - 0.8**7, rel=1e-12) and r["q"] == pytest.approx(0.7**9, rel=1e-12)
    assert r["m"] == pytest.approx(0.5, abs=1e-12) and r["e"] == pytest.approx(1 - 0.025**(1 / 40), rel=1e-10)


def test_huge_counts_are_near_the_normal_bounds(spark):
    low, high = exact_interval(F.lit(3e9), F.lit(1e10))
    r = spark.range(1).select(low.alias("a"), high.alias("b")).first()
    wide = 1.959963984540054 * (0.3 * 0.7 / 1e10) ** 0.5
    assert r["a"] == pytest.approx(0.3 - wide, abs=wide * 1e-3) and r["b"] == pytest.approx(0.3 + wide, abs=wide * 1e-3)


def test_nulls_empty_groups_and_empty_tables(spark):
    conf = spark.createDataFrame([("a", 0.5, 0, 0, 0, 0), ("b", 0.5, 3, 1, 6, 0), ("c", 0.5, None, 1, 6, 0)],
                                 "model string, threshold double, tp long, fp long, tn long, fn long")
    got = {r["model"]: r for r in EV.accuracy_interval(conf).collect()}
    assert got["a"]["accuracy_low"] is None and got["a"]["accuracy_p_value"] is None and got["c"]["accuracy_high"] is None
    assert got["b"]["accuracy"] == 0.9 and got["b"]["accuracy_p_value"] == pytest.approx(tail(9, 10, 0.7))
    assert EV.accuracy_interval(conf.limit(0)).count() == 0
