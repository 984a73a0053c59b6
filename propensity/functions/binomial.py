"""Exact binomial tail and interval (G4) as JVM expressions.

Spark SQL has neither a beta function nor its inverse. P(X >= k) of a binomial
is the share of a beta density below the success probability, so it is a ratio
of two Gauss-Legendre sums over a density scaled to 1 at its mode; the scale,
and with it every gamma function, drops out. For whole k and n the density is
smooth on [0, 1], and it is summed where it is not negligible: ``REACH``
standard deviations around the mode. The interval inverts the share by
bisection. Arguments may be columns of any size; null arguments give null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from propensity.functions.columns import col

NODES = 256
REACH = 40.0
BISECTIONS = 60


def _points() -> Column:
    at, weight = np.polynomial.legendre.leggauss(NODES)
    return F.arrays_zip(F.array(*[F.lit(float(v)) for v in at]).alias("at"),
                        F.array(*[F.lit(float(v)) for v in weight]).alias("weight"))


def _shape(a: Column, b: Column) -> Column:
    """Mode and reach of the beta density with a, b >= 1."""
    mode = F.when(a + b > 2, (a - 1) / (a + b - 2)).otherwise(F.lit(0.5))
    wide = F.sqrt(a * b / (a + b + 1)) / (a + b) * REACH
    return F.struct(a.alias("a"), b.alias("b"), mode.alias("mode"), F.greatest(mode - wide, F.lit(0.0)).alias("low"),
                    F.least(mode + wide, F.lit(1.0)).alias("high"))


def _mass(s: Column, low: Column, high: Column, points: Column) -> Column:
    """The density, 1 at its mode, summed over [low, high]."""
    half, middle = (high - low) / 2, (high + low) / 2

    def density(t: Column) -> Column:
        u = t - s["mode"]
        # log1p of the distance from the mode: large exponents do not cancel
        left = F.when(s["a"] > 1, (s["a"] - 1) * F.log1p(u / s["mode"])).otherwise(F.lit(0.0))
        right = F.when(s["b"] > 1, (s["b"] - 1) * F.log1p(-u / (F.lit(1.0) - s["mode"]))).otherwise(F.lit(0.0))
        return F.exp(left + right)

    return half * F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p["weight"] * density(middle + half * p["at"]))


def beta_share(a, b, x) -> Column:
    """The regularised incomplete beta function I_x(a, b) for a, b >= 1."""
    a, b, x, points = col(a).cast("double"), col(b).cast("double"), col(x).cast("double"), _points()
    given = F.array(_shape(a, b))
    share = F.transform(given, lambda s: _mass(s, s["low"], F.least(F.greatest(x, s["low"]), s["high"]), points)
                        / _mass(s, s["low"], s["high"], points))[0]
    return F.when(a.isNull() | b.isNull() | x.isNull(), F.lit(None).cast("double")).otherwise(share)


def beta_quantile(a, b, p) -> Column:
    """The x with I_x(a, b) = p for a, b >= 1, by bisection where the density is not negligible."""
    a, b, p, points = col(a).cast("double"), col(b).cast("double"), col(p).cast("double"), _points()

    def solved(s: Column) -> Column:
        whole = F.array(_mass(s, s["low"], s["high"], points))

        def halved(r: Column, wanted: Column) -> Column:
            middle = (r["low"] + r["high"]) / 2
            below = _mass(s, s["low"], middle, points) < wanted
            return F.struct(F.when(below, middle).otherwise(r["low"]).alias("low"),
                            F.when(below, r["high"]).otherwise(middle).alias("high"))

        start = F.struct(s["low"].alias("low"), s["high"].alias("high"))
        return F.transform(whole, lambda w: F.aggregate(
            F.sequence(F.lit(1), F.lit(BISECTIONS)), start, lambda r, _: halved(r, w * p),
            lambda r: (r["low"] + r["high"]) / 2))[0]

    found = F.transform(F.array(_shape(a, b)), solved)[0]
    return F.when(a.isNull() | b.isNull() | p.isNull(), F.lit(None).cast("double")).otherwise(found)


def binomial_upper_tail(k, n, p) -> Column:
    """P(X >= k) for X binomial(n, p)."""
    k, n, p = (col(c).cast("double") for c in (k, n, p))
    one = F.greatest(k, F.lit(1.0))
    inner = beta_share(one, F.greatest(n - one + 1, F.lit(1.0)), p)
    return (F.when(k.isNull() | n.isNull() | p.isNull(), F.lit(None).cast("double"))
            .when(k <= 0, F.lit(1.0)).when((k > n) | (p <= 0), F.lit(0.0)).when(p >= 1, F.lit(1.0)).otherwise(inner))


def exact_interval(k, n, confidence: float = 0.95) -> tuple[Column, Column]:
    """Clopper-Pearson bounds of a share k / n; null where n is 0."""
    k, n = (col(c).cast("double") for c in (k, n))
    tail = (1 - confidence) / 2
    one = F.greatest(k, F.lit(1.0))
    low = beta_quantile(one, F.greatest(n - one + 1, F.lit(1.0)), F.lit(tail))
    less = F.greatest(n - k, F.lit(1.0))
    high = beta_quantile(k + 1, less, F.lit(1 - tail))
    none = k.isNull() | n.isNull() | (n <= 0)
    return (F.when(none, F.lit(None).cast("double")).when(k <= 0, F.lit(0.0)).otherwise(low),
            F.when(none, F.lit(None).cast("double")).when(k >= n, F.lit(1.0)).otherwise(high))
