import math
from fractions import Fraction

import numpy as np
import pytest

from propensity.llm import whitening as W

ROWS = "vec_id long, embedding array<float>, n long, x string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "c") for i, v in vectors], ROWS)


def exact(vectors):
    """Integer vectors, n, S and the covariance over the distinct ones, in fractions."""
    xs = {i: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for i, v in vectors}
    fit = sorted(set(xs.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    cov = [[Fraction(sum((n * x[j] - sums[j]) * (n * x[k] - sums[k]) for x in fit), n ** 3) for k in range(d)] for j in range(d)]
    return xs, fit, n, sums, np.array([[float(c) for c in row] for row in cov])


def check(got, vectors, components):
    xs, fit, n, sums, cov = exact(vectors)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    rows = {}
    for r in got:
        rows.setdefault(r["vec_id"], []).append(r)
    assert set(rows) == set(xs)
    for i, rs in rows.items():
        rs.sort(key=lambda r: r["component"])
        assert [r["component"] for r in rs] == list(range(1, len(values) + 1))
        x = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(xs[i], sums)])
        for c, r in enumerate(rs):
            assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(xs[i], sums))
            assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
            assert abs(r["whitened"]) == pytest.approx(abs(x @ basis[:, c]) / math.sqrt(values[c]), rel=1e-6, abs=1e-7)
            assert r["identity_error"] < 1e-8


def test_equals_exact_fractions(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(20, 20))
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(120, 20)) @ mix)]
    vectors += [(200 + i, v) for i, (_, v) in enumerate(vectors[:30])]        # copies count once in the fit
    check(W.whiten(table(spark, vectors).repartition(5)).collect(), vectors, 16)


def test_signs_agree_and_partitions_do_not_matter(spark):
    rng = np.random.default_rng(4)
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))])
    one, many = ({(r["vec_id"], r["component"]): r["whitened"] for r in W.whiten(d).collect()}
                 for d in (df.coalesce(1), df.repartition(7)))
    assert one == many and len(one) == 240


def test_covariance_of_whitened_rows_is_the_identity(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = W.whiten(small).toPandas().drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    x = {tuple(r["x"]): r["vec_id"] for r in W.integer_vectors(small).collect()}
    cov = np.cov(got.loc[sorted(x.values())].to_numpy().T, bias=True)
    assert np.abs(cov - np.eye(16)).max() < 1e-6


def test_rows_that_are_dropped(spark):
    good = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 1.5, -3.0]), (None, [4.0, 0.25, 1.0]), (4, [4.0, 0.25, 1.0]), (5, [2.0, 2.0, 2.0])]
    bad = [(6, None), (7, [1.0, None, 2.0]), (8, [1.0, float("nan"), 2.0]), (9, [1.0, float("inf"), 2.0]), (10, [1.0]), (11, [])]
    got = W.whiten(table(spark, good + bad)).collect()
    assert {r["vec_id"] for r in got} == {1, 2, None, 4, 5} and len(got) == 15
    assert {r["n"] for r in got} == {4}
    check([r for r in got if r["vec_id"] is not None], [g for g in good if g[0] is not None], 3)


def test_without_rows_and_without_variance(spark):
    assert W.whiten(table(spark, [])).collect() == []
    assert W.whiten(table(spark, [(1, None)])).columns == [c.split()[0] for c in W.RESULT.split(", ")]
    got = W.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["whitened"], r["deviation"], r["identity_error"], r["explained"]) for r in got] == [(None, 0, 0.0, 0.0)] * 4
    flat = W.whiten(table(spark, [(i, [float(i), 2.0 * i]) for i in range(6)])).collect()   # rank 1
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    assert all(r["identity_error"] < 1e-9 for r in flat)


def test_large_entries_stay_exact(spark):
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate([(1e7, -3e7), (2.5e7, 1e6), (-1e7, 4e5)])]
    xs, fit, n, sums, cov = exact(vectors)
    vectors_df = W.integer_vectors(table(spark, vectors))
    model = W.fit(vectors_df, 2)
    assert model.sums == sums
    assert np.allclose(model.components @ np.diag(model.eigenvalues) @ model.components.T, cov, rtol=1e-12)


def test_squares_beyond_64_bits(spark):
    y = np.array([[2 ** 40, -2 ** 41], [3, 2 ** 33]])
    want = [2 ** 80 + 9, 2 ** 82 + 2 ** 66, (2 ** 40 - 2 ** 41) ** 2 + (3 + 2 ** 33) ** 2]
    assert W.exact_squares(y) == want
