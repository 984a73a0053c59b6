import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from propensity.operators import segment as SG

POINTS = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [9.0, 9.0]]


def copies(spark, n):
    x = F.element_at(F.array(*[F.array(*map(F.lit, p)) for p in POINTS]), (F.col("id") % len(POINTS) + 1).cast("int"))
    return spark.range(n * len(POINTS)).select(array_to_vector(x).alias("features"))


def test_many_copies_do_not_crowd_out_other_points(spark):
    model = SG.kmeans_best(copies(spark, 2500), 4, n_start=2)
    assert model.cost < 1e-9
    assert sorted(map(tuple, np.round(model.centres, 6).tolist())) == sorted(map(tuple, POINTS))


def test_starts_do_not_depend_on_copies_or_partitions(spark):
    few = copies(spark, 3).select(SG.vector_to_array("features").alias("x"))
    many = copies(spark, 3000).repartition(7).select(SG.vector_to_array("features").alias("x"))
    for a, b in zip(SG._spread(few, [2, 3, 5], 1), SG._spread(many, [2, 3, 5], 1), strict=True):
        assert a.tolist() == b.tolist()
    assert SG.kmeans_runs(copies(spark, 1).where("false"), [2], 2) == {}


def test_copies_are_drawn_as_often_as_they_are_there(spark):
    rows = copies(spark, 1).select(SG.vector_to_array("features").alias("x"))
    heavy = rows.unionByName(rows.where("x[0] = 9").crossJoin(spark.range(95)).select("x"))
    firsts = [s[0].tolist() == POINTS[3] for s in SG._spread(heavy, [1] * 400, 1)]
    assert 0.93 < np.mean(firsts) <= 1.0


def test_starts_equal_a_draw_over_all_distances(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(900, 3)) * [1, 5, 30] + 1000, 1)
    x = np.vstack([x, x[:200], x[:5]])
    rows = spark.createDataFrame([(p,) for p in x.tolist()], "x array<double>").repartition(3)
    each = rows.groupBy("x").count().withColumn("h", F.xxhash64("x", F.lit(7))).toPandas()
    p, w, h = np.array(each["x"].tolist()), each["count"].to_numpy().astype(float), each["h"].to_numpy().view(np.uint64)
    runs = [2, 2, 6, 6, 6]
    for i, (k, got) in enumerate(zip(runs, SG._spread(rows, runs, 7), strict=True)):
        want = np.zeros((0, 3))
        for no in range(k):
            gap = ((p[:, None] - want) ** 2).sum(-1).min(1) if no else np.ones(len(p))
            u = SG._mixed(h ^ np.uint64((i * 1_000_003 + no + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
            with np.errstate(divide="ignore"):
                want = np.vstack([want, p[(-np.log(u) / (w * gap)).argmin()]])
        assert got.tolist() == want.tolist()


def test_runs_whose_centres_stand_still_take_no_further_part(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(300, 2)) + at for at in ([0, 0], [40, 0])])
    data = spark.createDataFrame([(p,) for p in x.tolist()], "x array<double>").select(array_to_vector("x").alias("features"))
    sizes, frame = [], type(data)
    before = frame.toPandas
    monkeypatch.setattr(frame, "toPandas", lambda self: sizes.append(len(got := before(self))) or got)
    found = SG.kmeans_runs(data, [2, 7], 2, seed=3)
    assert sizes[0] == sizes[-1] == 18 and min(sizes) < 18         # the costs are of all runs
    for k, model in found.items():                                 # what plain Lloyd steps from the same starts end with
        rows, costs = data.select(SG.vector_to_array("features").alias("x")), []
        starts = SG._spread(rows, [2, 2, 7, 7], 3)
        for c in (s for s in starts if len(s) == k):
            for _ in range(20):
                near = ((x[:, None] - c) ** 2).sum(-1).argmin(1)
                c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
            costs.append(((x[:, None] - c) ** 2).sum(-1).min(1).sum())
        assert abs(model.cost - min(costs)) < 1e-6 * min(costs)
