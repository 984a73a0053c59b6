import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.operators import features as FE
from propensity.operators import profile as P
from propensity.operators import split as S
from propensity.operators.artifact import PrepSpec, fit_artifact


@pytest.fixture(scope="module")
def dup_table(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (1, "a", 1.0), (2, None, None), (2, None, None), (3, "b", 2.0),
            (4, "c", 3.0), (4, "d", 3.0)]
    return spark.createDataFrame(rows, "k int, s string, v double")


def test_duplicates(spark, dup_table):
    c = P.duplicate_count(dup_table).first()
    assert (c.n_rows, c.n_distinct, c.n_duplicates) == (8, 5, 3)
    rows = sorted(P.duplicate_rows(dup_table).collect(), key=lambda r: (r.k, str(r.s)))
    assert [(r.k, r.s, r.v) for r in rows] == [(1, "a", 1.0), (1, "a", 1.0), (2, None, None)]
    by_key = sorted((r.k, r.s) for r in P.duplicate_rows(dup_table, ["k"]).collect())
    assert by_key == [(1, "a"), (1, "a"), (2, None), (4, "d")]


def test_nzv(spark):
    rng = np.random.default_rng(1)
    rows = [(1.0, 0.0 if i < 995 else 1.0, float(rng.normal())) for i in range(1000)]
    df = spark.createDataFrame(rows, "const double, rare double, cont double")
    out = {r.feature: r for r in P.near_zero_variance(df, ["const", "rare", "cont"]).collect()}
    assert out["const"].zero_var == 1 and out["const"].nzv == 1 and out["const"].freq_ratio == 0.0
    assert out["rare"].freq_ratio == pytest.approx(199.0) and out["rare"].nzv == 1
    assert out["cont"].nzv == 0 and out["cont"].percent_unique == pytest.approx(100.0)


def test_summaries(spark, dup_table):
    ns = {r.feature: r for r in P.numeric_summary(dup_table, ["v"]).collect()}
    assert ns["v"].n_missing == 2 and ns["v"].n_unique == 4 and ns["v"].min_value == 1.0
    cs = {r.feature: r for r in P.categorical_summary(dup_table, ["s"]).collect()}
    assert cs["s"].n_missing == 2 and cs["s"].n_unique == 5 and cs["s"].top_level == "a"
    t2 = P.category_top2(dup_table, ["s"]).first()
    assert t2.top1 == "a" and t2.top1_pct == pytest.approx(50.0)   # among non-null values, as table()
    one = spark.createDataFrame([("x",), ("x",)], "s string")
    assert P.category_top2(one, ["s"]).first().top2 == "N/A"
    txt = P.format_top2(P.category_top2(dup_table, ["s"])).first()
    assert txt.top_class_1 == "a (50.00%)"


def test_histogram_sturges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    h = P.histogram(df, ["x"]).toPandas()
    assert len(h) == 8 and h["n"].sum() == 100      # ceil(log2 100) + 1
    assert h["lower"].min() == 0.0 and h["upper"].max() == 99.0


def test_conversion_rate_declared_levels(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "g string, label int")
    out = {r.level: r.conversion_pct for r in P.conversion_rate(df, ["g"], "label", {"g": ["a", "b", "z"]}).collect()}
    assert out == {"a": 50.0, "b": 100.0, "z": 0.0}


def test_level_counts_keep_empty_levels(spark):
    df = spark.createDataFrame([("Mar",), ("Mar",), ("June",), ("Nope",)], "m string")
    out = {r.level: r.n for r in P.level_counts(df, "m", ["Jan", "Mar", "June"]).collect()}
    assert out == {"Jan": 0, "Mar": 2, "June": 1}


def test_lumping_at_exactly_five_percent(spark):
    rows = [("big",)] * 94 + [("edge",)] * 5 + [("small",)]
    train = spark.createDataFrame(rows, "c string")
    keep = FE.fit_lump(train, ["c"], 0.05)
    assert keep["c"] == ["big", "edge"]
    test = spark.createDataFrame([("big",), ("small",), ("unseen",), (None,)], "c string")
    assert [r.c for r in test.select(FE.lump("c", keep["c"]).alias("c")).collect()] == ["big", "Other", "Other", "Other"]


def test_quarter_and_onehot(spark):
    df = spark.createDataFrame([("Jan",), ("June",), ("Sep",), ("Nov",), ("bogus",)], "m string")
    assert [r.q for r in df.select(FE.quarter("m").alias("q")).collect()] == ["Q1", "Q2", "Q3", "Q4", "Q4"]
    lv = {"t": ["13", "2", "3"]}
    d = spark.createDataFrame([("13",), ("2",), (None,)], "t string").select(*FE.onehot_full_rank(lv))
    assert d.columns == ["t_2", "t_3"]
    assert [tuple(r) for r in d.collect()] == [(0.0, 0.0), (1.0, 0.0), (None, None)]


def test_artifact_is_fitted_on_train_only(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "train" if i < 300 else "test", float(rng.exponential()), ["Returning_Visitor", "New_Visitor",
            "Other"][i % 3], ["x", "y"][i % 2], i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, period string, v double, visitor string, g string, label int")
    spec = PrepSpec(numeric=["v"], lump=["g"], visitor="visitor", label="label", keep=["id"])
    a1 = fit_artifact(df.where("period = 'train'"), spec)
    changed = df.withColumn("v", F.when(F.col("period") == "test", F.col("v") * 100).otherwise(F.col("v")))
    a2 = fit_artifact(changed.where("period = 'train'"), spec)
    assert a1.means == a2.means and a1.sds == a2.sds and a1.prob_returning == a2.prob_returning
    assert a1.prob_returning == pytest.approx(0.5)
    out = a1.transform(df.where("period = 'train'")).toPandas()
    assert out["v"].mean() == pytest.approx(0.0, abs=1e-9) and out["v"].std() == pytest.approx(1.0)


def test_weights_and_sampling(spark):
    df = spark.createDataFrame([(i, 1 if i < 20 else 0) for i in range(100)], "k long, y int")
    w = {r.y: r.weight for r in S.balanced_weights(df, "y").select("y", "weight").distinct().collect()}
    assert w[1] == pytest.approx(100 / 40) and w[0] == pytest.approx(100 / 160)
    sp = {r.y: r.weight for r in S.scale_pos_weight(df, "y").select("y", "weight").distinct().collect()}
    assert sp == {1: 4.0, 0: 1.0}
    s = S.sample_balanced(df, "y", "k", 1.5)
    counts = {r.y: r["count"] for r in s.groupBy("y").count().collect()}
    assert counts == {1: 20, 0: 30}
    assert s.where("y = 0").agg(F.max("k")).first()[0] == 49


def test_artifact_forces_train_levels_on_test(spark):
    # D3: test rows only see the train level set; a quarter that train has not seen gives nulls, not the first level
    train = spark.createDataFrame([(i, ["Mar", "May", "Aug"][i % 3], 1.0, i % 2) for i in range(30)],
                                  "id int, m string, v double, label int")
    test = spark.createDataFrame([(100, "Nov", 1.0, 0), (101, "Dec", 2.0, 1), (102, "Mar", 3.0, 0)],
                                 "id int, m string, v double, label int")
    spec = PrepSpec(numeric=["v"], month="m", label="label", keep=["id"], log1p=False)
    art = fit_artifact(train, spec)
    assert art.onehot_levels["quarter"] == ["Q1", "Q2", "Q3"]
    out = {r.id: (r.quarter_Q2, r.quarter_Q3) for r in art.transform(test).collect()}
    assert out == {100: (None, None), 101: (None, None), 102: (0.0, 0.0)}
    assert art.feature_names() == ["v", "quarter_Q2", "quarter_Q3"]


def test_split_helpers(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01"), (3, None)], "k long, d string") \
        .withColumn("d", F.to_date("d"))
    out = {r.k: r.split for r in S.split_by_cutoff(df, "d", "2024-01-15").collect()}
    assert out == {1: "train", 2: "test", 3: "train"}
    per = {r.k: r.split for r in S.split_by_period(df.withColumn("m", F.month("d")), "m", [2]).collect()}
    assert per == {1: "train", 2: "test", 3: "train"}
    folds = spark.range(1000).select(S.hash_fold_column(["id"], 5).alias("f"), S.fold_column("id", 5).alias("g"))
    r = folds.agg(F.min("f"), F.max("f"), F.countDistinct("f"), F.countDistinct("g")).first()
    assert (r[0], r[1], r[2], r[3]) == (0, 4, 5, 5)
    roles = spark.createDataFrame([("train", "Q1"), ("train", "Q3"), ("train", "Q4"), ("test", "Q4")],
                                  "split string, q string")
    got = [r.role for r in S.temporal_holdout(roles, "split", "q", ["Q1", "Q2"], ["Q3"]).collect()]
    assert got == ["fit", "validate", "unused", "test"]


def test_read_csv_with_schema(spark, tmpdir_path):
    import os
    from pyspark.sql import types as T
    from propensity.sources import io
    p = os.path.join(tmpdir_path, "x.csv")
    with open(p, "w") as fh:
        fh.write("a,b\n1,x\n2,y\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = io.read_csv(spark, p, schema)
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, "y")]


def test_correlation_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=500)
    rows = [(float(a), float(a * 2 + rng.normal() * 0.1), float(rng.normal())) for a in x]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    cm = P.correlation_matrix(df, ["a", "b", "c"])
    assert cm.count() == 9
    pairs = [(r.var1, r.var2) for r in P.high_correlations(cm, ["a", "b", "c"], 0.4).collect()]
    assert pairs == [("a", "b")]


def test_wide_integers_stay_apart(spark):
    df = spark.createDataFrame([(2**53 + i,) for i in range(3)] + [(None,)], "k long")
    r = P.numeric_summary(df, ["k"]).first()
    assert (r.n_unique, r.n_missing, r.min_exact, r.max_exact) == (4, 1, str(2**53), str(2**53 + 2))
    assert P.near_zero_variance(df, ["k"]).first().percent_unique == 75.0
    from decimal import Decimal
    dec = spark.createDataFrame([(Decimal("1.10"),), (Decimal("1.11"),)], "d decimal(20,2)")
    r = P.numeric_summary(dec, ["d"]).first()
    assert (r.n_unique, r.min_exact, r.max_exact) == (2, "1.10", "1.11")


def test_many_rare_levels_fit(spark):
    df = spark.range(300_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id) END AS c", "1.0 AS x")
    from propensity.operators.artifact import PrepSpec, fit_artifact
    art = fit_artifact(df, PrepSpec(numeric=["x"], lump=["c"]))
    assert art.keep_levels == {"c": ["hot"]} and art.onehot_levels == {"c": ["Other", "hot"]}


def test_unseen_levels_are_other_or_null(spark):
    from propensity.operators.artifact import PrepSpec, fit_artifact
    train = spark.createDataFrame([("a", "p", 1.0), ("b", "q", 2.0)] * 9, "l string, o string, x double")
    art = fit_artifact(train, PrepSpec(numeric=["x"], lump=["l"], onehot=["o"]))
    new = spark.createDataFrame([("z", "z", 1.0), ("a", "p", 1.0)], "l string, o string, x double")
    rows = [r.asDict() for r in art.transform(new).collect()]
    assert art.onehot_levels == {"l": ["Other", "a", "b"], "o": ["p", "q"]}
    assert rows[0]["o_q"] is None and rows[0]["l_a"] == rows[0]["l_b"] == 0.0       # 'Other', the first level
    assert rows[1]["o_q"] == 0.0 and rows[1]["l_a"] == 1.0


def test_column_types(spark):
    df = spark.createDataFrame([(1, "a", True)], "n int, s string, b boolean")
    assert P.split_column_types(df) == (["n"], ["s", "b"])


def test_duplicates_keep_null_keys_and_copies(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (7, 3), (8, 4), (8, 4)], "k int, v int")
    got = sorted((str(r.k), r.v) for r in P.duplicate_rows(df, ["k"]).collect())
    assert got == [("8", 4), ("None", 1), ("None", 2)]


def test_arg_extremes_ties_nulls_and_groups_without_values(spark):
    from propensity.operators.topk import arg_extremes
    rows = [("a", 1, 5.0), ("a", 3, 9.0), ("a", 2, 9.0), ("a", 7, 5.0), ("a", 0, None), ("b", 4, None), (None, 8, 2.0)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = {r["g"]: tuple(r)[1:] for r in arg_extremes(df, ["g"], "v", "id").collect()}
    assert got == {"a": (9.0, 5.0, 2, 1), "b": (None, None, None, None), None: (2.0, 2.0, 8, 8)}


def test_too_many_levels_are_an_error_not_a_cut(spark):
    from propensity.operators.features import fit_onehot_levels
    df = spark.range(30).selectExpr("cast(id as string) as user", "cast(id % 3 as string) as k")
    assert fit_onehot_levels(df, ["k"], max_levels=3) == {"k": ["0", "1", "2"]}
    with pytest.raises(ValueError, match="levels"):
        fit_onehot_levels(df, ["user", "k"], max_levels=29)


def test_histogram_sends_the_bounds_to_the_rows(spark):
    df = spark.range(0, 3000, 1, 4).select((F.col("id") % 97).cast("double").alias("a"), F.col("id").cast("double").alias("b"))
    assert P.histogram(df, ["a", "b"]).toPandas().groupby("feature")["n"].sum().to_dict() == {"a": 3000, "b": 3000}
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")         # no guess from the size
    try:
        assert "BroadcastHashJoin [feature" in P.histogram(df, ["a", "b"])._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
