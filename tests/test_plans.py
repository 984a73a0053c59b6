"""Plan-shape checks: pruning reaches the scan, curves never use one global window partition."""

import numpy as np

import __spark_entry__ as E
from propensity.operators import evaluate as EV
from propensity.operators import split as S
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["prof_numeric_summary"](spark, SMALL))
    schema = [ln for ln in p.splitlines() if "ReadSchema" in ln or "FileScan" in ln]
    text = " ".join(schema)
    assert "l_quantity" in text and "l_shipdate" not in text and "l_returnflag" not in text


def test_curve_has_no_single_partition_window(spark):
    rng = np.random.default_rng(0)
    rows = [("m", float(s), int(y)) for s, y in zip(rng.random(3000), rng.random(3000) < 0.3)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    p = plan(EV.roc_points(df, ["model"], n_ranges=200))
    assert "_range" in p and "SinglePartition" not in p


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_building_a_curve_query_starts_no_job_and_leaves_no_cache(spark):
    rows = [("m", i / 50, i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    before = jobs(spark)
    for made in (EV.roc_points(df, ["model"]), EV.youden(df, ["model"]), EV.curve_areas(df, ["model"])):
        made.schema
    assert jobs(spark) == before
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("eval_youden", "prof_boxplot", "flagship_compare", "feat_apply_artifact"):
        E.queries()[name](spark, SMALL).write.format("noop").mode("overwrite").save()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_duplicates_scan_the_table_once(spark):
    from pyspark.sql import functions as F
    df = E.queries()["prof_duplicate_rows"](spark, SMALL)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    reads = final.count("Scan parquet") - final.count("ReusedExchange")
    assert reads <= 1 and F is not None


def test_prepared_rows_come_without_a_join_of_their_own(spark):
    from propensity.plans.q_models import prepared
    with prepared(spark, SMALL) as (prep, _):
        logical = prep._jdf.queryExecution().optimizedPlan().toString()
        assert {"fold", "fold10", "weight", "role", "label"} <= set(prep.columns)
    assert logical.count("Join ") <= 1      # visits to customer


def test_sampling_cut_is_a_filter_not_a_class_window(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(5000)], "k long, y int")
    p = plan(S.sample_balanced(df, "y", "k", 1.0))
    # the only windows are over (class, range bucket) or small histograms, never a row_number per class
    assert "row_number" not in p
