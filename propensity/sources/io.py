"""Sources and sinks.

Reads are lazy parquet/CSV scans with an explicit column list so Catalyst
prunes columns at the scan; writes are plain DataFrame writers.
"""

from __future__ import annotations

import json
import os
import warnings
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.ml.classification import (DecisionTreeClassificationModel, GBTClassificationModel,
                                       LogisticRegressionModel, RandomForestClassificationModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.operators.models.bagging import Forest
from propensity.operators.models.boosting import Booster
from propensity.operators.models.generative import GaussianNB, LinearDiscriminant
from propensity.operators.models.pruning import PrunedTree

#: The kinds of model that packets may hold, by name.
CLOSED_FORM = {c.__name__: c for c in (GaussianNB, LinearDiscriminant)}
SPARK_ML = {c.__name__: c for c in (DecisionTreeClassificationModel, GBTClassificationModel,
                                    LogisticRegressionModel, RandomForestClassificationModel)}
#: Models with ``save(spark, path)`` and ``load(spark, path)`` of their own.
OWN_FORM = {c.__name__: c for c in (Booster, Forest, PrunedTree)}


def read_table(spark: SparkSession, base: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    """A1: load one table of a dataset folder (``<base>/<name>.parquet``)."""
    path = base if name is None else os.path.join(base, f"{name}.parquet")
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True) -> DataFrame:
    """A1 for delimited files: always with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def bind_columns(left: DataFrame, right: DataFrame, key: str | list[str],
                 how: str = "inner") -> DataFrame:
    """A2: features and target held in two tables are glued on a key.

    The reference glues by row position; Spark has no row order, so the key
    is mandatory. An equi-join lets AQE pick broadcast (small side, size
    checked at runtime) or sort-merge.
    """
    return left.join(right, on=key, how=how)


def write_result_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """A4: CSV with a header, one part per partition or at most ``files`` parts."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_split(df: DataFrame, path: str, partition_by: str | None = "split") -> None:
    """A5: persist prepared rows, partitioned by split so readers prune."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Reload prepared rows; a split filter becomes partition pruning."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df


# ---------------------------------------------------------------- model packets

def save_packet(model, path: str, name: str, threshold: float | None,
                params: dict | None = None) -> None:
    """A fitted Spark ML model plus its manifest (threshold, params).

    ``model`` is a Spark ML model of ``SPARK_ML``, a tree model of ``OWN_FORM``, a closed-form model of
    ``CLOSED_FORM`` (saved as its parameter table, which loads as the model
    again) or any DataFrame of parameters.
    """
    target = os.path.join(path, name)
    spark = SparkSession.getActiveSession()
    kind = type(model).__name__
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(os.path.join(target, "params"))
        kind = "params"
    elif kind in CLOSED_FORM:
        model.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(target, "params"))
    elif kind in OWN_FORM:
        model.save(spark, os.path.join(target, "params"))
    elif kind in SPARK_ML:
        model.write().overwrite().save(os.path.join(target, "model"))
    else:
        raise ValueError(f"a {kind} has no packet form")
    manifest = spark.createDataFrame(
        [(name, kind, threshold, json.dumps(params or {}, sort_keys=True))],
        "model string, kind string, threshold double, params string")
    manifest.coalesce(1).write.mode("overwrite").parquet(os.path.join(target, "manifest"))


def load_packets(spark: SparkSession, path: str, names: Iterable[str]) -> dict:
    """Load the packets that exist; warn on missing; fail when none load."""
    out = {}
    for name in names:
        target = os.path.join(path, name)
        try:
            manifest = spark.read.parquet(os.path.join(target, "manifest"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":        # unreadable or broken is not missing
                raise
            warnings.warn(f"model packet {name!r} not found under {path}")
            continue
        man = manifest.first()
        if man.kind == "params":
            model = spark.read.parquet(os.path.join(target, "params"))
        elif man.kind in CLOSED_FORM:
            model = CLOSED_FORM[man.kind].from_frame(spark.read.parquet(os.path.join(target, "params")))
        elif man.kind in OWN_FORM:
            model = OWN_FORM[man.kind].load(spark, os.path.join(target, "params"))
        elif man.kind in SPARK_ML:
            model = SPARK_ML[man.kind].load(os.path.join(target, "model"))
        else:
            raise ValueError(f"packet {name!r} holds an unknown kind: {man.kind}")
        out[name] = {"model": model, "threshold": man.threshold,
                     "params": json.loads(man.params)}
    if not out:
        raise RuntimeError("no model packets could be loaded")
    return out
