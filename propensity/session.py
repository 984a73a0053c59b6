"""Spark session helpers.

On a cluster the session is created by the platform; ``get_spark`` only fills
settings that are unset, so cluster-level configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _submitted(key: str) -> bool:
    """Whether the platform has set ``key`` already (spark-submit, pyspark-shell or a running gateway)."""
    given = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    option = {"spark.driver.memory": "--driver-memory", "spark.master": "--master"}.get(key, key)
    if key in given or option in given:
        return True
    return "PYSPARK_GATEWAY_PORT" in os.environ and SparkConf().contains(key)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "propensity", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one; defaults fill only what the platform has not set."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    wanted = {**_DEFAULTS, "spark.driver.memory": os.environ.get("PROPENSITY_DRIVER_MEMORY", "16g")}
    if master:
        wanted["spark.master"] = master
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in wanted.items():
        if not _submitted(k):
            b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, from ``spark.checkpoint.dir``.

    Only a local session (one machine, as in tests) may go without the setting
    and then gets a scratch folder; on a cluster its absence is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="propensity-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed there."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a fresh table in the shared folder, read back: a lost executor costs a re-read."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/propensity-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
