"""Helpers shared by the corpus operators.

Nothing here keeps rows on the driver: intermediate tables go to the folder
that all executors share (``spark.checkpoint.dir``), as Parquet.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.session import checkpoint_dir

REPO_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it is not installed there."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if REPO_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO_ROOT, known) if x)


def saved(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/propensity-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def doc_text(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty), any other column left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       *[F.col(c) for c in keep])


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4 is 2; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_columns_of(docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with another text, and ``n_chars`` (if there) to match it."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
