"""Scoring new rows with a saved artifact, batch or streaming.

The reference's forward path is "apply the saved preprocessing bundle to
new sessions". Both the artifact and the closed-form models are narrow
projections (literal expressions), so the same plan runs on a
``readStream`` source: no state, no watermark, exactly-once via the sink's
checkpoint. The checkpoint location must be a shared folder on a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from propensity.operators.artifact import Artifact


def score_frame(df: DataFrame, artifact: Artifact, score: Column | None = None,
                out: str = "score") -> DataFrame:
    """Artifact projection (+ optional model expression over the prepared columns)."""
    prep = artifact.transform(df)
    return prep.withColumn(out, score) if score is not None else prep


def stream_source(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A file stream of new rows (parquet) with a declared schema."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def start_scoring(stream: DataFrame, artifact: Artifact, sink_path: str, checkpoint: str,
                  score: Column | None = None, available_now: bool = True):
    """Score a stream into a parquet sink; ``available_now`` processes what exists and stops."""
    scored = score_frame(stream, artifact, score)
    w = scored.writeStream.format("parquet").option("path", sink_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
