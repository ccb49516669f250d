"""Batch scoring (R6) on a stream: a fitted PipelineModel applied to a
Structured Streaming source. Every stage of the pipeline is a row-wise
transformer once fitted, so scoring is stateless and needs no watermark; the
sink is a parquet table with its own checkpoint in the shared folder, so a
restarted query resumes where it stopped and writes each file once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def score_stream(model: PipelineModel, stream: DataFrame, keys: Sequence[str], label: str
                 ) -> DataFrame:
    """Streaming frame of ``keys, prediction, trueLabel``."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame")
    scored = model.transform(stream)
    return scored.select(*keys, F.col("prediction"), F.col(label).alias("trueLabel"))


def run_to_parquet(scored: DataFrame, sink_path: str, checkpoint_path: str,
                   timeout_sec: float | None = None, query_name: str | None = None) -> str:
    """Process everything available now, append it to ``sink_path``, then stop."""
    w = (scored.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    try:
        q.awaitTermination(timeout_sec)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()
    return sink_path


def read_sink(spark: SparkSession, sink_path: str, schema: StructType) -> DataFrame:
    """The sink's rows. The schema is given, so a sink to which nothing was written yet is
    an empty frame."""
    return spark.read.schema(schema).parquet(sink_path)
