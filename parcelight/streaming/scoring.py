"""Scoring of orders as they arrive: the batch transform on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelight.plans.modeling import score_orders


def score_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    model: PipelineModel,
    needed: Sequence[str],
    target: str,
    progress: str,
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Score every parquet file that appears in ``source`` into ``target`` and
    stop when all present files are done.  ``progress`` records what was done,
    so a restart scores nothing twice."""
    arrivals = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    return (
        score_orders(arrivals, model, needed)
        .writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(target)
    )
