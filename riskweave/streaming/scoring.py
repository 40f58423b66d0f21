"""Scoring of arriving rows with the promoted model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskweave.operators.models import score_batch


def read_arrivals(
    spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None, files_per_trigger: int = 1000
) -> DataFrame:
    """Stream of the parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def score_stream(
    arrivals: DataFrame,
    model_path: str,
    out: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    alias: str = "champion",
) -> StreamingQuery:
    """Score everything that has arrived and stop; the checkpoint makes a restart exactly-once."""
    scored = score_batch(prepare(arrivals), model_path, alias)
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
