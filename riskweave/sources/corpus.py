"""Document corpus, question set and chunk store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GOLDEN_SCHEMA = "question string, ground_truth string, source string"
CHUNK_SCHEMA = "id string, text string, source string"


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``.md`` / ``.txt`` file: ``corpus_order, source, text``.

    ``corpus_order`` sorts all markdown files by name before all text files; the
    table itself is not sorted, since that would shuffle whole texts.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.{md,txt}")
    name = F.col("_metadata.file_name")
    # file names arrive URL-encoded; '+' must survive the decoding
    source = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return files.select(
        source.alias("source"), F.col("value").alias("text")
    ).withColumn(
        "corpus_order", F.concat(F.when(F.col("source").endswith(".md"), "0:").otherwise("1:"), "source")
    ).select("corpus_order", "source", "text")


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """The question set, a JSON array of objects; a missing file raises at once."""
    return spark.read.schema(GOLDEN_SCHEMA).json(path, multiLine=True)


def read_chunk_store(spark: SparkSession, path: str) -> DataFrame:
    """Chunks written by ``write_report(chunks, path, "json")``."""
    return spark.read.schema(CHUNK_SCHEMA).json(path)
