"""Typed table scans and overwrite sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the source files; in Spark it is a value that poisons avg and max."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    clean_nan: bool = True,
) -> DataFrame:
    """Scan a parquet, ORC, JSON or CSV table. Text formats need a schema: no inference pass."""
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"{fmt} needs an explicit schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, enforceSchema=False)
    df = reader.load(path)
    return nan_to_null(df) if clean_nan else df


def read_optional(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """As :func:`read_table`, but an absent table is ``None`` and its join is then skipped."""
    try:
        return read_table(spark, path, **options)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite a parquet table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Overwrite a report (ranking, benchmark, summary, chunk store) as CSV or JSON lines."""
    if fmt == "csv":
        df.write.mode("overwrite").csv(path, header=True)
    elif fmt == "json":
        df.write.mode("overwrite").json(path, ignoreNullFields=False)
    else:
        raise ValueError(f"unknown report format {fmt}")
    return path


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan that has fewer splits than the cluster has cores.

    Meant for Python-heavy work on small tables stored in one file; a table with
    enough splits is returned as it is. Call it on plain scans only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
