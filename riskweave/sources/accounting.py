"""How many raw rows a job read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def rows_processed(named: dict[str, DataFrame]) -> DataFrame:
    """One row per input with its row count, plus a ``total`` row."""
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
         for name, df in named.items()],
    )
    total = counts.agg(F.sum("n_rows").alias("n_rows")).select(F.lit("total").alias("source"), "n_rows")
    return counts.unionByName(total)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while the job's own action runs, without another scan."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen
