"""Train/test splits that no repartitioning, retry or file order changes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.risk import key_hash, key_uniform
from riskweave.operators.ordered import order_statistics


def is_test(key: str, test: float = 0.25, seed: int = 42) -> Column:
    """Stateless membership rule: the leading 32 hash bits lie below ``test``."""
    limit = f"{min(round(test * 2**32), 2**32 - 1):08x}"
    return F.substring(key_hash(seed, key), 1, 8) < F.lit(limit)


def stable_split(df: DataFrame, key: str, test: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test). The class rate is kept in expectation; rows never move when data is added."""
    inside = is_test(key, test, seed)
    return df.where(~inside), df.where(inside)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = 0.25, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly round(test * n) test rows of each class.

    Each class takes its rows with the smallest hashes; the limits are exact order
    statistics, so no row is shuffled.
    """
    scored = df.withColumn("_u", key_uniform(seed, key))
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(c for c in sizes if c is not None)
    wide = scored.select(*[F.when(F.col(label) == c, F.col("_u")).alias(f"c{i}") for i, c in enumerate(classes)])
    wanted = {f"c{i}": math.floor(test * sizes[c] + 0.5) for i, c in enumerate(classes)}
    limits = order_statistics(
        wide, {c: [n - 1] for c, n in wanted.items() if n}, {f"c{i}": sizes[c] for i, c in enumerate(classes)}
    )
    inside = F.lit(False)
    for i, c in enumerate(classes):
        if wanted[f"c{i}"]:
            limit = limits[f"c{i}", wanted[f"c{i}"] - 1]
            inside = F.when(F.col(label) == c, F.col("_u") <= F.lit(limit)).otherwise(inside)
    return scored.where(~inside).drop("_u"), scored.where(inside).drop("_u")
