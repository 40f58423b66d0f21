"""Minority oversampling by interpolation, for training rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.risk import key_uniform
from riskweave.operators.neighbours import nearest_neighbours
from riskweave.operators.ordered import order_statistics


def smote(
    train: DataFrame, label: str, features: list[str], key: str, ratio: float = 0.1, k: int = 5, seed: int = 42,
    block_rows: int = 2048,
) -> DataFrame:
    """``key, label, features...`` of the training rows plus synthetic positives (null key).

    Positives grow to ``ratio`` of the negatives. Each synthetic row lies between a
    positive and one of its k nearest positives; base, neighbour and place follow
    from hashes of the key, so the result does not depend on partitioning.
    """
    rows = train.select(key, F.col(label).cast("int").alias(label), *[F.col(f).cast("double").alias(f) for f in features])
    sizes = rows.agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) == 0).cast("long")).alias("neg")
    ).first()
    missing = int(ratio * (sizes["neg"] or 0)) - (sizes["pos"] or 0)
    if missing <= 0 or (sizes["pos"] or 0) < 2:
        return rows
    each, extra = divmod(missing, sizes["pos"])
    minority = rows.where(F.col(label) == 1).withColumn("_u", key_uniform(f"{seed}/extra", key))
    copies = F.lit(each)
    if extra:
        limit = order_statistics(minority, {"_u": [extra - 1]}, {"_u": sizes["pos"]})["_u", extra - 1]
        copies = copies + (F.col("_u") <= F.lit(limit)).cast("int")
    wanted = (
        minority.withColumn("_copies", copies).where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    )
    near = min(k, sizes["pos"] - 1)
    wanted = wanted.withColumn(
        "_position", (F.floor(key_uniform(f"{seed}/neighbour", key, "_copy") * near) + 1).cast("int")
    ).withColumn("_gap", key_uniform(f"{seed}/gap", key, "_copy"))
    neighbours = nearest_neighbours(minority, key, features, near, block_rows, seed).select(
        F.col("key").alias("_base"), F.col("position").alias("_at"), "neighbour"
    )
    other = minority.select(F.col(key).alias("_other"), *[F.col(f).alias(f"_n_{f}") for f in features])
    synthetic = (
        wanted.join(neighbours, (F.col(key) == F.col("_base")) & (F.col("_position") == F.col("_at")))
        .join(other, F.col("neighbour") == F.col("_other"))
        .select(
            F.lit(None).cast(rows.schema[key].dataType).alias(key), F.lit(1).alias(label),
            *[(F.col(f) + F.col("_gap") * (F.col(f"_n_{f}") - F.col(f))).alias(f) for f in features],
        )
    )
    return rows.unionByName(synthetic)
