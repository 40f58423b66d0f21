"""Exact k nearest neighbours of each row within one table, without pairing all rows.

Rows go to the cell of their nearest pivot. A first round finds neighbours in a
row's own block of its cell, which bounds the distance of its k-th neighbour. By
the triangle inequality most other cells then lie too far away; a second round
visits only the blocks of the remaining ones. Cells beyond ``block_rows`` rows are
split by key hash and blocks with many visitors are copied, so no task holds more
than a block and a batch of visitors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import materialize

MAX_PIVOTS = 1024
SLACK = 1e-9


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(total)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float) if len(vectors) else np.zeros((0, dim))


def _closest(left: pd.DataFrame, right: pd.DataFrame, k: int, dim: int) -> pd.DataFrame:
    """Up to k nearest right rows of each left row, itself excluded, ties by key."""
    right = right.sort_values("key")
    distances = _distances(_matrix(left["x"], dim), _matrix(right["x"], dim))
    mine, theirs = left["key"].to_numpy(), right["key"].to_numpy()
    distances[mine[:, None] == theirs[None, :]] = np.inf
    order = np.argsort(distances, axis=1, kind="stable")[:, :k]
    near = np.take_along_axis(distances, order, axis=1)
    out = pd.DataFrame({
        "key": np.repeat(mine, order.shape[1]),
        "neighbour": theirs[order].ravel(),
        "distance": near.ravel(),
    })
    return out[np.isfinite(out["distance"])]


def _placer(pivots: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                away = _distances(_matrix(rows["x"], pivots.shape[1]), pivots)
                yield rows.assign(cell=away.argmin(axis=1).astype("int32"), away=away.min(axis=1))

    return place


def _router(pivots: np.ndarray, reach: np.ndarray):
    """Cells that may hold something nearer than a row's radius."""
    between = _distances(pivots, pivots)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            away = _distances(_matrix(rows["x"], pivots.shape[1]), pivots)
            own = rows["cell"].to_numpy()
            home = away[np.arange(len(rows)), own][:, None]
            gap = between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(gap > 0, (away**2 - home**2) / (2 * gap), 0.0)
            bound = np.maximum(away - reach[None, :], plane)
            radius = rows["radius"].to_numpy()[:, None]
            near = (bound <= radius * (1 + SLACK) + SLACK) & np.isfinite(reach)[None, :]
            at, cell = np.nonzero(near)
            picked = rows.iloc[at]
            yield pd.DataFrame({
                "key": picked["key"].to_numpy(), "x": picked["x"].to_numpy(),
                "home_cell": picked["cell"].to_numpy(), "home_block": picked["block"].to_numpy(),
                "cell": cell.astype("int32"),
            })

    return route


def nearest_neighbours(
    df: DataFrame, key: str, features: list[str], k: int = 5, block_rows: int = 2048, seed: int = 42
) -> DataFrame:
    """``key, neighbour, distance, position`` (1..k). ``key`` must be a unique long."""
    spark, dim = df.sparkSession, len(features)
    rows = df.select(
        F.col(key).cast("long").alias("key"), F.array(*[F.col(f).cast("double") for f in features]).alias("x")
    )
    n = rows.count()
    n_pivots = max(1, min(MAX_PIVOTS, math.ceil(n / block_rows)))
    hashed = F.xxhash64(F.lit(seed), F.col("key"))
    pivots = np.array([r["x"] for r in rows.orderBy(hashed, "key").limit(n_pivots).collect()]).reshape(-1, dim)
    result = "key long, neighbour long, distance double"
    if n <= block_rows:
        # the whole table is one proven-small block
        found = rows.groupBy().applyInPandas(lambda part: _closest(part, part, k, dim), result)
        return _top(found, k)
    placed = rows.mapInPandas(_placer(pivots), "key long, x array<double>, cell int, away double")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("reach")).collect()
    reach = np.full(len(pivots), -np.inf)
    blocks = {}
    for r in cells:
        reach[r["cell"]] = r["reach"]
        blocks[r["cell"]] = math.ceil(r["n"] / block_rows)
    sizes = F.broadcast(spark.createDataFrame(list(blocks.items()), "cell int, blocks int"))  # one row per pivot
    placed = placed.join(sizes, "cell").withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("blocks")).cast("int")
    ).select("key", "x", "cell", "block")
    placed = materialize(placed, "cells")
    first = placed.groupBy("cell", "block").applyInPandas(lambda part: _closest(part, part, k, dim), result)
    first = materialize(first, "near")
    radius = first.groupBy("key").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("radius")
    )
    queries = placed.join(radius, "key", "left").withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
    visits = queries.mapInPandas(
        _router(pivots, reach), "key long, x array<double>, home_cell int, home_block int, cell int"
    )
    visits = (
        visits.join(sizes, "cell")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where("NOT (cell = home_cell AND block = home_block)").select("key", "x", "cell", "block")
    )
    visits = materialize(visits, "visits")
    second = _visited(visits, placed, block_rows, k, dim, seed)
    return _top(first.unionByName(second), k)


def _visited(visits: DataFrame, placed: DataFrame, block_rows: int, k: int, dim: int, seed: int) -> DataFrame:
    """The nearest rows of every block for the rows that visit it; a block with many visitors is copied."""
    load = visits.groupBy("cell", "block").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("copies")
    )
    load = materialize(load, "visitors")
    visits = visits.join(load, ["cell", "block"]).select(
        "key", "x", "cell", "block", F.pmod(F.xxhash64(F.lit(seed + 2), "key"), F.col("copies")).cast("int").alias("copy")
    )
    again = load.select("cell", "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    targets = placed.join(again, ["cell", "block"]).select("key", "x", "cell", "block", "copy")
    where = ["cell", "block", "copy"]
    return visits.groupBy(*where).cogroup(targets.groupBy(*where)).applyInPandas(
        lambda left, right: _closest(left, right, k, dim), "key long, neighbour long, distance double"
    )


# --------------------------------------------------------------------------- many dimensions
def _codes(x: np.ndarray, planes: np.ndarray, offsets: np.ndarray, probes: int) -> np.ndarray:
    """Bucket numbers of rows in one table of random projections: the own one, then those across the nearest planes."""
    side = x @ planes - offsets
    powers = 1 << np.arange(planes.shape[1])
    own = (side > 0) @ powers
    near = np.argsort(np.abs(side), axis=1)
    # across one plane by rising distance, then across the two nearest
    flips = [powers[near[:, i]] for i in range(min(probes, near.shape[1]))]
    if probes > near.shape[1] > 1:
        flips.append(powers[near[:, 0]] + powers[near[:, 1]])
    return np.stack([own, *[own ^ f for f in flips]], axis=1)


def projected_neighbours(
    df: DataFrame, key: str, features: list[str], k: int = 5, tables: int = 6, probes: int = 4, recall: float = 0.9, sample: int = 200,
    block_rows: int = 2048, seed: int = 42,
) -> tuple[DataFrame, dict]:
    """Near neighbours in many dimensions, where pivots rule out next to nothing, and what it took.

    Every table deals the rows into buckets by the sides of random planes on which they lie; a row looks into its own bucket of each
    table and into ``probes`` buckets across the nearest planes. The share of the true neighbours of ``sample`` rows that this
    finds is measured; below ``recall`` the tables are doubled, once they would hold more than the exact way reads it is taken.
    Returns rows as ``nearest_neighbours`` does, and ``tables`` (0 for the exact way), ``recall`` and ``visits_per_row`` (rows compared).
    """
    dim, n = len(features), df.count()
    exact = lambda: nearest_neighbours(df, key, features, k, block_rows, seed)
    if n <= 4 * block_rows:
        return exact(), {"tables": 0, "recall": 1.0, "visits_per_row": float(n)}
    rows = materialize(df.select(F.col(key).cast("long").alias("key"), F.array(*[F.col(f).cast("double") for f in features]).alias("x")), "points")
    drawn = rows.orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(max(sample, 1000)).toPandas()  # a bounded sample
    points = _matrix(drawn["x"], dim)
    asked = drawn.head(sample)
    true = _top(rows.groupBy(F.spark_partition_id()).applyInPandas(
        lambda part: _closest(asked, part, k, dim), "key long, neighbour long, distance double"), k)
    limit = {r["key"]: r["distance"] for r in true.where(F.col("position") == min(k, n - 1)).collect()}
    bits = max(1, math.ceil(math.log2(n / block_rows)) + 1)
    while tables * (probes + 1) < 2**bits:
        draw = np.random.default_rng(seed)
        planes = draw.normal(size=(tables, dim, bits)) / points.std(axis=0).clip(1e-12)[None, :, None]
        offsets = np.median(np.einsum("nd,tdb->tnb", points, planes), axis=1)

        def deal(batches: Iterator[pd.DataFrame], planes=planes, offsets=offsets) -> Iterator[pd.DataFrame]:
            for part in batches:
                x = _matrix(part["x"], dim)
                for t in range(len(planes)):
                    codes = _codes(x, planes[t], offsets[t], probes) if len(part) else np.zeros((0, 1), int)
                    for i in range(codes.shape[1]):
                        yield part.assign(cell=(t << bits | codes[:, i]).astype("int32"), own=i == 0)

        dealt = materialize(rows.mapInPandas(deal, "key long, x array<double>, cell int, own boolean"), "dealt")
        sizes = materialize(dealt.where("own").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")), "buckets")
        placed = materialize(dealt.where("own").join(sizes, "cell").select(
            "key", "x", "cell", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("blocks")).cast("int").alias("block")), "placed")
        visits = dealt.join(sizes, "cell")
        compared = visits.agg(F.sum("n")).first()[0] / n
        visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", "x", "cell", "block")
        found = materialize(_top(_visited(visits, placed, block_rows, k, dim, seed).dropDuplicates(["key", "neighbour"]), k), "near")
        own = found.join(F.broadcast(df.sparkSession.createDataFrame([(int(i),) for i in asked["key"]], "key long")), "key").collect()
        reached = sum(r["distance"] <= limit[r["key"]] * (1 + SLACK) for r in own) / max(1, min(k, n - 1) * len(asked))
        if reached >= recall:
            return found, {"tables": tables, "recall": reached, "visits_per_row": float(compared)}
        tables *= 2
    return exact(), {"tables": 0, "recall": 1.0, "visits_per_row": float(n)}


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy("distance", "neighbour")
    return found.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
