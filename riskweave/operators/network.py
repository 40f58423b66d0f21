"""A small feed-forward network with row weights, fitted on all rows by L-BFGS.

Every evaluation is one job: tasks run their rows forward and back and sum the weighted loss and its gradient, and only these
sums travel. A weight multiplies a row's loss, so no row is copied.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.features import fit_standardizer
from riskweave.session import materialize

#: Rows of a stored piece, of a block that runs through the network at once, and of a partition of a small table.
PIECE_ROWS, BLOCK_ROWS, ROWS_PER_TASK = 16_384, 8192, 10_000
#: Tables with more rows are dealt out evenly over all cores, in tasks of so many rows at most.
MANY_ROWS, TASK_ROWS = 500_000, 1_000_000
#: So many tasks send their sums to the driver at once; of more they are added in a tree, which takes further stages.
FEW_TASKS = 64
#: Pairs of steps that L-BFGS remembers, and halvings of a step that does not descend.
MEMORY, HALVINGS = 10, 25


def shapes(sizes: list[int]) -> list[tuple[int, int]]:
    return [*zip(sizes, sizes[1:])]


def layers_of(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and biases in one vector, as views by layer."""
    out, at = [], 0
    for a, b in shapes(sizes):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def starting_point(sizes: list[int], seed: int) -> np.ndarray:
    """Weights scaled to the number of inputs, biases 0."""
    draw = np.random.default_rng(seed)
    return np.concatenate([np.concatenate([draw.normal(0, np.sqrt(2 / a), a * b), np.zeros(b)]) for a, b in shapes(sizes)])


def log_odds(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> np.ndarray:
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0)
    w, b = layers[-1]
    return (x @ w + b)[:, 0]


def loss_and_gradient(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted sum of the cross-entropy of rows, and its gradient."""
    layers = layers_of(flat, sizes)
    loss, gradient = 0.0, np.zeros_like(flat)
    parts = layers_of(gradient, sizes)
    for at in range(0, len(y), BLOCK_ROWS):
        own, target, w = x[at:at + BLOCK_ROWS], y[at:at + BLOCK_ROWS], weight[at:at + BLOCK_ROWS]
        seen = [own]
        for matrix, bias in layers[:-1]:
            seen.append(np.maximum(seen[-1] @ matrix + bias, 0))
        z = (seen[-1] @ layers[-1][0] + layers[-1][1])[:, 0]
        loss += float((w * (np.logaddexp(0, z) - target * z)).sum())
        back = (w * (1 / (1 + np.exp(-z)) - target))[:, None]
        for i in range(len(layers) - 1, -1, -1):
            parts[i][0][...] += seen[i].T @ back
            parts[i][1][...] += back.sum(axis=0)
            if i:
                back = (back @ layers[i][0].T) * (seen[i] > 0)
    return loss, gradient


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, iterations: int, tolerance: float) -> np.ndarray:
    """L-BFGS with a step that is halved until it descends enough."""
    x = start
    loss, gradient = value(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(iterations):
        direction, scales = -gradient, []
        for s, d, rho in reversed(steps):
            scales.append(rho * (s @ direction))
            direction = direction - scales[-1] * d
        if steps:
            s, d, rho = steps[-1]
            direction = direction / (rho * (d @ d))
        else:
            direction = direction / max(1.0, np.linalg.norm(gradient))
        for (s, d, rho), a in zip(steps, reversed(scales)):
            direction = direction + (a - rho * (d @ direction)) * s
        slope, length = gradient @ direction, 1.0
        if slope >= 0:  # not a way down any more: start from the gradient again
            direction, slope, steps = -gradient, -(gradient @ gradient), []
        for _ in range(HALVINGS):
            new = x + length * direction
            new_loss, new_gradient = value(new)
            if new_loss <= loss + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        s, d = new - x, new_gradient - gradient
        if s @ d > 1e-12 * (d @ d):
            steps = [*steps[1 - MEMORY:], (s, d, 1 / (s @ d))]
        done = loss - new_loss <= tolerance * max(abs(loss), abs(new_loss), 1e-12)
        x, loss, gradient = new, new_loss, new_gradient
        if done:
            break
    return x


@dataclass(frozen=True)
class Network:
    features: list[str]
    means: list[float]
    scales: list[float]
    sizes: list[int]
    weights: list[float]

    def score(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """``df`` with the probability of the positive class; works on streams too. A missing value counts as the mean."""
        layers = layers_of(np.array(self.weights), self.sizes)
        means, scales = np.array(self.means), np.array(self.scales)

        @F.pandas_udf("double")
        def probability(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                x = (np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns]) - means) / scales
                yield pd.Series(1 / (1 + np.exp(-log_odds(layers, np.nan_to_num(x)))))

        return df.withColumn(name, probability(*[F.col(f).cast("double") for f in self.features]))

    def to_json(self) -> str:
        return json.dumps(vars(self))

    @staticmethod
    def from_json(text: str) -> Network:
        return Network(**json.loads(text))


def _packed(train: DataFrame, label: str, weight: str | None, features: list[str], means: np.ndarray, scales: np.ndarray) -> DataFrame:
    """Pieces of standardized rows."""
    weights = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = train.select(F.col(label).cast("double").alias("_y"), weights.alias("_w"), *[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.slice(at, PIECE_ROWS).columns]
                x = np.nan_to_num((np.column_stack(columns[2:]) - means) / scales)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, columns[0], columns[1])], names=["x", "y", "w"])

    return materialize(rows.mapInArrow(pack, "x binary, y binary, w binary"), "standardized")


def added(parts: RDD) -> tuple[float, np.ndarray]:
    add = lambda a, b: (a[0] + b[0], a[1] + b[1])
    return parts.reduce(add) if parts.getNumPartitions() <= FEW_TASKS else parts.treeReduce(add)


def fit_network(train: DataFrame, label: str, features: list[str], hidden: tuple[int, ...] = (64, 32), positive_weight: float = 1.0,
                weight: str | None = None, iterations: int = 100, tolerance: float = 1e-6, seed: int = 42) -> Network:
    """Fit on all rows; a row counts ``weight`` (a column, 1 without one), a positive ``positive_weight`` times that."""
    stats = fit_standardizer(train, features)
    means = np.array([stats[f][0] or 0.0 for f in features])
    scales = np.array([(stats[f][1] or 0.0) + 1e-8 for f in features])
    sizes = [len(features), *hidden, 1]
    packed = _packed(train, label, weight, features, means, scales)
    n_features = len(features)

    def gather(pieces: Iterator) -> Iterator[tuple]:
        found = [[np.frombuffer(p[c]) for c in ("x", "y", "w")] for p in pieces]
        if found:
            x, y, w = (np.concatenate(c) for c in zip(*found))
            yield x.reshape(-1, n_features), y, w * np.where(y == 1, positive_weight, 1.0)

    n = packed.agg(F.sum(F.octet_length("y")) / 8).first()[0]
    if not n:
        raise ValueError("no rows to learn from")
    n, cores = int(n), train.sparkSession.sparkContext.defaultParallelism
    dealt = packed.coalesce(max(1, -(-n // ROWS_PER_TASK))) if n <= MANY_ROWS else packed.repartition(cores * -(-n // (cores * TASK_ROWS)))
    rows = dealt.rdd.mapPartitions(gather).persist(StorageLevel.MEMORY_AND_DISK)
    whole = rows.map(lambda r: float(r[2].sum())).sum()

    def value(flat: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = added(rows.map(lambda r: loss_and_gradient(flat, sizes, *r)))
        return loss / whole, gradient / whole

    try:
        found = minimise(value, starting_point(sizes, seed), iterations, tolerance)
    finally:
        rows.unpersist()
    return Network(list(features), means.tolist(), scales.tolist(), sizes, found.tolist())


def save_network(spark: SparkSession, model: Network, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.text(path)


def load_network(spark: SparkSession, path: str) -> Network:
    return Network.from_json(spark.read.option("wholetext", True).text(path).first()[0])
