"""Per-feature Shapley values of boosted trees, by the paths of their leaves.

A leaf contributes its value if all conditions on its path hold; a feature that is left out lets through the share of training
rows that its splits let through. For one leaf the Shapley sum over all subsets of the features on its path is a sum over
sizes only, and the coefficients of a product of linear factors give it in polynomial time. The row is scored where it lies: nothing
is copied per subset, and no row is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.boosting import BoostedTrees, Tree

#: Paths with so many features at most are summed once per pattern of conditions that hold, not once per row.
PATTERN_FEATURES = 8


class Path(NamedTuple):
    """A leaf, and per feature on its path: the open-closed interval it asks for, whether missing values pass, and the share of training
    rows that its splits let through."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    missing: list[bool]
    share: list[float]


def paths_of(tree: Tree) -> list[Path]:
    found: list[Path] = []

    def walk(node: int, held: dict[int, tuple[float, float, bool, float]]) -> None:
        f = tree.feature[node]
        if f < 0:
            found.append(Path(tree.value[node], list(held), *[list(c) for c in zip(*held.values())] or [[]] * 4))
            return
        low, high, missing, share = held.get(f, (-math.inf, math.inf, True, 1.0))
        for child, is_left in ((tree.left[node], True), (tree.right[node], False)):
            part = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.5
            inner = (low, min(high, tree.threshold[node])) if is_left else (max(low, tree.threshold[node]), high)
            walk(child, held | {f: (*inner, missing and tree.missing_left[node] == is_left, share * part)})

    walk(0, {})
    return found


def shares_of(share: np.ndarray, holds: np.ndarray) -> np.ndarray:
    """The Shapley value of every feature on a path with leaf value 1: ``share`` per feature, ``holds`` per feature and row.

    Among the other features, the subsets of each size add up to a coefficient of the product of (share + holds * y).
    """
    m, n = holds.shape
    out = np.empty((m, n))
    for j in range(m):
        coefficients = np.zeros((m, n))
        coefficients[0] = 1.0
        degree = 0
        for i in range(m):
            if i == j:
                continue
            raised = coefficients[: degree + 1] * holds[i]
            coefficients[: degree + 2] *= share[i]
            coefficients[1: degree + 2] += raised
            degree += 1
        total = np.zeros(n)
        for size in range(m):
            total += coefficients[size] * (math.factorial(size) * math.factorial(m - 1 - size) / math.factorial(m))
        out[j] = total * (holds[j] - share[j])
    return out


class Attribution:
    """Shapley values of a model for many rows at once."""

    def __init__(self, model: BoostedTrees):
        self.n_features = len(model.features)
        self.paths = [p for tree in model.trees for p in paths_of(tree)]
        #: The mean log odds over the training rows, as the covers have it.
        self.expectation = model.base + sum(p.value * math.prod(p.share) for p in self.paths)
        self.tables = {}
        for number, p in enumerate(self.paths):
            m = len(p.features)
            if m <= PATTERN_FEATURES:
                holds = (np.arange(2**m)[None, :] >> np.arange(m)[:, None] & 1).astype(float)
                self.tables[number] = p.value * shares_of(np.array(p.share), holds) if m else np.zeros((0, 1))

    def values(self, columns: list[np.ndarray]) -> np.ndarray:
        """Rows by features, in log odds."""
        n = len(columns[0]) if columns else 0
        out = np.zeros((self.n_features, n))
        missing = [np.isnan(c) for c in columns]
        conditions: dict[tuple, np.ndarray] = {}

        def holds(f: int, low: float, high: float, passes: bool) -> np.ndarray:
            key = (f, low, high, passes)
            if key not in conditions:
                with np.errstate(invalid="ignore"):
                    inside = (columns[f] > low) if low > -math.inf else np.ones(n, bool)
                    if high < math.inf:
                        inside = inside & (columns[f] <= high)
                conditions[key] = np.where(missing[f], passes, inside)
            return conditions[key]

        for number, p in enumerate(self.paths):
            held = [holds(*c) for c in zip(p.features, p.low, p.high, p.missing)]
            if number in self.tables:
                pattern = np.zeros(n, np.int32)
                for i, h in enumerate(held):
                    pattern |= h.astype(np.int32) << i
                for f, table in zip(p.features, self.tables[number]):
                    out[f] += table[pattern]
            else:
                found = p.value * shares_of(np.array(p.share), np.array(held, float))
                for f, values in zip(p.features, found):
                    out[f] += values
        return out.T


def tree_contributions(df: DataFrame, key: str, model: BoostedTrees, expectation: str | None = None) -> DataFrame:
    """``key`` and one column per feature: its Shapley value in log odds, against the training rows.

    The values of a row and the expectation (a column if ``expectation`` names one) add up to its log odds.
    """
    names = [*model.features, *([expectation] if expectation else [])]
    held: list[Attribution] = []

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held.append(Attribution(model))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                values = held[0].values([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[1:]])
                more = [pa.array(np.full(part.num_rows, held[0].expectation))] if expectation else []
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(values[:, i]) for i in range(values.shape[1])], *more], names=[key, *names])

    fields = ", ".join([f"`{key}` {df.schema[key].dataType.simpleString()}", *[f"`{n}` double" for n in names]])
    return df.select(key, *[F.col(f).cast("double").alias(f) for f in model.features]).mapInArrow(attribute, fields)
