"""Second-order gradient boosting on histograms.

Features are quantised once and stored as one byte each; of a large table equal quantised rows become one with a count. For every level of a tree the tasks sum gradients and Hessians per node,
feature and bin over the rows they hold, and only these sums travel; of two sibling nodes one is summed and the other is the
difference to their parent. A level is one job, and leaf values follow from the sums of the last split. Rows and margins stay
with their tasks; the lineage of the margins is cut by a checkpoint every few trees. Rows find their leaves by look-ups, a block of
rows at a time (``LeafBits``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import ensure_checkpoints, materialize

#: Bins of present values; one more holds missing ones.
BINS = 255
#: Rows of a stored piece, and of a partition of a small table.
PIECE_ROWS, ROWS_PER_TASK = 16_384, 10_000
#: Tables with more rows are dealt out evenly over all cores, in tasks of so many rows at most.
MANY_ROWS, TASK_ROWS = 500_000, 1_000_000
#: So many tasks send their sums to the driver at once.
FEW_TASKS = 64
#: Rows whose leaves are looked up at once, and rows whose gradients are summed at once: what they need stays in a core's cache.
LOOK_ROWS, SUM_ROWS = 8192, 65_536
#: Trees after which tasks store their margins again, and after which a checkpoint cuts the lineage of the margins.
STORE_EVERY, CHECKPOINT_EVERY = 5, 20
#: Bins of the margin in which held-out rows are counted, and the range they cover.
MARGIN_BINS, MARGIN_RANGE = 4096, 16.0


@dataclass(frozen=True)
class Growth:
    """How trees grow; the values that gradient boosting usually starts from."""

    depth: int = 5
    step: float = 0.05
    l2: float = 1.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    rows: float = 0.8
    features: float = 0.8


class LeafBits:
    """The leaves of a tree as bits: for each feature and code, the leaves that a row with that code can still reach.

    A node rules out the leaves under the child that a row doesn't go to, so what all features of a row leave is the bit of its own
    leaf. That is a look-up per feature instead of a walk. A word holds 32 leaves; larger trees have several words.
    """

    #: The top five bits of a power of two times this number tell the power.
    MAGIC = np.uint32(0x077CB531)

    def __init__(self, feature: list[int], left: list[int], right: list[int], goes_left: np.ndarray):
        """``goes_left``: per node and code; children come after their parent."""
        under: list[int] = [0] * len(feature)
        leaves = [node for node, f in enumerate(feature) if f < 0]
        for place, node in enumerate(leaves):
            under[node] = 1 << place
        for node in range(len(feature) - 1, -1, -1):
            if feature[node] >= 0:
                under[node] = under[left[node]] | under[right[node]]
        self.words = []
        for at in range(0, len(leaves), 32):
            own = np.array([u >> at & 0xFFFFFFFF for u in under], np.uint32)
            left_out = own[0] & ~own
            tables: dict[int, np.ndarray] = {}
            for node, f in enumerate(feature):
                if f >= 0:
                    passes = np.where(goes_left[node], left_out[right[node]], left_out[left[node]])
                    tables[f] = tables[f] & passes if f in tables else passes
            leaf_of = np.zeros(32, np.int64)
            bits = np.uint32(1) << np.arange(len(leaves[at:at + 32]), dtype=np.uint32)
            leaf_of[(bits * self.MAGIC) >> np.uint32(27)] = leaves[at:at + 32]
            self.words.append((tables, leaf_of))

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``codes``: features by rows, as indices."""
        found = None
        for tables, leaf_of in self.words:
            bits = None
            for f, table in tables.items():
                own = table.take(codes[f])
                bits = own if bits is None else np.bitwise_and(bits, own, out=bits)
            if bits is None:  # the root is the only leaf
                return np.full(codes.shape[1], leaf_of[0])
            here = leaf_of.take((bits * self.MAGIC) >> np.uint32(27))
            found = here if found is None else np.where(bits, here, found)
        return found


@dataclass(frozen=True)
class Tree:
    """Nodes by number; a leaf has feature -1. A row goes left if its value is at most the threshold; missing values go where they did best."""

    feature: list[int]
    threshold: list[float]
    missing_left: list[bool]
    left: list[int]
    right: list[int]
    value: list[float]
    cover: list[float]

    def leaves(self, columns: list[np.ndarray]) -> np.ndarray:
        """The leaf of every row; ``columns`` are the features, NaN where missing."""
        feature, threshold, missing, left, right = map(np.array, (self.feature, self.threshold, self.missing_left, self.left, self.right))
        node = np.zeros(len(columns[0]) if columns else 0, np.int32)
        while True:
            inner = np.flatnonzero(feature[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            x = np.empty(len(inner))
            for f in np.unique(feature[at]):
                mine = feature[at] == f
                x[mine] = columns[f][inner[mine]]
            goes_left = np.where(np.isnan(x), missing[at], x <= threshold[at])
            node[inner] = np.where(goes_left, left[at], right[at])


@dataclass(frozen=True)
class BoostedTrees:
    features: list[str]
    base: float
    trees: list[Tree]

    @cached_property
    def _look_up(self) -> tuple[list[np.ndarray], list[tuple[LeafBits, np.ndarray]]]:
        """The thresholds of each feature, which are the edges of its codes, and the leaves and values of the trees over such codes."""
        cuts = [np.unique([t for tree in self.trees for g, t in zip(tree.feature, tree.threshold) if g == f]) for f in range(len(self.features))]
        most = max((len(c) for c in cuts), default=0) + 1  # the code of missing values
        codes = np.arange(most + 1)
        found = []
        for tree in self.trees:
            last = np.array([np.searchsorted(cuts[f], t) if f >= 0 else 0 for f, t in zip(tree.feature, tree.threshold)])
            goes_left = np.where(codes == most, np.array(tree.missing_left)[:, None], codes <= last[:, None])
            found.append((LeafBits(tree.feature, tree.left, tree.right, goes_left), np.array(tree.value)))
        return cuts, found

    def margin(self, columns: list[np.ndarray]) -> np.ndarray:
        """Log odds of rows."""
        total = np.full(len(columns[0]), self.base)
        cuts, trees = self._look_up
        most = max((len(c) for c in cuts), default=0) + 1
        for at in range(0, len(total), LOOK_ROWS):
            own = total[at:at + LOOK_ROWS]
            parts = [c[at:at + LOOK_ROWS] for c in columns]
            codes = np.stack([np.where(np.isnan(x), most, np.searchsorted(c, x)) for x, c in zip(parts, cuts)])
            for bits, value in trees:
                own += value.take(bits.leaves(codes))
        return total

    def score(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """``df`` with the probability of the positive class; works on streams too."""
        model = self

        @F.pandas_udf("double")
        def probability(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                yield pd.Series(1 / (1 + np.exp(-model.margin([c.to_numpy(dtype=float, na_value=np.nan) for c in columns]))))

        return df.withColumn(name, probability(*[F.col(f).cast("double") for f in self.features]))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "base": self.base, "trees": [vars(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        found = json.loads(text)
        return BoostedTrees(found["features"], found["base"], [Tree(**t) for t in found["trees"]])


# --------------------------------------------------------------------------- rows in tasks
class Rows:
    """The rows of one partition: a byte per feature, label, whether held out, and the margin so far; positives have a weight.

    With ``times`` a row stands for so many equal ones.
    """

    def __init__(self, codes: np.ndarray, label: np.ndarray, weight: float, held: np.ndarray, margin: np.ndarray, seed: int,
                 times: np.ndarray | None = None):
        self.codes, self.label, self.weight, self.held, self.margin, self.seed, self.times = codes, label, weight, held, margin, seed, times

    def moved(self, trees: list[dict]) -> Rows:
        """After further trees."""
        if not trees:
            return self
        margin = self.margin.copy()
        steps = [(_bits(tree), np.array(tree["value"])) for tree in trees]
        for at in range(0, len(margin), LOOK_ROWS):
            codes, own = self.codes[:, at:at + LOOK_ROWS].astype(np.intp), margin[at:at + LOOK_ROWS]
            for bits, value in steps:
                own += value.take(bits.leaves(codes))
        return Rows(self.codes, self.label, self.weight, self.held, margin, self.seed, self.times)

    def nodes(self, tree: dict) -> np.ndarray:
        """The node of every row in a tree, finished or not."""
        bits, node = _bits(tree), np.empty(len(self.label), np.int32)
        for at in range(0, len(node), LOOK_ROWS):
            node[at:at + LOOK_ROWS] = bits.leaves(self.codes[:, at:at + LOOK_ROWS].astype(np.intp))
        return node

    def weights(self, rows: np.ndarray) -> np.ndarray:
        weight = np.where(self.label[rows] == 1, self.weight, 1.0)
        return weight if self.times is None else weight * self.times[rows]

    def sums(self, tree: dict, wanted: list[int], number: int, share: float) -> np.ndarray:
        """Per wanted node, feature and bin: the sums of gradient and Hessian over the rows that the tree learns from."""
        slot_of = np.full(len(tree["feature"]), -1)
        slot_of[wanted] = np.arange(len(wanted))
        bits, draw = _bits(tree), np.random.default_rng([self.seed, number])
        out = np.zeros((2, len(wanted), len(self.codes), BINS + 1))
        for at in range(0, len(self.label), SUM_ROWS):
            part = slice(at, min(at + SUM_ROWS, len(self.label)))
            slot = np.concatenate([
                slot_of.take(bits.leaves(self.codes[:, i:min(i + LOOK_ROWS, part.stop)].astype(np.intp)))
                for i in range(part.start, part.stop, LOOK_ROWS)])
            drawn = ~self.held[part] & (slot >= 0)
            times = None if self.times is None else self.times[part]
            if share < 1:
                if times is None:
                    drawn &= draw.random(len(slot)) < share
                else:  # of equal rows each is drawn by itself
                    times = draw.binomial(times, share)
                    drawn &= times > 0
            rows = np.flatnonzero(drawn)
            base = slot[rows] * (BINS + 1)
            own = 1 if times is None else times[rows]
            rows += at
            p = 1 / (1 + np.exp(-self.margin[rows]))
            weight = np.where(self.label[rows] == 1, self.weight, 1.0) * own
            gradient, hessian = weight * (p - self.label[rows]), weight * p * (1 - p)
            for f, codes in enumerate(self.codes):
                cell = base + codes[rows]
                for i, values in enumerate((gradient, hessian)):
                    out[i, :, f] += np.bincount(cell, weights=values, minlength=len(wanted) * (BINS + 1)).reshape(len(wanted), -1)
        return out

    def held_out(self) -> np.ndarray:
        """Counts of held-out rows per label and bin of the margin."""
        at = np.clip((self.margin[self.held] / MARGIN_RANGE + 1) * (MARGIN_BINS / 2), 0, MARGIN_BINS - 1).astype(int)
        times = None if self.times is None else self.times[self.held]
        return np.bincount(self.label[self.held].astype(int) * MARGIN_BINS + at, times, minlength=2 * MARGIN_BINS).astype(float)


def _bits(tree: dict) -> LeafBits:
    """The leaves of a tree that grows, over the bins."""
    bins = np.arange(BINS + 1)
    goes_left = np.where(bins == BINS, np.array(tree["missing_left"])[:, None], bins <= np.array(tree["bin"])[:, None])
    return LeafBits(tree["feature"], tree["left"], tree["right"], goes_left)


def average_precision(counts: np.ndarray) -> float | None:
    """Step sum over falling margins; None without a positive."""
    negative, positive = counts.reshape(2, -1)[:, ::-1]
    if not positive.sum():
        return None
    true, all_ = np.cumsum(positive), np.cumsum(positive + negative)
    return float((positive * true / np.maximum(all_, 1)).sum() / positive.sum())


def _edges(train: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Upper edges of the bins, from one sketched pass over all features."""
    found = train.select(*[F.col(f).cast("double").alias(f) for f in features]).approxQuantile(
        features, [i / BINS for i in range(1, BINS)], 0.0005)
    return [np.unique(np.array(e, float)) for e in found]


def _packed(train: DataFrame, label: str, features: list[str], edges: list[np.ndarray], held_out: float, seed: int) -> DataFrame:
    """Pieces of quantised rows. Equal rows are held out together."""
    values = [F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)]
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(label), *[F.col(f) for f in features]), F.lit(1_000_000)) < int(1_000_000 * held_out)
    rows = train.select(F.col(label).cast("double").alias("_y"), draw.alias("_held"), *values)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                part = batch.slice(at, PIECE_ROWS)
                y = part.column(0).to_numpy(zero_copy_only=False)
                codes = np.empty((len(features), len(y)), np.uint8)
                for i, e in enumerate(edges):
                    x = part.column(i + 2).to_numpy(zero_copy_only=False).astype(float)
                    codes[i] = np.where(np.isnan(x), BINS, np.searchsorted(e, x))
                held = part.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(y)], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in (codes, y.astype(np.uint8), held)]],
                    names=["n", "codes", "label", "held"])

    return materialize(rows.mapInArrow(pack, "n long, codes binary, label binary, held binary"), "quantised")


def _grouped(packed: DataFrame, n_features: int) -> DataFrame:
    """The different quantised rows, ``key, times``: codes, label and held-out mark as one value, and how often it occurs.

    There are at most as many as combinations of bins, however many rows there are.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                codes = np.frombuffer(p["codes"], np.uint8).reshape(n_features, p["n"])
                keys = np.concatenate([codes, np.frombuffer(p["label"], np.uint8)[None], np.frombuffer(p["held"], np.uint8)[None]]).T
                different, times = np.unique(np.ascontiguousarray(keys).view(f"V{n_features + 2}").ravel(), return_counts=True)
                ends = pa.array(np.arange(len(different) + 1, dtype="int32") * (n_features + 2)).buffers()[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), len(different), [None, ends, pa.py_buffer(different.tobytes())]), pa.array(times, pa.int64())],
                    names=["key", "times"])

    pieces = packed.mapInArrow(split, "key binary, times long")
    return materialize(pieces.groupBy("key").agg(F.sum("times").alias("times")), "different-rows")


def _dealt(grouped: DataFrame, n_features: int, tasks: int) -> DataFrame:
    """Pieces of the different rows in so many tasks, the same ones and in the same order every time."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                part = batch.slice(at, PIECE_ROWS)
                keys = np.frombuffer(b"".join(part.column(0).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                made = [np.ascontiguousarray(keys[:, :n_features].T), keys[:, n_features], keys[:, n_features + 1], part.column(1).to_numpy().astype("<i8")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in made]],
                    names=["n", "codes", "label", "held", "times"])

    rows = grouped.repartition(tasks, "key").sortWithinPartitions("key")
    return rows.mapInArrow(pack, "n long, codes binary, label binary, held binary, times binary")


def _partition(n_features: int, weight: float, base: float, seed: int):
    def gather(index: int, pieces: Iterator) -> Iterator[Rows]:
        found = [(np.frombuffer(p["codes"], np.uint8).reshape(n_features, p["n"]), np.frombuffer(p["label"], np.uint8),
                  np.frombuffer(p["held"], np.uint8).astype(bool), np.frombuffer(p["times"], "<i8") if "times" in p else None) for p in pieces]
        if found:
            codes, label, held = np.concatenate([f[0] for f in found], axis=1), *[np.concatenate([f[i] for f in found]) for i in (1, 2)]
            times = None if found[0][3] is None else np.concatenate([f[3] for f in found])
            yield Rows(codes, label, weight, held, np.full(len(label), base), seed * 1_000_003 + index, times)

    return gather


def _added(rows: RDD, work) -> list[np.ndarray]:
    """Sums over all partitions of the arrays that ``work`` makes of one; in a tree where there are many, as that takes further stages."""
    add = lambda a, b: [x + y for x, y in zip(a, b)]
    made = rows.map(work)
    return made.reduce(add) if rows.getNumPartitions() <= FEW_TASKS else made.treeReduce(add)


# --------------------------------------------------------------------------- growing
def best_split(sums: np.ndarray, usable: np.ndarray, growth: Growth) -> tuple | None:
    """(gain, feature, bin, missing left, left sums, right sums) of one node; ``sums``: gradient and Hessian per feature and bin."""
    total = sums[:, 0].sum(axis=1)
    missing = sums[:, :, BINS]
    below = np.cumsum(sums[:, :, :BINS], axis=2)[:, :, :-1]
    fitness = lambda g, h: g**2 / (h + growth.l2)
    best = None
    for with_missing in (True, False):
        left = below + missing[:, :, None] if with_missing else below
        right = total[:, None, None] - left
        gain = 0.5 * (fitness(*left) + fitness(*right) - fitness(*total)) - growth.least_gain
        open_ = usable[:, None] & (left[1] >= growth.least_hessian) & (right[1] >= growth.least_hessian)
        gain = np.where(open_, gain, -np.inf)
        f, b = np.unravel_index(gain.argmax(), gain.shape)
        if gain[f, b] > 1e-9 and (best is None or gain[f, b] > best[0]):
            best = (float(gain[f, b]), int(f), int(b), with_missing, left[:, f, b].copy(), right[:, f, b].copy())
    return best


def _grow(rows: RDD, pending: list[dict], number: int, first: np.ndarray, usable: np.ndarray, edges: list[np.ndarray], growth: Growth) -> dict:
    """One tree, as lists by node."""
    tree: dict[str, list] = {k: [] for k in ("feature", "bin", "threshold", "missing_left", "left", "right", "value")}

    def add(total: np.ndarray) -> int:
        for k, v in (("feature", -1), ("bin", 0), ("threshold", 0.0), ("missing_left", True), ("left", 0), ("right", 0),
                     ("value", float(-growth.step * total[0] / (total[1] + growth.l2)))):
            tree[k].append(v)
        return len(tree["feature"]) - 1

    open_ = {add(first[:, 0].sum(axis=1)): first}
    for depth in range(growth.depth):
        pairs, small, parents = [], [], {}
        for node, sums in open_.items():
            split = best_split(sums, usable, growth)
            if split is None:
                continue
            _, f, b, missing_left, left, right = split
            children = add(left), add(right)
            # behind the last edge all present values go left, and missing ones right
            tree["feature"][node], tree["bin"][node] = f, b
            tree["threshold"][node] = float(edges[f][b]) if b < len(edges[f]) else float("inf")
            tree["missing_left"][node], (tree["left"][node], tree["right"][node]) = missing_left, children
            lesser = 0 if left[1] <= right[1] else 1
            pairs.append((children[lesser], children[1 - lesser]))
            small.append(children[lesser])
            parents[children[lesser]] = sums
        if not pairs or depth == growth.depth - 1:
            break
        nodes = {k: tree[k] for k in ("feature", "bin", "missing_left", "left", "right")}
        share = growth.rows
        found = _added(rows, lambda r: [r.moved(pending).sums(nodes, small, number, share)])[0]
        open_ = {}
        for i, (lesser, other) in enumerate(pairs):
            open_[lesser] = found[:, i]
            open_[other] = parents[lesser] - found[:, i]  # what the sibling leaves of their parent
    return tree


def fit_trees(train: DataFrame, label: str, features: list[str], weight: float = 1.0, trees: int = 400, growth: Growth = Growth(),
              patience: int | None = 50, held_out: float = 0.1, seed: int = 42) -> BoostedTrees:
    """Fit at most so many trees; positives weigh ``weight``.

    With ``patience`` a part of the rows is held out, and growth ends when their average precision hasn't risen for so many
    trees; the trees up to the best are kept. All other rows take part in every level's sums of the trees that draw them.
    """
    spark = train.sparkSession
    ensure_checkpoints(spark)
    edges = _edges(train, features)
    packed = _packed(train, label, features, edges, held_out if patience else 0.0, seed)
    n = packed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not n:
        raise ValueError("no rows to learn from")
    # a job per level: a small table needs few tasks, and those of a large one should end together
    cores = spark.sparkContext.defaultParallelism
    if n <= MANY_ROWS:
        table = packed.coalesce(max(1, -(-n // ROWS_PER_TASK))).rdd
    else:
        grouped = _grouped(packed, len(features))
        table = _dealt(grouped, len(features), cores * -(-grouped.count() // (cores * TASK_ROWS))).rdd
    base = 0.0
    rows = table.mapPartitionsWithIndex(_partition(len(features), weight, 0.0, seed))
    positive, all_ = _added(rows, lambda r: [np.array(v) for v in _weighed(r)])
    if 0 < positive < all_:
        base = float(np.log(positive / (all_ - positive)))
    rows = table.mapPartitionsWithIndex(_partition(len(features), weight, base, seed)).persist(StorageLevel.MEMORY_AND_DISK)
    draw = np.random.default_rng(seed)
    grown: list[dict] = []
    best, best_at = -1.0, 0
    root = {"feature": [-1], "bin": [0], "missing_left": [True], "left": [0], "right": [0]}
    older: list[RDD] = []
    pending: list[dict] = []  # trees that the stored margins don't have yet
    share = growth.rows
    for number in range(trees + 1):
        if len(pending) == STORE_EVERY:
            older.append(rows)
            rows = rows.map(lambda r, new=pending: r.moved(new)).persist(StorageLevel.MEMORY_AND_DISK)
            pending = []
            if number % CHECKPOINT_EVERY == 0:
                rows.checkpoint()

        def begin(r: Rows, new=pending, number=number) -> list[np.ndarray]:
            r = r.moved(new)
            return [r.sums(root, [0], number, share), r.held_out()]

        first, counts = _added(rows, begin)
        while older:  # the one before stays until this one has been made
            older.pop().unpersist()
        quality = average_precision(counts) if patience else None
        if quality is not None:
            if quality > best:
                best, best_at = quality, number
            elif number - best_at >= patience:
                break
        if number == trees:
            break
        usable = np.zeros(len(features), bool)
        usable[draw.permutation(len(features))[: max(1, round(growth.features * len(features)))]] = True
        pending = [*pending, _grow(rows, pending, number, first[:, 0], usable, edges, growth)]
        grown.append(pending[-1])
    kept = grown[:best_at] if patience and best >= 0 else grown
    covers = _added(rows, lambda r: [_covers(r, kept)])[0] if kept else np.zeros((0, 1))
    rows.unpersist()
    made = []
    for tree, cover in zip(kept, covers):
        size = len(tree["feature"])
        made.append(Tree(*[tree[k] for k in ("feature", "threshold", "missing_left", "left", "right", "value")], cover[:size].tolist()))
    return BoostedTrees(list(features), base, made)


def _weighed(rows: Rows) -> tuple[float, float]:
    """The weight of the positives that aren't held out, and of all such rows."""
    own = np.flatnonzero(~rows.held)
    weight = rows.weights(own)
    return (weight * rows.label[own]).sum(), weight.sum()


def _covers(rows: Rows, trees: list[dict]) -> np.ndarray:
    """Training rows in each node of each tree, by one pass; a node has those of its children."""
    out = np.zeros((len(trees), max(len(t["feature"]) for t in trees)))
    for i, tree in enumerate(trees):
        out[i] = np.bincount(rows.nodes(tree), rows.times, minlength=out.shape[1])
        for node in range(len(tree["feature"]) - 1, -1, -1):  # children come after their parent
            if tree["feature"][node] >= 0:
                out[i, node] = out[i, tree["left"][node]] + out[i, tree["right"][node]]
    return out


# --------------------------------------------------------------------------- storing
def save_trees(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.text(path)


def load_trees(spark: SparkSession, path: str) -> BoostedTrees:
    return BoostedTrees.from_json(spark.read.option("wholetext", True).text(path).first()[0])
