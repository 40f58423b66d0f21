"""Toxic passages as maximum-scoring segments of a text, and their significance.

Training counts in how many toxic and clean documents a word occurs. A word's rate is a Dirichlet posterior whose prior
is the rate of its longest known beginning, back to the rate of all words; its score is the log-odds against that last
rate, less a drift. One linear scan finds all maximal-scoring segments of a text. Their scores follow an
extreme-value law in clean texts, whose scale comes from the scores of clean words and whose place from clean documents; a
logistic curve over the significance of the best and of all segments gives the final probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import Memo, bounded, crc_of, drawn, keyed, table
from riskweave.session import materialize

WORD = re.compile(r"\w+")
#: Lengths of the beginnings that words share a prior by.
STEMS = (4, 5, 6, 8)
EULER = 0.5772156649015329


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """The word's beginnings, marked as such, and the word."""
    return [word[:n] + "*" for n in STEMS if len(word) > n] + [word]


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) in one pass.

    Each candidate keeps the sums before and after it; a new one is joined with the nearest earlier candidate that starts
    lower, as long as that one also ends lower.
    """
    found: list[tuple[float, float, int, int]] = []  # sum before, sum after, start, end
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        left, right, start = total, total + s, i
        total = right
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j -= 1
            if j < 0 or found[j][1] >= right:
                found.append((left, right, start, i + 1))
                break
            left, start = found[j][0], found[j][2]
            del found[j:]
    return [(r - l, a, b) for l, r, a, b in found]


def _word_score(odds: dict[str, float], drift: float, word: str) -> float:
    """The odds of the word or its longest known beginning, less the drift."""
    return next((odds[f] for f in reversed(features(word)) if f in odds), 0.0) - drift


@dataclass
class ToxicModel:
    """Log-odds of words and their beginnings, the drift, and the laws fitted to segments."""

    odds: dict[str, float]
    drift: float
    scale: float = 1.0
    place: float = 0.0
    weights: tuple[float, ...] = (0.0, 1.0, 0.0)
    memo: Memo = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        odds, drift = self.odds, self.drift  # no way back to the model, so both go with its last use
        self.memo = Memo(lambda word: _word_score(odds, drift, word), limit=300_000)

    def __reduce__(self):
        return ToxicModel, (self.odds, self.drift, self.scale, self.place, self.weights)

    def passages(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of words, and the segments by word numbers."""
        found = words(text)
        return len(found), segments([*map(self.memo.__getitem__, found)])

    def significance(self, score: float, n: int) -> float:
        """The segment's score on the scale on which the best of a clean text follows the standard Gumbel law."""
        return self.scale * score - math.log(max(n, 1)) - self.place

    def evidence(self, n: int, found: list[tuple[float, int, int]]) -> tuple[float, float]:
        """Significance of the best segment, and the sum over all significant ones, damped."""
        best = max((s for s, _, _ in found), default=0.0)
        total = sum(max(0.0, self.significance(s, n)) for s, _, _ in found)
        return max(-10.0, min(30.0, self.significance(best, n))), math.log1p(total)

    def probability(self, n: int, found: list[tuple[float, int, int]]) -> float:
        best, total = self.evidence(n, found)
        z = self.weights[0] + self.weights[1] * best + self.weights[2] * total
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, z))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that have a feature, per task."""
    toxic: Counter = Counter()
    clean: Counter = Counter()
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if label else clean).update({f for w in {*words(text)} for f in features(w)})
    names = list({*toxic, *clean})
    for at in range(0, len(names), 50_000):
        part = names[at:at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([toxic[f] for f in part], pa.int64()),
             pa.array([clean[f] for f in part], pa.int64())], ["feature", "toxic", "clean"])


def _evidence(model: ToxicModel):
    """Label, significance of the best segment and damped sum over all, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.evidence(*model.passages(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b for b, _ in found], pa.float64()), pa.array([t for _, t in found], pa.float64())],
                ["label", "best", "total"])

    return run


def _scored_sample(model: ToxicModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, list[float], list[float]]] = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                scores = [*map(model.memo.__getitem__, found)]
                values, often = np.unique(np.round(scores, 2), return_counts=True)
                best = max((s for s, _, _ in segments(scores)), default=0.0)
                out.append((label, len(found), best, [x for pair in zip(values, often) for x in pair]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.list_(pa.float64()))],
                ["label", "n", "best", "words"])

    return run


def _scale(values: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum share * exp(scale * value) = 1; the mean is below 0 and some value above."""
    if values.max(initial=-1.0) <= 0:
        return 1.0
    low, high = 1e-4, 1.0
    law = lambda x: float((share * np.exp(np.minimum(x * values, 500.0))).sum()) - 1.0
    while law(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if law(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton's steps for a logistic curve with a small penalty on all but the constant; a step that doesn't lower the loss is
    halved, as labels that the evidence separates nearly perfectly make whole steps jump to and fro."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(a.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    loss_at = lambda v: float((np.logaddexp(0, a @ v) - y * (a @ v)).sum() + v @ penalty @ v / 2)
    loss = loss_at(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        slope = a.T @ (y - p) - penalty @ w
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, slope)
        while (new := loss_at(w + step)) > loss and np.abs(step).max() > 1e-12:
            step = step / 2
        if new > loss:
            break
        w, fallen, loss = w + step, loss - new, new
        if np.abs(step).max() < 1e-9 or fallen <= 1e-12 * loss:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                 sample: int = 20_000, max_features: int = 100_000, strength: float = 4.0, drift: float = 1.0) -> ToxicModel:
    """Learn from the labelled rows given; at most about ``sample`` of them, drawn by a hash of the id, are read.

    The model keeps at most ``max_features`` words and beginnings, those whose score differs most from their prior's, so
    its size has a bound. A document labelled both ways is toxic. Three of four sampled rows give the counts, the others the laws. Without rows of both labels every
    text gets the share of toxic rows (0 without rows).
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).groupBy("doc_id").agg(
        F.max("label").alias("label"))
    known = drawn(known, F.xxhash64("doc_id"), known.count(), sample)
    # the sample is bounded, so it may go to all executors; stored, it is drawn from the texts once
    rows = materialize(keyed(docs, key, text).join(F.broadcast(known), "doc_id").select(
        "label", "text", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("held")), "labelled-sample")
    sizes = {(r["held"], r["label"]): r["count"] for r in rows.groupBy("held", "label").count().collect()}
    n_toxic, n_clean = (sum(c for (_, y), c in sizes.items() if y == v) for v in (1, 0))
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        return ToxicModel({}, drift, weights=(math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0, 0.0))
    counted = rows.filter(~F.col("held")).select("label", "text").mapInArrow(
        _counts, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    base = (sizes.get((False, 1), 0) + 0.5) / (sizes.get((False, 1), 0) + sizes.get((False, 0), 0) + 1.0)
    # only features seen in several documents of which more are toxic than usual can raise a score
    raised = counted.filter((F.col("toxic") >= 2) & (F.col("toxic") > base * 1.2 * (F.col("toxic") + F.col("clean"))))
    kept = raised.orderBy((F.col("toxic") / (F.col("toxic") + F.col("clean")) * F.sqrt("toxic")).desc(), "feature").limit(
        max_features).collect()
    counts = {r["feature"]: (r["toxic"], r["clean"]) for r in kept}
    odds: dict[str, float] = {}
    rates: dict[str, float] = {}
    for f in sorted(counts, key=len):
        word = f.rstrip("*")
        shorter = [x for x in features(word)[:-1] if x in rates and x != f]
        prior = rates[shorter[-1]] if shorter else base
        t, c = counts[f]
        rates[f] = (t + strength * prior) / (t + c + strength)
        odds[f] = math.log(rates[f] / (1 - rates[f])) - math.log(base / (1 - base))
    model = ToxicModel(odds, drift)
    scored = rows.filter("held").select("label", "text").mapInArrow(
        _scored_sample(model), "label int, n long, best double, words array<double>").collect()
    clean = [r for r in scored if not r["label"] and r["n"]]
    histogram: Counter = Counter()
    for r in clean:
        for value, often in zip(r["words"][::2], r["words"][1::2]):
            histogram[value] += often
    if histogram:
        values = np.array(list(histogram))
        share = np.array(list(histogram.values())) / sum(histogram.values())
        model.scale = _scale(values, share)
        best = [model.scale * r["best"] - math.log(r["n"]) for r in clean]
        model.place = float(np.mean(best)) - EULER
    judged = rows.filter("held").select("label", "text").mapInArrow(_evidence(model), "label int, best double, total double").collect()
    x = np.array([(r["best"], r["total"]) for r in judged]).reshape(-1, 2)
    y = np.array([r["label"] for r in judged], float)
    if 0 < y.sum() < len(y):
        model.weights = tuple(map(float, _logistic(x, y)))
    else:
        model.weights = (-3.0, 1.0, 0.0)
    return model


def score_toxicity(df: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, score, and the significant passages (first and last word number, expected count E by chance).

    Null and empty texts have no passage and the score of that. Texts of any length are read whole.
    """
    shape = "doc_id long, score double, passages array<struct<start:int,end:int,expected:double>>"
    inner = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for value in batch.column(1):
                n, found = model.passages(value.as_py())
                scores.append(model.probability(n, found))
                expected = [(a, b, math.exp(-model.significance(s, n))) for s, a, b in found]
                passages.append([{"start": a, "end": b - 1, "expected": e} for a, b, e in expected if e < 0.05])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, inner)], ["doc_id", "score", "passages"])

    return keyed(df, key, text).mapInArrow(run, shape)


def reject_toxic(df: DataFrame, model: ToxicModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose text scores below the threshold, all columns as they are."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.probability(*model.passages(v.as_py() or "")) for v in batch.column(place)]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return bounded(df).mapInArrow(run, df.schema)


def trained(spark: SparkSession, sf_dir: str) -> ToxicModel:
    """From the labels that aren't held out."""
    labels = table(spark, sf_dir, "labels").filter(crc_of("doc_id") % 5 != 0)
    return fit_toxicity(table(spark, sf_dir, "documents"), labels)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), trained(spark, sf_dir))
    return scored.select("doc_id", (crc_of("doc_id") % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
