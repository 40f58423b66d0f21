"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts of a bounded sample become one matrix of log-probabilities, buckets by languages, whose size is fixed by the
parameters; it travels to the tasks, which score whole batches of texts with a gather and a segmented sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import bounded, crc_of, drawn, held, keyed, table

ORDERS = (1, 2, 3)
#: Characters that are scored at once.
BLOCK = 1 << 20


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str], buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams that start at each character, per order; each text's start; whether it has a letter.

    Other characters than letters are all one, and n-grams without a letter fall into bucket 0.
    """
    gap = " " * (max(ORDERS) - 1)  # n-grams of one text don't reach letters of the next
    lowered = [gap + t.lower() for t in texts]
    starts = np.cumsum([0, *map(len, lowered)])[:-1]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = held("letters", _letters)[codes]
    codes = np.where(letter, codes, 0).astype(np.uint64)
    has = np.logical_or.reduceat(letter, starts) if len(texts) else np.zeros(0, bool)
    found, h, some = [], np.zeros(len(codes), np.uint64), np.zeros(len(codes), bool)
    for n in range(max(ORDERS)):
        shifted = np.concatenate([codes[n:], np.zeros(n, np.uint64)])
        h = (h ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        some = some | (shifted > 0)
        if n + 1 in ORDERS:
            place = (h >> np.uint64(20)) % np.uint64(buckets - 1) + np.uint64(1)
            found.append(np.where(some, place, 0).astype(np.int64))
    return found, starts, has


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    held_texts, size = [], 0
    for t in texts:
        held_texts.append(t)
        size += len(t)
        if size >= BLOCK:
            yield held_texts
            held_texts, size = [], 0
    if held_texts:
        yield held_texts


@dataclass
class LanguageModel:
    languages: list[str]
    logs: np.ndarray  # orders x buckets, by languages; row 0 of each order is 0
    prior: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names: list[str] = []
        scores: list[float] = []
        for block in _blocks(texts):
            if not self.languages:
                names += ["und"] * len(block)
                scores += [0.0] * len(block)
                continue
            found, starts, has = grams(block, self.logs.shape[1])
            summed = self.prior + sum(
                np.add.reduceat(self.logs[k][place], starts, axis=0, dtype=np.float64) for k, place in enumerate(found))
            best = summed.argmax(axis=1)
            share = 1.0 / np.exp(summed - summed.max(axis=1, keepdims=True)).sum(axis=1)
            names += [self.languages[b] if h else "und" for b, h in zip(best, has)]
            scores += np.where(has, share, 0.0).tolist()
        return names, scores


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(langs, batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                total = counts.setdefault(lang, np.zeros((len(ORDERS), buckets), np.int64))
                docs[lang] = docs.get(lang, 0) + len(texts)
                for block in _blocks(texts):
                    for k, place in enumerate(grams(block, buckets)[0]):
                        total[k] += np.bincount(place, minlength=buckets)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([docs[x] for x in counts], pa.int64()),
                 pa.array([c.tobytes() for c in counts.values()], pa.binary())], ["lang", "docs", "counts"])

    return run


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
    return pd.DataFrame({"lang": [group["lang"].iloc[0]], "docs": [int(group["docs"].sum())], "counts": [total.tobytes()]})


def fit_language(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = 20_000,
                 buckets: int = 1 << 15, alpha: float = 0.5, most_languages: int = 200) -> LanguageModel:
    """From at most about ``sample`` rows with a language, drawn by a hash of the id; rows without text or letter count little.

    More languages than ``most_languages`` are refused, as the matrix grows with them. Without rows the model knows none.
    """
    known = bounded(df).filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(key).alias("draw"))
    known = drawn(known, F.col("draw"), known.count(), sample)
    rows = known.select("lang", "text").repartition(8).mapInArrow(
        _counted(buckets), "lang string, docs long, counts binary").groupBy("lang").applyInPandas(
        _summed, "lang string, docs long, counts binary").limit(most_languages + 1).collect()
    if len(rows) > most_languages:
        raise ValueError(f"more than {most_languages} languages; raise most_languages if executors have the memory")
    rows = sorted(rows, key=lambda r: r["lang"])
    if not rows:
        return LanguageModel([], np.zeros((len(ORDERS), buckets, 0), np.float32), np.zeros(0))
    counts = np.stack([np.frombuffer(r["counts"], np.int64).reshape(len(ORDERS), buckets) for r in rows], axis=-1)
    counts = counts.astype(np.float64)
    counts[:, 0, :] = 0
    logs = np.log(counts + alpha) - np.log((counts + alpha)[:, 1:, :].sum(axis=1, keepdims=True))
    logs[:, 0, :] = 0
    docs = np.array([r["docs"] for r in rows], float)
    return LanguageModel([r["lang"] for r in rows], logs.astype(np.float32), np.log(docs / docs.sum()))


def identify(df: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, lang_pred, score. Null, empty and letterless texts are ``und`` with score 0."""
    # orders x buckets x languages floats, whatever the input
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.logs, model.prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        for batch in batches:
            names, scores = known.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return keyed(df, key, text).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs.filter(crc_of("doc_id") % 4 != 2))
    return identify(docs, model).select(
        "doc_id", (crc_of("doc_id") % 4 == 2).alias("held_out"), "lang_pred", "score")
