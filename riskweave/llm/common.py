"""What the training-data operators share: tables, texts and bounded caches."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import bounded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, a missing text as the empty one; other columns never meet those of an operator."""
    return bounded(df).select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))


#: Ids of so many documents at most are sent to all executors; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key isn't among ``ids`` (one column named as the key, stored)."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, key, "left_anti").select(docs.columns)


def only_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key is among ``ids`` where that saves moving the others; else all rows."""
    return docs.join(F.broadcast(ids), key, "left_semi") if ids.count() <= BROADCAST_IDS else docs


def crc_of(key: str) -> Column:
    """crc32 of the key written as text, by which rows are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary"))


def drawn(df: DataFrame, draw: Column, n: int, sample: int) -> DataFrame:
    """About ``sample`` of ``n`` rows, by a hash that is spread over all 64-bit numbers; all rows if there aren't more."""
    return df if n <= sample else df.filter(draw < F.lit(-(2**63) + sample * 2**64 // n))


class Memo(dict):
    """A cache of ``make(key)`` that starts anew at ``limit`` entries and doesn't keep long keys."""

    def __init__(self, make, limit: int = 600_000, longest: int = 48):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def held(key, make):
    """One object per Python worker, kept from task to task; globals of this package come anew with each task.

    Only the two objects used last are kept, so the caches of one operator don't stay in memory under the next.
    """
    kept = sys.modules.setdefault("_riskweave_held", types.ModuleType("_riskweave_held")).__dict__.setdefault("kept", {})
    found = kept.pop(key) if key in kept else make()
    while len(kept) > 1:
        del kept[next(iter(kept))]
    kept[key] = found
    return found
