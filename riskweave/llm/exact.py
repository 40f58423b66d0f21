"""Exact duplicates of whole texts, over batches that arrive one after another.

Texts equal after lower-casing A-Z share a SHA-256. Each batch groups its own digests first; what is new in it becomes an
immutable snapshot: exact buckets of digests, and a static binary fuse filter per bucket. The digests of a later batch meet
only the filters; those that pass join the exact buckets, and the texts behind a match are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import bounded, crc_of, keyed, only_ids, table, text_or_empty, without_ids
from riskweave.llm.fuse import FuseFilter
from riskweave.session import materialize

DIGEST = ["sha", "check", "n_bytes"]


def _digests(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().encode("utf-8").lower() for t in batch.column(1)]  # of bytes, lower() changes A-Z only
            first = [n for n in batch.schema.names if n != "text"]
            columns = [*[batch.column(n) for n in first], pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                       pa.array([xxhash.xxh3_64_intdigest(t) - 2**63 for t in texts], pa.int64()),
                       pa.array([len(t) for t in texts], pa.int64())]
            names = [*first, *DIGEST]
            if with_text:
                columns.append(pa.array(texts, pa.binary()))
                names.append("bytes")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _build_filter(group: pd.DataFrame) -> pd.DataFrame:
    made = FuseFilter.build(np.unique(group["key"].to_numpy()))
    return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "seed": [made.seed], "segment": [made.segment],
                         "segments": [made.segments], "prints": [made.prints.tobytes()]})


def _screen(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if incoming.empty or filters.empty:
        return incoming.iloc[:0][["sha"]]
    f = filters.iloc[0]
    made = FuseFilter(int(f["seed"]), int(f["segment"]), int(f["segments"]), np.frombuffer(f["prints"], np.uint8))
    return incoming[made.contains(incoming["key"].to_numpy())][["sha"]]


class Snapshot:
    """The digests that a batch brought, and its filters; neither changes any more."""

    def __init__(self, rows: DataFrame, per_bucket: int):
        self.rows, self.per_bucket = rows, per_bucket
        self.buckets = max(1, -(-rows.count() // per_bucket))
        self.filters = materialize(
            self._bucketed(rows).groupBy("bucket").applyInPandas(
                _build_filter, "bucket long, seed long, segment long, segments long, prints binary"), "fuse-filters")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        key = F.xxhash64("sha")
        return rows.select("sha", key.alias("key"), F.pmod(F.xxhash64(key), F.lit(self.buckets)).alias("bucket"))

    def screened(self, groups: DataFrame) -> DataFrame:
        """The digests that may be in the snapshot: all that are, and about one in 256 others.

        Where more come in than the snapshot has, a bucket's digests are dealt out, each part with the filter.
        """
        parts = max(1, -(-groups.count() // (self.buckets * self.per_bucket)))
        incoming = self._bucketed(groups).withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(parts)))
        filters = self.filters.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return incoming.groupBy("bucket", "part").cogroup(filters.groupBy("bucket", "part")).applyInPandas(_screen, "sha binary")


def _with_equal_bytes(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """Of matches (both sides' kept ids and the digest) those whose texts are equal byte by byte."""
    ids = materialize(matches.select(F.explode(F.array("keep_id", "old_id")).alias("doc_id")).distinct(), "dup-ids")
    shape = "doc_id long, sha binary, check long, n_bytes long, bytes binary"
    texts = only_ids(docs, ids).join(ids, "doc_id", "left_semi").mapInArrow(_digests(True), shape)
    if not ids.filter("doc_id IS NULL").isEmpty():  # missing ids say nothing, the digest tells which texts are meant
        unnamed = docs.filter("doc_id IS NULL").mapInArrow(_digests(True), shape)
        texts = texts.unionByName(unnamed.join(
            matches.filter("keep_id IS NULL OR old_id IS NULL").select("sha").distinct(), "sha", "left_semi"))
    texts = materialize(texts.select("doc_id", "sha", "bytes").dropDuplicates(["doc_id", "sha"]), "dup-texts")
    new = texts.select(F.col("doc_id").alias("new_id"), F.col("sha").alias("new_sha"), F.col("bytes").alias("new_bytes"))
    old = texts.select(F.col("doc_id").alias("earlier_id"), F.col("sha").alias("earlier_sha"), F.col("bytes").alias("old_bytes"))
    both = matches.join(new, (F.col("sha") == F.col("new_sha")) & F.col("keep_id").eqNullSafe(F.col("new_id"))).join(
        old, (F.col("sha") == F.col("earlier_sha")) & F.col("old_id").eqNullSafe(F.col("earlier_id")))
    return both.filter(F.col("new_bytes") == F.col("old_bytes")).select(matches.columns)


def exact_duplicates(df: DataFrame, batch: Column, batches: int, key: str = "doc_id", text: str = "text",
                     per_bucket: int = 100_000) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``batch`` numbers the batch a row arrives with, from 0 to ``batches - 1``. Null and empty texts are equal. Of equal
    texts the largest id stays. Rows repeated with id and text are one document; rows that share an id but not the text
    are documents of their own. The same holds of a missing id: rows without one are a document per text, which stays only if
    no row with an id has the text; ``keep_id`` is then null and ``kept`` true. A row without a batch comes with the first.
    No rows give no rows.
    """
    docs = keyed(df, key, text)
    rows = bounded(df).select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"),
                     F.coalesce(batch.cast("int"), F.lit(0)).alias("batch"))
    rows = rows.mapInArrow(_digests(False), "doc_id long, batch int, sha binary, check long, n_bytes long")
    rows = materialize(rows.groupBy("doc_id", *DIGEST).agg(F.min("batch").alias("batch")), "digests")
    snapshots: list[Snapshot] = []
    news, hits = [], []
    for number in range(batches):
        groups = materialize(rows.filter(F.col("batch") == number).groupBy(*DIGEST).agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size")), "batch-groups")
        found = [_matches(docs, snapshot, groups).withColumn("home", F.lit(home)) for home, snapshot in enumerate(snapshots)]
        new = groups
        if found:
            hit = materialize(reduce(DataFrame.unionByName, found), "batch-hits").withColumn("batch", F.lit(number))
            hits.append(hit)
            new = materialize(groups.join(hit.select("sha"), "sha", "left_anti"), "batch-new")
        news.append(new.withColumn("batch", F.lit(number)).withColumn("home", F.lit(number)))
        if number < batches - 1:
            snapshots.append(Snapshot(new, per_bucket))
    columns = ["sha", "batch", "home", "keep_id", "size"]
    parts = reduce(DataFrame.unionByName, [p.select(*columns) for p in [*news, *hits]])
    classes = parts.groupBy("sha", "home").agg(
        F.max("keep_id").alias("keep_id"), F.sum("size").alias("group_size"), F.collect_list("batch").alias("batches"))
    classes = materialize(classes.select("sha", "keep_id", "group_size", F.explode("batches").alias("batch")), "classes")
    return rows.join(classes, ["sha", "batch"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def _matches(docs: DataFrame, snapshot: Snapshot, groups: DataFrame) -> DataFrame:
    """Groups of a batch whose text is in a snapshot."""
    screened = materialize(snapshot.screened(groups), "screened")
    old = snapshot.rows.select(*DIGEST, F.col("keep_id").alias("old_id"))
    same = materialize(screened.join(groups, "sha").join(old, DIGEST), "digest-matches")
    return _with_equal_bytes(docs, same)


def keep_one(df: DataFrame, batch: Column, batches: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group of equal texts, that of the largest id, or one without an id if none has any."""
    judged = materialize(exact_duplicates(df, batch, batches, key, text), "judged")
    n, ids = judged.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids == df.count():
        gone = materialize(judged.filter("not kept").select(F.col("doc_id").alias(key)), "dropped-ids")
        return without_ids(df, gone, key)
    # ids that repeat or are missing: the digest tells which of their rows stays
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    digest = F.sha2(F.translate(text_or_empty(text), letters, letters.lower()).cast("binary"), 256)
    no_column = "_" * (1 + max(map(len, df.columns)))  # longer than any column's name
    own, of, stays_id, stays_of = [no_column + name for name in ("id", "of", "stays_id", "stays_of")]
    stays = judged.filter("kept").select(F.col("doc_id").alias(stays_id), F.col("text_sha256").alias(stays_of))
    rows = df.withColumn(own, F.col(f"`{key}`").cast("long")).withColumn(of, digest).dropDuplicates([own, of])
    same = F.col(own).eqNullSafe(F.col(stays_id)) & (F.col(of) == F.col(stays_of))
    return rows.join(stays, same, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), crc_of("doc_id") % 2, 2)


OP2_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), g AS (
  SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""
