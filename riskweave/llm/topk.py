"""Exact top-k search by integer inner product, tile by tile.

Shards of the vectors and blocks of the queries travel as whole matrices. Each pair of a block and a shard is a tile: one
matrix product, of which each query keeps its best k. The lists of a query are merged in a tree, several shards at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from riskweave.llm.common import table
from riskweave.session import materialize

#: Sums of products stay exact in doubles while they are below this.
EXACT = float(2**53)
#: The numbers of so many blocks at most are sent to all executors.
BROADCAST_BLOCKS = 1_000_000


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as one row per dimension: ids, and the matrix of floor(1024 x)."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        vectors = batch.column(1)
        sizes = np.asarray(vectors.value_lengths())
        flat = np.floor(np.asarray(vectors.flatten(), dtype=np.float64) * 1024.0)
        ends = np.cumsum(sizes)
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            matrix = flat[(ends[rows] - dim)[:, None] + np.arange(dim)[None, :]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(dim)], pa.int32()), pa.array([len(rows)], pa.int64()),
                 pa.array([ids[rows].astype(np.int64).tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())],
                ["dim", "n", "ids", "matrix"])


def _products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can lose a bit, else in Python's whole numbers."""
    dim = queries.shape[1]
    if dim == 0:
        return np.zeros((len(queries), len(shard)), np.int64)
    if np.abs(queries).max() * np.abs(shard).max() * dim < EXACT:
        return (queries @ shard.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in queries], object) @ np.array(
        [[int(x) for x in row] for row in shard], object).T
    return np.clip(whole, -2**63, 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores without the rows of the query's own id, however many, equal ones by id."""
    others = ids != own
    if not others.all():
        scores, ids = scores[others], ids[others]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)  # all ties of the last stay
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, ~scores))[:k]  # ~ turns the order round without overflow
    return scores[order], ids[order]


def _tiles(k: int, rows_at_once: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, shard_no, ids, matrix, query_ids, query_matrix in zip(*[c.to_pylist() for c in batch.columns]):
                ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                shard = np.frombuffer(matrix).reshape(len(ids), dim)
                queries = np.frombuffer(query_matrix).reshape(len(query_ids), dim)
                found: list[list] = [[], [], [], []]
                for at in range(0, len(queries), rows_at_once):
                    for own, scores in zip(query_ids[at:], _products(queries[at:at + rows_at_once], shard)):
                        best, best_ids = _best(scores, ids, own, k)
                        found[0].append(np.full(len(best), own))
                        found[1].append(best_ids)
                        found[2].append(best)
                        found[3].append(np.full(len(best), shard_no))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(f).astype(np.int64), pa.int64()) for f in found],
                    ["query_id", "vec_id", "score", "shard"])

    return run


def top_k(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
          shard_rows: int = 4096, block_rows: int = 4096, fan_in: int = 32) -> DataFrame:
    """The k best other rows of every query row: query_id, rank, vec_id, score.

    A component x counts as floor(1024 x); the score is the whole-number inner product, within the range of a long. Equal
    scores are ranked by the smaller id. Vectors that are null or hold a null or a component that is not finite take no
    part; vectors of different length aren't compared, and empty ones score 0. Of rows repeated with one id each takes
    part, as in the SQL: none is a neighbour of its own id, all others have places of their own in a list, and a query's list
    is drawn from the pairs of each of its rows with each other row, so a query that stands twice lists a neighbour twice. Shards and blocks hold at most so many rows, the bound on what one task multiplies.
    """
    item = df.schema[vector].dataType
    if not isinstance(item, T.ArrayType):
        raise ValueError("the vector is an array")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = df.filter(F.col(vector).isNotNull() & finite & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query"))
    packed = "dim int, n long, ids binary, matrix binary"
    rows = materialize(rows, "vectors")

    def matrices(part: DataFrame, per: int, name: str) -> DataFrame:
        tasks = max(1, -(-part.count() // per))
        held = part.select("vec_id", "v").repartition(tasks, F.xxhash64("vec_id"))
        return materialize(held.mapInArrow(_packed, packed).withColumn("number", F.monotonically_increasing_id()), name)

    shards = matrices(rows, shard_rows, "shards")
    blocks = matrices(rows.filter("is_query"), block_rows, "query-blocks")
    # which block meets which shard: small tables of numbers; the matrices then follow by their numbers
    listed = blocks.select("dim", F.col("number").alias("block"))
    if blocks.count() <= BROADCAST_BLOCKS:
        listed = F.broadcast(listed)
    pairs = shards.select("dim", F.col("number").alias("shard")).join(listed, "dim").repartition("shard", "block")
    tiles = pairs.join(shards.select(F.col("number").alias("shard"), "ids", "matrix"), "shard").join(
        blocks.select(F.col("number").alias("block"), F.col("ids").alias("query_ids"), F.col("matrix").alias("query_matrix")),
        "block").select("dim", "shard", "ids", "matrix", "query_ids", "query_matrix")
    found = materialize(tiles.mapInArrow(_tiles(k), "query_id long, vec_id long, score long, shard long"), "tile-lists")
    order = [F.col("score").desc(), F.col("vec_id")]
    numbers = shards.count()
    found = found.withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(max(1, -(-numbers // fan_in)))))
    by_part = W.Window.partitionBy("query_id", "part").orderBy(*order)
    found = found.withColumn("place", F.row_number().over(by_part)).filter(F.col("place") <= k)
    ranked = found.withColumn("rank", F.row_number().over(W.Window.partitionBy("query_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
