"""Exact top-k retrieval of many queries in one pass over the corpus.

Joining queries and chunks on tokens or hash buckets would emit nearly every
pair, because common tokens occur everywhere. Instead a block of queries of
bounded size travels to the corpus: each task multiplies its chunks with the
query weights and keeps the best k per query, so only tasks x queries x k rows are
shuffled. More queries than a block holds mean more passes, not a larger block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskweave.functions.text import hash_bucket, tokens
from riskweave.session import bounded, materialize

# Number of hash buckets and of retrieved chunks.
EMBED_DIM = 256
TOP_K = 4

QUERY_BLOCK = 16_384
SCAN_BLOCK = 2048
CELL_LIMIT = 4_000_000
SCORE_DECIMALS = 9  # equal up to summation order counts as a tie


# --------------------------------------------------------------------------- embedding
def _list_rows(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Row number of each list element, and the elements."""
    offsets = column.offsets.to_numpy()
    return np.repeat(np.arange(len(column)), np.diff(offsets)), column.values.slice(offsets[0], offsets[-1] - offsets[0])


def _bucket_counts(column: pa.ListArray) -> np.ndarray:
    """Counts per row and hash bucket."""
    row, bucket = _list_rows(column)
    flat = row * EMBED_DIM + bucket.to_numpy()
    return np.bincount(flat, minlength=len(column) * EMBED_DIM).reshape(-1, EMBED_DIM).astype(float)


def _word_counts(column: pa.ListArray) -> np.ndarray:
    """Counts per row and hash bucket of tokens; each different token of a batch is hashed once. The buckets are those of ``hash_bucket``."""
    row, words = _list_rows(column)
    coded = words.dictionary_encode()
    bucket = np.array([hashlib.md5(w.encode()).digest()[0] for w in coded.dictionary.to_pylist()], np.int64)
    flat = row * EMBED_DIM + (bucket[coded.indices.to_numpy()] if len(row) else row)
    return np.bincount(flat, minlength=len(column) * EMBED_DIM).reshape(-1, EMBED_DIM)


def hash_embed(df: DataFrame, id: str, text: str) -> DataFrame:
    """Sparse hashed bag of words: ``id, bucket, n, weight``; weights have L2 norm 1 per id.

    A text is counted where it is read: grouping its tokens by id would shuffle
    several times the corpus.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CELL_LIMIT // EMBED_DIM):
                part = batch.slice(begin, CELL_LIMIT // EMBED_DIM)
                counts = _bucket_counts(part.column(1))
                row, bucket = counts.nonzero()
                n = counts[row, bucket]
                norms = np.sqrt((counts**2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(bucket, pa.int32()), pa.array(n.astype("int64")),
                     pa.array(n / norms[row])],
                    names=[id, "bucket", "n", "weight"],
                )

    buckets = bounded(df).select(id, F.transform(tokens(text), hash_bucket).alias("_buckets"))
    return buckets.mapInArrow(count, f"{_fields(df, [id])}, bucket int, n long, weight double")


def _fields(df: DataFrame, cols: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


# --------------------------------------------------------------------------- top-k engine
def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores; among equals the earlier ones."""
    if len(scores) <= k:
        return np.arange(len(scores))
    limit = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > limit)
    return np.concatenate([above, np.flatnonzero(scores == limit)[: k - len(above)]])


def _keep_best(
    batches: Iterator[pa.RecordBatch], score: Callable, query_ids: pa.Array, order: list[str], out: list[str], k: int,
) -> Iterator[pa.RecordBatch]:
    """The k best rows per query of one partition; ``score(batch) -> (queries, rows)`` array."""
    best: pd.DataFrame | None = None
    fields: list[pa.Field] = []
    limits = np.full(len(query_ids), -np.inf)  # a row below its query's limit cannot enter any more
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.take(pc.sort_indices(batch.select(order), sort_keys=[(c, "ascending") for c in order]))
        fields = [batch.schema.field(c) for c in out]
        step = max(1, CELL_LIMIT // max(len(query_ids), EMBED_DIM))
        for begin in range(0, batch.num_rows, step):
            part = batch.slice(begin, step)
            scores = np.round(score(part), SCORE_DECIMALS)
            live = np.flatnonzero(scores.max(axis=1) >= limits)
            if not len(live):
                continue
            picks = [_best(scores[q], k) for q in live]
            rows = np.concatenate(picks)
            which = np.repeat(live, [len(p) for p in picks])
            kept = part.select(out).take(pa.array(rows)).to_pandas()
            kept["_query"], kept["score"] = which, scores[which, rows]
            best = kept if best is None else pd.concat([best, kept])
            best = (
                best.sort_values(["_query", "score", *order], ascending=[True, False] + [True] * len(order))
                .groupby("_query", sort=False).head(k)
            )
            held = best.groupby("_query")["score"].agg(["size", "min"])
            full = held[held["size"] == k]
            limits[full.index] = full["min"]
    if best is not None:
        ids = query_ids.take(pa.array(best["_query"].to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(best["score"].to_numpy()), *[pa.array(best[f.name], f.type, from_pandas=True) for f in fields]],
            names=["query_id", "score", *out],
        )


def _rank(found: DataFrame, order: list[str], k: int) -> DataFrame:
    within = Window.partitionBy("query_id").orderBy(F.desc("score"), *order)
    return found.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)


def _search(
    corpus: DataFrame, features: Column, weights: Callable, query_ids: list, id_type: str, order: list[str],
    payload: list[str], k: int,
) -> DataFrame:
    """One pass: ``query_id, rank, score, order..., payload...``."""
    keep = list(dict.fromkeys([*order, *payload]))
    result = f"query_id {id_type}, score double, {_fields(corpus, keep)}"
    if not query_ids:
        return _rank(corpus.sparkSession.createDataFrame([], result), order, k)
    rows = bounded(corpus).select(*keep, features.alias("_features"))
    ids = pa.array(query_ids, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[id_type])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _keep_best(batches, weights, ids, order, keep, k)

    return _rank(rows.mapInArrow(scan, result), order, k)


def _blocks(queries: DataFrame, limit: int) -> list[DataFrame]:
    """Queries in parts of about ``limit`` rows; one part needs no copy."""
    n = queries.count()
    if n <= limit:
        return [queries]
    parts = math.ceil(n / limit * 1.2)
    stored = materialize(queries.withColumn("_part", F.pmod(F.xxhash64("query_id"), F.lit(parts))), "queries")
    return [stored.where(F.col("_part") == p).drop("_part") for p in range(parts)]


def _all_blocks(queries: DataFrame, search: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
    blocks = _blocks(queries, limit)
    if len(blocks) == 1:
        return search(blocks[0])
    return reduce(DataFrame.unionByName, [materialize(search(b), "hits") for b in blocks])


# --------------------------------------------------------------------------- hashed vectors
class BestRows:
    """The k best rows of each query that a task has met, and what a row must score to be one of them."""

    def __init__(self, order: list[str], k: int, limits: np.ndarray | None = None):
        self.order, self.k, self.best, self.new, self.held, self.seen = order, k, None, [], 0, 0
        self.limits = limits

    def add(self, queries: np.ndarray, scores: np.ndarray, rows: pd.DataFrame) -> None:
        self.new.append(rows.assign(_query=queries, score=scores))
        self.held += len(rows)
        if self.held > (200_000 if self.limits is None else max(4096, 0 if self.best is None else len(self.best))):
            self.cut()

    def add_pairs(self, queries: np.ndarray, scores: np.ndarray, rows: np.ndarray, table: pd.DataFrame) -> None:
        """Scores of pairs of a query and a row of ``table``; only the k best per query are kept as rows."""
        place = np.empty(len(table), int)
        place[table.reset_index(drop=True).sort_values(self.order).index] = np.arange(len(table))
        self.add_placed(queries, scores, rows, table, place)

    def add_placed(self, queries: np.ndarray, scores: np.ndarray, rows: np.ndarray, table: pd.DataFrame, place: np.ndarray) -> None:
        sort = np.lexsort((place[rows], -scores, queries))
        first = np.flatnonzero(np.diff(queries[sort], prepend=-1))
        within = np.arange(len(sort)) - np.repeat(first, np.diff(np.append(first, len(sort))))
        kept = sort[within < self.k]
        self.add(queries[kept], scores[kept], table.iloc[rows[kept]])

    def cut(self) -> pd.DataFrame | None:
        if self.new:
            found = pd.concat([self.best, *self.new] if self.best is not None else self.new)
            found = found.sort_values(["_query", "score", *self.order], ascending=[True, False] + [True] * len(self.order))
            self.best, self.new, self.held = found.groupby("_query", sort=False).head(self.k), [], 0
            if self.limits is not None:
                query, score = self.best["_query"].to_numpy(), self.best["score"].to_numpy()
                full = np.flatnonzero(query[self.k - 1:] == query[: len(query) - self.k + 1]) + self.k - 1
                self.limits[query[full]] = np.maximum(self.limits[query[full]], score[full])
        return self.best

    def batch(self, query_ids: pa.Array, fields: list[pa.Field]) -> Iterator[pa.RecordBatch]:
        best = self.cut()
        if best is not None:
            yield pa.RecordBatch.from_arrays(
                [query_ids.take(pa.array(best["_query"].to_numpy())), pa.array(best["score"].to_numpy()),
                 *[pa.array(best[f.name], f.type, from_pandas=True) for f in fields]], names=["query_id", "score", *[f.name for f in fields]])


#: Rows and queries whose products are made at once; the first rows of a task come in smaller lots, as they set the limits.
TILE_ROWS, TILE_QUERIES, FIRST_ROWS = 2048, 512, 256
#: Products of unit vectors in single precision are off by far less.
SINGLE = 1e-5
#: Pairs whose exact scores are made at once.
PAIRS = 8192
#: Rows on which each query's limit is set before all rows are read, about; corpora of fewer than eight times as many take an eighth.
LIMIT_ROWS = 32_768


class Directions:
    """Vectors of queries: as given, their squared lengths, and as unit vectors in single precision."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.squares = (weights.astype(float) ** 2).sum(axis=1)
        self.squares[self.squares == 0] = 1
        self.units = (weights / np.sqrt(self.squares)[:, None]).astype(np.float32)


def _set_places(reach: np.ndarray) -> np.ndarray:
    """Flat places of the true cells; eight are looked at together, as few are set."""
    flat = reach.reshape(-1)
    whole = len(flat) // 8 * 8
    near = np.flatnonzero(flat[:whole].view(np.uint64))
    places = (near[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([places[flat[places]], np.flatnonzero(flat[whole:]) + whole])


def offer(best: BestRows, asking: Directions, queries: np.ndarray, vectors: np.ndarray, table: pd.DataFrame) -> None:
    """Offer rows, in the order that settles ties, to these queries, given in rising order.

    Products in single precision tell which pairs could enter; only those get their score in double precision.
    """
    norms = (vectors**2).sum(axis=1)
    norms[norms == 0] = 1
    single = (vectors / np.sqrt(norms)[:, None]).astype(np.float32)
    every = len(queries) and queries[-1] - queries[0] == len(queries) - 1  # then no copy of the vectors is needed
    made = np.empty(TILE_QUERIES * min(TILE_ROWS, len(vectors)), np.float32)
    over = np.empty(len(made), bool)
    at = 0
    while at < len(vectors):
        rows = slice(at, min(len(vectors), at + min(TILE_ROWS, max(FIRST_ROWS, best.seen))))
        width = rows.stop - rows.start
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for begin in range(0, len(queries), TILE_QUERIES):
            own = queries[begin:begin + TILE_QUERIES]
            limits = best.limits[own] - SINGLE
            products = made[:len(own) * width].reshape(len(own), width)
            np.matmul(asking.units[own[0]:own[-1] + 1] if every else asking.units[own], single[rows].T, out=products)
            reach = np.greater_equal(products, limits.astype(np.float32)[:, None], out=over[:products.size].reshape(products.shape))
            met = np.count_nonzero(reach)
            if not met:
                continue
            many = np.flatnonzero(np.count_nonzero(reach, axis=1) > width // 4) if met > width // 4 else []
            if len(many):
                scores = asking.weights[own[many]].astype(float) @ vectors[rows].T
                scores = np.round(scores / np.sqrt(asking.squares[own[many], None] * norms[None, rows]), SCORE_DECIMALS)
                picks = [_best(s, best.k) for s in scores]
                flat, which = np.concatenate(picks), np.repeat(np.arange(len(many)), [len(x) for x in picks])
                best.add(own[many[which]], scores[which, flat], table.iloc[flat + at])
                reach[many] = False
            which, flat = np.divmod(_set_places(reach), width)
            if len(which):
                pairs.append((own[which], flat + at))
        if pairs:
            which, flat = (np.concatenate(x) for x in zip(*pairs))
            scores = np.concatenate([
                np.einsum("ij,ij->i", asking.weights[which[i:i + PAIRS]].astype(float), vectors[flat[i:i + PAIRS]])
                for i in range(0, len(which), PAIRS)])
            scores = np.round(scores / np.sqrt(asking.squares[which] * norms[flat]), SCORE_DECIMALS)
            enter = scores >= best.limits[which]
            if enter.any():
                best.add_placed(which[enter], scores[enter], flat[enter], table, np.arange(len(table)))
        at = rows.stop
        best.seen += width


@dataclass(frozen=True)
class Counted:
    """A corpus with the counts of its hashed tokens, stored with a number for each row."""

    rows: DataFrame
    order: list[str]
    payload: list[str]


def store_counts(
    corpus: DataFrame, text: str = "text", order: list[str] = ("corpus_order", "ordinal"),
    payload: list[str] = ("id", "source", "text"),
) -> Counted:
    """Tokenize a corpus once, for any number of searches."""
    keep = list(dict.fromkeys([*order, *payload]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CELL_LIMIT // EMBED_DIM):
                part = batch.slice(begin, CELL_LIMIT // EMBED_DIM)
                counts = _packed_counts(_word_counts(part.column(len(keep))).astype("<i4"))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], counts], names=[*keep, "_counts"])

    words = bounded(corpus).select(*keep, tokens(text).alias("_words"))
    counted = words.mapInArrow(count, f"{_fields(corpus, keep)}, _counts binary")
    return Counted(materialize(counted.withColumn("_row", F.monotonically_increasing_id()), "counts"), list(order), list(payload))


def _packed_counts(counts: np.ndarray) -> pa.Array:
    """A matrix of counts as one value a row."""
    ends = pa.array(np.arange(len(counts) + 1, dtype="int32") * 4 * EMBED_DIM).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, ends, pa.py_buffer(counts.tobytes())])


def _unpacked(column: pa.Array) -> np.ndarray:
    """Stored counts as a matrix."""
    start = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, column.offset * 4)
    flat = np.frombuffer(column.buffers()[2], np.uint8)[start[0]:start[-1]] if len(column) else np.zeros(0, np.uint8)
    return flat.view("<i4").reshape(-1, EMBED_DIM).astype(float)


def _with_limits(queries: DataFrame, stored: Counted, k: int, n_queries: int) -> DataFrame:
    """``query_id, _counts, _limit`` of the queries; a limit is the k-th best score among some of the stored rows, so every row that is
    one of the k best of all has at least that score. Without it each task would have to find its own.

    Few queries and few rows need none (null).
    """
    spark = queries.sparkSession
    id_type = queries.schema["query_id"].dataType.simpleString()
    n = stored.rows.count()
    share = min(LIMIT_ROWS / n, 1 / 8) if n_queries > TILE_QUERIES and n > LIMIT_ROWS else 0.0
    draw = F.xxhash64(F.lit(42), F.col("_row"))
    drawn = stored.rows.where(draw < F.lit(int(-(2**63) + share * 2**64))).select("_counts").toArrow() if share else None
    sample = np.concatenate([np.zeros((0, EMBED_DIM)), *[_unpacked(c) for c in drawn.column(0).chunks]]) if share else np.zeros((0, EMBED_DIM))
    sent = spark.sparkContext.broadcast(sample.astype(np.int32)) if len(sample) >= k else None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4 * TILE_QUERIES):
                part = batch.slice(begin, 4 * TILE_QUERIES)
                counts = _word_counts(part.column(1)).astype("<i4")
                limits = None
                if sent is not None:
                    asking, best = Directions(counts), BestRows(["at"], k, np.full(len(counts), -np.inf))
                    for at in range(0, len(sent.value), TILE_ROWS):
                        rows = sent.value[at:at + TILE_ROWS].astype(float)
                        offer(best, asking, np.arange(len(counts)), rows, pd.DataFrame({"at": np.arange(at, at + len(rows))}))
                    best.cut()
                    limits = best.limits
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _packed_counts(counts), pa.nulls(len(counts), pa.float64()) if limits is None else pa.array(limits)],
                    names=["query_id", "_counts", "_limit"])

    asked = queries.select("query_id", tokens("query").alias("words"))
    if sent is not None:
        asked = asked.repartition(max(spark.sparkContext.defaultParallelism, -(-n_queries // QUERY_BLOCK)))
    return asked.mapInArrow(add, f"query_id {id_type}, _counts binary, _limit double")


def search_counts(queries: DataFrame, stored: Counted, k: int = TOP_K, block: int = QUERY_BLOCK) -> DataFrame:
    """Cosine of hashed bags of words over a stored corpus; see ``top_k_sparse``.

    The rows of all blocks are ranked by their numbers; what goes with a row joins the ranked ones, or for few queries comes along.
    """
    spark, sort = queries.sparkSession, [*stored.order, "_row"]
    id_type = queries.schema["query_id"].dataType.simpleString()
    n_queries = queries.count()
    more = [c for c in stored.payload if c not in stored.order]
    kept = [*sort, *(more if n_queries <= TILE_QUERIES else [])]
    scanned = stored.rows.select(*kept, "_counts")
    result = f"query_id {id_type}, score double, {_fields(stored.rows, kept)}"
    fields = pa.schema([pa.field(c, to_arrow_type(stored.rows.schema[c].dataType)) for c in kept])

    def search(part: DataFrame) -> DataFrame:
        rows = part.toArrow()
        if not rows.num_rows:
            return spark.createDataFrame([], result)
        ids = rows.column(0).combine_chunks()
        counts = np.concatenate([_unpacked(c) for c in rows.column(1).chunks])
        limits = rows.column(2).to_numpy()
        sent = spark.sparkContext.broadcast((counts.astype(np.int32), ids, np.where(np.isnan(limits), -np.inf, limits)))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, ids, limits = sent.value
            asking, queries = Directions(counts), np.arange(len(counts))
            best = BestRows(sort, k, limits.copy())
            best.seen = TILE_ROWS if np.isfinite(limits).all() else 0
            for batch in batches:
                batch = batch.take(pc.sort_indices(batch.select(sort), sort_keys=[(c, "ascending") for c in sort]))
                for begin in range(0, batch.num_rows, TILE_ROWS):
                    some = batch.slice(begin, TILE_ROWS)
                    offer(best, asking, queries, _unpacked(some.column(len(kept))), some.select(kept).to_pandas())
            yield from best.batch(ids, list(fields))

        return scanned.mapInArrow(scan, result)

    asked = _with_limits(queries, stored, k, n_queries)
    blocks = [asked] if n_queries <= block else _blocks(materialize(asked, "asked"), block)
    found = [search(b) if len(blocks) == 1 else materialize(_rank(search(b), sort, k), "hits") for b in blocks]
    hits = reduce(DataFrame.unionByName, found)
    ranked = _rank(hits, sort, k) if len(blocks) == 1 else hits
    if more and n_queries > TILE_QUERIES:
        ranked = ranked.join(stored.rows.select("_row", *more), "_row")
    return ranked.select("query_id", "score", *dict.fromkeys([*stored.order, *stored.payload]), "rank")


def top_k_sparse(
    queries: DataFrame, corpus: DataFrame, text: str = "text", order: list[str] = ("corpus_order", "ordinal"),
    payload: list[str] = ("id", "source", "text"), k: int = TOP_K, block: int = QUERY_BLOCK,
) -> DataFrame:
    """Cosine of hashed bags of words. ``queries``: ``query_id, query``; always k rows, zero scores included.

    Counts and squared norms are whole numbers, so the score of a pair is the same
    whatever the order of summation.
    """
    return search_counts(queries, store_counts(corpus, text, order, payload), k, block)


# --------------------------------------------------------------------------- dense vectors
def top_k_dense(
    queries: DataFrame, corpus: DataFrame, vector: str = "embedding", order: list[str] = ("id",),
    payload: list[str] = ("id",), k: int = TOP_K, block: int = SCAN_BLOCK,
) -> DataFrame:
    """1 - cosine distance to stored vectors. ``queries``: ``query_id, vector`` of the same length.

    Rows without a vector are not found.
    """
    id_type = queries.schema["query_id"].dataType.simpleString()
    corpus = corpus.where(F.col(vector).isNotNull())

    def search(part: DataFrame) -> DataFrame:
        rows = part.select("query_id", F.col("vector").cast("array<double>").alias("v")).collect()
        weights = np.array([r["v"] for r in rows])
        norms = np.sqrt((weights**2).sum(axis=1)) if rows else np.zeros(0)
        norms[norms == 0] = 1

        def score(batch: pa.RecordBatch) -> np.ndarray:
            _, flat = _list_rows(batch.column("_features"))
            vectors = flat.to_numpy().reshape(batch.num_rows, -1)
            lengths = np.sqrt((vectors**2).sum(axis=1))
            lengths[lengths == 0] = 1
            return (weights @ vectors.T) / (norms[:, None] * lengths[None, :])

        return _search(corpus, F.col(vector).cast("array<double>"), score, [r["query_id"] for r in rows], id_type,
                       list(order), list(payload), k)

    return _all_blocks(queries, search, block)


# --------------------------------------------------------------------------- lexical
def inverse_frequency(n: int, df: int) -> float:
    return math.log((n + 1) / (df + 1)) + 1.0


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` without the text, with the different tokens of each row, their counts and the length of these as a vector; counted where the row is read."""
    keep = [c for c in df.columns if c != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, words = _list_rows(batch.column(len(keep)))
            coded = words.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            pairs, times = np.unique(row * max(len(coded.dictionary), 1) + code, return_counts=True)
            sizes = np.bincount(pairs // max(len(coded.dictionary), 1), minlength=batch.num_rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            names = coded.dictionary.take(pa.array(pairs % max(len(coded.dictionary), 1)))
            lengths = np.sqrt(np.bincount(pairs // max(len(coded.dictionary), 1), times.astype(float)**2, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(offsets, names.cast(pa.string())),
                 pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))), pa.array(lengths)], names=[*keep, "_tokens", "_times", "_length"])

    words = F.coalesce(tokens(text), F.array().cast("array<string>"))
    return bounded(df).select(*keep, words.alias("_words")).mapInArrow(count, f"{_fields(df, keep)}, _tokens array<string>, _times array<int>, _length double")


#: Scores of a query and a row that are made at once; terms that stand in most pairs, which are multiplied as a matrix.
TERM_CELLS, DENSE_TERMS = 1_000_000, 512
#: Sums of what can't be negative, in single precision, are off by less than this part of them.
SINGLE_PART = 1e-4
#: Steps of adding terms where they occur that take as long as looking one term of one pair up.
LOOK_UP_STEPS = 8
#: Rows at most that set each query's limit before all rows are read, and the different tokens that they hold together at most.
LONG_ROWS, LONG_TOKENS = 512, 1_000_000


@dataclass(frozen=True)
class Terms:
    """The terms of a block of queries: ``term`` and ``weight`` of query q lie from ``starts[q]`` on."""

    ids: pa.Array
    vocabulary: pa.Array
    starts: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    dense: np.ndarray

    def part(self, queries: np.ndarray) -> Terms:
        """The terms of some of the queries."""
        many = np.diff(self.starts)[queries]
        starts = np.concatenate([[0], np.cumsum(many)]).astype(int)
        own = np.arange(starts[-1]) + np.repeat(self.starts[queries] - starts[:-1], many)
        return Terms(self.ids.take(pa.array(queries)), self.vocabulary, starts, self.term[own], self.weight[own], self.dense)

    @staticmethod
    def of(ids: list, id_type: str, words: list[list[str] | None], frequency: dict[str, int], n: int) -> Terms:
        """Tokens without a document add nothing to any score."""
        vocabulary = sorted({t for own in words for t in own or [] if t in frequency})
        place = {t: i for i, t in enumerate(vocabulary)}
        idf = np.array([inverse_frequency(n, frequency[t]) for t in vocabulary])
        found = [np.unique(np.array([place[t] for t in own or [] if t in place], int), return_counts=True) for own in words]
        none = np.zeros(0, int)
        term = np.concatenate([none, *[f for f, _ in found]])
        weight = idf[term] * np.concatenate([none, *[c for _, c in found]])
        asked = np.bincount(term, minlength=len(vocabulary)) * np.array([frequency[t] for t in vocabulary], float)
        dense = np.sort(np.argsort(-asked, kind="stable")[:DENSE_TERMS])
        return Terms(pa.array(ids, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[id_type]), pa.array(vocabulary, pa.string()),
                     np.concatenate([[0], np.cumsum([len(f) for f, _ in found])]).astype(int), term, weight, dense)


class TermScores:
    """Scores of the queries of a block for tiles of rows, from the different tokens of each row and their counts.

    A score is at most the product over the terms that stand in most pairs, as a matrix, plus what the other terms can add: the highest count that a row
    of the tile has of each, or the lengths of both sides multiplied. Only pairs that this could let enter are scored; of many such pairs the
    other terms are added where they occur. That is in single precision and tells which pairs could enter; only those get their score in
    double precision, added up in the order of the vocabulary.
    """

    def __init__(self, asking: Terms):
        self.asking, size = asking, len(asking.vocabulary)
        query = np.repeat(np.arange(len(asking.ids)), np.diff(asking.starts))
        self.column = np.full(size, -1)
        self.column[asking.dense] = np.arange(len(asking.dense))
        column = self.column[asking.term]
        self.matrix = np.zeros((len(asking.ids), len(asking.dense)), np.float32)
        self.matrix[query[column >= 0], column[column >= 0]] = asking.weight[column >= 0]
        # lengths of the queries, of what the matrix has of them and of the rest
        self.whole, self.lengths, self.rest = (
            np.sqrt(np.bincount(query[x], asking.weight[x]**2, len(asking.ids))) for x in (column >= -1, column >= 0, column < 0))
        # the queries of each other term
        other = np.flatnonzero(column < 0)
        other = other[np.argsort(asking.term[other], kind="stable")]
        self.who, self.what, self.rare = query[other], asking.weight[other], asking.term[other]
        self.first = np.searchsorted(self.rare, np.arange(size + 1))

    def least_length(self, limits: np.ndarray) -> float:
        """How long a row must be to be one of the best of any query."""
        if (limits <= 0).any():
            return 0.0
        return float((limits / self.whole).min(initial=np.inf)) * (1 - SINGLE_PART)

    def offer_batch(self, best: BestRows, words: pa.ListArray, times: pa.ListArray, table: pd.DataFrame) -> None:
        """Offer rows with their tokens and counts, in the order that settles ties; the longest are scored first, as they raise the limits."""
        row, names = _list_rows(words)
        at = pc.index_in(names, value_set=self.asking.vocabulary)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        row, term = row[known], at.drop_null().to_numpy().astype(np.int64)
        counts = _list_rows(times)[1].to_numpy()[known].astype(float)
        step = max(1, TERM_CELLS // max(1, len(self.asking.ids)))
        longest = np.argsort(-np.bincount(row, counts**2, len(table)), kind="stable")
        place = np.concatenate([np.sort(longest[i:i + step]) for i in range(0, len(table), step)])
        new = np.empty(len(table), int)
        new[place] = np.arange(len(table))
        row = new[row]
        sort = np.lexsort((term, row))
        row, term, counts = row[sort], term[sort], counts[sort]
        table = table.iloc[place]
        for begin in range(0, len(table), step):
            part = slice(*np.searchsorted(row, [begin, begin + step]))
            self.offer(best, row[part] - begin, term[part], counts[part], table.iloc[begin:begin + step])

    def offer(self, best: BestRows, row: np.ndarray, term: np.ndarray, times: np.ndarray, table: pd.DataFrame) -> None:
        """Offer rows, in the order that settles ties; ``row``, ``term`` and ``times`` of their tokens that some query has, by row."""
        n_rows, k = len(table), best.k
        column = self.column[term]
        dense = column >= 0
        counts = np.zeros((n_rows, self.matrix.shape[1]), np.float32)
        counts[row[dense], column[dense]] = times[dense]
        length, others = (np.sqrt(np.bincount(row[x], times[x]**2, n_rows).max()) for x in (dense, ~dense))
        highest = np.zeros(len(self.asking.vocabulary))
        np.maximum.at(highest, term[~dense], times[~dense])
        least = best.limits * (1 - SINGLE_PART)
        least -= np.minimum(self.rest * others, np.bincount(self.who, self.what * highest[self.rare], len(least))) * (1 + SINGLE_PART)
        live = np.flatnonzero((self.lengths * length * (1 + SINGLE_PART) >= least) | (best.limits <= 0))
        if not len(live):
            return
        reach = (self.matrix if len(live) == len(self.matrix) else self.matrix[live]) @ counts.T >= (least[live] - SINGLE_PART * abs(least[live])).astype(np.float32)[:, None]
        reach[best.limits[live] <= 0] = True
        asked, met = np.flatnonzero(reach.any(axis=1)), np.flatnonzero(reach.any(axis=0))
        if not len(asked):
            return
        steps = np.bincount(row[~dense], (self.first[term + 1] - self.first[term])[~dense], n_rows)[met].sum() + len(asked) * len(met)
        each = LOOK_UP_STEPS * max(1, len(self.asking.term) // len(self.matrix))
        if np.count_nonzero(reach) * each < steps and (best.limits[live[asked]] > 0).all():
            which, flat = np.divmod(np.flatnonzero(reach), n_rows)
            which = live[which]
        else:
            own, limits = live[asked], best.limits[live[asked]]
            scores = self._sums(own, met, counts, row[~dense], term[~dense], times[~dense])
            reach = scores >= (limits * (1 - SINGLE_PART)).astype(np.float32)[:, None]
            wide = np.flatnonzero(np.count_nonzero(reach, axis=1) > max(k, len(met) // 4))
            if len(wide):  # of these rows only those that could be among the best k of the tile
                some = scores[wide]
                kth = np.partition(some, len(met) - k, axis=1)[:, len(met) - k] * (1 - 2 * SINGLE_PART)
                none = some == 0  # of rows without a term of the query the first k are enough
                reach[wide] &= (some >= kth[:, None]) & (~none | (np.cumsum(none, axis=1) <= k))
            which, flat = np.divmod(np.flatnonzero(reach), len(met))
            which, flat = own[which], met[flat]
        if not len(which):
            return
        key = row * len(self.asking.vocabulary) + term  # rises, as tokens come by row and are sorted within
        for begin in range(0, len(which), PAIRS):
            queries, rows = which[begin:begin + PAIRS], flat[begin:begin + PAIRS]
            found = np.round(self.exact(queries, rows, key, times), SCORE_DECIMALS)
            enter = found >= best.limits[queries]
            if enter.any():
                best.add_placed(queries[enter], found[enter], rows[enter], table, np.arange(n_rows))

    def _sums(self, own: np.ndarray, met: np.ndarray, counts: np.ndarray, row: np.ndarray, rare: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Scores of some queries and rows; ``row``, ``rare`` and ``times`` of the tokens that are no column of the matrix."""
        n_rows, n_queries = len(met), len(own)
        scores = self.matrix[own] @ counts[met].T
        if n_rows < len(counts):
            place = np.full(len(counts), -1)
            place[met] = np.arange(n_rows)
            row = place[row]
            rare, times, row = rare[row >= 0], times[row >= 0], row[row >= 0]
        query = None
        if n_queries < len(self.matrix):
            query = np.full(len(self.matrix), -1)
            query[own] = np.arange(n_queries)
        many = self.first[rare + 1] - self.first[rare]
        ends = np.cumsum(many)
        begin = 0
        while begin < len(rare):  # long texts in both tables have many terms in common: so many at once
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + TERM_CELLS, "right")))
            part = slice(begin, end)
            size = many[part].sum()
            if size:
                at = np.arange(size) + np.repeat(self.first[rare[part]] - np.cumsum(many[part]) + many[part], many[part])
                who, rows = self.who[at], np.repeat(row[part], many[part])
                what = self.what[at] * np.repeat(times[part], many[part])
                if query is not None:
                    who = query[who]
                    who, rows, what = who[who >= 0], rows[who >= 0], what[who >= 0]
                scores += np.bincount(who * n_rows + rows, what, n_queries * n_rows).reshape(n_queries, n_rows)
            begin = end
        return scores

    def exact(self, queries: np.ndarray, rows: np.ndarray, key: np.ndarray, times: np.ndarray) -> np.ndarray:
        starts, size = self.asking.starts, len(self.asking.vocabulary)
        many = starts[queries + 1] - starts[queries]
        ends = np.cumsum(many)
        out = np.zeros(len(queries))
        if not len(key) or not ends[-1]:
            return out
        at = np.arange(ends[-1]) + np.repeat(starts[queries] - ends + many, many)
        wanted = np.repeat(rows, many) * size + self.asking.term[at]
        place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        parts = np.where(key[place] == wanted, self.asking.weight[at] * times[place], 0.0)
        some = many > 0
        out[some] = np.add.reduceat(parts, (ends - many)[some])
        return out


def longest_rows(documents: DataFrame) -> pa.Table | None:
    """``_tokens, _times`` of some of the longest rows of a large table, or none of a small one. They are likely to score highest, as scores are sums."""
    if documents.count() <= 8 * LONG_ROWS:
        return None
    found = documents.select("_length", F.size("_tokens").alias("n")).orderBy(F.desc("_length")).limit(LONG_ROWS).collect()
    total = np.cumsum([r["n"] for r in found])
    some = min(len(found), max(1, int(np.searchsorted(total, LONG_TOKENS, "right"))))
    return documents.where(F.col("_length") >= found[some - 1]["_length"]).limit(some).select("_tokens", "_times").toArrow()


def _long_limits(asking: Terms, longest: pa.Table, spark: SparkSession, k: int) -> np.ndarray:
    """The k-th best score of each query among these rows: what a row must score to be one of the k best of all."""
    sent = spark.sparkContext.broadcast((asking, longest.combine_chunks()))
    lots = spark.sparkContext.defaultParallelism

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking, rows = sent.value
        for batch in batches:
            for lot in batch.column(0).to_pylist():
                own = asking.part(np.arange(lot * len(asking.ids) // lots, (lot + 1) * len(asking.ids) // lots))
                made, best = TermScores(own), BestRows(["at"], k, np.full(len(own.ids), -np.inf))
                for part in rows.to_batches(64):
                    made.offer_batch(best, part.column(0), part.column(1), pd.DataFrame({"at": np.arange(part.num_rows)}))
                    best.cut()
                yield pa.RecordBatch.from_arrays([pa.array([lot], pa.int32()), pa.array([best.limits])], names=["lot", "limits"])

    found = spark.range(0, lots, 1, lots).select(F.col("id").cast("int")).mapInArrow(limits, "lot int, limits array<double>").collect()
    return np.concatenate([r["limits"] for r in sorted(found)])


def scan_terms(asking: Terms, documents: DataFrame, order: list[str], k: int, longest: pa.Table | None = None) -> DataFrame:
    """``query_id, score, order...``: the k best rows that each task finds. ``documents``: ``order..., _tokens, _times, _length``; ``longest``: some of them."""
    spark = documents.sparkSession
    fields = pa.schema([pa.field(c, to_arrow_type(documents.schema[c].dataType)) for c in order])
    kind = {pa.int32(): "int", pa.int64(): "bigint", pa.string(): "string"}[asking.ids.type]
    many = longest is not None and len(asking.ids) > TILE_QUERIES
    limits = _long_limits(asking, longest, spark, k) if many else np.full(len(asking.ids), -np.inf)
    bound = limits > 0
    if bound.any() and not bound.all():  # the others need all rows
        parts = [(asking.part(np.flatnonzero(x)), limits[x]) for x in (bound, ~bound)]
        return reduce(DataFrame.unionByName, [_scan_terms(p, own, documents, order, k, fields, kind) for p, own in parts])
    return _scan_terms(asking, limits, documents, order, k, fields, kind)


def _scan_terms(asking: Terms, limits: np.ndarray, documents: DataFrame, order: list[str], k: int, fields: pa.Schema, kind: str) -> DataFrame:
    least = TermScores(asking).least_length(limits)
    sent = documents.sparkSession.sparkContext.broadcast((asking, limits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking, limits = sent.value
        made, best = TermScores(asking), BestRows(order, k, limits.copy())
        for batch in batches:
            batch = batch.filter(pa.array(batch.column(len(order) + 2).to_numpy() >= made.least_length(best.limits)))
            if batch.num_rows:
                batch = batch.take(pc.sort_indices(batch.select(order), sort_keys=[(c, "ascending") for c in order]))
                made.offer_batch(best, batch.column(len(order)), batch.column(len(order) + 1), batch.select(order).to_pandas())
        yield from best.batch(asking.ids, list(fields))

    rows = documents.where(F.col("_length") >= least) if least > 0 else documents
    return rows.select(*order, "_tokens", "_times", "_length").mapInArrow(scan, f"query_id {kind}, score double, {_fields(documents, order)}")


def top_k_lexical(
    queries: DataFrame, corpus: DataFrame, text: str = "text", order: list[str] = ("corpus_order", "ordinal"),
    payload: list[str] = ("id", "source", "text"), k: int = TOP_K, block: int = QUERY_BLOCK,
) -> DataFrame:
    """Sum over query tokens of count times smoothed idf; a token repeated in the query counts again.

    The corpus is tokenized once, for all blocks of queries; what goes with a row joins the ranked ones.
    """
    keep = list(dict.fromkeys([*order, *payload]))
    inner = corpus.select(*keep, F.col(text).alias("_text"))
    documents = materialize(token_counts(inner, "_text").withColumn("_row", F.monotonically_increasing_id()), "tokens")
    n = documents.count()
    frequencies = materialize(documents.select(F.explode("_tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    sort = [*order, "_row"]
    id_type = queries.schema["query_id"].dataType.simpleString()
    longest = longest_rows(documents)

    def search(part: DataFrame) -> DataFrame:
        rows = part.select("query_id", tokens("query").alias("t")).collect()  # bounded by the block
        wanted = sorted({t for r in rows for t in r["t"] or []})
        asked = corpus.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
        found = {r["token"]: r["df"] for r in frequencies.join(F.broadcast(asked), "token").collect()}
        return _rank(scan_terms(Terms.of([r["query_id"] for r in rows], id_type, [r["t"] for r in rows], found, n), documents, sort, k, longest), sort, k)

    ranked = _all_blocks(queries, search, block)
    more = [c for c in keep if c not in order]
    if more:
        ranked = ranked.join(documents.select("_row", *more), "_row")
    return ranked.select("query_id", "score", *keep, "rank")
