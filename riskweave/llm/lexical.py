"""Ranked lexical search by the Best Position Algorithm.

Documents are counted once into lists of the terms that the items ask for. Each task turns the documents it holds into
shards: per term an impact list, highest impact first. An item walks its lists side by side; a document met in one list is
looked up in the others, which marks its places there as seen too. The best position of a list is the last one before
its first unseen place: no unseen document can have more than the impacts at the best positions add up to, so the walk ends
when that sum is strictly below the k-th score. Every document lies in one shard, so a frequent term has no task of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from riskweave.llm.common import bounded, table
from riskweave.session import materialize

#: Terms that are looked up at once, and items that are walked at once: what a task holds. More take further passes.
TERMS_AT_ONCE, ITEMS_AT_ONCE = 2_000_000, 20_000
#: Postings of a shard, and bytes of a text that are split at once.
SHARD_POSTINGS, SLICE = 2_000_000, 1 << 20
#: Places of every list that the first round of a walk reads; later rounds double.
FIRST_ROUND = 16
#: Parts in which lists of the best are merged before the last merge.
PARTS = 64

_LETTERS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: A-Z as a-z; all other ASCII that is no letter or digit as a space; bytes of other characters stay.
_FOLD = bytes((c | 32 if 65 <= c <= 90 else c) if c in _LETTERS or c > 127 else 32 for c in range(256))
_NONE = np.iinfo(np.int64).max


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, slice by slice."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _lists(number_of: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in batch.column(1):
                count: Counter = Counter()
                for part in terms_of(text.as_py()):
                    count.update(part)
                wanted = [(number_of[t], c) for t, c in count.items() if t in number_of]
                sizes.append(count.total())
                terms.append([t for t, _ in wanted])
                times.append([c for _, c in wanted])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "times"])

    return run


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Shard:
    """Impact lists of some documents. Documents are numbered by rising id, missing ids last."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, terms: np.ndarray, times: np.ndarray,
                 weights: np.ndarray, documents: int, tokens: int):
        by_id = np.argsort(ids, kind="stable")
        self.ids = ids[by_id]
        starts = np.cumsum(counts) - counts
        rows = _ranges(starts[by_id], counts[by_id])
        self.terms, times = terms[rows], times[rows]
        self.row_length = counts[by_id]
        self.row_start = np.cumsum(self.row_length) - self.row_length
        stretch = 50 + (50 * sizes[by_id] * documents) // tokens
        docs = np.repeat(np.arange(len(ids)), self.row_length)
        self.impacts = weights[self.terms] * ((1_000_000_000 * times) // (1000 * times + 20 * stretch[docs]))
        order = np.lexsort((docs, -self.impacts, self.terms))
        self.place = np.empty(len(order), np.int64)  # of a document's term in the lists
        self.place[order] = np.arange(len(order))
        self.listed, self.listed_impacts = docs[order], self.impacts[order]
        self.length = np.bincount(self.terms, minlength=len(weights))
        self.start = np.cumsum(self.length) - self.length
        self.asked = np.zeros(len(weights), bool)
        self.seen = np.zeros(len(order), bool)
        self.scored = np.zeros(len(ids), bool)

    def search(self, terms: np.ndarray, k: int, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The best k of this shard and of (``scores``, ``ids``), found before; and how many documents were scored."""
        terms = terms[self.length[terms] > 0]
        start, length = self.start[terms], self.length[terms]
        best = np.zeros(len(terms), np.int64)  # places of a list that are seen without a gap
        self.asked[terms] = True
        marked, met = [], []
        depth, step = 0, FIRST_ROUND
        while len(terms) and depth < length.max():
            reach = np.clip(length - depth, 0, step)
            places = _ranges(start + depth, reach)
            self.seen[places] = True
            marked.append(places)
            docs = np.unique(self.listed[places])
            docs = docs[~self.scored[docs]]
            if len(docs):
                self.scored[docs] = True
                met.append(docs)
                rows = _ranges(self.row_start[docs], self.row_length[docs])
                owner = np.repeat(np.arange(len(docs)), self.row_length[docs])
                held = self.asked[self.terms[rows]]
                rows, owner = rows[held], owner[held]
                places = self.place[rows]
                self.seen[places] = True
                marked.append(places)
                total = np.add.reduceat(self.impacts[rows], np.searchsorted(owner, np.arange(len(docs))))
                scores, ids = self._kept(np.concatenate([scores, total]), np.concatenate([ids, self.ids[docs]]), k)
            depth += step
            step *= 2
            limit = 0
            for i in range(len(terms)):
                best[i] = max(best[i], min(depth, length[i]))
                while best[i] < length[i]:
                    ahead = self.seen[start[i] + best[i]:start[i] + min(length[i], best[i] + 256)]
                    gap = int(ahead.argmin())
                    if not ahead[gap]:
                        best[i] += gap
                        break
                    best[i] += len(ahead)
                if best[i] < length[i]:  # a list that is seen whole has nothing for an unseen document
                    limit += self.listed_impacts[start[i] + best[i] - 1]
            if len(scores) == k and limit < scores[-1]:
                break
        self.asked[terms] = False
        for places in marked:
            self.seen[places] = False
        for docs in met:
            self.scored[docs] = False
        return scores, ids, sum(map(len, met))

    @staticmethod
    def _kept(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        some = scores > 0
        if len(scores) > k:
            some &= scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[some], ids[some]
        order = np.lexsort((ids, -scores))[:k]
        return scores[order], ids[order]


def _walk(items: list[tuple[int | None, np.ndarray]], k: int, weights: np.ndarray, documents: int, tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        found = [(none, none)] * len(items)
        parts: list[tuple] = []
        held = 0

        def search() -> None:
            shard = Shard(*[np.concatenate(c) for c in zip(*parts)], weights, documents, tokens)
            for i, (_, terms) in enumerate(items):
                found[i] = shard.search(terms, k, *found[i])[:2]
            parts.clear()

        for batch in batches:
            counts = np.diff(batch.column(2).offsets.to_numpy())
            terms = batch.column(2).flatten().to_numpy()
            parts.append((batch.column(0).fill_null(_NONE).to_numpy(), batch.column(1).to_numpy(), counts, terms,
                          batch.column(3).flatten().to_numpy()))
            held += len(terms)
            if held >= SHARD_POSTINGS:
                search()
                held = 0
        if parts:
            search()
        for at in range(0, len(items), 1000):
            some = list(zip(items[at:at + 1000], found[at:at + 1000]))
            names = [item for (item, _), (scores, _) in some for _ in range(len(scores))]
            ids = np.concatenate([i for _, (_, i) in some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(ids, pa.int64(), mask=ids == _NONE), pa.array(np.concatenate([s for _, (s, _) in some]))],
                ["item_id", "doc_id", "score"])

    return run


def best_k(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every item with their rank, merged in parts first, so the last merge sees at most PARTS x k rows of an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = W.Window.partitionBy("item_id", "part").orderBy(*order)
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    found = found.withColumn("place", F.row_number().over(parts)).filter(F.col("place") <= k)
    found = found.withColumn("rank", F.row_number().over(W.Window.partitionBy("item_id").orderBy(*order)))
    return found.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
                   item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score, with scores above 0.

    Terms are runs of letters and digits of ASCII and of all other characters, A-Z as a-z. A document's score is the sum over
    the item's terms, once each, of w * ((10**9 * tf) // (1000 * tf + 20 * m)), where w = floor(1000 * ln((2N + 2) / (2 df + 1)))
    and m = 50 + (50 n N) // L; equal scores rank by rising id, missing ids last. Each row is a document of its own, ids may
    repeat; null texts have no terms. Rows of one item id, the missing one too, are one item with the terms of all.

    The texts are read once for up to TERMS_AT_ONCE different terms of the items, and the stored lists once for up to ITEMS_AT_ONCE
    items; beyond that in several passes.
    """
    spark = docs.sparkSession
    folded = F.translate(F.col(item_text).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = materialize(
        items.select(F.col(item_key).cast("long").alias("item_id"),
                     F.explode(F.split(folded, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).alias("term"))
        .filter("term <> ''").distinct(), "asked-terms")
    total, names = asked.agg(F.count("*"), F.approx_count_distinct("item_id")).first()
    groups = max(1, -(-total // TERMS_AT_ONCE))
    blocks = max(1, -(-2 * names // (ITEMS_AT_ONCE * groups)))
    asked = asked.withColumn("lot", F.xxhash64(F.coalesce("item_id", F.lit(-1))))
    rows = bounded(docs).select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    found = []
    for group in range(groups):
        own = asked.filter(F.pmod("lot", F.lit(groups)) == group)
        # bounded by the number of groups
        number_of = {t.encode(): i for i, t in enumerate(sorted(r[0] for r in own.select("term").distinct().collect()))}
        lists = materialize(rows.mapInArrow(_lists(number_of), "doc_id long, n long, terms array<int>, times array<long>"), "term-lists")
        documents, tokens = lists.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(number_of), np.int64)
        for term, df in lists.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        lists = lists.filter(F.size("terms") > 0)
        for block in range(blocks):
            part = own.filter(F.pmod(F.shiftright("lot", 20), F.lit(blocks)) == block)
            terms_of_item: dict[int | None, list[int]] = {}
            for item, term in part.select("item_id", "term").collect():
                terms_of_item.setdefault(item, []).append(number_of[term.encode()])
            walked = [(item, np.array(sorted(t))) for item, t in terms_of_item.items()]
            if walked and tokens:
                found.append(lists.mapInArrow(_walk(walked, k, weights, documents, tokens), "item_id long, doc_id long, score long"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionAll(more)
    return best_k(materialize(merged, "item-lists"), k)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), x AS (
  SELECT count(*) FILTER (len(ts) > 0) AS docs, CAST(sum(len(ts)) AS BIGINT) AS tokens FROM d
), p AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL
), f AS (
  SELECT t, count(*) AS df FROM p GROUP BY t
), q AS (
  SELECT DISTINCT item_id, t FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
), s AS (
  SELECT item_id, r, doc_id,
         CAST(sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                  * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM q JOIN p USING (t) JOIN f USING (t) CROSS JOIN x GROUP BY ALL
), k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
