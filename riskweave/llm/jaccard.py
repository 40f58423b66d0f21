"""Join of documents whose sets of word 5-grams have a Jaccard similarity of at least a threshold.

Documents with one and the same set form a class. Classes that agree in a band of MinHash values are candidates; instead of
listing the pairs of a band, its members are tied to one of them, and the resulting clusters are dealt out in pairs of
blocks. Within a pair of blocks, candidate pairs are compared a few MinHash values at a time: a pair goes as
soon as the posterior probability that it reaches the threshold falls below a tolerance, and the rest are verified exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import Memo, held, keyed, only_ids, table
from riskweave.llm.components import components
from riskweave.session import materialize

WORD = re.compile(r"\w+")
_U = np.uint64


@dataclass(frozen=True)
class Terms:
    """What counts as a link, and the sizes of the search.

    With 40 bands of 5 values, a pair at similarity 0.8 is no candidate with probability (1 - 0.8^5)^40 = 1e-7; one more
    similar with less.
    """

    words: int = 5
    threshold: Fraction = Fraction(4, 5)
    bands: int = 40
    rows: int = 5
    step: int = 20
    tolerance: float = 1e-7
    block: int = 256


def least_agreements(terms: Terms) -> list[int]:
    """For each number of compared values, the least agreements with which a pair goes on.

    With a uniform prior the similarity's posterior after m agreements in n values is Beta(m + 1, n - m + 1); the chance
    that it reaches t is that of at most m successes in n + 1 trials with t.
    """
    t = float(terms.threshold)
    out = []
    for n in range(terms.step, terms.bands * terms.rows + 1, terms.step):
        chance, least = 0.0, n + 1
        for m in range(n + 1):
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= terms.tolerance:
                least = m
                break
        out.append(least)
    return out


def _word_hashes() -> Memo:
    return Memo(lambda w: xxhash.xxh3_64_intdigest(w.encode("utf-8")), limit=500_000)


def shingles(text: str, n: int, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of lower-cased words; a shorter text is one n-gram of all its words."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        s = (s ^ h[k:len(h) - n + 1 + k]) * _U(0x9E3779B97F4A7C15)
        s ^= s >> _U(29)
    return np.unique(s * _U(0xBF58476D1CE4E5B9))


def minhash(s: np.ndarray, count: int) -> np.ndarray:
    """MinHash values of a set that isn't empty."""
    factors, offsets = held(("minhash", count), lambda: tuple(
        np.random.default_rng(97).integers(0, 2**32, (2, count), dtype=np.uint32)))
    factors = factors | np.uint32(1)
    x = (s >> _U(32)).astype(np.uint32)
    least = np.full(count, 2**32 - 1, np.uint32)
    for at in range(0, len(x), 512):  # the products stay in the processor's cache
        np.minimum(least, (factors[:, None] * x[None, at:at + 512] + offsets[:, None]).min(axis=1), out=least)
    return least


def band_keys(values: np.ndarray, terms: Terms) -> np.ndarray:
    """A key for each band of the values (of one set, or of one per row)."""
    v = values.reshape(*values.shape[:-1], terms.bands, terms.rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, terms.bands + 1, dtype=np.uint64), v.shape[:-1])
    for k in range(terms.rows):
        h = (h ^ v[..., k]) * _U(0xD6E8FEB86659FD93)
        h = h ^ (h >> _U(32))
    return h.view(np.int64)


def _sketches(terms: Terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = held("word hashes", _word_hashes)
        for batch in batches:
            digests, sizes, bands = [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), terms.words, memo)
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sizes.append(len(s))
                bands.append(band_keys(minhash(s, terms.bands * terms.rows), terms) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "digest", "n", "bands"])

    return run


def _sets(terms: Terms):
    """Sets of the documents that stand for a class; others with the same id fall away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = held("word hashes", _word_hashes)
        for batch in batches:
            nodes, blobs = [], []
            for text, node, digest in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                s = shingles(text.as_py(), terms.words, memo).tobytes()
                if xxhash.xxh3_128_digest(s) == digest:
                    nodes.append(node)
                    blobs.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(blobs, pa.binary())], ["node", "items"])

    return run


def _digested_sets(terms: Terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = held("word hashes", _word_hashes)
        for batch in batches:
            blobs = [shingles(text.as_py(), terms.words, memo).tobytes() for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s) for s in blobs], pa.binary()), pa.array(blobs, pa.binary())], ["digest", "items"])

    return run


def linked_pairs(sets: list[np.ndarray], side: np.ndarray, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that reach the threshold, within one block (all sides 0) or between two.

    ``side`` is 0 or 1; with both, only pairs across count.
    """
    count = terms.bands * terms.rows
    values = np.stack([minhash(s, count) for s in sets])
    keys = band_keys(values, terms)
    near = np.zeros((len(sets), len(sets)), bool)
    for k in range(terms.bands):
        near |= keys[:, k][:, None] == keys[:, k][None, :]
    near &= (side[:, None] < side[None, :]) if side.any() else np.triu(np.ones_like(near), 1)
    i, j = np.nonzero(near)
    agreed = np.zeros(len(i), np.int32)
    for step, least in enumerate(least_agreements(terms)):
        if not len(i):
            break
        part = slice(step * terms.step, (step + 1) * terms.step)
        agreed = agreed + (values[i, part] == values[j, part]).sum(axis=1)
        stays = agreed >= least
        i, j, agreed = i[stays], j[stays], agreed[stays]
    if not len(i):
        return i, j
    sizes = np.array([len(s) for s in sets])
    if len(i) <= 2 * len(sets):
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)])
    else:
        common = _common(sets)[i, j]
    t = terms.threshold
    ok = common * t.denominator >= t.numerator * (sizes[i] + sizes[j] - common)
    return i[ok], j[ok]


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of the 0-1 matrix of the items that several sets have."""
    items, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(place, minlength=len(items)) > 1
    column = (np.cumsum(shared) - 1)[place]
    keep = shared[place]
    row, column = row[keep], column[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, (at, at + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out.astype(np.int64)


_LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("docs", pa.int64()), ("root", pa.int64())])


def _linked(terms: Terms):
    """Rows sorted by cluster and pair of blocks; for each pair the links of its members and a spanning tree of them."""

    def solved(rows: list[tuple]) -> list[tuple]:
        first = {}
        for r in rows:
            first.setdefault(r[0], r)  # a document that was repeated comes more than once
        rows = list(first.values())
        if len(rows) < 2:
            return []
        side = np.array([r[1] for r in rows])
        i, j = linked_pairs([np.frombuffer(r[2], np.uint64) for r in rows], side, terms)
        links = np.bincount(np.concatenate([i, j]), minlength=len(rows))
        size = np.array([r[3] for r in rows])
        docs = np.bincount(np.concatenate([i, j]), weights=np.concatenate([size[j], size[i]]), minlength=len(rows))
        root = list(range(len(rows)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(i.tolist(), j.tolist()):
            a, b = top(a), top(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        return [(rows[x][0], int(links[x]), int(docs[x]), rows[top(x)][0]) for x in range(len(rows)) if links[x]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []
        for batch in batches:
            for cluster, low, high, side, node, items, size in zip(*[c.to_pylist() for c in batch.columns]):
                if (cluster, low, high) != now:
                    out += solved(rows)
                    now, rows = (cluster, low, high), []
                rows.append((node, side, items, size))
            yield _link_batch(out)
            out = []
        yield _link_batch(solved(rows))

    return run


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_LINKS.names, r)) for r in rows], _LINKS)


def jaccard_join(df: DataFrame, terms: Terms = Terms(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, group_id, n_links, n_linked_docs, n_copies.

    A class holds the documents with the same set of n-grams, under its least id. ``n_links`` counts the other classes that
    reach the threshold with it, ``n_linked_docs`` the documents in them, ``n_copies`` the documents of its own class. A
    group is what links connect, under its least id. Texts without a word, null ones too, have no n-gram and no link: each
    is its own class. Texts with fewer words than an n-gram needs have one n-gram of all their words. Rows repeated with
    id and text are one document. Rows without an id are documents by their set of n-grams; they have links like others, a
    class that has no other rows has no id, and a group has the least id in it, none if no row has one.
    """
    docs = keyed(df, key, text)
    shape = "doc_id long, digest binary, n int, bands array<long>"
    sketched = materialize(docs.mapInArrow(_sketches(terms), shape), "sketches")
    rows = materialize(sketched.select("doc_id", "digest", "n").distinct(), "class-members")
    classes = rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # each band of a class that another class has too ties it to the least of them, its hub
    standing = classes.select(F.col("digest").alias("class_digest"), "node", "class_id")
    banded = sketched.join(standing, (F.col("digest") == F.col("class_digest")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        "node", F.explode("bands").alias("band"))
    banded = materialize(banded, "bands")
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub < other")
    # a node and the hubs of its bands are tied to the least of them: most nodes of a large cluster then have one tie, not one a band
    met = banded.join(hubs.select("band", "hub"), "band").groupBy("node").agg(F.collect_set("hub").alias("hubs"))  # one a band at most
    tied = met.select(F.array_union("hubs", F.array("node")).alias("all")).select(F.explode("all").alias("a"), F.array_min("all").alias("b"))
    ties = tied.filter("a <> b").distinct()
    clusters = components(ties)
    clusters = materialize(clusters, "clusters")
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    members = clusters.join(sizes, "root").join(classes, "node").withColumn(
        "blocks", F.ceil(F.col("m") / terms.block).cast("int"))
    members = materialize(members.select("node", "root", "blocks", "digest", F.col("class_id").alias("doc_id"), "n_copies"),
                          "cluster-members")
    wanted = members.select("doc_id").distinct()
    sets = only_ids(docs, wanted).join(members.select("doc_id", "node", "digest"), "doc_id").select("text", "node", "digest").mapInArrow(
        _sets(terms), "node long, items binary")
    if not members.filter("doc_id IS NULL").isEmpty():  # missing ids say nothing, the digest tells which texts are meant
        unnamed = docs.filter("doc_id IS NULL").select("text").mapInArrow(_digested_sets(terms), "digest binary, items binary")
        sets = sets.unionByName(unnamed.join(members.filter("doc_id IS NULL").select("digest", "node"), "digest").select(
            "node", "items").dropDuplicates(["node"]))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = sets.join(members.select("node", "root", "blocks", "n_copies"), "node").withColumn("mine", mine).withColumn(
        "theirs", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("root").alias("cluster"), F.least("mine", "theirs").alias("low"), F.greatest("mine", "theirs").alias("high"),
        (F.col("mine") > F.col("theirs")).cast("int").alias("side"), "node", "items", "n_copies")
    dealt = dealt.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")
    links = materialize(dealt.mapInArrow(_linked(terms), "node long, links long, docs long, root long"), "links")
    groups = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_node = links.groupBy("node").agg(F.sum("links").alias("n_links"), F.sum("docs").alias("n_linked_docs"))
    rooted = classes.join(groups, "node")
    named = rooted.join(rooted.groupBy("root").agg(F.min("class_id").alias("group_id")), "root").select("node", "group_id")
    found = classes.join(per_node, "node", "left").join(named, "node", "left").select(
        "digest", "class_id", F.coalesce("group_id", "class_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_linked_docs", F.lit(0)).alias("n_linked_docs"), "n_copies")
    found = materialize(found, "class-results")
    return rows.join(found, "digest", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_linked_docs", F.lit(0)).alias("n_linked_docs"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), j AS (
  SELECT a, b, c = x.n AND c = y.n AS same FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 5 * c >= 4 * (x.n + y.n - c)
), k AS (
  SELECT doc_id, least(doc_id, coalesce(min(b), doc_id)) AS class_id, 1 + count(b) AS n_copies
  FROM documents LEFT JOIN j ON a = doc_id AND same GROUP BY doc_id
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN j ON a = other
), g AS (SELECT doc_id, min(other) AS group_id FROM reach GROUP BY doc_id
), l AS (
  SELECT a, count(DISTINCT kb.class_id) AS n_links, count(*) AS n_linked_docs FROM j JOIN k kb ON kb.doc_id = b
  WHERE NOT same GROUP BY a
)
SELECT doc_id, class_id, group_id, coalesce(n_links, 0) AS n_links, coalesce(n_linked_docs, 0) AS n_linked_docs, n_copies
FROM k JOIN g USING (doc_id) LEFT JOIN l ON a = doc_id
"""
