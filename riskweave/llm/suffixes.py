"""Removal of repeated passages with a logarithmic family of sparse suffix arrays.

A suffix is indexed where its first 32 bytes have the least fingerprint of all that start in some 100-byte string; equal
strings so index the same place, and every string holds an indexed suffix. A suffix is filed under that fingerprint, with
a second one of its whole surroundings: all 100-byte strings that hold its first 32 bytes. A batch of documents gets sorted
arrays of its suffixes, cut into ranges. They are merged range by range with the arrays of the levels that exist. A
suffix whose surroundings occurred before repeats as a whole. Where one fingerprint has several surroundings, the bytes
around are compared string by string. A batch becomes a new level, and levels of like size are merged into one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import BROADCAST_IDS, keyed, only_ids, table
from riskweave.session import materialize

LENGTH = 100
PREFIX = 32
LEFT = LENGTH - PREFIX
#: Bytes of text that are fingerprinted at once; longer texts go block by block.
BLOCK = 1 << 18
#: Bytes of text whose suffixes are sorted at once in a task.
CHUNK = 24 << 20
#: Bytes of text per range of the arrays, about a thirtieth as many suffixes.
RANGE_BYTES = 24 << 20

_U = np.uint64
_TABLES: dict[int, np.ndarray] = {}
_BASES = [0x9E3779B97F4A7C15, 0xD1B54A32D192ED03]
_LETTERS = [np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64) for seed in (11, 23)]


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, from a table that is made once."""
    known = _TABLES.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, BLOCK + 2 * LENGTH), base, np.uint64)
        known[0] = 1
        known = _TABLES[base] = np.multiply.accumulate(known)
    return known[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


class Fingerprints:
    """Fingerprints of any part of a byte array, from running sums; one of two independent families."""

    def __init__(self, data: np.ndarray, family: int):
        n, base = len(data), _BASES[family]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[family][data] * _powers(base, n), dtype=np.uint64, out=self.sums[1:])
        self.back = _powers(pow(base, -1, 2**64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start])


def indexed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, own: int | None = None) -> tuple:
    """The indexed places of texts that lie one after another: text number, place in it, fingerprint, surroundings.

    With ``own``, data is a part of one text that begins with up to LEFT bytes before its own first one, which is at
    ``own``, and only strings that start from there on count.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(_U), none.astype(_U)
    prints = Fingerprints(data, 0)
    n = len(data) - PREFIX + 1
    key = _mixed((prints.sums[PREFIX:] - prints.sums[:n]) * prints.back[:n])
    least, at = key, np.arange(n, dtype=np.int32)
    span, width = 1, LEFT + 1  # the least of `width` neighbours, the leftmost of equal ones
    while span < width:
        step = min(span, width - span)
        after = least[step:] < least[:-step]
        at = np.where(after, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        span += step
    number = np.repeat(np.arange(len(starts), dtype=np.int32), ends - starts)
    if own is None:
        at = at[number[:len(at)] == number[LENGTH - 1:LENGTH - 1 + len(at)]]  # strings within one text
    else:
        at = at[own:own + BLOCK]
    if not len(at):
        return none, none, none.astype(_U), none.astype(_U)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])].astype(np.int64)
    number = number[at]
    low, high = np.maximum(starts[number], at - LEFT), np.minimum(ends[number], at + LENGTH)
    around = _mixed(prints.of(low, high) + (at - low).astype(_U) * _U(0x1F3D5B79))
    return number, at - starts[number], key[at], around


def indexed_long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, fingerprint and surroundings in one text of any length, block by block."""
    parts, last = [], -1
    for start in range(0, max(1, len(data) - LENGTH + 1), BLOCK):
        low = max(0, start - LEFT)
        part = data[low:start + BLOCK + LEFT + LENGTH]  # all that surrounds the suffixes of the block's strings
        _, pos, key, around = indexed(part, np.array([0]), np.array([len(part)]), start - low)
        pos = pos + low
        fresh = pos > last  # the first may be the one before's last
        parts.append((pos[fresh], key[fresh], around[fresh]))
        last = int(pos[-1]) if len(pos) else last
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def _firsts(key: np.ndarray, around: np.ndarray, doc: np.ndarray, pos: np.ndarray, new: np.ndarray) -> tuple:
    """Order by fingerprint, surroundings, age and place, and which entries are the first of their surroundings."""
    order = np.lexsort((pos, doc, new, around, key))
    k, a = key[order], around[order]
    first_key = np.concatenate([[True], k[1:] != k[:-1]])
    return order, first_key, first_key | np.concatenate([[True], a[1:] != a[:-1]])


#: Kinds of rows: entries of the arrays, suffixes that repeat as a whole, and those whose surroundings must be compared.
ENTRY, REPEAT, OPEN = 0, 1, 2
ARRAYS = "range int, kind int, key binary, around binary, doc binary, pos binary"
_SCHEMA = pa.schema([("range", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("key", "around", "doc", "pos"))])


def _row(number: int, kind: int, *arrays: np.ndarray) -> dict:
    types = (np.uint64, np.uint64, np.int64, np.int32)
    return dict(zip(_SCHEMA.names, (number, kind, *(a.astype(t).tobytes() for a, t in zip(arrays, types)))))


def _ranges_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((_mixed(key) >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int32)


def _arrays(ranges: int):
    """Sorted arrays of the suffixes of each chunk of texts, cut into ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[bytes] = []
        found: list[tuple] = []
        size = total = 0

        def index_block() -> None:
            """Suffixes of the texts that wait, as arrays of document, place, fingerprint and surroundings."""
            if len(texts) == 1 and len(texts[0]) > BLOCK:
                pos, key, around = indexed_long(np.frombuffer(texts[0], np.uint8))
                doc = np.full(len(pos), ids[0], np.int64)
            else:
                lengths = np.array([len(t) for t in texts])
                ends = np.cumsum(lengths)
                number, pos, key, around = indexed(np.frombuffer(b"".join(texts), np.uint8), ends - lengths, ends)
                doc = np.array(ids, np.int64)[number]
            found.append((doc, pos.astype(np.int32), key, around))
            ids.clear()
            texts.clear()

        def sorted_chunk() -> pa.RecordBatch:
            doc, pos, key, around = (np.concatenate([f[i] for f in found]) for i in range(4))
            found.clear()
            if not len(key):
                return pa.RecordBatch.from_pylist([], _SCHEMA)
            order, _, first = _firsts(key, around, doc, pos, np.zeros(len(key), np.int8))
            kept, again = order[first], order[~first]
            where = _ranges_of(key[kept], ranges)
            by_range = np.argsort(where, kind="stable")
            kept, where = kept[by_range], where[by_range]
            cuts = np.searchsorted(where, np.arange(ranges + 1))
            rows = []
            for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    part = kept[a:b]
                    rows.append(_row(r, ENTRY, key[part], around[part], doc[part], pos[part]))
            if len(again):
                none = np.zeros(0)
                rows.append(_row(int(doc[0] % ranges), REPEAT, none, none, doc[again], pos[again]))
            return pa.RecordBatch.from_pylist(rows, _SCHEMA)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py().encode("utf-8")
                if texts and size + len(data) > BLOCK:
                    index_block()
                    total, size = total + size, 0
                    if total >= CHUNK:
                        yield sorted_chunk()
                        total = 0
                ids.append(key)
                texts.append(data)
                size += len(data)
        if texts:
            index_block()
        if found:
            yield sorted_chunk()

    return run


def _merged_range(keep: bool):
    """Merge the arrays of a range, old and new; say what repeats and what must be compared."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        number = rows[0]["range"]
        parts = [r for r in rows if r["kind"] == ENTRY]
        out = [{k: r[k] for k in _SCHEMA.names} for r in rows if r["kind"] == REPEAT]
        if parts:
            key, around, doc, pos = (np.concatenate([np.frombuffer(r[c], t) for r in parts]) for c, t in (
                ("key", np.uint64), ("around", np.uint64), ("doc", np.int64), ("pos", np.int32)))
            new = np.concatenate([np.full(len(r["key"]) // 8, r["new"], np.int8) for r in parts])
            order, first_key, first = _firsts(key, around, doc, pos, new)
            none = np.zeros(0)
            again = order[~first]  # entries of old levels are distinct, so these are new
            if len(again):
                out.append(_row(number, REPEAT, none, none, doc[again], pos[again]))
            kept = order[first]
            of = (np.cumsum(first_key) - 1)[first]
            several = np.bincount(of) > 1
            fresh = np.bincount(of, weights=new[kept]) > 0
            compared = kept[(several & fresh)[of]]
            if len(compared):
                out.append(_row(number, OPEN, key[compared], new[compared], doc[compared], pos[compared]))
            if keep:
                mine = kept[new[kept] == 1]
                out.append(_row(number, ENTRY, key[mine], around[mine], doc[mine], pos[mine]))
        return pa.Table.from_pylist(out, _SCHEMA)

    return run


def _joined_range(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    return pa.Table.from_pylist([{"range": rows[0]["range"], "kind": ENTRY} | {
        c: b"".join(r[c] for r in rows) for c in ("key", "around", "doc", "pos")}], _SCHEMA)


def _places(kind: int):
    """One row per suffix of a kind: doc_id, pos, key, new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] != kind:
                    continue
                doc, pos = np.frombuffer(r["doc"], np.int64), np.frombuffer(r["pos"], np.int32)
                key = np.frombuffer(r["key"], np.int64) if kind == OPEN else np.zeros(len(doc), np.int64)
                new = np.frombuffer(r["around"], np.uint64) > 0 if kind == OPEN else np.ones(len(doc), bool)
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in (doc, pos, key, new)], ["doc_id", "pos", "key", "new"])

    return run


_PLACE = "doc_id long, pos int, key long, new boolean"


def _cut_out(ranges: int):
    """The bytes around listed suffixes, by range of their fingerprint."""
    shape = pa.schema([("range", pa.int32()), ("key", pa.binary()), ("new", pa.binary()), ("doc", pa.binary()),
                       ("pos", pa.binary()), ("before", pa.binary()), ("after", pa.binary()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, news, docs, poss, befores, afters, cuts = [], [], [], [], [], [], []
            for doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = np.frombuffer(text.as_py().encode("utf-8"), np.uint8)
                pos = np.array([p["pos"] for p in places], np.int64)
                padded = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(LENGTH, np.uint8)])
                cuts.append(padded[pos[:, None] + np.arange(LEFT + LENGTH)[None, :]])
                keys.append(np.array([p["key"] for p in places], np.int64))
                news.append(np.array([p["new"] for p in places], np.uint8))
                docs.append(np.full(len(pos), doc, np.int64))
                poss.append(pos.astype(np.int32))
                befores.append(np.minimum(pos, LEFT).astype(np.uint8))
                afters.append(np.minimum(len(data) - pos, LENGTH).astype(np.uint8))
            if not keys:
                continue
            columns = [np.concatenate(x) for x in (keys, news, docs, poss, befores, afters, cuts)]
            where = _ranges_of(columns[0].view(np.uint64), ranges)
            rows = [[int(r), *(c[where == r].tobytes() for c in columns)] for r in np.unique(where)]
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, r)) for r in rows], shape)

    return run


_CUTS = "range int, key binary, new binary, doc binary, pos binary, before binary, after binary, bytes binary"
_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _compared(group: pa.Table) -> pa.Table:
    """Of suffixes with one fingerprint, the strings around that occur earlier, as spans.

    For each distance of the prefix from a string's start, equal strings are brought together by 128-bit fingerprints.
    """
    rows = group.to_pylist()
    key, new, doc, pos, before, after = (np.concatenate([np.frombuffer(r[c], t) for r in rows]) for c, t in (
        ("key", np.int64), ("new", np.uint8), ("doc", np.int64), ("pos", np.int32), ("before", np.uint8), ("after", np.uint8)))
    around = np.concatenate([np.frombuffer(r["bytes"], np.uint8).reshape(-1, LEFT + LENGTH) for r in rows])
    # by fingerprint, then old before new, then by place
    order = np.lexsort((pos, doc, new, key))
    key, new, doc, pos, before, after, around = (a[order] for a in (key, new, doc, pos, before, after, around))
    letters = [_LETTERS[family] for family in (0, 1)]
    back = [_U(pow(base, -1, 2**64)) for base in _BASES]
    top = [_U(pow(base, LENGTH - 1, 2**64)) for base in _BASES]
    prints = [np.zeros(len(around), np.uint64) for _ in _BASES]
    for family, base in enumerate(_BASES):  # of the first string, from its last byte to its first
        for c in range(LENGTH - 1, -1, -1):
            prints[family] = prints[family] * _U(base) + letters[family][around[:, c]]
    found_doc, found_start = [], []
    for at in range(LEFT + 1):
        if at:  # the next string has one byte less before, one more behind
            for family in (0, 1):
                h = (prints[family] - letters[family][around[:, at - 1]]) * back[family]
                prints[family] = h + letters[family][around[:, at + LENGTH - 1]] * top[family]
        shift = LEFT - at
        rows_in = np.flatnonzero((before >= shift) & (after >= LENGTH - shift))
        if not len(rows_in):
            continue
        one, two, k = prints[0][rows_in], prints[1][rows_in], key[rows_in]
        by = np.lexsort((rows_in, two, one, k))  # rows lie in the order of age
        k, one, two = k[by], one[by], two[by]
        same = np.concatenate([[False], (k[1:] == k[:-1]) & (one[1:] == one[:-1]) & (two[1:] == two[:-1])])
        again = rows_in[by[same]]
        again = again[new[again] == 1]
        found_doc.append(doc[again])
        found_start.append(pos[again] - shift)
    if not found_doc:
        return pa.Table.from_pylist([], _SPANS)
    d, s = np.concatenate(found_doc), np.concatenate(found_start).astype(np.int64)
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    if not len(d):
        return pa.Table.from_pylist([], _SPANS)
    # strings that touch become one span
    cut = np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + LENGTH)])
    last = np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(d) - 1]])
    return pa.Table.from_arrays([pa.array(d[cut]), pa.array(s[cut].astype(np.int32)),
                                 pa.array((s[last] + LENGTH).astype(np.int32))], schema=_SPANS)


class SuffixIndex:
    """Levels of sorted suffix arrays over all batches so far, and their documents."""

    def __init__(self, ranges: int):
        self.ranges = ranges
        self.levels: list[tuple[int, DataFrame]] = []  # how many batches, and the arrays
        self.docs: list[DataFrame] = []

    def add(self, docs: DataFrame, last: bool = False) -> DataFrame:
        """Spans (doc_id, start, end) of the batch that repeat earlier text: of earlier batches, or earlier in this one."""
        arrays = docs.mapInArrow(_arrays(self.ranges), ARRAYS).withColumn("new", F.lit(1))
        for _, level in self.levels:
            arrays = arrays.unionByName(level.withColumn("new", F.lit(0)))
        merged = materialize(arrays.groupBy("range").applyInArrow(_merged_range(not last), ARRAYS), "merged-ranges")
        self.docs.append(docs)
        if not last:
            self._store(merged.filter(F.col("kind") == ENTRY))
        whole = merged.filter(F.col("kind") == REPEAT).mapInArrow(_places(REPEAT), _PLACE).select(
            "doc_id", F.greatest(F.col("pos") - LEFT, F.lit(0)).alias("start"), (F.col("pos") + LENGTH).alias("end"))
        listed = merged.filter(F.col("kind") == OPEN).mapInArrow(_places(OPEN), _PLACE).groupBy("doc_id").agg(
            F.collect_list(F.struct("pos", "key", "new")).alias("places"))
        listed = materialize(listed, "open-places")
        texts = only_ids(reduce(DataFrame.unionByName, self.docs), listed.select("doc_id"))
        cuts = texts.join(listed, "doc_id").select("doc_id", "text", "places").mapInArrow(_cut_out(self.ranges), _CUTS)
        part = cuts.groupBy("range").applyInArrow(_compared, "doc_id long, start int, end int")
        return whole.unionByName(part)

    def _store(self, arrays: DataFrame) -> None:
        """A new level of one batch; levels of equal size are merged, so there are never more than log2 of the batches."""
        size = 1
        while self.levels and self.levels[-1][0] == size:
            older = self.levels.pop()[1]
            arrays = materialize(older.unionByName(arrays).groupBy("range").applyInArrow(_joined_range, ARRAYS), "level")
            size *= 2
        self.levels.append((size, arrays))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the spans out of each text."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data = text.as_py().encode("utf-8")
            kept, at, removed, runs = [], 0, 0, 0
            run_end = -1
            for start, end in sorted((s["start"], min(s["end"], len(data))) for s in spans or []):
                if start > run_end:
                    runs += 1
                run_end = max(run_end, end)
                if end > at:
                    kept.append(data[at:max(start, at)])
                    removed += end - max(start, at)
                    at = end
            kept.append(data[at:])
            for column, value in zip(out, (doc, len(data), removed, runs, hashlib.sha256(b"".join(kept)).hexdigest())):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(df: DataFrame, batches: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a 100-byte string that covers it also starts earlier: in a document of a smaller id, or earlier in the
    same. Documents arrive in ``batches`` of rising ids. Null and empty texts, and those under 100 bytes, lose nothing. Of rows
    repeated with one id the one with the least text counts. Rows without an id are a document per text; they come before all
    ids, in the order of their texts' SHA-256. Equality is that of 128-bit fingerprints.
    """
    docs = keyed(df, key, text)
    n, named, ids, size = docs.agg(
        F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id"), F.sum(F.octet_length("text"))).first()
    if n != named:
        digest = F.when(F.col("doc_id").isNull(), F.sha2(F.col("text").cast("binary"), 256))
        docs = docs.groupBy("doc_id", digest.alias("digest")).agg(F.min("text").alias("text"))
        # numbers in the order of age stand for the ids
        docs = docs.sort(F.col("doc_id").asc_nulls_first(), "digest").withColumn("number", F.monotonically_increasing_id())
        docs = materialize(docs.select("number", "doc_id", "text"), "numbered")
        of_number = docs.select("number", "doc_id")
        found = _of_documents(docs.select(F.col("number").alias("doc_id"), "text"), size or 0, batches)
        found = found.withColumnRenamed("doc_id", "number").join(of_number, "number")
        return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    if n != ids:
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    return _of_documents(docs, size or 0, batches)


def _of_documents(docs: DataFrame, size: int, batches: int) -> DataFrame:
    """``remove_repeats`` for documents of distinct ids and ``size`` bytes at most."""
    index = SuffixIndex(max(1, -(-size // RANGE_BYTES)))
    limits = docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 and size else []
    edges = [None, *sorted({int(x) for x in limits}), None]
    spans = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        batch = docs
        if low is not None:
            batch = batch.filter(F.col("doc_id") > low)
        if high is not None:
            batch = batch.filter(F.col("doc_id") <= high)
        spans.append(index.add(batch, last=i == len(edges) - 2))
    found = reduce(DataFrame.unionByName, spans).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    found = materialize(found, "repeated-spans")
    if found.count() <= BROADCAST_IDS:  # texts without spans needn't move
        ids = F.broadcast(found.select("doc_id"))
        hit = docs.join(ids, "doc_id", "left_semi").join(found, "doc_id").select("doc_id", "text", "spans")
        rest = docs.join(ids, "doc_id", "left_anti").select("doc_id", "text", F.lit(None).cast(hit.schema["spans"].dataType).alias("spans"))
        return hit.mapInArrow(_without, _RESULT).unionByName(rest.mapInArrow(_without, _RESULT))
    return docs.join(found, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_without, _RESULT)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), batches=2)
