"""Alignment of two tokenizers' tokens over the same bytes.

A byte offset where tokens of both end is a common end; common ends cut the tokens into groups. Any byte range of a document
gives a fragment: the tokens up to its first common end (open prefix), the groups between its common ends (closed), and the
tokens behind the last one (open suffix). Two neighbouring fragments join by closing the left one's suffix with the right one's
prefix, which is associative, so the ranges of a very long document are aligned by different tasks and joined in a tree. Only
open ends travel up the tree; closed groups stay where they were found.

Where a space or a line end follows a character that is no white space, both tokenizers begin a new token whatever is around.
The groups of what lies between two such sure cuts are found once and kept, and a range is tokenized from the sure cut
before it to the one behind it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import held, keyed, table
from riskweave.llm.pieces import SPACE, PieceCodec, model_bytes
from riskweave.session import materialize

#: Bytes of a range; longer documents are cut into several.
RANGE_BYTES = 64 << 10
#: Fragments that one step of the tree joins.
FAN_IN = 16
#: At most so many frequent id pairs are sent to all tasks; each of the others has at most 1 / so much of all links.
BROADCAST_PAIRS = 1_000_000
#: Stretches whose groups a worker keeps.
KEPT_UNITS = 500_000
#: Rows and bytes of text of a batch that a task emits.
ROWS, BYTES = 1000, 4 << 20

#: The bytes that byte-level vocabularies write as themselves; the others are written from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
#: Marks that end a run of letters for a byte-level tokenizer.
_MARKS = "。，、；：！？.,;:!?"

Group = tuple[tuple[int, ...], tuple[int, ...]]
NOTHING: Group = ((), ())


def _glued(left: Group, right: Group) -> Group:
    return left[0] + right[0], left[1] + right[1]


class Fragment(NamedTuple):
    """What two tokenizers make of a byte range. ``first`` numbers the range in which its first common end lies; without a
    common end it is None and all tokens are in the prefix. Closed groups carry the number of the range that ends them."""

    prefix: Group
    first: int | None
    closed: tuple[tuple[int, Group], ...]
    suffix: Group

    def join(self, right: Fragment) -> Fragment:
        if self.first is None:
            return right._replace(prefix=_glued(self.prefix, right.prefix))
        if right.first is None:
            return self._replace(suffix=_glued(self.suffix, right.prefix))
        middle = (right.first, _glued(self.suffix, right.prefix))
        return Fragment(self.prefix, self.first, (*self.closed, middle, *right.closed), right.suffix)


#: The fragment of an empty range.
UNIT = Fragment(NOTHING, None, (), NOTHING)


def fragment_of(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int], number: int = 0) -> Fragment:
    """The fragment of tokens with their ends; both lists of ends rise strictly."""
    parts: list[Group] = []
    last_a = last_b = j = 0
    for i, end in enumerate(a_ends):
        while j < len(b_ends) and b_ends[j] < end:
            j += 1
        if j == len(b_ends):
            break
        if b_ends[j] == end:
            j += 1
            parts.append((tuple(a[last_a:i + 1]), tuple(b[last_b:j])))
            last_a, last_b = i + 1, j
    rest = (tuple(a[last_a:]), tuple(b[last_b:]))
    if not parts:
        return Fragment(rest, None, (), NOTHING)
    return Fragment(parts[0], number, tuple((number, g) for g in parts[1:]), rest)


def written(groups) -> str:
    return ";".join([f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups])


def linked(groups) -> list[int]:
    """The pairs of ids whose tokens end together, a << 32 | b."""
    return [a[-1] << 32 | b[-1] for a, b in groups]


class Unit(NamedTuple):
    """What is kept of a stretch between two sure cuts."""

    text: str
    n_a: int
    n_b: int
    links: tuple[int, ...]


def unit_of(groups: list[Group]) -> Unit:
    return Unit(written(groups), sum([len(a) for a, _ in groups]), sum([len(b) for _, b in groups]), tuple(linked(groups)))


def unit_from(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> Unit:
    """The same as ``unit_of`` the fragment of tokens that end together, for the many short stretches."""
    if a_ends == b_ends:
        return Unit(";".join([f"{x}|{y}" for x, y in zip(a, b)]), len(a), len(b), tuple([x << 32 | y for x, y in zip(a, b)]))
    places = dict(zip(b_ends, range(1, len(b) + 1)))
    parts, links, last_a, last_b = [], [], 0, 0
    for i, end in enumerate(a_ends, 1):
        j = places.get(end)
        if j is not None:
            if i - last_a == 1 == j - last_b:
                parts.append(f"{a[last_a]}|{b[last_b]}")
            else:
                parts.append(f"{','.join(map(str, a[last_a:i]))}|{','.join(map(str, b[last_b:j]))}")
            links.append(a[i - 1] << 32 | b[j - 1])
            last_a, last_b = i, j
    return Unit(";".join(parts), len(a), len(b), tuple(links))


class Aligner:
    """Both tokenizers, and the groups of a text exactly as they tokenize it whole."""

    def __init__(self, byte_tokenizer: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(byte_tokenizer)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("a byte-level tokenizer that keeps the text as it is is needed")
        self.tokenizer = Tokenizer.from_str(byte_tokenizer)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.codec = PieceCodec(piece_model)
        if not (self.codec.splits_at_space and self.codec.splits_at_line and self.codec.prefix):
            raise ValueError("pieces across a space or a line end, or no space before the text, are not supported")
        special = {t["content"] for t in spec.get("added_tokens", [])}
        vocabulary = self.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes([_BYTE_OF[c] for c in token])
        self.b_bytes = [b""] * len(self.codec.surface)
        for piece, i in self.codec.ids.items():
            self.b_bytes[i] = piece.replace(SPACE, " ").encode()
        for i, value in self.codec.byte_of.items():
            self.b_bytes[i] = bytes([value])
        #: Neighbours that some piece holds; no piece lies across two characters that none holds side by side.
        self.joined = {piece[i:i + 2] for piece in self.codec.score for i in range(len(piece) - 1)}
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.after_line = len(self.pieces.encode("\n"))
        plain = "".join(c for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" if not {c + ".", c + ","} & self.joined)
        #: Most sure cuts: spaces, line ends, and a full stop or comma behind a letter.
        self.cut = re.compile(r"(?<=\S)(?=[ \n])" + (f"|(?<=[{plain}])(?=[.,])" if plain else ""))
        self.a_size, self.b_size = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.units: dict[str, Unit | None] = {}

    def a_ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def b_ids(self, text: str) -> list[int]:
        """The ids of what lies behind a sure cut: without a space of its own before it."""
        if text[:1] == " " and len(text) > 1:
            return self.pieces.encode(text[1:])  # the library adds the space again, but to no empty text
        return self.pieces.encode("\n" + text)[self.after_line:]

    def fragment(self, text: str, left: int = 0, right: int | None = None, number: int = 0) -> Fragment | None:
        """The fragment of the tokens of ``text``, which lies between two sure cuts, that end behind byte ``left`` and not behind
        byte ``right``. None if the tokens don't give the text back."""
        a, b, raw = self.a_ids(text), self.b_ids(text), text.encode()
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return None
        a_ends, b_ends = [*accumulate(map(len, a_parts))], [*accumulate(map(len, b_parts))]
        if left or right is not None:
            own = [slice(*np.searchsorted(ends, [left, len(raw) if right is None else right], "right")) for ends in (a_ends, b_ends)]
            a, a_ends, b, b_ends = a[own[0]], a_ends[own[0]], b[own[1]], b_ends[own[1]]
        return fragment_of(a, a_ends, b, b_ends, number)

    def learn(self, texts: list[str]) -> None:
        """Keep the groups of stretches between sure cuts; None for one whose tokens don't give it back."""
        spaced = [t for t in texts if t[0] == " " and len(t) > 1]
        b_ids = dict(zip(spaced, self.pieces.encode([t[1:] for t in spaced], num_threads=1)))
        a_size, b_size, units = self.a_size, self.b_size, self.units
        for text, found in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            a = found.ids
            b = b_ids[text] if text in b_ids else self.b_ids(text)
            raw = text.encode()
            if b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b]):
                units[text] = unit_from(a, [*accumulate([a_size[i] for i in a])], b, [*accumulate([b_size[i] for i in b])])
            else:
                units[text] = None

    def units_of(self, texts: list[str]) -> list[list[Unit] | None]:
        """Of every text the groups of a space and the text; None if the tokens don't give it back, none if it is empty."""
        cut = [self.cut.split(" " + text) if text else [] for text in texts]
        if len(self.units) > KEPT_UNITS:
            self.units.clear()
        new = {u for one in cut for u in one if u not in self.units}
        if new:
            self.learn([*new])
        units = self.units
        found = [[units[u] for u in one] for one in cut]
        return [None if None in one else one for one in found]

    def is_cut(self, raw: bytes, at: int) -> bool:
        """Whether both tokenizers begin a token at this byte whatever lies around."""
        if at in (0, len(raw)):
            return True
        if raw[at] & 0xC0 == 0x80:  # inside a character
            return False
        start = at - 1
        while raw[start] & 0xC0 == 0x80:
            start -= 1
        before, behind = raw[start:at].decode(), raw[at:at + 4].decode("utf-8", "ignore")[0]
        if behind in " \n":
            return not before.isspace()
        return behind in _MARKS and before.isalpha() and before < "ꀀ" and before + behind not in self.joined

    def ranges(self, text: str, size: int) -> Iterator[tuple[int, str, int, int]]:
        """(number, text between sure cuts, left, right) of byte ranges of ``size``. A stretch of more bytes than that without
        a sure cut lies in one range."""
        raw = (" " + text).encode()
        start = number = low = 0
        while start < len(raw):
            end = min(start + size, len(raw))
            high = end
            while not self.is_cut(raw, high):
                high += 1
            if high - end > size:
                end = high
            yield number, raw[low:high].decode(), start - low, end - low
            start, number, low = end, number + 1, end
            while not self.is_cut(raw, low):
                low -= 1


_WHOLE = [("uid", pa.binary()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
          ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("number", pa.int32()),
          ("text", pa.string()), ("low", pa.int64()), ("high", pa.int64())]
_FRAGMENT = [("uid", pa.binary()), ("doc_id", pa.int64()), ("number", pa.int32()), ("differs", pa.bool_()), ("first", pa.int32()),
             ("prefix_a", pa.list_(pa.int32())), ("prefix_b", pa.list_(pa.int32())), ("suffix_a", pa.list_(pa.int32())),
             ("suffix_b", pa.list_(pa.int32())), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
             ("text", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
_OPEN = ["uid", "first", "prefix_a", "prefix_b", "suffix_a", "suffix_b"]
_STEP = [("uid", pa.binary()), ("number", pa.int32()), ("closes", pa.bool_()), *[f for f in _FRAGMENT if f[0] in _OPEN[1:]]]
_DIGEST = [("uid", pa.binary()), ("groups_sha256", pa.string())]
_SUMS = [("uid", pa.binary()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
_SQL = {pa.binary(): "binary", pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean",
        pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>"}


def _schema(fields) -> str:
    return ", ".join(f"{name} {_SQL[kind]}" for name, kind in fields)


def _batches(rows: Iterator[tuple], fields) -> Iterator[pa.RecordBatch]:
    """Batches of bounded rows and text."""
    names = [name for name, _ in fields]
    text = names.index("text") if "text" in names else None
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[text] or "") if text is not None else 0
        if len(some) == ROWS or size > BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*some), fields)], names)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*some), fields)], names)


def _documents(byte_tokenizer: str, piece_model: bytes, range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("align", hash(byte_tokenizer), hash(piece_model)), lambda: Aligner(byte_tokenizer, piece_model))

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 100):
                    yield from some(batch.slice(at, 100))

        def some(batch: pa.RecordBatch) -> Iterator[tuple]:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            is_long = [len(t) > range_bytes or 4 * len(t) > range_bytes and len(t.encode()) > range_bytes for t in texts]
            found = aligner.units_of(["" if cut else t for t, cut in zip(texts, is_long)])
            for doc_id, text, cut, units in zip(ids, texts, is_long, found):
                uid = uuid.uuid4().bytes
                if cut:
                    for number, part, low, high in aligner.ranges(text, range_bytes):
                        yield uid, doc_id, None, None, None, None, None, None, number, part, low, high
                elif not units:
                    yield uid, doc_id, 0, 0, 0, "", [], [], None, None, None, None
                else:
                    links = Counter(chain.from_iterable([u.links for u in units]))
                    digest = hashlib.sha256(";".join([u.text for u in units]).encode()).hexdigest()
                    yield (uid, doc_id, sum([u.n_a for u in units]), sum([u.n_b for u in units]), links.total(), digest,
                           [*links], [*links.values()], None, None, None, None)

        yield from _batches(rows(), _WHOLE)

    return run


def _fragments(byte_tokenizer: str, piece_model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("align", hash(byte_tokenizer), hash(piece_model)), lambda: Aligner(byte_tokenizer, piece_model))

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for uid, doc_id, number, text, low, high in zip(*[c.to_pylist() for c in batch.columns]):
                    found = aligner.fragment(text, low, high, number)
                    differs, found = found is None, found or UNIT
                    unit = unit_of([g for _, g in found.closed])
                    links = Counter(unit.links)
                    yield (uid, doc_id, number, differs, found.first, *found.prefix, *found.suffix, unit.n_a, unit.n_b, len(unit.links),
                           unit.text, [*links], [*links.values()])

        yield from _batches(rows(), _FRAGMENT)

    return run


def _step(part: pa.Table) -> pa.Table:
    """Joins neighbouring fragments: one row with the open ends of all, and a row per group that closed between two."""
    part = part.sort_by("number")
    columns = {name: part.column(name).to_pylist() for name in ["number", *_OPEN]}
    leaves = [Fragment((tuple(pa_), tuple(pb)), first, (), (tuple(sa), tuple(sb))) for first, pa_, pb, sa, sb in
              zip(*[columns[name] for name in _OPEN[1:]])]
    whole = reduce(Fragment.join, leaves)
    uid, place = columns["uid"][0], columns["number"][0] // FAN_IN
    rows = [(uid, place, False, whole.first, *whole.prefix, *whole.suffix)]
    rows += [(uid, place, True, at, *group, (), ()) for at, group in whole.closed]
    return pa.Table.from_batches(_batches(iter(rows), _STEP))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by document and number; the digest of a document runs over them without joining their texts."""

    def rows() -> Iterator[tuple]:
        last, running, some = None, None, False
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if uid != last:
                    if last is not None:
                        yield last, running.hexdigest()
                    last, running, some = uid, hashlib.sha256(), False
                if text:
                    running.update((";" + text if some else text).encode())
                    some = True
        if last is not None:
            yield last, running.hexdigest()

    yield from _batches(rows(), _DIGEST)


def _sums(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Sums over the frequent pairs, which are sorted; the other pairs are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            known = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            sums = np.zeros((2, len(sizes)), np.int64)
            np.add.at(sums[0], row[known], times[known] * best[at[known]])
            np.add.at(sums[1], row[known], times[known] * counts[at[known]])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=len(sizes)))]).astype(np.int32))
            rest = [pa.ListArray.from_arrays(offsets, pa.array(v[~known])) for v in (own, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), *rest], [name for name, _ in _SUMS])

    return run


def _long_documents(ranges: DataFrame, byte_tokenizer: str, piece_model: bytes) -> tuple[DataFrame, DataFrame]:
    """Of documents cut into ranges: one row each (uid, doc_id, counts, digest), and rows of pairs (uid, pairs, times)."""
    fragments = materialize(ranges.repartition("uid", "number").mapInArrow(_fragments(byte_tokenizer, piece_model), _schema(_FRAGMENT)),
                            "fragments")
    bad = fragments.filter("differs").select("uid").distinct()
    good = fragments.join(bad, "uid", "left_anti")
    level, closing, most = good.select("number", *_OPEN), [], fragments.agg(F.max("number")).first()[0] or 0
    while True:
        step = materialize(level.groupBy("uid", F.expr(f"number div {FAN_IN}")).applyInArrow(_step, _schema(_STEP)), "joined-fragments")
        closing.append(step.filter("closes"))
        level, most = step.filter("not closes"), most // FAN_IN
        if not most:
            break
    # what is open before the first common end of a document is its first group; behind the last one nothing is open
    closing.append(level.filter("first is not null"))
    closed = reduce(DataFrame.unionAll, closing).select("uid", F.col("first").alias("number"), F.col("prefix_a").alias("a"), F.col("prefix_b").alias("b"))
    closed = closed.select("uid", "number", F.size("a").alias("more_a"), F.size("b").alias("more_b"),
                           F.concat_ws("|", F.concat_ws(",", F.col("a").cast("array<string>")), F.concat_ws(",", F.col("b").cast("array<string>"))).alias("opening"),
                           (F.shiftleft(F.element_at("a", -1).cast("long"), 32) + F.element_at("b", -1)).alias("pair"))
    parts = materialize(good.join(closed, ["uid", "number"], "left").select(
        "uid", "doc_id", "number", (F.col("n_a") + F.coalesce("more_a", F.lit(0))).alias("n_a"),
        (F.col("n_b") + F.coalesce("more_b", F.lit(0))).alias("n_b"),
        (F.col("n_groups") + F.col("pair").isNotNull().cast("int")).alias("n_groups"),
        F.concat_ws(";", F.col("opening"), F.when(F.col("text") != "", F.col("text"))).alias("text"),
        F.when(F.col("pair").isNull(), F.col("pairs")).otherwise(F.concat("pairs", F.array("pair"))).alias("pairs"),
        F.when(F.col("pair").isNull(), F.col("times")).otherwise(F.concat("times", F.array(F.lit(1).cast("long")))).alias("times")),
        "aligned-ranges")
    digests = parts.select("uid", "number", "text").repartition("uid").sortWithinPartitions("uid", "number").select("uid", "text").mapInArrow(
        _digests, _schema(_DIGEST))
    counts = parts.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")])
    zeros = fragments.join(bad, "uid").groupBy("uid").agg(F.first("doc_id").alias("doc_id")).select(
        "uid", "doc_id", *[F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups")], F.lit("").alias("groups_sha256"))
    return counts.join(digests, "uid").unionByName(zeros), parts.select("uid", "pairs", "times")


def align(df: DataFrame, byte_tokenizer: str, piece_model: bytes, key: str = "doc_id", text: str = "text",
          range_bytes: int = RANGE_BYTES, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Align the tokens of a byte-level tokenizer (A) and a piece model (B) in a space and the text of every row.

    One row per row of ``df``: doc_id, n_a and n_b (tokens), n_groups, n_links (pairs of tokens that end together, one a group),
    n_best (links whose pair of ids is linked as often as any of its B id in all texts), count_sum (how often the ids of its links
    are linked in all texts) and groups_sha256, the digest of the ids ``a1,a2|b1;a3|b2``. A null or empty text, and one that either
    tokenizer's tokens don't give back, has zeros and an empty digest. Rows may repeat and ids may be null; each row counts.
    """
    first = materialize(keyed(df, key, text).mapInArrow(_documents(byte_tokenizer, piece_model, range_bytes), _schema(_WHOLE)), "aligned")
    columns = ["uid", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    rows, pairs = first.filter("number is null").select(columns), first.filter("number is null").select("uid", "pairs", "times")
    ranges = first.filter("number is not null").select("uid", "doc_id", "number", "text", "low", "high")
    if not ranges.isEmpty():
        long_rows, long_pairs = _long_documents(ranges, byte_tokenizer, piece_model)
        rows, pairs = rows.unionByName(long_rows), pairs.unionByName(long_pairs)
    counts = pairs.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.times").alias("count"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    counts = materialize(counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "best-pairs")
    links = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    # fewer pairs than broadcast_pairs can have more than this many of all links
    seldom = links // broadcast_pairs
    often = counts.filter(F.col("count") > seldom).orderBy("pair").toArrow()
    sums = pairs.mapInArrow(_sums(*[often.column(c).to_numpy().astype(np.int64) for c in ("pair", "count", "best")]), _schema(_SUMS))
    if seldom:
        sums = materialize(sums, "pair-sums")
        rest = sums.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("uid", "p.pairs", "p.times")
        rest = rest.join(counts.filter(F.col("count") <= seldom), F.col("pairs") == F.col("pair")).select(
            "uid", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("count")).alias("count_sum"))
        sums = sums.select("uid", "n_best", "count_sum").unionAll(rest)
    sums = sums.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(sums, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def byte_tokenizer_json(path: str | None = None) -> str:
    """The tokenizer's file; by default the public byte-level one of 50k tokens."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), byte_tokenizer_json(), model_bytes())
