"""Best-fit packing of token sequences, by hierarchical residual packing.

Each task packs the pieces it holds by best fit, the longest first, and emits the bins that are nearly full. Bins with
room left become items themselves: a tree of rounds brings the underfull bins of several tasks together, each round a
bounded number to a task, and packs them by best fit again, until one task holds what is left or a round joins next to none.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import Memo, held, keyed, table
from riskweave.session import materialize

MEMBERS = "array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
BINS = f"sequence_id long, filled int, members {MEMBERS}"
#: Letters, and the characters that byte-level vocabularies write for bytes.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_MEMBER = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                              ("ids_crc32", pa.int64()), ("offset", pa.int64())]))


class WordTokens:
    """Ids of a text by a tokenizer that never joins characters across a space or a line end, word by word.

    The tokenizer drops white space and splits at it before it merges, so a text's ids are those of its words in order.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.memo = Memo(lambda word: self._make([word])[0])
        probes = ["Version", "straÙe", "ÄÖÿß", "x"]
        self.direct = [self._merged(w) for w in probes] == self._encoded(probes)

    def _encoded(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merged(self, word: str) -> bytes:
        """A word of Latin letters alone passes all but the merges as its lower-cased bytes."""
        letters = word.lower()
        if not letters.isascii():
            letters = letters.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _make(self, words: list[str]) -> list[bytes]:
        if not self.direct:
            return self._encoded(words)
        plain = {w: self._merged(w) for w in words if _LATIN.fullmatch(w)}
        rest = [w for w in words if w not in plain]
        if rest:
            plain.update(zip(rest, self._encoded(rest)))
        return [plain[w] for w in words]

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if "<|" not in text and text.isascii():  # the tokenizer lower-cases all but its special tokens
            text = text.lower()
        words = text.replace("\n", " ").split(" ")
        memo = self.memo
        ids = [*map(memo.get, words)]
        if None in ids:
            if len(memo) > memo.limit:
                memo.clear()
            new = [w for w in {*words} if w not in memo and len(w) <= memo.longest]
            # a full stop or comma behind a letter is a word of its own
            ending = [w for w in new if w[-1:] in (".", ",") and w[-2:-1].isalpha() and w[-2].lower().isalpha()]
            rest = {*new, *(w[:-1] for w in ending), ".", ","}.difference(ending)
            whole = [w for w in rest if w not in memo]
            memo.update(zip(whole, self._make(whole)))
            memo.update([(w, memo[w[:-1]] + memo[w[-1]]) for w in ending])
            ids = [memo[w] for w in words]
        return b"".join(ids)


def cut(ids: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of the pieces of at most ``size`` ids; no ids, no piece."""
    for piece, at in enumerate(range(0, len(ids), 4 * size)):
        part = ids[at:at + 4 * size]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins as lists of item numbers: the longest item first, each into the fullest bin that takes it.

    Room left is a whole number up to ``size``, so the open bins lie in one list per room, and the bits of one integer tell
    which lists have a bin.
    """
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, number = size, len(bins)
            bins.append([])
        bins[number].append(item)
        left = room - length
        if left:
            by_room[left].append(number)
            rooms |= 1 << left
    return bins


def _numbers(level: int) -> Iterator[int]:
    """Sequence numbers that no other task or round gives."""
    base = (level << 56) | (TaskContext.get().partitionId() << 32)
    yield from range(base, base + (1 << 32))


def _bin_batch(bins: list[tuple[int, int, list[tuple]]]) -> pa.RecordBatch:
    names = [f.name for f in _MEMBER.value_type]
    members = [[dict(zip(names, m)) for m in b[2]] for b in bins]
    return pa.RecordBatch.from_arrays(
        [pa.array([b[0] for b in bins], pa.int64()), pa.array([b[1] for b in bins], pa.int32()), pa.array(members, _MEMBER)],
        ["sequence_id", "filled", "members"])


def _pack_pieces(tokenizer: str, end_id: int, size: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, numbers = held(("words", hash(tokenizer)), lambda: WordTokens(tokenizer)), _numbers(0)
        end = np.array([end_id], "<u4").tobytes()
        pieces: list[tuple] = []

        def packed() -> pa.RecordBatch:
            out = []
            for group in best_fit([p[3] for p in pieces], size):
                members, offset = [], 0
                for i in group:
                    members.append((*pieces[i], offset))
                    offset += pieces[i][3]
                out.append((next(numbers), offset, members))
            pieces.clear()
            return _bin_batch(out)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                pieces += [(key, *p) for p in cut(tokens(text.as_py()) + end, size)]
                if len(pieces) >= block:
                    yield packed()
        if pieces:
            yield packed()

    return run


def _pack_bins(level: int, size: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers(level)
        held: list[tuple[int, list]] = []

        def packed() -> pa.RecordBatch:
            out = []
            for group in best_fit([h[0] for h in held], size):
                members, offset = [], 0
                for i in group:
                    members += [(m["doc_id"], m["piece"], m["start"], m["length"], m["ids_crc32"], m["offset"] + offset)
                                for m in held[i][1]]
                    offset += held[i][0]
                out.append((next(numbers), offset, members))
            held.clear()
            return _bin_batch(out)

        for batch in batches:
            held += zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            if len(held) >= block:
                yield packed()
        if held:
            yield packed()

    return run


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = 4096, end_id: int = 1,
         slack: int = 16, block: int = 20_000) -> DataFrame:
    """Pack all texts into sequences of at most ``size`` tokens, an end id behind each text.

    ``tokenizer`` is the JSON of a tokenizer whose words end at white space. Per piece: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset. Null and empty texts have the end id alone; longer texts than ``size`` are cut, nothing
    else; repeated rows are packed as often as they occur. Bins with at most ``slack`` tokens of room are final; a task
    holds at most about ``block`` items at once, however many rows there are.
    """
    stored = materialize(keyed(df, key, text).mapInArrow(_pack_pieces(tokenizer, end_id, size, block), BINS), "bins-0")
    done, level = [], 0
    while True:
        under = stored.filter(F.col("filled") < size - slack)
        n = under.count()
        tasks = -(-n // block)
        if level and (before <= block or n > 0.98 * before):  # one task had all, or hardly any two bins fit
            done.append(stored)
            break
        if n < 2:
            done.append(stored)
            break
        done.append(stored.filter(F.col("filled") >= size - slack))
        before, level = n, level + 1
        stored = materialize(under.repartition(tasks).mapInArrow(_pack_bins(level, size, block + 1), BINS), f"bins-{level}")
    bins = reduce(DataFrame.unionByName, done)
    return bins.select("sequence_id", F.explode("members").alias("m")).select("m.doc_id", "m.piece", "m.start", "m.length",
                                                                             "m.ids_crc32", "sequence_id", "m.offset")


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer's file, 1.7 MB that travels with the tasks; by default the public one that lower-cases words."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_json())
