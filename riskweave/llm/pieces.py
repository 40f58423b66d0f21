"""Exact encoding and decoding with a SentencePiece model of merge type.

A merge-type encoding is the one token sequence in which every two neighbours are compatible: merging their joined
characters again gives just the two. So the encoder walks a text with the longest token at each place (from one
Aho-Corasick pass), takes a token if it is compatible with the one before, else the next shorter one, and goes back
where none is left. A bitfield marks places from which no way leads to the end; no place fails twice, so the walk is linear.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from riskweave.llm.common import Memo, held, keyed, table

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_NEVER = float("-inf")


class PieceCodec:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        proto = model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("a merge-type (BPE) model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that keep the text as it is are supported")
        if any(p.type == _USER for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in proto.pieces if p.type in (_NORMAL, _UNUSED)}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (_NORMAL, _UNUSED)}
        self.byte_ids = [0] * 256
        self.surface: list[str | None] = []
        self.byte_of: dict[int, int] = {}
        self.end_id = self.unknown_id = -1
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                self.byte_of[i] = int(p.piece[3:5], 16)
                self.byte_ids[self.byte_of[i]] = i
                # bytes below 128 are characters; others need their neighbours
                self.surface.append(chr(self.byte_of[i]) if self.byte_of[i] < 128 else None)
            elif p.type == _UNKNOWN:
                self.surface.append(proto.trainer_spec.unk_surface)
                self.unknown_id = i
            elif p.type == _CONTROL:
                self.surface.append("")
                if p.piece == proto.trainer_spec.eos_piece:
                    self.end_id = i
            else:
                self.surface.append(p.piece.replace(SPACE, " "))
        # Equal scores are merged from the left, and then compatible neighbours don't settle the whole.
        often = Counter(self.score.values())
        self.tied = {t for t, value in self.score.items() if often[value] > 1}
        if any(t.strip(SPACE) for t in self.tied):
            raise ValueError("equal scores are supported for runs of spaces only")
        # Only tokens that stay whole when they are merged again can occur.
        whole = [t for t in self.score if len(t) == 1 or self.merge(t) == [t]]
        self.trie = ahocorasick.Automaton()
        for t in whole:
            self.trie.add_word(t, t)
        self.trie.make_automaton()
        known = set(whole)
        self.shorter = {t: next((t[:n] for n in range(len(t) - 1, 0, -1) if t[:n] in known), None) for t in whole}
        self.splits_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.score)
        self.splits_at_line = not any("\n" in t for t in self.score)
        self._pairs: dict[tuple[str, str], bool] = {}
        self._words = Memo(lambda word: self._numbered(SPACE + word))
        self._bare = Memo(self._numbered)

    def merge(self, text: str) -> list[str]:
        """The merges themselves: the best-scored pair first, of equal ones the left one."""
        if len(text) > 64:
            return self._merge_long(text)
        parts, score = list(text), self.score
        scores = [score.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == _NEVER:
                break
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score.get(parts[i - 1] + parts[i], _NEVER)
            if i < len(scores):
                scores[i] = score.get(parts[i] + parts[i + 1], _NEVER)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        """The same with a heap, for runs of any length."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                joined = parts[i] + parts[after[i]]
                if joined in self.score:
                    heapq.heappush(heap, (-self.score[joined], i, joined))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != joined:
                continue
            j = after[i]
            parts[i], parts[j], after[i] = joined, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def compatible(self, left: str, right: str) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            known = self.merge(left + right) == [left, right]
            if len(self._pairs) >= 500_000:
                self._pairs.clear()
            self._pairs[left, right] = known
        return known

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text whose spaces are escaped; characters without a token stand for themselves."""
        n = len(text)
        if n == 0:
            return []
        longest = list(text)
        for end, token in self.trie.iter(text):  # by rising end, so the last one from a place is the longest
            longest[end + 1 - len(token)] = token
        failed = bytearray((n >> 3) + 1)
        out: list[str] = []
        pos, token = 0, longest[0]
        while True:
            last = out[-1] if out else None
            while True:
                end = pos + len(token)
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or self.compatible(last, token)):
                    out.append(token)
                    pos = end
                    if pos == n:
                        return out
                    token = longest[pos]
                    break
                shorter = self.shorter.get(token)
                if shorter is None:
                    failed[pos >> 3] |= 1 << (pos & 7)
                    token = out.pop()
                    pos -= len(token)
                    break
                token = shorter

    def _numbered(self, text: str) -> tuple[int, ...]:
        # tokens of spaces alone may have equal scores
        parts = self.merge(text) if self.tied and SPACE + SPACE in text else self.tokens(text)
        ids: list[int] = []
        for part in parts:
            i = self.ids.get(part)
            if i is not None:
                ids.append(i)
            else:
                ids.extend(self.byte_ids[b] for b in part.encode("utf-8"))
        return tuple(ids)

    def encode(self, text: str, end: bool = False) -> list[int]:
        """The ids of a text; with ``end``, the end id after them. The empty text has no ids of its own."""
        ids: list[int] = []
        if text:
            lines = text.split("\n") if self.splits_at_line else [text]
            for k, line in enumerate(lines):
                if k:
                    ids.append(self.byte_ids[10])
                start = self.prefix if not k else ""
                if not self.splits_at_space:
                    ids += self._numbered(start + line.replace(" ", SPACE))
                elif "  " in line or SPACE in line or (start and line[:1] == " "):
                    for part in re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", start + line.replace(" ", SPACE)):
                        ids += self._words[part[1:]] if part[0] == SPACE else self._bare[part]
                else:
                    words = line.split(" ")
                    if not start:
                        ids += self._bare[words[0]]
                        del words[0]
                    memo = self._words
                    for word in words:
                        ids += memo[word]
        if end:
            ids.append(self.end_id)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; a byte that is no part of a character becomes U+FFFD."""
        surface = self.surface
        try:
            text = "".join([surface[i] for i in ids])
        except TypeError:  # bytes beyond ASCII
            text = self._decode_bytes(ids)
        if self.prefix and text[:1] == " " and self._starts_with_space(ids):
            return text[1:]
        return text

    def _starts_with_space(self, ids: list[int]) -> bool:
        first = next((i for i in ids if self.surface[i] != ""), None)
        return first is not None and first not in self.byte_of and first != self.unknown_id

    def _decode_bytes(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i is not None and i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    n = 1
                    out.append("�")
                del run[:n]
            if i is not None:
                out.append(self.surface[i])
        return "".join(out)


def _arrow_codec(model: bytes, work) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(("pieces", hash(model)), lambda: PieceCodec(model))
        for batch in batches:
            yield work(codec, batch)

    return run


def encode_texts(df: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """One row per row of ``df``: doc_id and ids. Null and empty texts have the end id only; rows may repeat."""

    def work(codec: PieceCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [codec.encode(t, end) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return keyed(df, key, text).mapInArrow(_arrow_codec(model, work), "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row of ``df``: doc_id and the decoded text; null ids give the empty text."""

    def work(codec: PieceCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [codec.decode(i or []) for i in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return df.selectExpr(f"cast(`{key}` as long) as doc_id", f"`{ids}` as ids").mapInArrow(
        _arrow_codec(model, work), "doc_id long, text string")


def code_digests(df: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and return counts and digests of both; null and empty texts have one id."""

    def work(codec: PieceCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        digits = [str(i) for i in range(len(codec.surface))]
        counts, coded, decoded = [], [], []
        for value in batch.column(1):
            ids = codec.encode(value.as_py(), True)
            counts.append(len(ids))
            coded.append(hashlib.sha256(" ".join([digits[i] for i in ids]).encode()).hexdigest())
            decoded.append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return keyed(df, key, text).mapInArrow(
        _arrow_codec(model, work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def model_bytes(path: str | None = None) -> bytes:
    """The model's file, half a megabyte that travels with the tasks; by default the public 32k one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(table(spark, sf_dir, "documents"), model_bytes())
