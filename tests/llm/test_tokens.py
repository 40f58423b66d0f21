"""Piece codec and packing against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskweave.llm import packing, pieces

SCHEMA = "doc_id long, text string, ids string, sequence_id string, offset string"


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(pieces.model_bytes())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_codec_equals_the_library_on_random_texts(codec, library):
    draw = random.Random(5)
    parts = [" ", "  ", "   ", "a", "the", "ing", "▁", "\n", "\t", "é", "ß", "😀", "漢字", "12", ".", "----", "</s>", "<0x0A>", "\x00", "ﬁ"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        ids = library.encode(text, add_eos=True)
        assert codec.encode(text, True) == ids
        assert codec.decode(ids) == library.decode(ids)


def test_codec_on_runs_and_very_long_texts(codec, library):
    for text in [" " * 77 + "the", "a" * 5000, " " * 3000, "x y " * 4000 + "\n\n"]:
        assert codec.encode(text, True) == library.encode(text, add_eos=True)


def test_decoding_of_broken_bytes(codec, library):
    for ids in [[3 + 0xE6], [3 + 0xE6, 3 + 0xBC, 450], [1, 450, 2], [], [0, 450], [3 + 0xFF, 3 + 0x41, 3 + 0xF0, 3 + 0x9F]]:
        assert codec.decode(ids) == library.decode(ids)


def test_encode_and_decode_tables(spark, library):
    rows = [(1, "a b", "x", "x", "x"), (2, None, "x", "x", "x"), (3, "", "x", "x", "x"), (3, "", "x", "x", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = pieces.model_bytes()
    encoded = pieces.encode_texts(docs, model)
    found = sorted((r.doc_id, list(r.ids)) for r in encoded.collect())
    assert found == [(1, library.encode("a b", add_eos=True)), (2, [2]), (3, [2]), (3, [2])]
    assert sorted((r.doc_id, r.text) for r in pieces.decode_ids(encoded, model).collect()) == [(1, "a b"), (2, ""), (3, ""), (3, "")]
    assert pieces.code_digests(docs.limit(0), model).count() == 0


def test_query_equals_the_library(spark, tables, library):
    found = {r.doc_id: r for r in pieces.op1_sentencepiece(spark, tables).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    assert found.keys() == texts.keys()
    for key, text in texts.items():
        ids = library.encode(text, add_eos=True)
        assert found[key].n_tokens == len(ids)
        assert found[key].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[key].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _ids(text):
    return [*TOKENIZER.encode(text, add_special_tokens=False).ids, 1]


def test_words_equal_the_tokenizer():
    words = packing.WordTokens(packing.tokenizer_json())
    draw = random.Random(6)
    parts = [" ", "\n", "\t", "a", "'s", "'ll", "İ", "é", "ß", "ΑΣ", "😀", "12", "<|endoftext|>", ".", ",", "!!", "\x85", "́", "don"]
    for _ in range(2000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert np.frombuffer(words(text), "<u4").tolist() == _ids(text)[:-1]


def test_best_fit_takes_the_fullest_bin():
    assert [sorted(b) for b in packing.best_fit([6, 5, 4, 3, 2], 10)] == [[0, 2], [1, 3, 4]]
    assert packing.best_fit([], 10) == []


def _valid(rows, texts, size):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for key, parts in by_doc.items():
        ids, at = _ids(texts[key]), 0
        for i, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start, r.length) == (i, at, min(size, len(ids) - at))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_packing_over_several_rounds(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").repartition(6)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = packing.pack(docs, packing.tokenizer_json(), size=700, slack=2, block=40).collect()
    n = _valid(rows, texts, 700)
    assert n <= 1.05 * sum(r.length for r in rows) / 700


def test_packing_of_odd_rows(spark):
    rows = [(1, "a " * 9000, "x", "x", "x"), (2, None, "x", "x", "x"), (3, "", "x", "x", "x"), (4, "b", "x", "x", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = packing.pack(docs, packing.tokenizer_json()).collect()
    _valid(found, {r[0]: r[1] or "" for r in rows}, 4096)
    assert packing.pack(docs.limit(0), packing.tokenizer_json()).count() == 0
    assert packing.pack(docs.filter("doc_id = 4").union(docs.filter("doc_id = 4")), packing.tokenizer_json()).count() == 2
