"""Token alignment against both libraries on whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskweave.llm import align
from riskweave.llm.pieces import model_bytes

SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


@pytest.fixture(scope="module")
def aligner():
    return align.Aligner(align.byte_tokenizer_json(), model_bytes())


def plainly(rows):
    """The result of ``align`` by tokenizing every text whole with the libraries."""
    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = {i: t for t, i in byte_level.get_vocab().items()}
    a_bytes = lambda i: bytes([BYTE[c] for c in names[i]])

    def b_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    count, links, out = Counter(), [], []
    for doc_id, text in rows:
        a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        raw = (" " + text).encode() if text else b"-"
        if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            out.append((doc_id, 0, 0, 0, ""))
            links.append([])
            continue
        ends = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            at, found = 0, {}
            for n, i in enumerate(ids):
                at += len(size(i))
                found[at] = n + 1
            ends.append(found)
        groups, mine, last = [], [], (0, 0)
        for end in sorted({*ends[0]} & {*ends[1]}):
            here = (ends[0][end], ends[1][end])
            groups.append(",".join(map(str, a[last[0]:here[0]])) + "|" + ",".join(map(str, b[last[1]:here[1]])))
            mine.append((a[here[0] - 1], b[here[1] - 1]))
            last = here
        count.update(mine)
        links.append(mine)
        out.append((doc_id, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return [(d, na, nb, ng, len(own), sum(count[p] == highest[p[1]] for p in own), sum(count[p] for p in own), digest)
            for (d, na, nb, ng, digest), own in zip(out, links)]


def sort(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r))


def odd_texts():
    draw = random.Random(3)
    parts = [" ", "  ", "\n", " \n", "\n\n", "\t", "a", "the", "ing", "'s", "é", "ß", "😀", "漢字", "。", "12", ".", "----", "</s>",
             "<|endoftext|>", "<0x0A>", "\x00", "ﬁ", "　", "\xa0", "\x1c", "Straße", "don't"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    return [*texts, "▁ stands here", "a" * 3000, "漢字。" * 400, "x y\n" * 500, " " * 300, "no cut" + "-" * 700, "the end " * 90]


def test_table_of_odd_texts(spark):
    rows = [*enumerate(odd_texts()), (3, "twice"), (3, "twice"), (None, "no id"), (5000, None), (5001, "")]
    df = spark.createDataFrame([(*r, "u", "n") for r in rows], "doc_id long, text string, uid string, number string")
    want = sort(plainly(rows))
    for options in ({}, {"range_bytes": 50, "broadcast_pairs": 40}):
        found = align.align(df, align.byte_tokenizer_json(), model_bytes(), **options)
        assert found.columns[:2] == ["doc_id", "n_a"]
        assert sort(tuple(r) for r in found.collect()) == want


def test_one_long_text_needs_three_levels_of_the_tree(spark):
    text = " ".join(odd_texts()) + "word " * 2000
    df = spark.createDataFrame([(1, text.replace("▁", ""))], "doc_id long, text string")
    found = align.align(df, align.byte_tokenizer_json(), model_bytes(), range_bytes=20)
    assert [tuple(r) for r in found.collect()] == plainly([(1, text.replace("▁", ""))])


def test_joining_is_associative_and_has_a_unit(aligner):
    text = " " + "Whatever the épreuve, 漢字 joins.\n" * 6
    raw = text.encode()
    draw = random.Random(8)
    whole = aligner.fragment(text)
    strip = lambda f: f._replace(first=f.first and 0, closed=tuple((0, g) for _, g in f.closed))
    for _ in range(20):
        edges = [0, *sorted(draw.sample(range(1, len(raw)), 9)), len(raw)]
        parts = [aligner.fragment(text, a, b, n) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
        left = reduce(align.Fragment.join, parts, align.UNIT)
        right = reduce(lambda x, y: y.join(x), reversed(parts), align.UNIT)
        while len(parts) > 1:
            i = draw.randrange(len(parts) - 1)
            parts[i:i + 2] = [parts[i].join(parts[i + 1])]
        assert left == right == parts[0]
        assert strip(left) == strip(whole)
        # the closed groups carry the range that ends them
        assert [n for n, _ in left.closed] == sorted(n for n, _ in left.closed)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(df, align.byte_tokenizer_json(), model_bytes()).collect() == []


def test_tokenizers_that_do_not_fit_are_refused():
    other = align.byte_tokenizer_json(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError):
        align.Aligner(other, model_bytes())
