"""Exact duplicates, repeated passages and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm import exact, jaccard, suffixes
from riskweave.llm.components import components
from riskweave.llm.fuse import FuseFilter

SCHEMA = "doc_id long, text string, batch string, sha string, node string, places string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 20_000])
def test_fuse_filter(n):
    draw = np.random.default_rng(n)
    keys = np.unique(draw.integers(-2**63, 2**63 - 1, n))
    made = FuseFilter.build(keys)
    assert made.contains(keys).all()
    assert made.contains(draw.integers(-2**63, 2**63 - 1, 20_000)).mean() < 0.01


def _lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_duplicates_of_odd_rows(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, "Äb"), (4, "äb"), (5, None), (6, ""), (7, "long " * 50_000), (9, "LONG " * 50_000), (1, "Ab"), (2, "c")]
    for batches in (1, 2, 4):
        found = exact.exact_duplicates(_frame(spark, rows), F.col("doc_id") % batches, batches, per_bucket=2).collect()
        ids = {}
        for key, text in {*rows}:
            ids.setdefault(_lowered(text), set()).add(key)
        assert sorted((r.doc_id, r.text_sha256) for r in found) == sorted(
            (k, hashlib.sha256(t.encode()).hexdigest()) for t, keys in ids.items() for k in keys)
        for r in found:
            group = next(k for t, k in ids.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
            assert (r.keep_id, r.group_size, r.kept) == (max(group), len(group), r.doc_id == max(group))
    assert exact.exact_duplicates(_frame(spark, rows).limit(0), F.lit(0), 2).count() == 0


def test_keep_one(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, "c"), (4, None), (5, "")]
    kept = exact.keep_one(_frame(spark, rows), F.col("doc_id") % 2, 2)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5] and kept.columns[2:] == ["batch", "sha", "node", "places"]
    repeated = exact.keep_one(_frame(spark, [*rows, (2, "aB"), (2, "z")]), F.col("doc_id") % 2, 2)
    assert sorted((r.doc_id, r.text or "") for r in repeated.collect()) == [(2, "aB"), (2, "z"), (3, "c"), (5, "")]


def test_missing_ids_are_documents_of_their_texts(spark):
    rows = [(None, "only"), (None, "ONLY"), (None, "both"), (4, "Both"), (5, "c"), (None, "late"), (7, "Late"), (None, None)]
    want = {(None, None, 1, True, "only"), (None, 4, 2, False, "both"), (4, 4, 2, True, "both"), (5, 5, 1, True, "c"),
            (None, 7, 2, False, "late"), (7, 7, 2, True, "late"), (None, None, 1, True, "")}
    want = {(*r[:4], hashlib.sha256(r[4].encode()).hexdigest()) for r in want}
    first, last = F.coalesce(F.col("doc_id") % 2, F.lit(0)), F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    for batch in (F.col("doc_id") % 2, first, last):  # a missing batch, texts without an id before and after the others
        found = [tuple(r) for r in exact.exact_duplicates(_frame(spark, rows), batch, 2, per_bucket=2).collect()]
        assert len(found) == len(want) and set(found) == want
        kept = sorted((r.doc_id or 0, _lowered(r.text)) for r in exact.keep_one(_frame(spark, rows), batch, 2).collect())
        assert kept == [(0, ""), (0, "only"), (4, "both"), (5, "c"), (7, "late")]


def test_the_pipeline_keeps_texts_without_an_id(spark):
    rows = [(None, "a clean text"), (None, "another"), (3, "Third"), (4, "third")]
    kept = corpus_pipeline.exact_dedup(spark, _frame(spark, rows), "")
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(None, "a clean text"), (None, "another"), (4, "third")}


def _without_repeats(rows):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(data[i:i + 100])
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_repeated_passages(spark, batches):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abé") for _ in range(draw.randint(1, 3)))
    passages = [" ".join(word() for _ in range(draw.randint(20, 90))) for _ in range(5)]
    rows = [(3 * d, "|".join(draw.choice(passages)[draw.randint(0, 30):draw.randint(90, 400)] if draw.random() < 0.5
                             else " ".join(word() for _ in range(draw.randint(0, 60))) for _ in range(draw.randint(0, 5))))
            for d in range(50)]
    rows += [(1000, "a" * 4000), (1001, "ab" * 900), (1002, "a" * 99), (1003, "a" * 100), (1004, None), (1005, ""), (1006, "q" * 100)]
    found = suffixes.remove_repeats(_frame(spark, rows), batches)
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == _without_repeats(rows)


def test_repeated_passages_of_odd_tables(spark):
    assert suffixes.remove_repeats(_frame(spark, [(1, "a")]).limit(0), 2).count() == 0
    row = suffixes.remove_repeats(_frame(spark, [(1, "b" * 300), (1, "b" * 300)])).collect()
    assert [tuple(r)[:4] for r in row] == [(1, 300, 299, 1)]


@pytest.mark.parametrize("batches", [1, 2])
def test_repeated_passages_of_texts_without_an_id(spark, batches):
    draw = random.Random(5)
    passage, other = ("".join(draw.choice("abcdef ") for _ in range(150)) for _ in range(2))
    unnamed = [passage + "1", "2" + passage, "3" + other, "short"]
    rows = [(-2**63, "4" + passage), (5, other + "5"), (6, "six"), (6, "least" + other)]
    age = sorted(unnamed, key=lambda t: hashlib.sha256(t.encode()).digest())
    want = _without_repeats([(i, t) for i, t in enumerate([*age, rows[0][1], rows[1][1], rows[3][1]])])
    frame = _frame(spark, [*[(None, t) for t in unnamed], (None, "short"), *rows])
    found = suffixes.remove_repeats(frame, batches).collect()
    ids = [*[None] * 4, -2**63, 5, 6]
    assert sorted(map(str, map(tuple, found))) == sorted(str((ids[i], *w)) for i, w in want.items())


def test_long_texts_go_block_by_block(monkeypatch):
    draw = random.Random(1)
    data = np.frombuffer(bytes(draw.choice(b"ab cd") for _ in range(9000)), np.uint8)
    _, pos, key, around = suffixes.indexed(data, np.array([0]), np.array([len(data)]))
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    for mine, whole in zip(suffixes.indexed_long(data), (pos, key, around)):
        assert (mine == whole).all()


def test_levels_stay_few(spark):
    index = suffixes.SuffixIndex(2)
    for i in range(5):
        docs = spark.createDataFrame([(i, f"{i} " + "some words that come again and again " * 5)], "doc_id long, text string")
        index.add(docs).count()
    assert [size for size, _ in index.levels] == [4, 1]


def _sets(rows):
    out = {}
    for key, text in {*rows}:
        w = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(w))
        out[key] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
    return out


def _joined(rows, least=Fraction(4, 5)):
    sets = _sets(rows)
    near = {a: {b for b in sets if b != a and sets[a] and sets[a] & sets[b]
                and Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= least} for a in sets}
    out = {}
    for a in sets:
        copies = {b for b in sets if sets[a] and sets[b] == sets[a]} | {a}
        group, more = {a}, [a]
        while more:
            new = near[more.pop()] - group
            group |= new
            more += new
        others = near[a] - copies
        out[a] = (min(copies), min(group), len({frozenset(sets[b]) for b in others}), len(others), len(copies))
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_near_duplicates(spark, block):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [draw.choice(words) for _ in range(120)]
    rows = []
    for d in range(40):
        text = list(base)
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((d, " ".join(text)))
    rows += [(100 + d, " ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))) for d in range(30)]
    rows += [(200, "One two"), (201, "one  TWO!"), (202, None), (203, ""), (204, "?!"), (205, rows[0][1]), (206, "z " * 20_000)]
    rows.append(rows[3])
    found = jaccard.jaccard_join(_frame(spark, rows), jaccard.Terms(block=block))
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == _joined(rows)


def test_near_duplicates_of_an_empty_table(spark):
    assert jaccard.jaccard_join(_frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard.least_agreements(jaccard.Terms())
    assert len(least) == 10 and least == sorted(least)
    assert 0 < least[0] < 16 and least[-1] < 160


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(31)} | {k: 100 for k in range(100, 130)}


def test_near_copies_have_few_ties(spark, monkeypatch):
    """The ties of a cluster of near copies grow with its texts, not with texts times bands."""
    draw = random.Random(3)
    words = [f"w{draw.randrange(1000)}" for _ in range(300)]
    rows = []
    for i in range(80):
        text = list(words)
        text[draw.randrange(300)] = f"x{i}"
        text[draw.randrange(300)] = f"y{i}"
        rows.append((i, " ".join(text)))
    ties, whole = [], jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda edges: ties.append(edges.distinct().count()) or whole(edges))
    found = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["group_id"] for r in found} == {0} and {r["n_links"] for r in found} == {79}
    assert ties[0] <= 3 * len(rows)
