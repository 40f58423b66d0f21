"""Best position search against scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskweave.llm import lexical

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plainly(docs, items, k=50):
    counted = [(d, Counter(words(t))) for d, t in docs]
    n_docs, n_all = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc_id, count in counted:
            score = 0
            for t in terms & count.keys():
                m = 50 + (50 * count.total() * n_docs) // n_all
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * count[t]) // (1000 * count[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sort(out)


def sort(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def made(seed, n_docs, n_words):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(n_words)] + ["É", "naïve", "漢字", " x"]
    skewed = lambda: vocabulary[min(int(draw.expovariate(0.1)), len(vocabulary) - 1)]
    text = lambda n: draw.choice([" ", ", ", "\n", "_"]).join(skewed().upper() if draw.random() < 0.1 else skewed() for _ in range(n))
    docs = [(i, text(draw.choice([1, 5, 40, 200]))) for i in range(n_docs)]
    docs += [(i, t) for i, t in docs[:20]] + [(None, docs[3][1]), (n_docs, None), (n_docs + 1, ""), (n_docs + 2, " ... ")]
    items = [(i, text(draw.randint(1, 12))) for i in range(25)] + [(3, "w0 w1"), (None, "w2 w5"), (100, None), (101, "unheard-of")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"SHARD_POSTINGS": 60}, {"TERMS_AT_ONCE": 9, "ITEMS_AT_ONCE": 3}, {"SLICE": 7}])
def test_equals_scoring_all(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = made(1, 150, 60)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, terms string, n int").repartition(3)
    asked = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    for k in (50, 3):
        found = lexical.lexical_search(df, asked, k=k)
        assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
        assert sort(tuple(r) for r in found.collect()) == plainly(docs, items, k)


def test_a_walk_ends_before_the_lists_do():
    draw = np.random.default_rng(4)
    n, m = 20_000, 6
    held = draw.random((n, m)) < 0.5
    held[:, 0] |= ~held.any(axis=1)
    docs, terms = np.nonzero(held)
    times = draw.pareto(1.0, len(docs)).astype(np.int64) + 1
    weights, sizes = np.full(m, 700), draw.integers(20, 20_000, n)  # short documents stand high in all of their lists
    shard = lexical.Shard(np.arange(n), sizes, held.sum(axis=1), terms.astype(np.int32), times, weights, n, int(sizes.sum()))
    stretch = 50 + (50 * sizes * n) // sizes.sum()
    none = np.zeros(0, np.int64)
    scores, ids, scored = shard.search(np.arange(m), 10, none, none)
    total = np.bincount(docs, weights=(weights[terms] * ((10**9 * times) // (1000 * times + 20 * stretch[docs]))).astype(float), minlength=n)
    best = np.lexsort((np.arange(n), -total))[:10]
    assert ids.tolist() == best.tolist() and scores.tolist() == total[best].astype(int).tolist()
    assert scored < n / 2
    # what a walk has marked doesn't reach the next one
    again = shard.search(np.arange(m), 10, none, none)
    assert again[1].tolist() == best.tolist() and again[2] == scored
    # with all from before better, the first round is enough
    assert shard.search(np.arange(m), 1, np.array([10**12]), np.array([7]))[2] <= m * lexical.FIRST_ROUND


def test_empty_tables(spark):
    none, asked = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.lexical_search(none, asked).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.lexical_search(docs, asked.limit(0)).collect() == []
