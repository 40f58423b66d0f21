"""No caps: samples of tables of any size, many languages, many segments, exhausted forms of addresses."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm import exact, jaccard, language, surrogates, toxicity
from riskweave.llm.common import crc_of, drawn


def test_a_sample_of_a_very_large_table_is_not_empty(spark):
    """Of rows that stand for 50 billion, the share that the draw keeps is the sample's."""
    rows = spark.range(200_000).select(F.xxhash64("id").alias("draw"))
    assert drawn(rows, F.col("draw"), 100, 100).count() == 200_000
    assert drawn(rows, F.col("draw"), 200_000, 20_000).count() == pytest.approx(20_000, rel=0.05)
    edge = -(2**63) + 20_000 * 2**64 // 50_000_000_000
    near = spark.createDataFrame([(edge - 1,), (edge,), (-(2**63),), (0,)], "draw long")
    assert sorted(r[0] for r in drawn(near, F.col("draw"), 50_000_000_000, 20_000).collect()) == [-(2**63), edge - 1]


def test_languages_beyond_the_bound_are_refused_not_dropped(spark):
    docs = spark.createDataFrame([(i, f"text {chr(97 + i % 26) * 9} {i}", f"l{i:03d}") for i in range(201)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language.fit_language(docs, buckets=256)
    assert len(language.fit_language(docs, buckets=256, most_languages=201).languages) == 201


def test_all_segments_count(spark):
    """Texts with more than 64 significant segments: the curve is fitted on the sums that scoring uses."""
    good, bad = "fine words that are clean and stand here in the middle of it ", "vile slur "
    texts = [(i, (bad + good) * 90 if i % 2 else good * 120, i % 2) for i in range(240)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    n, found = model.passages(texts[1][1])
    assert len(found) > 64
    assert model.probability(n, found) > 0.5 > model.probability(*model.passages(texts[0][1]))


def test_a_document_labelled_both_ways_is_toxic_whatever_the_order(spark):
    docs = spark.createDataFrame([(i, "vile slur" if i % 2 else "clean words") for i in range(80)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(80)] + [(1, 0), (3, 0)]
    models = [toxicity.fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int").repartition(3)) for rows in (labels, labels[::-1])]
    assert models[0].odds == models[1].odds and models[0].weights == pytest.approx(models[1].weights)


def test_an_exhausted_form_gets_longer_surrogates(spark):
    """All one-letter addresses of a domain of one letter occur, so none of them is free."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("email", f"{a}@{b}.de") for a in letters for b in letters]
    found = surrogates.settle(spark.createDataFrame(rows, "kind string, canonical string"), b"k")
    attempts = {(r["kind"], r["canonical"]): r["attempt"] for r in found.collect()}
    made = {surrogates.surrogate(b"k", *e, attempts.get(e, 0)) for e in rows}
    assert len(made) == len(rows) and not made & {c for _, c in rows}


@pytest.mark.parametrize("kind, original, canonical", [
    ("phone", "+49 30 1234", "+49301234"), ("card", "4111-1111-1111-1111", "4111111111111111"), ("ip", "1.2.3.4", "1.2.3.4"), ("secret", "abc", "abc")])
def test_later_attempts_are_longer_and_of_their_kind(kind, original, canonical):
    first, late = (surrogates.surrogate(b"k", kind, canonical, n) for n in (0, 2 * surrogates.LENGTHEN))
    assert len(late) > len(first)
    shown = surrogates.written(kind, original, late)
    if kind in ("phone", "card"):
        assert "".join(c for c in shown if c.isdigit()) == late.lstrip("+")
    if kind == "card":
        assert surrogates.luhn(late)


def test_columns_of_any_name_stay_where_ids_repeat(spark):
    names = ["_id", "_digest", "_stays", "_of", "doc_id", "text", "batch", "sha"]
    rows = [("mongo-1", "d", "s", "o", 1, "same text", 5, "x"), ("mongo-2", "d", "s", "o", 2, "SAME text", 5, "x"),
            ("mongo-3", "d", "s", "o", 2, "other", 5, "x"), ("mongo-4", "d", "s", "o", None, "third", 5, "x")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n in ('doc_id', 'batch') else 'string'}" for n in names))
    kept = exact.keep_one(df, crc_of("doc_id") % 2, 2)
    assert kept.columns == names
    assert sorted(r["_id"] for r in kept.collect()) == ["mongo-2", "mongo-3", "mongo-4"]


def test_more_incoming_digests_than_the_snapshot_has_are_dealt_out(spark, monkeypatch):
    """An empty first batch, then many: no group of the screen holds more than its share."""
    df = spark.createDataFrame([(i, f"text {i % 700}", 1 if i else 0) for i in range(1000)], "doc_id long, text string, b int")
    groups = []
    deal = exact.Snapshot.screened

    def seen(self, incoming):
        groups.append(-(-incoming.count() // (self.buckets * self.per_bucket)))
        return deal(self, incoming)

    monkeypatch.setattr(exact.Snapshot, "screened", seen)
    found = exact.exact_duplicates(df, F.col("b"), 2, per_bucket=10).collect()
    assert groups[0] >= 70
    assert len(found) == 1000 and sum(r["kept"] for r in found) == 700


WORDS = " ".join(f"word{i}" for i in range(60))
NEAR = [f"{WORDS} tail{k}" for k in range(4)]


@pytest.mark.parametrize("ids, want", [
    ((1, 5, 7, 9), {1: (3, 1), 5: (3, 1), 7: (3, 1), 9: (3, 1)}),
    ((None, 5, None, 9), {None: (3, 5), 5: (3, 5), 9: (3, 5)}),
    ((None, None, None, None), {None: (3, None)})])
def test_missing_ids_lose_no_links(spark, ids, want):
    rows = [*zip(ids, NEAR), (40, "something else entirely that stands alone here"), (None, "another text that stands for itself too")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r for r in jaccard.jaccard_join(df).collect() if r["n_links"]]
    assert len(found) == 4
    assert all((r["n_links"], r["group_id"]) == want[r["doc_id"]] for r in found)


def test_near_copies_go_by_row_where_ids_repeat_or_are_missing(spark):
    rows = [(3, NEAR[0], "a"), (5, NEAR[1], "b"), (5, "a clean text of its own under the same id five", "c"), (None, NEAR[2], "d"),
            (None, "clean words without any id at all stand here", "e"), (3, "also a clean text that shares the id three", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["_id"] for r in kept.collect()) == ["a", "c", "e", "f"]
    unnamed = spark.createDataFrame([(None, t, str(i)) for i, t in enumerate(NEAR)], "doc_id long, text string, _id string")
    assert corpus_pipeline.ngram_jaccard_join(spark, unnamed, "").count() == 1
    assert corpus_pipeline.ngram_jaccard_join(spark, docs.limit(0), "").collect() == []


def test_the_curve_is_found_where_the_evidence_nearly_separates():
    """Whole Newton steps jump to and fro on such rows; the loss must be at its least all the same."""
    for seed in range(12):
        draw = np.random.default_rng(seed)
        y = (draw.random(3000) < 0.1).astype(float)
        best = np.where(y == 1, 30, np.clip(draw.gumbel(size=3000), -5, 30))
        total = np.where(y == 1, draw.normal(5.5, 0.8, 3000), np.abs(draw.normal(0, 0.8, 3000)) * (draw.random(3000) < 0.3))
        odd = draw.random(3000) < 0.002
        best[odd], total[odd] = 30, 6
        x = np.stack([best, total], axis=1)
        w = toxicity._logistic(x, y)
        p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
        assert ((p > 0.5) == (y == 1)).mean() > 0.99
        slope = np.hstack([np.ones((3000, 1)), x]).T @ (y - p) - np.array([1e-6, 0.05, 0.05]) * w
        assert np.abs(slope).max() < 1e-3
