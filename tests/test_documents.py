from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import md5

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave.functions import text as tx
from riskweave.operators import answering as an
from riskweave.operators import chunking as ck
from riskweave.operators import reteval as rv
from riskweave.operators import retrieval as rt
from riskweave.plans.retrieval_report import build_index, evaluate, export_chunk_store

# --------------------------------------------------------------------------- chunks


def test_full_windows_without_any_boundary():
    chunks = ck.split_text("q" * 2000, size=300, overlap=40)
    assert [len(c) for c in chunks] == [300] * 7 + [180]


@pytest.mark.parametrize("text,want", [
    ("", []), (None, []), ("  \n ", []), (" a ", ["a"]), ("x" * 800, ["x" * 800]), ("a\n\n\n\n\nb", ["a\n\nb"]),
])
def test_short_texts(text, want):
    assert ck.split_text(text) == want


def test_a_boundary_inside_the_overlap_is_passed_over_unless_asked():
    text = "Short. " + "y" * 2000
    assert [len(c) for c in ck.split_text(text)] == [800, 800, 707]
    crawling = ck.split_text(text, crawl=True)
    assert crawling[0] == "Short." and len(crawling) > 4


def test_sequential_matches_decide_the_end():
    # ".\n" is taken first, so the blank line after it is not a boundary of its own
    text = "z" * 300 + ".\n\n" + "w" * 900
    first = ck.split_text(text)[0]
    assert first == "z" * 300 + "."
    assert ck.split_text(text)[1].startswith("z" * 148)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .!?\né", max_size=400), st.integers(5, 60), st.integers(0, 12), st.booleans())
def test_chunk_limits_follow_the_rule(text, size, overlap, crawl):
    overlap = min(overlap, size - 1)
    limits = list(ck.chunk_limits(text, size, overlap, crawl))
    assert limits[0][0] == 0 and limits[-1][1] == len(text)
    for (a, b), (c, d) in zip(limits, limits[1:]):
        assert c == max(b - overlap, a + 1) and a < b <= a + size and len(text) - a > size
        ends = [m.end() for m in re.finditer(r"[.!?]\s|\n\n", text[a:a + size])]
        assert b - a == (ends[-1] if ends and (crawl or ends[-1] > overlap) else size)
    assert len(text) - limits[-1][0] <= size


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .!?\né", max_size=400), st.integers(5, 60))
def test_chunks_are_parts_of_the_text_and_lose_nothing(text, size):
    chunks = ck.split_text(text, size, 3)
    assert all(c in re.sub(r"\n{3,}", "\n\n", text) and len(c) <= size for c in chunks)
    kept = Counter("".join(chunks).replace(" ", "").replace("\n", ""))
    assert not Counter(re.sub(r"\s", "", text)) - kept


def test_chunk_table_statistics_and_sanity(spark):
    docs = spark.createDataFrame([("a.md", "One. " * 400), ("b.md", ""), ("c.md", "tiny"), ("d.md", None)], "source string, text string")
    chunks = ck.chunk_corpus(docs)
    ids = [r["id"] for r in chunks.orderBy("source", "ordinal").collect()]
    assert ids == [f"a.md::{i}" for i in range(len(ids) - 1)] + ["c.md::0"]
    assert tuple(ck.index_stats(chunks).first()) == (len(ids), 2)
    assert tuple(ck.index_stats(chunks.where("1 = 0")).first()) == (0, 0)
    assert all(r["ok"] for r in ck.chunk_sanity(chunks).collect())
    short = spark.createDataFrame([("x", 0, "s"), ("x", 1, "y" * 200)], "source string, ordinal int, text string")
    assert ck.chunk_sanity(short).first()["n_short"] == 1


# --------------------------------------------------------------------------- tokens and vectors


def test_tokens_are_ascii_runs_of_the_lower_cased_text(spark):
    df = spark.createDataFrame([("Zé2 don't, A-B a",), ("",), (None,)], "t string")
    rows = df.select(tx.tokens("t").alias("t"), tx.token_set("t").alias("s")).collect()
    assert rows[0]["t"] == ["z", "2", "don", "t", "a", "b", "a"] and rows[0]["s"] == ["z", "2", "don", "t", "a", "b"]
    assert rows[1]["t"] == [] and rows[2]["t"] is None


def test_space_is_stripped_like_any_unicode_space(spark):
    df = spark.createDataFrame([(" \t a b \n",)], "t string")
    assert df.select(tx.strip_space(F.col("t"))).first()[0] == "a b"
    split = spark.createDataFrame([("One.  Two!\nThree? four.",)], "t string").select(tx.sentences("t")).first()[0]
    assert split == ["One.", "Two!", "Three?", "four."]


def _bag(text: str) -> np.ndarray:
    out = np.zeros(256)
    for token in re.findall(r"[a-z0-9]+", text.lower()):
        out[md5(token.encode()).digest()[0]] += 1
    return out


TEXTS = [f"alpha beta w{i % 5} {'gamma ' * (i % 3)} doc {i % 7}" for i in range(40)] + ["", "!!!", "alpha beta"] * 2


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(f"d{i}", f"s{i % 4}", i, 0, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id string, source string, corpus_order int, ordinal int, text string").repartition(5)


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(1, "alpha beta"), (2, "gamma gamma w3"), (3, "unknownword"), (4, ""), (5, "doc 6 alpha alpha")]
    return spark.createDataFrame(rows, "query_id long, query string")


def test_embedding(spark, corpus):
    rows = rt.hash_embed(corpus, "id", "text").collect()
    for i, text in enumerate(TEXTS):
        mine = {r["bucket"]: (r["n"], r["weight"]) for r in rows if r["id"] == f"d{i}"}
        bag = _bag(text)
        norm = math.sqrt((bag**2).sum()) or 1.0
        assert mine == {int(b): (int(bag[b]), pytest.approx(bag[b] / norm)) for b in np.flatnonzero(bag)}


def _ranked(score, k=4):
    return [(i, pytest.approx(s, abs=1e-8)) for s, i in sorted(((round(score(t), 9), i) for i, t in enumerate(TEXTS)),
                                                             key=lambda p: (-p[0], p[1]))[:k]]


def _hits(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((int(r["id"][1:]), r["score"]))
    return out


@pytest.mark.parametrize("block", [2048, 2])
def test_vector_top_k_equals_brute_force(asked, corpus, block):
    got = _hits(rt.top_k_sparse(asked, corpus, block=block))
    for q in asked.collect():
        a = _bag(q["query"])

        def score(text, a=a):
            b = _bag(text)
            return float(a @ b) / ((math.sqrt((a**2).sum()) or 1) * (math.sqrt((b**2).sum()) or 1))

        assert got[q["query_id"]] == _ranked(score)


@pytest.mark.parametrize("block", [2048, 2])
def test_lexical_top_k_equals_brute_force(asked, corpus, block):
    bags = [Counter(re.findall(r"[a-z0-9]+", t.lower())) for t in TEXTS]
    df = Counter(t for b in bags for t in b)
    got = _hits(rt.top_k_lexical(asked, corpus, block=block))
    for q in asked.collect():
        words = re.findall(r"[a-z0-9]+", q["query"].lower())

        def score(text, words=words):
            bag = Counter(re.findall(r"[a-z0-9]+", text.lower()))
            return sum(bag[w] * (math.log((len(TEXTS) + 1) / (df[w] + 1)) + 1) for w in words)

        assert got[q["query_id"]] == _ranked(score)


def test_cell_limit_does_not_change_hits(asked, corpus, monkeypatch):
    want = [_hits(f(asked, corpus)) for f in (rt.top_k_sparse, rt.top_k_lexical)]
    monkeypatch.setattr(rt, "CELL_LIMIT", 300)
    assert [_hits(f(asked, corpus)) for f in (rt.top_k_sparse, rt.top_k_lexical)] == want


@pytest.mark.parametrize("block", [2048, 3])
def test_dense_top_k_equals_brute_force(spark, block):
    rng = np.random.default_rng(4)
    stored = rng.normal(size=(200, 6)).astype("float32")
    stored[7] = 0
    queries = rng.normal(size=(8, 6))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(stored)] + [(999, None)]
    corpus = spark.createDataFrame(rows, "id int, embedding array<float>")
    asked = spark.createDataFrame([(f"q{i}", [float(x) for x in v]) for i, v in enumerate(queries)], "query_id string, vector array<double>")
    got: dict = {}
    for r in rt.top_k_dense(asked, corpus.repartition(4), k=3, block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    for i, q in enumerate(queries):
        norms = np.linalg.norm(stored.astype(float), axis=1)
        cos = stored.astype(float) @ q / (np.where(norms == 0, 1, norms) * np.linalg.norm(q))
        best = np.argsort(-cos, kind="stable")[:3]
        assert [p for p, _ in got[f"q{i}"]] == list(best)
        assert np.allclose([s for _, s in got[f"q{i}"]], cos[best])


def test_nothing_to_search(spark, asked, corpus):
    assert rt.top_k_sparse(asked.where("1 = 0"), corpus).count() == 0
    assert rt.top_k_sparse(asked, corpus.where("1 = 0")).count() == 0
    assert rt.top_k_lexical(asked, corpus.where("1 = 0")).count() == 0


def test_limits_are_known_before_the_scan(spark, monkeypatch):
    """Tasks start from what a sample scores, so most rows enter no task's list; hits stay the same."""
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words[i] for i in draw.integers(0, 300, 12)) for _ in range(1600)]
    corpus = spark.createDataFrame([(i, f"s{i}", t) for i, t in enumerate(texts)], "doc_id long, source string, text string").repartition(4)
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([*texts[:70], "", None])], "query_id long, query string")
    stored = rt.store_counts(corpus, order=["doc_id"], payload=["source"])
    listed = lambda df: sorted((r["query_id"], r["rank"], r["doc_id"], r["source"], r["score"]) for r in df.collect())
    want = listed(rt.search_counts(asked, stored))
    assert [r["_limit"] for r in rt._with_limits(asked, stored, 4, 72).collect()] == [None] * 72
    monkeypatch.setattr(rt, "TILE_QUERIES", 16)
    monkeypatch.setattr(rt, "LIMIT_ROWS", 400)
    limits = {r["query_id"]: r["_limit"] for r in rt._with_limits(asked, stored, 4, 72).collect()}
    fourth = {q: s for q, rank, _, _, s in want if rank == 4}
    assert limits.keys() == fourth.keys() and all(-1 < limits[q] <= fourth[q] for q in limits)
    assert max(limits[q] for q in range(70)) > 0
    assert listed(rt.search_counts(asked, stored)) == want == listed(rt.search_counts(asked, stored, block=20))


def test_words_go_to_the_buckets_of_the_expression(spark):
    rows = spark.createDataFrame([(0, "ab cd ab"), (1, ""), (2, None), (3, "x9 ab")], "id long, text string")
    got = rt._word_counts(rows.select(tx.tokens("text").alias("w")).coalesce(1).toArrow().column(0).combine_chunks())
    want = {(r["id"], r["b"]): r["n"] for r in rows.select("id", F.explode(F.transform(tx.tokens("text"), tx.hash_bucket)).alias("b"))
            .groupBy("id", "b").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {(int(i), int(b)): int(got[i, b]) for i, b in zip(*np.nonzero(got))} == want


# --------------------------------------------------------------------------- answers


def _kept(spark, rows):
    return spark.createDataFrame(rows, "query_id long, rank int, question string, text string, source string")


def test_grading_keeps_relevant_hits_or_all_of_them(spark):
    hits = _kept(spark, [(1, 1, "red green blue", "red and green", "a"), (1, 2, "red green blue", "red red red", "b"),
                         (2, 1, "red", "red green", "a"), (2, 2, "red", "none", "c")])
    rows = an.grade_hits(hits).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["overlap"], r["weak"]) for r in rows] == [
        (1, 1, 2, False), (2, 1, 1, True), (2, 2, 0, True)]


def test_the_best_sentence_answers_and_the_first_wins(spark):
    kept = _kept(spark, [
        (1, 1, "a b c", "Zero here. a b! And a b?", "x"), (1, 2, "a b c", "b a!", "y"),  # equal shares: rank, then place
        (2, 1, "nothing", "\nFirst words. More words.", "x"),  # all zero: the first sentence
        (3, 1, "q", "? ! " + "t" * 400, "x"), (4, 1, "q", "", "x"),
    ])
    answers = {r["query_id"]: r["answer"] for r in an.extract_answers(kept).collect()}
    assert answers[1] == "a b!"
    assert answers[2] == "First words."
    assert answers[3] == "?"
    assert answers[4] == ""


def test_an_empty_sentence_falls_back_to_the_head_of_the_first_hit(spark):
    text = "! " + "é" * 400
    kept = _kept(spark, [(1, 1, "q", " " * 3, "x"), (1, 2, "q", text, "y")])
    assert an.extract_answers(kept).first()["answer"] == " " * 3


def test_grounding_of_supplied_answers(spark):
    kept = _kept(spark, [(1, 1, "q", "red green", "x"), (1, 2, "q", "blue", "x")])
    answers = spark.createDataFrame([
        (1, "Red blue other thing"), (1, "other thing red"), (1, "!!"), (1, "I cannot find red green blue"), (2, "red")],
        "query_id long, answer string")
    rows = {r["answer"]: (round(r["support"], 3), r["grounded"]) for r in an.grade_answers(answers, kept).collect()}
    assert rows["Red blue other thing"] == (0.5, True)
    assert rows["other thing red"] == (0.333, False)
    assert rows["!!"] == (0.0, False)
    assert rows["I cannot find red green blue"] == (0.5, False)
    assert rows["red"] == (0.0, False)


@pytest.fixture(scope="module")
def policy(spark):
    docs = [
        ("notice.md", "An adverse action notice goes out within thirty days. It lists the main reasons."),
        ("privacy.md", "Customer data stays private. The policy requirement for disclosure is yearly."),
        ("income.md", "Income is verified by payslips. Self-employed applicants send tax returns."),
    ]
    return ck.chunk_corpus(spark.createDataFrame(docs, "source string, text string"))


def test_corrective_loop_ends_in_each_of_its_ways(spark, policy):
    asked = spark.createDataFrame([
        (1, "When does an adverse action notice go out?"),
        (2, "Zebra swallow velocity"),
        (3, "!!!"),
    ], "query_id long, question string")
    rows = {r["query_id"]: r for r in an.answer_questions(asked, policy).collect()}
    assert rows[1]["attempts"] == 1 and rows[1]["grounded"]
    assert rows[1]["answer"].startswith("An adverse action notice") and rows[1]["sources"][0] == "notice.md"
    for q in (2, 3):
        assert rows[q]["attempts"] == 3 and not rows[q]["grounded"]
        assert "3 attempt" in rows[q]["answer"] and len(rows[q]["sources"]) == 3
        assert rows[q]["trace"] == ["retrieve 1", "weak", "rewrite", "retrieve 2", "weak", "rewrite", "retrieve 3", "weak", "give up"]


def test_a_rewrite_can_find_what_the_question_did_not(spark, policy):
    """With one hit per attempt, the appended words pull the right passage up."""
    asked = spark.createDataFrame([(1, "private customer applicants")], "query_id long, question string")

    def by_rewrite(queries):
        wanted = F.when(F.col("query").endswith(an.REWRITE_SUFFIX), "privacy.md").otherwise("notice.md")
        hits = queries.withColumn("source", wanted).join(policy.select("source", "text", "id"), "source")
        return hits.select("query_id", F.lit(1).alias("rank"), F.lit(1.0).alias("score"), "id", "source", "text")

    row = an.answer_questions(asked, policy, retrieve=by_rewrite).first()
    assert (row["attempts"], row["grounded"], row["answer"]) == (2, True, "Customer data stays private.")
    assert row["trace"] == ["retrieve 1", "weak", "rewrite", "retrieve 2", "relevant 2"[:-1] + "1", "answer", "grounded"]


@pytest.mark.parametrize("limit,attempts", [(1, 1), (2, 2), (5, 5)])
def test_the_number_of_attempts_is_kept(spark, policy, limit, attempts):
    asked = spark.createDataFrame([(1, "Zebra")], "query_id long, question string")
    row = an.answer_questions(asked, policy, max_attempts=limit).first()
    assert row["attempts"] == attempts and sum(t.startswith("retrieve") for t in row["trace"]) == attempts
    assert row["trace"][-1] == "give up"


# --------------------------------------------------------------------------- evaluation


def test_retrieval_measures(spark):
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "x"), (2, 2, "y"), (2, 3, "b"), (3, 1, "q")],
                                 "query_id long, rank int, source string")
    gold = spark.createDataFrame([(1, "b"), (1, "c"), (2, "b"), (3, "z")], "query_id long, source string")
    ranks = dict(map(tuple, rv.first_relevant_rank(hits, gold, 3).collect()))
    assert ranks == {1: 2, 2: 3, 3: None}
    assert rv.recall_at_k(hits, gold, 2).first()["value"] == pytest.approx(1 / 3)
    assert rv.recall_at_k(hits, gold, 1).first()["value"] == 0.0
    assert rv.mrr(hits, gold, 3).first()["value"] == pytest.approx((1 / 2 + 1 / 3) / 3)
    answers = spark.createDataFrame([(True,), (False,), (True,), (True,)], "grounded boolean")
    assert rv.grounded_share(answers).first()["value"] == 0.75


def test_context_reduction(spark):
    chunks = spark.createDataFrame([("a" * 60,), ("b" * 40,)], "text string")
    hits = spark.createDataFrame([(1, "a" * 10), (1, "a" * 20), (2, "a" * 10)], "query_id long, text string")
    row = rv.context_reduction(hits, chunks).first()
    assert tuple(row) == (100, 20.0, 80.0)
    assert rv.context_reduction(hits, chunks.where("1 = 0")).first()["reduction_pct"] == 0.0


def test_report_and_stores(spark, tmp_path):
    docs = spark.createDataFrame([(f"{i}.md", f"Topic{i} rule about item{i} and price{i}. " * 30) for i in range(6)],
                                 "source string, text string")
    chunks = build_index(docs, str(tmp_path))
    assert export_chunk_store(chunks, str(tmp_path / "store")).count() == chunks.count()
    asked = spark.createDataFrame([(i, f"What about topic{i} item{i}?") for i in range(6)], "query_id long, question string")
    gold = spark.createDataFrame([(i, f"{i}.md") for i in range(6)], "query_id long, source string")
    report = {r["metric"]: r["value"] for r in evaluate(asked, gold, chunks, str(tmp_path)).collect()}
    assert report["recall@4"] >= report["recall@1"] >= 0.4 and 0 < report["mrr@4"] <= 1
    assert report["grounded_share"] == 1.0 and 0 < report["context_reduction_pct"] < 100
    assert spark.read.json(str(tmp_path / "retrieval_report")).count() == 5


def test_blocks_of_queries_share_one_pass_of_tokens(spark, monkeypatch):
    """Many blocks of queries, tiles of few rows, copies and rows without a token give what comparing all pairs gives."""
    draw = np.random.default_rng(11)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(draw.choice(words, draw.integers(0, 9))) for _ in range(300)] + ["w1 w2 w3"] * 60 + [None]
    asked = [(i, " ".join(draw.choice(words, draw.integers(0, 6)))) for i in range(50)] + [(50, "w1 w2 w3"), (51, None)]
    stored_names = []
    kept = rt.materialize
    monkeypatch.setattr(rt, "materialize", lambda df, name: stored_names.append(name) or kept(df, name))
    monkeypatch.setattr(rt, "TILE_ROWS", 32)
    monkeypatch.setattr(rt, "TILE_QUERIES", 8)
    monkeypatch.setattr(rt, "FIRST_ROWS", 4)
    corpus = spark.createDataFrame(list(enumerate(texts)), "corpus_order long, text string").withColumn("ordinal", F.lit(0))
    queries = spark.createDataFrame(asked, "query_id long, query string")
    hits = rt.top_k_sparse(queries, corpus, payload=["text"], k=3, block=10).collect()
    assert stored_names.count("counts") == 1

    def counts(text):
        found = np.zeros(256)
        for t in (text or "").split():
            found[int(md5(t.encode()).hexdigest()[:2], 16)] += 1
        return found

    rows = np.stack([counts(t) for t in texts])
    norms = (rows**2).sum(axis=1)
    norms[norms == 0] = 1
    expected = {}
    for q, text in asked:
        c = counts(text)
        scores = np.round(rows @ c / np.sqrt(max((c**2).sum(), 1) * norms), 9)
        for rank, i in enumerate(np.lexsort((np.arange(len(rows)), -scores))[:3], 1):
            expected[q, rank] = (i, scores[i], texts[i])
    assert {(h["query_id"], h["rank"]): (h["corpus_order"], h["score"], h["text"]) for h in hits} == expected


@pytest.mark.parametrize("step", [
    lambda df: ck.chunk_corpus(df, "source", "text", "doc_id"), lambda df: rt.hash_embed(df, "doc_id", "text"),
    lambda df: rt.top_k_lexical(df.select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), df, order=["doc_id"], payload=["source"]),
])
def test_texts_go_to_python_in_small_batches(spark, step):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "10000")
    df = spark.createDataFrame([(1, "s", "one two. three")], "doc_id long, source string, text string")
    assert step(df).count() and int(spark.conf.get(name)) <= 1000
