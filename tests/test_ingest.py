"""Incremental ingest, the run log and questions of one or two tokens."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from riskweave.catalogue.inputs import gold_sources
from riskweave.operators.chunking import chunk_corpus
from riskweave.session import work_folder
from riskweave.sources.commits import read_entry, versions
from riskweave.sources.runlog import append_run, compact_runs, read_runs
from riskweave.streaming import ingest as ig


def changes(spark, *rows):
    return spark.createDataFrame(rows, ig.CHANGES)


def stored(spark, store):
    return {(r["source"], r["ordinal"]): r["text"] for r in ig.read_store(spark, store).collect()}


def test_stream_of_files_keeps_the_store_up_to_date(spark):
    arrivals, store, checkpoint = (work_folder(spark, n) for n in ("in", "store", "checkpoint"))
    long = "A sentence that fills the chunk. " * 60

    def arrive(*rows):
        changes(spark, *rows).coalesce(1).write.mode("append").parquet(arrivals)
        ig.ingest(ig.read_changes(spark, arrivals), store, checkpoint, buckets=4).awaitTermination()

    arrive(("a", 1, long), ("b", 1, "Short b."), ("c", 1, "Short c."), (None, 1, "nobody's"))
    want = {(r["source"], r["ordinal"]): r["text"] for r in chunk_corpus(changes(spark, ("a", 1, long), ("b", 1, "Short b."), ("c", 1, "Short c."))).collect()}
    assert stored(spark, store) == want and len([k for k in want if k[0] == "a"]) > 2
    arrive(("a", 2, "Now short."), ("b", 2, None), ("c", 2, "Short c."), ("d", 5, "One."), ("d", 7, "Two."), ("d", 6, None))
    assert stored(spark, store) == {("a", 0): "Now short.", ("c", 0): "Short c.", ("d", 0): "Two."}
    # changes that come late are older than what is stored, deletions too
    arrive(("b", 1, "Back again."), ("d", 6, "Late."), ("c", 1, None))
    assert stored(spark, store) == {("a", 0): "Now short.", ("c", 0): "Short c.", ("d", 0): "Two."}
    arrive(("b", 3, "Back again."))
    assert stored(spark, store)[("b", 0)] == "Back again."


def test_a_batch_that_is_run_again_changes_nothing_and_old_versions_stay(spark):
    store = work_folder(spark, "store")
    ig.apply_changes(changes(spark, ("a", 1, "First.")), 0, store, buckets=3)
    ig.apply_changes(changes(spark, ("a", 2, "Second."), ("b", 1, "Other.")), 1, store, buckets=3)
    before = read_entry(spark, f"{store}/manifests")[1]
    ig.apply_changes(changes(spark, ("a", 9, "Not applied.")), 1, store, buckets=3)
    assert read_entry(spark, f"{store}/manifests")[1] == before
    assert {r["text"] for r in ig.read_store(spark, store, 1).collect()} == {"First."}
    # a text that stays doesn't touch the chunks
    ig.apply_changes(changes(spark, ("a", 3, "Second.")), 2, store, buckets=3)
    after = read_entry(spark, f"{store}/manifests")[1]
    assert after["chunks"] == before["chunks"] and after["sources"] != before["sources"]


def test_a_text_is_shuffled_and_stored_once(spark, monkeypatch):
    """Changes meet the known sources in one exchange by bucket, old chunks the altered ones in another; texts that stay as they were end there."""
    store, stored, materialize = work_folder(spark, "chunk-store"), [], ig.materialize
    monkeypatch.setattr(ig, "materialize", lambda df, name: stored.append((name, df._jdf.queryExecution().executedPlan().toString())) or materialize(df, name))
    ig.apply_changes(changes(spark, ("a", 1, "First."), ("b", 1, "Other."), ("c", 1, "Goes.")), 0, store, buckets=3)
    ig.apply_changes(changes(spark, ("a", 2, "Second."), ("b", 2, "Other."), ("c", 2, None), ("d", None, "No number.")), 1, store, buckets=3)
    assert [name for name, _ in stored] == ["newer-changes"] * 2
    assert all(plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1 for _, plan in stored)
    assert sorted((r["source"], r["text"]) for r in ig.read_store(spark, store).collect()) == [("a", "Second."), ("b", "Other."), ("d", "No number.")]
    known = spark.createDataFrame([("b", 1, "x", 0)], "source string, number long, digest string, bucket int")
    arrived = changes(spark, ("b", 2, "Other."), ("b", 2, "Other."), ("e", 3, "low"), ("e", 3, "same number"), ("e", 2, "z")).withColumn("bucket", F.lit(0))
    got = {r["source"]: r for r in ig._newer(arrived, known, 2).collect()}
    assert got["b"]["text"] == "Other." and (got["e"]["number"], got["e"]["text"]) == (3, "same number") and len(got) == 2
    same = known.withColumn("digest", F.lit(got["b"]["digest"]))
    assert {r["source"]: r["text"] for r in ig._newer(arrived, same, 2).collect()} == {"b": None, "e": "same number"}


def test_two_streams_at_once_lose_nothing(spark):
    store = work_folder(spark, "store")
    rows = {name: [(f"{name}{i}", 1, f"Text {name} {i}.") for i in range(6)] for name in "xy"}
    threads = [threading.Thread(target=ig.apply_changes, args=(changes(spark, *rows[n]), 0, store, n, 3)) for n in "xy"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert {s for s, _ in stored(spark, store)} == {f"{n}{i}" for n in "xy" for i in range(6)}


def test_run_log_with_writers_at_once_and_compaction(spark):
    path = work_folder(spark, "runs")
    assert read_runs(spark, path).collect() == [] and compact_runs(spark, path) == 0
    threads = [threading.Thread(target=append_run, args=(spark, path, "e", f"r{i}", {"p": i}, {"m": i / 2, "none": None})) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    want = sorted(tuple(r) for r in read_runs(spark, path).collect())
    assert len(want) == 18 and {r[1] for r in want} == {f"r{i}" for i in range(6)}
    assert compact_runs(spark, path) == 6
    assert sorted(tuple(r) for r in read_runs(spark, path).collect()) == want
    append_run(spark, path, "e", "later", {"p": 1})
    assert len(read_runs(spark, path).inputFiles()) == 2 and read_runs(spark, path).count() == 19
    assert compact_runs(spark, path) == 7 and read_runs(spark, path).count() == 19 and len(versions(spark, f"{path}/log")) == 7


def test_gold_of_passages_of_any_length(spark, tmp_path):
    texts = ["The quick brown fox jumps over the lazy dog today.", "Stop! A tiny note.", "foxes", "", None, "Nothing here (really) at all."]
    asked = ["fox", "tiny note", "Stop!", "(really)", "!", "quick brown fox jumps over the lazy dog", "brown fox jumps", "absent words", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {(i, str(j)) for i, a in enumerate(asked) for j, t in enumerate(texts) if a and t and a in t}
    assert {(r["query_id"], r["source"]) for r in gold_sources(spark, str(tmp_path)).collect()} == want
    assert gold_sources(spark, str(tmp_path)).where(F.col("source").isNull()).count() == 0
