"""Events that arrive in files, against the batch operators over all of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators import features as ft
from riskweave.session import work_folder
from riskweave.streaming import history as hs

SCHEMA = "user_id long, ts timestamp, event_id long, event_type string"


@pytest.fixture
def store(spark):
    spark.conf.set(*hs.STATE_STORE)
    yield
    spark.conf.unset(hs.STATE_STORE[0])


def run(spark, folder, out, checkpoint):
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder)
    hs.follow(events, "user_id", "ts", "event_id", "event_type", 600, out, checkpoint, "10 minutes").awaitTermination()


def test_stream_equals_the_batch_and_goes_on_after_a_restart(spark, store):
    folder, out, checkpoint = (work_folder(spark, n) for n in ("events", "followed", "checkpoint"))
    second = (F.col("id") * 37 % 4000).cast("long")
    kinds = F.array(*[F.lit(k) for k in ("view", "click", "buy")])
    events = spark.range(900).select(
        (F.col("id") * F.col("id") % 7).alias("user_id"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + second * 1_000_000 + F.col("id") % 3 * 1000).alias("ts"),
        F.col("id").alias("event_id"), F.element_at(kinds, (F.col("id") % 3 + 1).cast("int")).alias("event_type"), second.alias("s"))
    # files overlap in time by less than the delay
    for part in range(4):
        within = (F.col("s") + F.col("event_id") % 2 * 300 >= part * 1000) & (F.col("s") + F.col("event_id") % 2 * 300 < part * 1000 + (9999 if part == 3 else 1000))
        events.where(within).drop("s").coalesce(1).write.mode("append").parquet(folder)
        if part in (1, 2):
            run(spark, folder, out, checkpoint)
    spark.createDataFrame([(None, None, None)], "user_id long, event_id long, event_type string").withColumn(
        "ts", F.timestamp_micros(F.lit(1_700_100_000_000_000))).select("user_id", "ts", "event_id", "event_type").write.mode("append").parquet(folder)
    run(spark, folder, out, checkpoint)
    found = spark.read.parquet(out)
    seconds = F.unix_seconds("ts")
    want = {(r["user_id"], r["second"], r["n_recent"]) for r in ft.rolling_count(events, "user_id", seconds, 600).collect()}
    got = [(r["user_id"], r["second"], r["n_recent"]) for r in hs.counts_of(found, "user_id").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    moves = ft.transition_matrix(events, "user_id", F.unix_micros("ts"), "event_id", "event_type")
    tidy = lambda df: sorted((r["previous"], r["current"], r["n"], round(r["share"], 9)) for r in df.collect())
    assert tidy(hs.transitions_of(found)) == tidy(moves)
    # what is later than the delay is dropped
    events.limit(1).drop("s").write.mode("append").parquet(folder)
    run(spark, folder, out, checkpoint)
    assert spark.read.parquet(out).count() == found.count()
