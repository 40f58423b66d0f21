from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweave.operators.ordered import (
    Pieces, exact_quantiles, order_statistics, plan_pieces, previous_values, quantiles, ranked, running_sums,
)


@pytest.fixture(scope="module")
def skewed(spark):
    # a third of the rows share one key, and half of those one order value
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 7}", 5 if i % 6 == 0 else (i * 7919) % 101, (i * 31) % 997) for i in range(900)]
    return spark.createDataFrame(rows, "id long, k string, x long, v long")


def test_pieces_follow_order_and_tie_break(spark, skewed):
    pieces = plan_pieces(skewed, F.col("x"), F.col("id"), rows_per_piece=40)
    assert pieces.edges and pieces.heavy == (5.0,) and pieces.tie_edges
    placed = skewed.select("x", "id", pieces.index(F.col("x"), F.col("id")).alias("p")).collect()
    in_order = sorted(placed, key=lambda r: (r["x"], r["id"]))
    assert [r["p"] for r in in_order] == sorted(r["p"] for r in in_order)
    sizes = np.unique([r["p"] for r in placed], return_counts=True)[1]
    assert sizes.max() < 120  # the heavy value alone has 150 rows


def test_many_pieces_are_sketched_again_and_looked_up_in_two_steps(spark):
    df = spark.range(4000).select("id", (F.col("id") * 7919 % 4000).alias("x"), F.lit(None).cast("string").alias("g"))
    pieces = plan_pieces(df, F.col("x"), rows_per_piece=4)
    assert 600 < len(pieces.edges) <= 1000
    got = ranked(df, ["g"], F.col("x"), "id", "rank", pieces).collect()
    assert all(r["rank"] == r["x"] + 1 for r in got)


def test_small_tables_get_one_plain_window(skewed):
    assert plan_pieces(skewed, F.col("x")) == Pieces()


def test_rank_in_pieces_equals_a_plain_window(skewed):
    plain = Window.partitionBy("k").orderBy(F.desc("x"), "id")
    want = skewed.withColumn("rank", F.row_number().over(plain))
    for pieces in (Pieces(), plan_pieces(skewed, -F.col("x"), F.col("id"), rows_per_piece=40)):
        got = ranked(skewed, ["k"], -F.col("x"), "id", "rank", pieces)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rank_puts_missing_orders_last_in_pieces(spark):
    df = spark.createDataFrame([(i, "k", None if i % 5 == 0 else i) for i in range(50)], "id long, k string, x long")
    plain = {r["id"]: r["rank"] for r in ranked(df, ["k"], -F.col("x"), "id").collect()}
    cut = Pieces((-40.0, -20.0, -10.0))
    assert {r["id"]: r["rank"] for r in ranked(df, ["k"], -F.col("x"), "id", "rank", cut).collect()} == plain
    assert plain[49] == 1 and plain[0] == 41 and plain[45] == 50


def test_previous_value_in_pieces_equals_a_plain_window(skewed):
    plain = Window.partitionBy("k").orderBy("x", "id")
    want = skewed.withColumn("previous", F.lag("v").over(plain))
    for pieces in (Pieces(), plan_pieces(skewed, F.col("x"), F.col("id"), rows_per_piece=40)):
        got = previous_values(skewed, ["k"], F.col("x"), "id", "v", "previous", pieces)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_running_sums_with_null_groups(spark):
    rows = [(None if i % 2 else "g", i, i % 5, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, x int, a long, b long")
    plain = running_sums(df, ["g"], "x", ["a", "b"], Pieces())
    cut = running_sums(df, ["g"], "x", ["a", "b"], Pieces((10.0, 30.0, 55.0)))
    assert plain.columns == cut.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))
    whole = running_sums(df, [], "x", ["a"], Pieces((30.0,))).orderBy("x").collect()
    assert [r["cum_a"] for r in whole] == list(np.cumsum([i % 5 for i in range(60)]))
    assert {r["tot_a"] for r in whole} == {sum(i % 5 for i in range(60))}


@pytest.mark.parametrize("cap,fanout", [(1_000_000, 128), (25, 4), (100, 16)])
def test_quantiles_equal_numpy_at_any_cap(spark, cap, fanout):
    rng = np.random.default_rng(3)
    x = rng.normal(size=1500).round(6)
    ties = np.where(rng.random(1500) < 0.4, 2.0, rng.integers(0, 9, 1500)).astype(float)
    rows = [(float(a), float(b), None, float("nan") if i % 10 == 0 else float(a)) for i, (a, b) in enumerate(zip(x, ties))]
    df = spark.createDataFrame(rows, "x double, ties double, empty double, holes double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.731, 1.0]
    got = exact_quantiles(df, ["x", "ties", "empty", "holes"], probs, cap, fanout)
    assert got["empty"] is None
    assert np.allclose(got["x"], np.quantile(x, probs), atol=1e-12)
    assert np.allclose(got["ties"], np.quantile(ties, probs), atol=1e-12)
    assert np.allclose(got["holes"], np.quantile(x[np.arange(1500) % 10 != 0], probs), atol=1e-12)


def test_order_statistics_of_one_repeated_value(spark):
    df = spark.createDataFrame([(4.0,)] * 200, "x double")
    assert order_statistics(df, {"x": [0, 199]}, {"x": 200}, cap=10, fanout=4) == {("x", 0): 4.0, ("x", 199): 4.0}


def test_sketched_quantiles(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("e"))
    got = quantiles(df, ["x", "e"], [0.0, 0.5, 1.0], accuracy=1000)
    assert got["e"] is None and got["x"][0] == 0.0 and got["x"][2] == 1000.0
    assert got["x"][1] == pytest.approx(500, abs=5)


def test_ids_that_are_no_numbers_break_ties(spark):
    rows = [(f"g{i % 2}", i // 6, f"id-{i:03d}") for i in range(60)]
    df = spark.createDataFrame(rows, "g string, day int, id string")
    cut = plan_pieces(df, F.col("day"), F.col("id"), rows_per_piece=10)
    assert cut.edges and not cut.tie_edges
