"""Physical plans: what is scanned, shuffled and run in Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from riskweave.catalogue import inputs
from riskweave.operators import features as ft
from riskweave.operators import metrics as mt
from riskweave.operators import reasons as rs
from riskweave.operators import retrieval as rt
from riskweave.operators import woe
from riskweave.operators.chunking import chunk_corpus
from riskweave.operators.ordered import Pieces, ranked


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_job_stays_in_the_engine_and_reads_only_its_columns(spark, tables):
    plan = _plan(inputs.feature_table(spark, tables))
    assert "Python" not in plan and "Pandas" not in plan
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert set(re.findall(r"l_\w+(?=#)", lineitem)) == {
        "l_orderkey", "l_linestatus", "l_extendedprice", "l_returnflag", "l_tax", "l_quantity"}
    assert "o_orderpriority" not in plan  # all orders are read, without the columns that nothing needs


def test_latest_amount_needs_no_window_or_sort_per_applicant(spark, tables):
    plan = _plan(ft.prior_aggregates(inputs.prior(spark, tables)))
    assert "Window" not in plan and plan.count("Exchange") == 1


def test_aggregates_are_combined_before_the_shuffle(spark, tables):
    plan = _plan(ft.history_aggregates(inputs.history(spark, tables)))
    assert "partial_count" in plan and "partial_max" in plan


@pytest.mark.parametrize("build", [
    lambda df, p: mt.cumulative_distribution(mt.score_histogram(df, "y", "s"), pieces=p),
    lambda df, p: ft.recency_ranks(df, ft.PriorColumns("k", "id", "s", "s", "s"), pieces=p),
])
def test_ordered_windows_in_pieces_never_sort_a_whole_group(spark, build):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("y"), (F.col("id") / 7).alias("s"), F.lit(1).alias("k"))
    plan = _plan(build(df, Pieces((20.0, 60.0, 100.0))))
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    assert any("_piece" in line.split("windowspec")[-1] or "_piece" in line for line in windows)
    row_level = [line for line in windows if "row_number" in line or "_cum_" in line]
    assert row_level and all("_piece" in line for line in row_level)


def test_pieces_cost_one_shuffle_of_the_rows(spark, tables):
    """The join with the offsets keeps the partitioning of the window below it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet(f"{tables}/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice")
        plan = _plan(ranked(df, ["o_custkey"], F.col("o_totalprice"), "o_orderkey", pieces=Pieces((1e5, 2e5))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    window = plan.index("row_number")
    join = plan.index("SortMergeJoin")
    assert join < window and "Exchange" not in plan[join:window]


def test_all_features_share_one_grouping(spark, tables):
    lines = inputs.returned_lines(spark, tables)
    edges = {c: [0.0, 10.0, 20.0, 60.0] for c in ("l_quantity", "l_discount", "l_tax")}
    plan = _plan(woe.woe_tables(lines, "returned", edges, ["l_linestatus"]))
    assert "Subquery" not in plan and plan.count("Location") <= 1  # class totals come from the bins
    main = plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(feature[^)]*bin_index", main)) <= 1  # the rows; then only bins move


def test_reasons_need_no_shuffle(spark, tables):
    contributions = inputs.table(spark, tables, "customer").select(
        F.col("c_custkey").alias("SK_ID_CURR"), F.col("c_acctbal").alias("AMT_CREDIT"), F.col("c_acctbal").alias("DTI"))
    for df in (rs.reason_codes(contributions, "SK_ID_CURR"), rs.notices(contributions, "SK_ID_CURR")):
        plan = _plan(df)
        assert "Exchange" not in plan and "Python" not in plan


def test_retrieval_shuffles_hits_not_chunks(spark, tables):
    asked = inputs.passages(spark, tables).select("query_id", F.col("question").alias("query"))
    plan = _plan(rt.top_k_sparse(asked, chunk_corpus(inputs.corpus(spark, tables))))
    assert plan.count("Exchange") == 1 and "hashpartitioning(query_id" in plan
    assert "Join" not in plan and "WindowGroupLimit" in plan
    assert plan.index("Exchange") < plan.index("MapInArrow")  # the exchange lies above the scan of chunks


def test_scores_of_a_scorecard_run_in_generated_code(spark, tables):
    bins = woe.FittedBins({"x": [1.0, 2.0]}, {"x": [0.1, 0.2, 0.3]}, {})
    plan = _plan(spark.range(10).select((F.col("id") / 3).alias("x")).select(bins.column("x").alias("w")))
    assert "Python" not in plan and "Exchange" not in plan
