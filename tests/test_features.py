from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from riskweave.functions import risk
from riskweave.functions.time import clock_micros, clock_seconds
from riskweave.operators import features as ft
from riskweave.operators.ordered import Pieces

APP = """SK_ID_CURR long, AMT_ANNUITY double, AMT_INCOME_TOTAL double, AMT_CREDIT double, DAYS_BIRTH int, DAYS_EMPLOYED int"""
HISTORY = """SK_ID_CURR long, CREDIT_ACTIVE string, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double,
    CREDIT_DAY_OVERDUE int"""
PRIOR = "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, AMT_CREDIT double, DAYS_DECISION int"


@pytest.fixture(scope="module")
def app(spark):
    return spark.createDataFrame([
        (1, 1000.0, 12000.0, 24000.0, -3653, -400),
        (2, 1000.0, 0.0, 5000.0, -10000, 300),
        (3, None, 6000.0, 5000.0, -10000, None),
    ], APP)


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame([
        (1, "Active", 100.0, 0.0, 0), (1, "Closed", None, 5.0, 12), (1, None, 300.0, None, 3), (2, "Sold", None, None, 1),
    ], HISTORY)


@pytest.fixture(scope="module")
def prior(spark):
    return spark.createDataFrame([
        (1, 11, "Refused", 10.0, -5), (1, 10, None, 20.0, -5), (1, 12, "Approved", 30.0, -90),
        (2, 21, "Refused", None, -1), (2, 20, "Refused", 7.0, -3), (2, 22, "Approved", 9.0, None),
    ], PRIOR)


def test_ratios_guard_zero_and_missing(app):
    rows = {r["SK_ID_CURR"]: r for r in ft.applicant_ratios(app).collect()}
    assert rows[1]["DTI"] == 1.0 and rows[1]["CREDIT_INCOME_RATIO"] == 2.0
    assert rows[2]["DTI"] is None and rows[2]["CREDIT_INCOME_RATIO"] is None
    assert rows[3]["DTI"] is None
    assert rows[1]["AGE_YEARS"] == pytest.approx(3653 / 365.25)
    assert rows[1]["EMPLOYED_YEARS"] == pytest.approx(400 / 365.25)
    assert rows[2]["EMPLOYED_YEARS"] == 0.0  # a start in the future is floored
    assert rows[3]["EMPLOYED_YEARS"] is None  # and a missing one stays missing


def test_sql_form_gives_the_same_ratios(app):
    cols = ["SK_ID_CURR", "DTI", "CREDIT_INCOME_RATIO", "AGE_YEARS"]
    plain = ft.applicant_ratios(app).select(*cols).orderBy("SK_ID_CURR").collect()
    assert ft.applicant_ratios_sql(app).select(*cols).orderBy("SK_ID_CURR").collect() == plain
    assert app.sparkSession.catalog.listTables() == []


def test_feature_table(app, history, prior):
    rows = {r["SK_ID_CURR"]: r for r in ft.applicant_features(app, history, prior).collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert (one["BUREAU_CNT"], one["BUREAU_ACTIVE_CNT"], one["BUREAU_DEBT_MEAN"]) == (3, 1, 200.0)
    assert (one["BUREAU_OVERDUE_SUM"], one["BUREAU_MAX_DAYS_OVERDUE"]) == (5.0, 12)
    assert one["PREV_CNT"] == 3 and one["PREV_REFUSED_RATE"] == pytest.approx(1 / 3)
    assert one["PREV_LAST_AMT_CREDIT"] == 20.0  # same day: the smaller id
    assert two["PREV_LAST_AMT_CREDIT"] is None  # the latest row's amount, missing as it is
    assert two["BUREAU_OVERDUE_SUM"] == 0.0  # sum over nothing but missing values, filled
    assert two["BUREAU_DEBT_MEAN"] is None
    for name, zero in ft.ZERO_FILLED.items():
        assert three[name] == zero
    assert three["BUREAU_DEBT_MEAN"] is None and three["PREV_LAST_AMT_CREDIT"] is None


def test_absent_tables_skip_their_join(app, prior):
    only = ft.applicant_features(app, None, prior)
    assert "PREV_CNT" in only.columns and "BUREAU_CNT" not in only.columns
    assert "PREV_CNT" not in ft.applicant_features(app).columns


def test_latest_amount_can_skip_missing_amounts(prior):
    rows = dict(ft.prior_aggregates(prior, ignore_nulls=True).select("SK_ID_CURR", "PREV_LAST_AMT_CREDIT").collect())
    assert rows == {1: 20.0, 2: 7.0}


def test_recency_rank_breaks_ties_by_id_and_puts_missing_days_last(prior):
    rows = {(r["SK_ID_CURR"], r["SK_ID_PREV"]): r["recency_rank"] for r in ft.recency_ranks(prior).collect()}
    assert rows == {(1, 10): 1, (1, 11): 2, (1, 12): 3, (2, 21): 1, (2, 20): 2, (2, 22): 3}


def test_model_features_keep_group_order(app):
    assert ft.model_features(ft.applicant_ratios(app)) == [
        "DTI", "AMT_ANNUITY", "CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AGE_YEARS", "EMPLOYED_YEARS"]


def test_statistics_come_from_the_training_rows(spark):
    train = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None), (None, None), (float("nan"), None)], "x double, e double")
    test = spark.createDataFrame([(None, None), (1e9, 1.0), (float("nan"), None)], "x double, e double")
    medians = ft.fit_medians(train, ["x", "e"])
    assert medians == {"x": 2.0, "e": None}
    assert [tuple(r) for r in ft.impute(test, medians).collect()] == [(2.0, None), (1e9, 1.0), (2.0, None)]
    stats = ft.fit_standardizer(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"])
    assert stats == {"x": (2.0, 1.0)}
    out = ft.standardize(spark.createDataFrame([(5.0,), (2.0,)], "x double"), stats).collect()
    assert out[0]["x"] == pytest.approx(3.0, abs=1e-6) and out[1]["x"] == 0.0


def test_sketched_median_is_close(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("x"))
    assert ft.fit_medians(df, ["x"], accuracy=1000)["x"] == pytest.approx(5000, abs=30)


def test_transaction_rules(spark):
    df = spark.createDataFrame([("TRANSFER", 96.0, 100.0), ("PAYMENT", 95.0, 100.0), ("CASH_OUT", 200_001.0, 1e7)],
                               "type string, amount double, old double")
    rows = df.select(risk.is_risky_type("type"), risk.drains_account("amount", "old"), risk.is_large("amount")).collect()
    assert [tuple(r) for r in rows] == [(True, True, False), (False, False, False), (True, False, True)]


def test_small_expressions(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (None,)], "p double")
    clipped = [r[0] for r in df.select(risk.clip_probability("p")).collect()]
    assert clipped == [1e-6, 0.5, 1 - 1e-6, None]
    iv = spark.createDataFrame([(x,) for x in (0.0, 0.02, 0.1, 0.3, 0.5, None)], "iv double")
    assert [r[0] for r in iv.select(risk.iv_strength("iv")).collect()] == [
        "not predictive", "weak", "medium", "strong", "suspiciously strong", None]
    edges = [1.0, 2.0, 5.0, 8.0]
    values = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 7.0, 8.0, 9.0)], "x double")
    assert [r[0] for r in values.select(risk.step_index(F.col("x"), edges)).collect()] == [0, 0, 1, 1, 3, 3, 4]


@pytest.mark.parametrize("n", [0, 1, 31, 33, 100, 1500])
def test_step_index_with_any_number_of_edges(spark, n):
    edges = [i * 0.5 for i in range(n)]
    df = spark.range(-2, n + 2).select((F.col("id") / 2).alias("x"))
    for x, k in df.select("x", risk.step_index(F.col("x"), edges)).collect():
        assert k == sum(e < x for e in edges)


def test_clock_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:15.250001' AS ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found.add(tuple(df.select(clock_seconds("ts"), clock_micros("ts")).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {(1710037815, 1710037815250001)}


def _events(spark):
    # one user has a third of all rows, with many in the same second
    rows = [(i, 7 if i % 3 == 0 else i % 11, (i * i * 37) % 4000 // (5 if i % 3 == 0 else 1), "abc"[i % 7 % 3]) for i in range(600)]
    return spark.createDataFrame(rows, "id long, user long, t long, state string"), rows


@pytest.mark.parametrize("pieces", [Pieces(), Pieces((1000.0, 3000.0)), Pieces((50.0, 100.0, 1500.0), (100.0,))])
def test_rolling_count_matches_brute_force(spark, pieces):
    df, rows = _events(spark)
    marks = Pieces(tuple(2 * e for e in pieces.edges), tuple(2 * e for e in pieces.heavy))
    got = {(r["user"], r["second"]): r["n_recent"]
           for r in ft.rolling_count(df, "user", F.col("t"), 100, pieces=marks).collect()}
    want = {(u, t): sum(1 for _, v, s, _ in rows if v == u and t - 100 <= s <= t) for _, u, t, _ in rows}
    assert got == want


@pytest.mark.parametrize("pieces", [Pieces(), Pieces((50.0, 1000.0), (50.0,), (100.0, 300.0))])
def test_transitions_match_brute_force(spark, pieces):
    df, rows = _events(spark)
    want: dict = {}
    for user in {r[1] for r in rows}:
        states = [s for _, _, s in sorted((t, i, s) for i, u, t, s in rows if u == user)]
        for pair in zip(states, states[1:]):
            want[pair] = want.get(pair, 0) + 1
    got = ft.transition_matrix(df, "user", F.col("t"), "id", "state", pieces).collect()
    assert {(r["previous"], r["current"]): r["n"] for r in got} == want
    for state in "abc":
        assert math.isclose(sum(r["share"] for r in got if r["previous"] == state), 1.0)
