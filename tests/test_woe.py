from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions.risk import key_uniform
from riskweave.operators import woe


def _expected(bins: pd.Series, y: pd.Series) -> pd.DataFrame:
    """WOE by hand from a series of bin labels."""
    bad, good = max(y.sum(), 1), max((1 - y).sum(), 1)
    table = pd.DataFrame({"n": y.groupby(bins).size(), "n_bad": y.groupby(bins).sum()})
    db, dg = (table["n_bad"] + 0.5) / (bad + 0.5), (table["n"] - table["n_bad"] + 0.5) / (good + 0.5)
    return table.assign(woe=np.log(dg / db), iv=(dg - db) * np.log(dg / db))


@pytest.fixture(scope="module")
def signal(spark):
    """P(bad) = x for a uniform x, an independent column, and degenerate columns."""
    x, noise, u = key_uniform("x", "id"), key_uniform("noise", "id"), key_uniform("y", "id")
    return spark.range(8000).select(
        "id", x.alias("x"), noise.alias("noise"), (u < x).cast("int").alias("y"),
        F.when(F.col("id") % 10 != 0, F.floor(x * 30)).alias("holes"),
        F.lit(1.5).alias("constant"), F.lit(None).cast("double").alias("empty"),
        F.when(x > 0.7, "high").when(x > 0.3, "mid").alias("level"),
    ).persist()


def test_woe_falls_on_a_rising_risk(signal):
    table = woe.woe_numeric(signal, "x", "y").orderBy("bin_index").collect()
    assert len(table) == 10
    assert woe.monotone_share(woe.woe_numeric(signal, "x", "y")).first()["falling_share"] >= 0.7
    assert sum(r["iv_contribution"] for r in table) > 0.1
    assert all(a["hi"] == b["lo"] for a, b in zip(table, table[1:]))


def test_noise_has_no_information(signal):
    iv = woe.woe_numeric(signal, "noise", "y").agg(F.sum("iv_contribution")).first()[0]
    assert iv < 0.05


@pytest.mark.parametrize("column", ["x", "holes"])
def test_numeric_table_equals_pandas_quantile_bins(signal, column):
    data = signal.select(column, "y").toPandas()
    cut = pd.qcut(data[column], 10, duplicates="drop").cat.codes  # -1 for missing
    want = _expected(cut, data["y"])
    got = {r["bin_index"]: r for r in woe.woe_numeric(signal, column, "y").collect()}
    assert sorted(got) == sorted(want.index)
    for i, row in want.iterrows():
        assert (got[i]["n"], got[i]["n_bad"]) == (row["n"], row["n_bad"])
        assert got[i]["woe"] == pytest.approx(row["woe"]) and got[i]["iv_contribution"] == pytest.approx(row["iv"])
    if column == "holes":
        assert got[-1]["category"] == "MISSING"


def test_categorical_table(signal):
    data = signal.select("level", "y").toPandas()
    want = _expected(data["level"].fillna("MISSING"), data["y"])
    got = {r["category"]: r for r in woe.woe_categorical(signal, "level", "y").collect()}
    assert set(got) == {"high", "mid", "MISSING"}
    for name, row in want.iterrows():
        assert got[name]["woe"] == pytest.approx(row["woe"])


def test_ranking_sorts_selects_and_survives_degenerate_columns(signal):
    names = ["noise", "constant", "x", "empty", "level"]
    ranking = woe.iv_ranking(signal, "y", names)
    rows = ranking.collect()
    assert {r["feature"] for r in rows} == set(names)
    assert [r["iv"] for r in rows] == sorted((r["iv"] for r in rows), reverse=True)
    chosen = {r["feature"] for r in rows if r["selected"]}
    assert chosen == {"x", "level"}
    assert {r["feature"]: r["iv"] for r in rows}["empty"] == pytest.approx(0.0)
    assert woe.selected_features(ranking, names) == [r["feature"] for r in rows if r["selected"]]
    assert woe.selected_features(ranking.where("iv < 0"), names) == names


def test_single_class_labels_stay_finite(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(0).alias("y"))
    rows = woe.woe_numeric(df, "x", "y").collect()
    assert all(math.isfinite(r["woe"]) for r in rows)


def test_few_values_are_taken_as_categories(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    by_value = woe.woe_categorical(df, "x", "y").agg(F.sum("iv_contribution")).first()[0]
    assert woe.iv_ranking(df, "y").first()["iv"] == pytest.approx(by_value)


def test_monotonic_bins_never_turn(signal):
    bins = woe.monotonic_bins(signal, "y", ["x", "noise", "holes"])
    assert bins.where("n = 0").count() == 0
    for name in ("x", "noise", "holes"):
        rows = bins.where((F.col("feature") == name) & (F.col("bin_index") >= 0)).orderBy("bin_index").collect()
        steps = np.diff([r["n_bad"] / r["n"] for r in rows])
        assert (steps > 0).all() or (steps < 0).all()
        assert sum(r["n"] for r in rows) == signal.where(F.col(name).isNotNull()).count()
    assert bins.where("feature = 'holes' AND bin_index = -1").first()["n"] == 800


def test_falling_risk_gives_rising_woe(signal):
    flipped = signal.select((-F.col("x")).alias("x"), "y")
    rows = woe.monotonic_bins(flipped, "y", ["x"]).orderBy("bin_index").collect()
    assert (np.diff([r["woe"] for r in rows]) > 0).all()


def test_transform_looks_up_bins_and_gives_unseen_values_zero(spark, signal):
    bins = woe.woe_tables(signal, "y", woe.quantile_edges(signal, ["x", "holes"]), ["level"])
    new = spark.createDataFrame([(-5.0, None, "high"), (5.0, 3.0, "new"), (None, 29.0, None)], "x double, holes double, level string")
    rows = woe.woe_transform(new, bins, ["x", "holes"], ["level"]).orderBy(F.col("x").asc_nulls_last()).collect()
    table = {(r["feature"], r["bin_index"] if r["bin_index"] is not None else r["category"]): r["woe"] for r in bins.collect()}
    assert rows[0]["x_woe"] == table["x", 0] and rows[1]["x_woe"] == table["x", 9]
    assert rows[2]["x_woe"] == 0.0  # x was never missing in training
    assert rows[0]["holes_woe"] == table["holes", -1]
    assert [r["level_woe"] for r in rows] == [table["level", "high"], 0.0, table["level", "MISSING"]]


def test_training_bins_code_the_training_rows(signal):
    bins = woe.woe_tables(signal, "y", woe.quantile_edges(signal, ["x"]))
    coded = woe.woe_transform(signal, bins, ["x"]).groupBy("x_woe").agg(F.count("*").alias("n"), F.sum("y").alias("b"))
    want = {(r["woe"], r["n"], r["n_bad"]) for r in bins.collect()}
    assert {tuple(r) for r in coded.collect()} == want


def test_nan_is_missing_in_bins_by_value(spark):
    rows = [(1.0, 1), (2.0, 0), (float("nan"), 1), (None, 0), (1.0, 0)]
    df = spark.createDataFrame(rows, "x double, y int")
    bins = woe.woe_categorical(df, "x", "y")
    assert {r["category"]: r["n"] for r in bins.collect()} == {"1.0": 2, "2.0": 1, "MISSING": 2}
    coded = woe.woe_transform(df, bins, [], ["x"]).where("x IS NULL OR isnan(x)").select("x_woe").distinct()
    assert coded.count() == 1


# --------------------------------------------------------------------------- optimal bins
def _all_ways(n, bad, totals, min_share, max_bins):
    """The highest value by trying every set of cuts."""
    m, best = len(n), None
    for mask in range(2 ** (m - 1)):
        cuts = [0, *[i + 1 for i in range(m - 1) if mask >> i & 1], m]
        parts = [(sum(n[a:b]), sum(bad[a:b])) for a, b in zip(cuts, cuts[1:])]
        gaps = [b2 * n1 - b1 * n2 for (n1, b1), (n2, b2) in zip(parts, parts[1:])]
        if not (all(g > 0 for g in gaps) or all(g < 0 for g in gaps)) or len(parts) > (max_bins or m):
            continue
        if len(parts) > 1 and min(p[0] for p in parts) < min_share * sum(n):
            continue
        value = sum(woe.information(*p, totals) for p in parts)
        best = value if best is None or value > best else best
    return best


def test_optimal_cuts_equal_exhaustive_search():
    import random

    draw = random.Random(4)
    for case in range(40):
        m = draw.randint(1, 12)
        n = [draw.randint(1, 60) for _ in range(m)]
        bad = [draw.randint(0, min(c, 3 + 5 * i if case % 2 else c)) for i, c in enumerate(n)]
        totals, share, most = (sum(bad), sum(n) - sum(bad)), draw.choice([0, 0.05, 0.2]), draw.choice([None, 2, 4])
        cuts = woe.best_cuts(n, bad, totals, share, most)
        parts = [(sum(n[a:b]), sum(bad[a:b])) for a, b in zip(cuts, cuts[1:])]
        assert cuts[0] == 0 and cuts[-1] == m and len(parts) <= (most or m)
        assert sum(woe.information(*p, totals) for p in parts) == pytest.approx(_all_ways(n, bad, totals, share, most), abs=1e-12)


def test_optimal_bins_are_worth_no_less_than_pooled_ones(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 17 != 0, F.col("id") * 7919 % 1000).cast("double").alias("x"), (F.col("id") * 31 % 97).cast("double").alias("z"),
        ((F.col("id") * 7919 % 1000 + F.col("id") * 104729 % 900) > 1100).cast("int").alias("y"))
    pooled, best = woe.monotonic_bins(df, "y", ["x", "z"]), woe.optimal_bins(df, "y", ["x", "z"], min_share=0)
    value = lambda bins: {r["feature"]: r["iv"] for r in bins.where("bin_index >= 0").groupBy("feature").agg(F.sum("iv_contribution").alias("iv")).collect()}
    for f, iv in value(pooled).items():
        assert value(best)[f] >= iv - 1e-12
    few = woe.optimal_bins(df, "y", ["x"], max_bins=3).collect()
    assert sum(r["n"] for r in few) == 3000 and sum(r["bin_index"] >= 0 for r in few) <= 3
    assert [r["n"] for r in few if r["bin_index"] == -1] == [177]
