from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.risk import key_uniform, sigmoid
from riskweave.operators import scorecard as sc
from riskweave.operators.metrics import metric_bundle
from riskweave.operators.reasons import linear_contributions
from riskweave.operators.split import is_test, stable_split
from riskweave.operators.woe import woe_transform

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def people(spark):
    a, b, c, u = (key_uniform(name, "id") for name in "abcu")
    risk = sigmoid(4 * a - 3 * b - 2)
    return spark.range(4000).select(
        "id", a.alias("a"), F.when(F.col("id") % 9 != 0, b).alias("b"), c.alias("c"), (u < risk).cast("int").alias("y")
    ).persist()


@pytest.fixture(scope="module")
def fitted(people):
    train, test = stable_split(people, "id")
    return sc.fit_scorecard(train, "y", FEATURES), train, test


def test_scale():
    factor, offset = sc.pdo_params()
    assert factor == pytest.approx(28.8539, abs=1e-4) and offset == pytest.approx(487.1229, abs=1e-4)
    wide = sc.pdo_params(sc.ScorecardConfig(500, 10, 40))
    assert wide[0] * math.log(10) + wide[1] == pytest.approx(500)


def test_twenty_points_double_the_odds(spark):
    df = spark.createDataFrame([(1 / 51,), (1 / 101,), (0.0,), (1.0,)], "p double")
    points = [r[0] for r in df.select(sc.score_points("p")).collect()]
    assert points[0] == pytest.approx(600) and points[1] == pytest.approx(620)
    assert all(math.isfinite(p) for p in points) and points[2] > points[1] > points[3]


def test_probabilities_and_points_are_sane(fitted):
    card, _, test = fitted
    scored = sc.scorecard_points(sc.scorecard_proba(test, card), card)
    rows = scored.select("probability", "points").collect()
    assert all(0 <= r["probability"] <= 1 and math.isfinite(r["points"]) for r in rows)
    by_risk = [r["points"] for r in sorted(rows, key=lambda r: r["probability"])]
    assert by_risk == sorted(by_risk, reverse=True)
    assert metric_bundle(scored, "y", "probability").first()["auc"] > 0.7


def test_coefficients_meet_the_first_order_condition(fitted):
    """Unit-strength L2 penalty on the summed loss: gradient plus coefficient is zero."""
    card, train, _ = fitted
    coded = sc.scorecard_proba(woe_transform(train, card.bins, FEATURES), card)
    gap = F.col("probability") - F.col("y")
    row = coded.agg(F.sum(gap).alias("i"), *[F.sum(gap * F.col(f"{f}_woe")).alias(f) for f in FEATURES]).first()
    assert abs(row["i"]) < 1e-2
    for f in FEATURES:
        assert abs(row[f] + card.coefficients[f]) < 1e-2


def test_points_of_the_bins_add_up_to_the_score(fitted):
    card, train, _ = fitted
    points = {(r["feature"], round(r["woe"], 9)): r["points"] for r in sc.points_table(card).collect()}
    coded = sc.scorecard_points(woe_transform(train, card.bins, FEATURES), card).limit(200).collect()
    for row in coded:
        total = sum(points[f, round(row[f"{f}_woe"], 9)] for f in FEATURES)
        assert total == pytest.approx(row["points"], abs=1e-6)


def test_fit_does_not_see_the_test_rows(people, fitted):
    card, _, _ = fitted
    spoiled = people.withColumn("a", F.when(is_test("id"), F.col("a") * 1e6).otherwise(F.col("a")))
    again = sc.fit_scorecard(stable_split(spoiled, "id")[0], "y", FEATURES)
    assert np.allclose([card.coefficients[f] for f in FEATURES], [again.coefficients[f] for f in FEATURES])


def test_contributions_add_up_to_the_distance_from_the_mean_row(fitted):
    card, train, _ = fitted
    parts = linear_contributions(train, "id", card)
    rows = parts.join(train.select("id", card.linear().alias("logit")), "id").limit(100).collect()
    centre = card.intercept + sum(card.coefficients[f] * card.mean_woe[f] for f in FEATURES)
    for r in rows:
        assert sum(r[f] for f in FEATURES) == pytest.approx(r["logit"] - centre)


def test_scorecard_on_optimal_bins(people):
    train, test = stable_split(people, "id")
    card = sc.fit_scorecard(train, "y", FEATURES, optimal=True)
    rates = {}
    for r in card.bin_table.where("bin_index >= 0").orderBy("feature", "bin_index").collect():
        rates.setdefault(r["feature"], []).append(r["n_bad"] / r["n"])
    for values in rates.values():
        assert values in (sorted(values), sorted(values, reverse=True))
    assert metric_bundle(sc.scorecard_proba(test, card), "y", "probability").first()["auc"] > 0.7
    assert sc.points_table(card).count() == card.bin_table.where("bin_index >= 0").count() + 3
