from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.risk import key_uniform, sigmoid
from riskweave.operators import models as md
from riskweave.operators import reasons as rs
from riskweave.operators.features import fit_medians
from riskweave.operators.metrics import metric_bundle
from riskweave.operators.split import stable_split
from riskweave.plans.credit import run_credit
from riskweave.plans.fraud import run_fraud
from riskweave.sources.runlog import read_runs
from riskweave.streaming.scoring import read_arrivals, score_stream

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def tx(spark):
    a, b, c, u = (key_uniform(name, "id") for name in "abcu")
    risk = sigmoid(6 * a * b + 2 * a - 4.5)
    return spark.range(3000).select(
        "id", a.alias("a"), b.alias("b"), c.alias("c"), (u < risk).cast("int").alias("y")).persist()


@pytest.fixture(scope="module")
def fitted(tx):
    train, test = stable_split(tx, "id")
    models = {
        "gbm": md.fit_gbt(train, "y", FEATURES, weighted=True, trees=10),
        "mlp": md.fit_mlp(train, "y", FEATURES, hidden=(8, 4), iterations=40),
    }
    return models, train, test


def test_both_models_beat_chance(fitted):
    models, _, test = fitted
    for model in models.values():
        scored = md.positive_proba(model, test)
        assert scored.columns == [*test.columns, "probability"]
        row = metric_bundle(scored, "y", "probability").first()
        assert row["auc"] > 0.65


def test_weighting_raises_recall(fitted):
    models, train, test = fitted
    plain = md.fit_gbt(train, "y", FEATURES, trees=10)
    recall = [metric_bundle(md.positive_proba(m, test), "y", "probability").first()["recall"] for m in (models["gbm"], plain)]
    assert recall[0] > recall[1]


def test_benchmark_is_sorted_and_skips_what_cannot_be_fitted(fitted):
    models, _, test = fitted

    def absent():
        raise ImportError("no such library")

    kept = md.fit_all({"gbm": lambda: models["gbm"], "none": absent, "mlp": lambda: models["mlp"]})
    assert list(kept) == ["gbm", "mlp"]
    with pytest.raises(TypeError):
        md.fit_all({"broken": lambda: len(3)})
    rows = md.benchmark(kept, test, "y").collect()
    assert [r["auprc"] for r in rows] == sorted((r["auprc"] for r in rows), reverse=True)
    one = metric_bundle(md.positive_proba(models["mlp"], test), "y", "probability").first()
    assert {r["model"]: r["auc"] for r in rows}["mlp"] == pytest.approx(one["auc"])
    lift = md.metric_lift(md.benchmark(kept, test, "y"), "auc", "gbm", "mlp").first()
    assert lift["lift"] == pytest.approx(lift["candidate"] - lift["baseline"])


def test_a_failed_fit_is_no_comparison(spark, fitted):
    def broken():
        return spark.range(3).select(F.raise_error(F.lit("lost")).alias("x")).collect()

    def absent():
        raise ImportError("no such library")

    good = {"gbm": lambda: fitted[0]["gbm"]}
    with pytest.raises(Exception, match="lost"):
        md.fit_all(good | {"mlp": broken})
    with pytest.raises(ImportError):
        md.fit_all(good | {"mlp": absent}, needed=True)


def test_whichever_model_wins_is_promoted(spark, fitted, tmp_path):
    models, _, test = fitted
    for best in ("gbm", "mlp"):
        results = spark.createDataFrame([(m, 0.9 if m == best else 0.1) for m in models], "model string, auprc double")
        path = str(tmp_path / best)
        assert md.promote(results, models, path) == best
        again = md.score_batch(test, path).orderBy("id").collect()
        assert again == md.positive_proba(models[best], test).orderBy("id").collect()
    with pytest.raises(FileNotFoundError):
        md.load_champion(spark, str(tmp_path / "nothing"))


def test_stream_scores_like_the_batch_and_each_file_once(spark, fitted, tmp_path):
    models, _, test = fitted
    path, arrivals, out, checkpoint = (str(tmp_path / n) for n in ("model", "in", "out", "checkpoint"))
    md.promote(spark.createDataFrame([("gbm", 0.5)], "model string, auprc double"), models, path)

    def run():
        score_stream(read_arrivals(spark, arrivals, test.schema), path, out, checkpoint).awaitTermination()

    halves = [test.where("id % 2 = 0"), test.where("id % 2 = 1")]
    halves[0].write.parquet(arrivals)
    run()
    run()  # nothing new: nothing is scored again
    assert spark.read.parquet(out).count() == halves[0].count()
    halves[1].write.mode("append").parquet(arrivals)
    run()
    got = spark.read.parquet(out).select("id", "probability").orderBy("id").collect()
    assert got == md.score_batch(test, path).select("id", "probability").orderBy("id").collect()


def test_group_shapley_is_complete_and_ignores_an_unused_group(fitted):
    models, train, test = fitted
    baseline = fit_medians(train, FEATURES)
    some = test.where("id < 300")
    groups = {"first": ["a"], "others": ["b", "c"]}
    values = rs.group_shapley(some, "id", models["gbm"], groups, baseline)
    base = test.sparkSession.createDataFrame([tuple(baseline[f] for f in FEATURES)], "a double, b double, c double")
    p0 = md.positive_proba(models["gbm"], base).first()["probability"]
    want = {r["id"]: math.log(r["probability"] / (1 - r["probability"])) - math.log(p0 / (1 - p0))
            for r in md.positive_proba(models["gbm"], some).collect()}
    rows = values.collect()
    assert {r["id"] for r in rows} == set(want)
    for r in rows:
        assert r["first"] + r["others"] == pytest.approx(want[r["id"]], abs=1e-9)


def test_group_shapley_equals_the_definition(fitted):
    from itertools import permutations

    models, train, test = fitted
    baseline = fit_medians(train, FEATURES)
    one = test.orderBy("id").limit(1)
    row = one.first()

    def value(kept):
        point = tuple(float(row[f]) if f in kept else float(baseline[f]) for f in FEATURES)
        df = test.sparkSession.createDataFrame([point], "a double, b double, c double")
        p = md.positive_proba(models["gbm"], df).first()["probability"]
        return math.log(p / (1 - p))

    table = {frozenset(s): value(s) for s in ([], ["a"], ["b"], ["c"], ["a", "b"], ["a", "c"], ["b", "c"], FEATURES)}
    want = {f: np.mean([table[frozenset(o[: o.index(f) + 1])] - table[frozenset(o[: o.index(f)])]
                        for o in permutations(FEATURES)]) for f in FEATURES}
    got = rs.group_shapley(one, "id", models["gbm"], {f: [f] for f in FEATURES}, baseline).first()
    for f in FEATURES:
        assert got[f] == pytest.approx(want[f], abs=1e-9)
    with pytest.raises(ValueError):
        rs.group_shapley(one, "id", models["gbm"], {}, baseline)


GROUPS = {"First": ["x", "y"], "Second": ["z"], "Absent": ["nope"], "Third": ["w"]}


def test_reasons_keep_positive_groups_in_order(spark):
    df = spark.createDataFrame([(1, 1.0, -0.25, 0.75, 0.1), (2, -1.0, 0.0, -2.0, 0.0)], "id int, x double, y double, z double, w double")
    rows = rs.reason_codes(df, "id", GROUPS, {"First": "one"}, top_n=2).collect()
    assert [(r["id"], r["rank"], r["group"], r["reason"]) for r in rows] == [(1, 1, "First", "one"), (1, 2, "Second", "Second")]
    sums = {(r["id"], r["group"]): r["contribution"] for r in rs.group_contributions(df, "id", GROUPS).collect()}
    assert sums == {(1, "First"): 0.75, (1, "Second"): 0.75, (1, "Third"): 0.1,
                    (2, "First"): -1.0, (2, "Second"): -2.0, (2, "Third"): 0.0}


def test_notice_lists_reasons_or_says_there_are_none(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0, 0.75, 0.1), (2, -1.0, 0.0, -2.0, 0.0)], "id int, x double, y double, z double, w double")
    letters = {r["id"]: r["notice"] for r in rs.notices(df, "id", "declined", GROUPS).collect()}
    assert "Reference: 1" in letters[1] and "Decision: declined" in letters[1]
    assert letters[1].index("  1. First") < letters[1].index("  2. Second") < letters[1].index("  3. Third")
    assert "no group has" in letters[2] and "1." not in letters[2]


def test_at_most_four_reasons(spark):
    df = spark.createDataFrame([(1, *[float(i) for i in range(1, 7)])], "id int, a double, b double, c double, d double, e double, f double")
    rows = rs.reason_codes(df, "id", {c.upper(): [c] for c in "abcdef"}, {}).collect()
    assert [r["group"] for r in rows] == ["F", "E", "D", "C"]


def test_zscores_of_a_constant_column_are_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, 4.0)], "id int, x double, k double")
    rows = rs.zscore_contributions(df, "id", {"x": 2.0, "k": 5.0}).orderBy("id").collect()
    assert [(r["x"], r["k"]) for r in rows] == [(-2.0, 0.0), (2.0, 0.0)]


def test_credit_run_end_to_end(tx, tmp_path):
    out = str(tmp_path / "credit")
    run = run_credit(tx, "id", "y", out, {"First": ["a"], "Second": ["b"], "Noise": ["c"]}, trees=5)
    assert {r["model"] for r in run.results.collect()} == {"scorecard", "gbm"}
    summary = run.summary.first()
    assert summary["auc_lift"] == pytest.approx(summary["gbm_auc"] - summary["scorecard_auc"], abs=2e-4)
    assert "Reasons:" in run.notice.first()["notice"]
    logged = {(r["run"], r["key"]) for r in read_runs(tx.sparkSession, f"{out}/runs").collect()}
    assert {("scorecard", "auc"), ("gbm", "auc"), ("gbm", "auc_lift_over_scorecard")} <= logged
    assert tx.sparkSession.read.csv(f"{out}/iv_ranking", header=True).count() == 3


def test_fraud_run_end_to_end(tx, tmp_path):
    out = str(tmp_path / "fraud")
    run = run_fraud(tx, "id", "y", FEATURES, out, trees=5, iterations=15, hidden=(4,))
    rows = run.results.collect()
    assert {r["model"] for r in rows} == {"gbm", "mlp"} and rows[0]["model"] == run.champion
    assert run.summary.first()["champion"] == run.champion
    assert md.score_batch(tx, out).where(F.col("probability").between(0, 1)).count() == 3000


def test_choice_of_the_champion_without_or_with_equal_figures(spark, fitted, tmp_path):
    models, _, _ = fitted
    path = str(tmp_path / "store")
    schema = "model string, auprc double"
    names = sorted(models)
    for figures in ([(n, None) for n in names], [(n, 0.4) for n in reversed(names)]):
        assert md.promote(spark.createDataFrame(figures, schema), models, path) == names[0]
    versions = md.alias_versions(spark, path).orderBy("version").collect()
    assert [r["version"] for r in versions] == [1, 2] and len({r["uri"] for r in versions}) == 2
    with pytest.raises(ValueError):
        md.promote(spark.createDataFrame([], schema), models, path)
