from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskweave.operators import metrics as mt
from riskweave.operators.ordered import Pieces


def _brute(y: np.ndarray, s: np.ndarray, threshold: float = 0.5) -> dict:
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    ap = last = 0.0
    for t in sorted(set(s), reverse=True):
        recall = (pos >= t).mean()
        ap += (recall - last) * (pos >= t).sum() / (s >= t).sum()
        last = recall
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in set(s))
    tp, fp = (pos >= threshold).sum(), (neg >= threshold).sum()
    fn, tn = len(pos) - tp, len(neg) - fp
    spread = math.sqrt(float(tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return {
        "auc": wins / len(pos) / len(neg), "auprc": ap, "ks": ks, "gini": 2 * wins / len(pos) / len(neg) - 1,
        "f1": 2 * tp / (2 * tp + fp + fn), "mcc": (tp * tn - fp * fn) / spread if spread else 0.0,
        "recall": tp / len(pos), "precision": tp / max(tp + fp, 1), "positive_rate": y.mean(),
    }


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    y = (rng.uniform(size=900) < 0.2).astype(int)
    s = np.clip(y * 0.3 + rng.uniform(size=900) * 0.7, 0, 1).round(2)  # many ties
    g = np.where(rng.uniform(size=900) < 0.6, "big", "small")
    df = spark.createDataFrame([(int(a), float(b), None if i % 10 == 0 else str(c)) for i, (a, b, c) in enumerate(zip(y, s, g))],
                               "y int, s double, g string")
    return df, y, s, np.array([None if i % 10 == 0 else c for i, c in enumerate(g)])


@pytest.mark.parametrize("pieces", [Pieces(), Pieces((0.2, 0.4, 0.41, 0.9))])
def test_bundle_equals_brute_force(scored, pieces):
    df, y, s, _ = scored
    row = mt.metric_bundle(df, "y", "s", pieces=pieces).first()
    for name, value in _brute(y, s).items():
        assert row[name] == pytest.approx(value), name


@pytest.mark.parametrize("pieces", [Pieces(), Pieces((0.3, 0.6))])
def test_groups_are_separate_and_a_missing_group_counts(scored, pieces):
    df, y, s, g = scored
    rows = {r["g"]: r for r in mt.metric_bundle(df, "y", "s", by=["g"], pieces=pieces).collect()}
    assert set(rows) == {"big", "small", None}
    for name in rows:
        mine = np.array([x == name if name else x is None for x in g])
        for metric, value in _brute(y[mine], s[mine]).items():
            assert rows[name][metric] == pytest.approx(value)


def test_auc_equals_the_ml_evaluator(scored):
    df = scored[0].withColumn("y", F.col("y").cast("double"))
    ours = mt.ranking_metrics(mt.score_histogram(df, "y", "s")).first()["auc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "y int, s double")
    row = mt.metric_bundle(df, "y", "s").first()
    assert row["auc"] is None and row["auprc"] is None and row["gini"] is None
    assert row["ks"] == 1.0 and row["mcc"] == 0.0 and row["recall"] == 0.0 and row["f1"] == 0.0
    positives = mt.metric_bundle(df.withColumn("y", F.lit(1)), "y", "s").first()
    assert positives["precision"] == 1.0 and positives["positive_rate"] == 1.0


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.49)], "y int, s double")
    assert tuple(mt.confusion_counts(df, "y", "s").first()) == (1, 1, 1, 0)


def test_no_rows(spark):
    row = mt.confusion_counts(spark.createDataFrame([], "y int, s double"), "y", "s").first()
    assert tuple(row) == (0, 0, 0, 0)


def test_metric_rows(scored):
    long = mt.metric_rows(mt.metric_bundle(scored[0], "y", "s"), ["auc", "ks"]).collect()
    assert [r["metric"] for r in long] == ["auc", "ks"]
