"""Points-based scorecard: monotonic WOE bins, L2 logistic regression, PDO scaling."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.risk import clip_probability, sigmoid
from riskweave.operators.woe import FittedBins, collect_bins, monotonic_bins, optimal_bins, woe_transform


@dataclass(frozen=True)
class ScorecardConfig:
    """Fixed values of the usual scale: 600 points at 50:1 odds, 20 points double the odds."""

    target_points: int = 600
    target_odds: float = 50.0
    pdo: int = 20


def pdo_params(cfg: ScorecardConfig = ScorecardConfig()) -> tuple[float, float]:
    """(factor, offset) of score = offset + factor * ln(good odds)."""
    factor = cfg.pdo / math.log(2)
    return factor, cfg.target_points - factor * math.log(cfg.target_odds)


def score_points(p: Column | str, cfg: ScorecardConfig = ScorecardConfig()) -> Column:
    """Points of a default probability; higher is safer."""
    factor, offset = pdo_params(cfg)
    p = clip_probability(p)
    return F.lit(offset) + F.lit(factor) * F.ln((1 - p) / p)


@dataclass(frozen=True)
class ScorecardModel:
    features: list[str]
    bins: FittedBins
    bin_table: DataFrame
    coefficients: dict[str, float]
    intercept: float
    mean_woe: dict[str, float]
    cfg: ScorecardConfig

    def linear(self) -> Column:
        """Log odds of default from the raw feature columns."""
        total = F.lit(self.intercept)
        for f in self.features:
            total = total + F.lit(self.coefficients[f]) * self.bins.column(f)
        return total

    def probability(self) -> Column:
        return sigmoid(self.linear())


def fit_scorecard(
    train: DataFrame, target: str, features: list[str], cfg: ScorecardConfig = ScorecardConfig(), prebins: int = 20,
    accuracy: int | None = None, optimal: bool = False,
) -> ScorecardModel:
    """Fit on training rows only; ``optimal`` takes the monotone bins of highest information value instead of pooled ones. ``regParam = 1/n`` matches a unit-strength L2 penalty on the summed loss."""
    table = (optimal_bins if optimal else monotonic_bins)(train, target, features, prebins, accuracy=accuracy)
    bins = collect_bins(table)
    woe = [f"{f}_woe" for f in features]
    coded = woe_transform(train, bins, features).select(F.col(target).cast("double").alias("label"), *woe)
    stats = coded.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in woe]).first()
    rows = VectorAssembler(inputCols=woe, outputCol="x").transform(coded).select("label", "x").persist()
    try:
        fitted = LogisticRegression(
            featuresCol="x", labelCol="label", regParam=1.0 / max(stats["n"], 1), elasticNetParam=0.0,
            standardization=False, maxIter=200, tol=1e-9,
        ).fit(rows)
    finally:
        rows.unpersist()
    coefficients = dict(zip(features, (float(v) for v in fitted.coefficients)))
    means = {f: stats[f"{f}_woe"] for f in features}
    return ScorecardModel(list(features), bins, table, coefficients, float(fitted.intercept), means, cfg)


def scorecard_proba(df: DataFrame, model: ScorecardModel, name: str = "probability") -> DataFrame:
    """Add the default probability, a plain column expression: no join, also on a stream."""
    return df.withColumn(name, model.probability())


def scorecard_points(df: DataFrame, model: ScorecardModel, name: str = "points") -> DataFrame:
    return df.withColumn(name, score_points(model.probability(), model.cfg))


def points_table(model: ScorecardModel) -> DataFrame:
    """Points per feature and bin; an applicant's points over all features add up to the score."""
    factor, offset = pdo_params(model.cfg)
    k = len(model.features)
    spark = model.bin_table.sparkSession
    rows = []
    for f in model.features:
        values = [(i, w) for i, w in enumerate(model.bins.woe.get(f, []))]
        values.append((-1, model.bins.missing.get(f, 0.0)))
        for i, w in values:
            rows.append((f, i, w, offset / k - factor * (model.coefficients[f] * w + model.intercept / k)))
    return spark.createDataFrame(rows, "feature string, bin_index int, woe double, points double")
