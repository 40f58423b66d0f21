"""Credit risk from the feature table to the notice of the riskiest applicant."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.attribution import tree_contributions
from riskweave.operators.boosting import BoostedTrees
from riskweave.operators.features import FEATURE_GROUPS, fit_medians, impute, model_features
from riskweave.operators.metrics import BUNDLE, metric_bundle
from riskweave.operators.models import RESULT_COLUMNS, fit_gbt, metric_lift, positive_proba
from riskweave.operators.reasons import highest_risk, notices
from riskweave.operators.scorecard import ScorecardModel, fit_scorecard, scorecard_proba
from riskweave.operators.split import stratified_split
from riskweave.operators.woe import IV_FLOOR, iv_ranking, selected_features
from riskweave.session import materialize
from riskweave.sources.runlog import append_run
from riskweave.sources.tables import write_report


@dataclass(frozen=True)
class CreditRun:
    results: DataFrame
    ranking: DataFrame
    notice: DataFrame
    summary: DataFrame
    scorecard: ScorecardModel
    gbm: BoostedTrees


def run_credit(
    features: DataFrame, key: str, target: str, out: str, groups: dict[str, list[str]] = FEATURE_GROUPS,
    trees: int = 400, seed: int = 42, accuracy: int | None = None,
) -> CreditRun:
    """Split, rank by IV, fit scorecard and trees, compare, explain; reports go under ``out``.

    Every statistic (quantiles, WOE, medians) comes from the training rows.
    """
    spark = features.sparkSession
    names = model_features(features, groups)
    table = materialize(features.select(key, F.col(target).cast("int").alias(target), *names), "credit")
    train, test = stratified_split(table, key, target, seed=seed)

    ranking = materialize(iv_ranking(train, target, names, IV_FLOOR, accuracy=accuracy), "iv")
    write_report(ranking.orderBy(F.desc("iv"), "feature"), f"{out}/iv_ranking")
    chosen = selected_features(ranking, names)

    card = fit_scorecard(train, target, chosen, accuracy=accuracy)
    medians = fit_medians(train, chosen, accuracy)
    gbm = fit_gbt(impute(train, medians), target, chosen, trees=trees, seed=seed)
    by_trees = positive_proba(gbm, impute(test, medians))
    scored = scorecard_proba(test, card).select(F.lit("scorecard").alias("model"), target, "probability").unionByName(
        by_trees.select(F.lit("gbm").alias("model"), target, "probability")
    )
    results = materialize(
        metric_bundle(scored, target, "probability", by=["model"]).select("model", *RESULT_COLUMNS), "credit-results"
    )
    lift = metric_lift(results, "auc", "gbm", "scorecard").first()

    riskiest = highest_risk(by_trees, key)
    used = {g: [c for c in cols if c in chosen] for g, cols in groups.items()}
    used = {g: cols for g, cols in used.items() if cols}
    contributions = tree_contributions(riskiest, key, gbm)
    notice = materialize(notices(contributions, key, groups=used), "notice")
    notice.select("notice").write.mode("overwrite").text(f"{out}/notice", lineSep="\n\n")

    for row in results.collect():
        append_run(
            spark, f"{out}/runs", "credit", row["model"],
            {"n_features": len(chosen), "iv_floor": IV_FLOOR, "model": row["model"]},
            {m: row[m] for m in BUNDLE},
        )
    append_run(spark, f"{out}/runs", "credit", "gbm", metrics={"auc_lift_over_scorecard": lift["lift"]})
    summary = table.agg(F.round(F.avg(target), 4).alias("default_rate")).select(
        F.round(F.lit(lift["baseline"]), 4).alias("scorecard_auc"), F.round(F.lit(lift["candidate"]), 4).alias("gbm_auc"),
        F.round(F.lit(lift["lift"]), 4).alias("auc_lift"), F.lit(len(chosen)).alias("n_selected_features"), "default_rate",
    )
    write_report(summary, f"{out}/summary", "json")
    return CreditRun(results, ranking, notice, summary, card, gbm)
