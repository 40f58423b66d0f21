"""Fraud models under heavy imbalance: fit, compare on one split, promote, log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.models import RESULT_COLUMNS, Model, benchmark, fit_all, fit_gbt, fit_mlp, promote
from riskweave.operators.split import stratified_split
from riskweave.session import materialize
from riskweave.sources.runlog import append_run
from riskweave.sources.tables import write_report


@dataclass(frozen=True)
class FraudRun:
    results: DataFrame
    champion: str
    summary: DataFrame
    models: dict[str, Model]


def run_fraud(
    transactions: DataFrame, key: str, label: str, features: list[str], out: str, trees: int = 400,
    iterations: int = 100, hidden: tuple[int, ...] = (64, 32), seed: int = 42,
) -> FraudRun:
    """Cost-sensitive trees against a cost-sensitive perceptron; reports and the champion go under ``out``."""
    spark = transactions.sparkSession
    table = materialize(transactions.select(key, F.col(label).cast("int").alias(label), *features), "fraud")
    train, test = stratified_split(table, key, label, seed=seed)
    models = fit_all({
        "gbm": lambda: fit_gbt(train, label, features, weighted=True, trees=trees, seed=seed),
        "mlp": lambda: fit_mlp(train, label, features, hidden, weighted=True, iterations=iterations, seed=seed),
    }, needed=True)
    results = materialize(benchmark(models, test, label), "fraud-results").orderBy(F.desc_nulls_last("auprc"), "model")
    write_report(results, f"{out}/benchmark")
    champion = promote(results, models, out)
    for row in results.collect():
        append_run(
            spark, f"{out}/runs", "fraud", row["model"],
            {"model": row["model"], "imbalance": "cost-sensitive", "champion": row["model"] == champion},
            {m: row[m] for m in RESULT_COLUMNS},
        )
    figures = results.agg(F.sort_array(F.collect_list(F.struct("model", *RESULT_COLUMNS))).alias("models"))  # a row per model
    summary = table.agg(F.round(F.avg(label), 5).alias("fraud_rate")).select(
        F.lit(champion).alias("champion"), "fraud_rate", figures.scalar().alias("models"))
    write_report(summary, f"{out}/summary", "json")
    return FraudRun(results, champion, summary, models)
