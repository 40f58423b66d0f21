"""Challenger models, their comparison on one split, and the champion store."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.boosting import BoostedTrees, Growth, fit_trees, load_trees, save_trees
from riskweave.operators.metrics import metric_bundle
from riskweave.operators.network import Network, fit_network, load_network, save_network
from riskweave.operators.profile import class_weights
from riskweave.session import materialize
from riskweave.sources.commits import commit, read_entries, read_entry

log = logging.getLogger(__name__)

RESULT_COLUMNS = ("auprc", "auc", "recall", "precision", "f1", "mcc", "ks", "gini", "positive_rate")


def positive_weight(train: DataFrame, label: str) -> float:
    return class_weights(train, label).first()["pos_weight"]


Model = BoostedTrees | Network


def fit_gbt(
    train: DataFrame, label: str, features: list[str], weighted: bool = False, trees: int = 400, depth: int = 5,
    step: float = 0.05, patience: int | None = 30, seed: int = 42,
) -> BoostedTrees:
    """Gradient-boosted trees; ``weighted`` lets the positives weigh as much as the negatives.

    ``trees`` is the most: growth ends when a held-out tenth of the rows hasn't been ranked better for ``patience`` trees.
    """
    weight = positive_weight(train, label) if weighted else 1.0
    return fit_trees(train, label, features, float(weight), trees, Growth(depth=depth, step=step), patience, seed=seed)


def fit_mlp(
    train: DataFrame, label: str, features: list[str], hidden: tuple[int, ...] = (64, 32), weighted: bool = True,
    iterations: int = 100, seed: int = 42,
) -> Network:
    """Small perceptron on standardized features; ``weighted`` lets the positives weigh as much as the negatives."""
    weight = positive_weight(train, label) if weighted else 1.0
    return fit_network(train, label, features, hidden, float(weight), iterations=iterations, seed=seed)


def positive_proba(model: Model, df: DataFrame, name: str = "probability") -> DataFrame:
    """The input columns plus the probability of the positive class."""
    return model.score(df, name)


# --------------------------------------------------------------------------- comparison
def fit_all(trainers: dict[str, Callable[[], Model]], needed: bool = False) -> dict[str, Model]:
    """Fit each trainer; a fit that fails ends the comparison with its error.

    One whose library is absent is left out, with a warning, unless all are ``needed``.
    """
    fitted = {}
    for name, trainer in trainers.items():
        try:
            fitted[name] = trainer()
        except ImportError as problem:
            if needed:
                raise
            log.warning("model %s skipped: %s", name, problem)
    return fitted


def benchmark(models: dict[str, Model], test: DataFrame, label: str, threshold: float = 0.5) -> DataFrame:
    """One metric row per model on the same test rows, best AUPRC first."""
    if not models:
        raise ValueError("no fitted model to compare")
    scored = reduce(DataFrame.unionByName, [
        positive_proba(model, test).select(
            F.lit(name).alias("model"), F.col(label).cast("int").alias("label"), "probability"
        )
        for name, model in models.items()
    ])
    scored = materialize(scored, "scored")  # the sketch and the histogram read it
    bundle = metric_bundle(scored, "label", "probability", threshold, ["model"])
    return bundle.select("model", *RESULT_COLUMNS).orderBy(F.desc_nulls_last("auprc"), "model")


def metric_lift(results: DataFrame, metric: str, candidate: str, baseline: str) -> DataFrame:
    """Difference of one metric between two rows of a comparison."""
    def value(name: str):
        return F.max(F.when(F.col("model") == name, F.col(metric)))

    return results.agg(
        value(candidate).alias("candidate"), value(baseline).alias("baseline"),
        (value(candidate) - value(baseline)).alias("lift"),
    )


# --------------------------------------------------------------------------- champion
def promote(results: DataFrame, models: dict[str, Model], path: str, alias: str = "champion") -> str:
    """Save the model with the best AUPRC, then point the alias at it as its next version.

    Equal AUPRC, and none at all, are settled by name. Models and versions are only ever added, and of two promoters at once each
    gets a version of its own, so a scorer that loads meanwhile gets the version before or a later one, whole.
    """
    spark = results.sparkSession
    best = results.select("model", "auprc").orderBy(F.desc_nulls_last("auprc"), "model").first()
    if best is None:
        raise ValueError("no result to choose from")
    model = models[best["model"]]
    kind, save = ("trees", save_trees) if isinstance(model, BoostedTrees) else ("network", save_network)
    uri = f"{path}/models/{best['model']}/{uuid.uuid4().hex[:12]}"
    save(spark, model, uri)
    commit(spark, f"{path}/alias/{alias}", {"alias": alias, "model": best["model"], "kind": kind, "uri": uri, "auprc": best["auprc"]})
    return best["model"]


def alias_versions(spark: SparkSession, path: str, alias: str = "champion") -> DataFrame:
    """``alias, version, model, uri, auprc``: all versions the alias has had, a row for each promotion."""
    rows = [(e["alias"], v, e["model"], e["uri"], e["auprc"]) for v, e in read_entries(spark, f"{path}/alias/{alias}")]
    return spark.createDataFrame(rows, "alias string, version long, model string, uri string, auprc double")


def load_champion(spark: SparkSession, path: str, alias: str = "champion") -> Model:
    found = read_entry(spark, f"{path}/alias/{alias}")
    if found is None:
        raise FileNotFoundError(f"no model has been promoted to {alias} under {path}")
    return (load_trees if found[1]["kind"] == "trees" else load_network)(spark, found[1]["uri"])


def score_batch(df: DataFrame, path: str, alias: str = "champion", name: str = "probability") -> DataFrame:
    """Score a table with the promoted model."""
    return positive_proba(load_champion(df.sparkSession, path, alias), df, name)
