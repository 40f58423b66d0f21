"""Resampling, model, scoring and end-to-end queries. Models have no SQL twin: SQL states rows, labels and properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalogue import sql
from riskweave.catalogue.inputs import (
    TRANSACTION_FEATURES, credit_table, prepare_transactions, rounded, table, transactions,
)
from riskweave.operators import models as md
from riskweave.operators import reasons as rs
from riskweave.operators.attribution import tree_contributions
from riskweave.operators.features import fit_medians, impute
from riskweave.operators.imbalance import smote
from riskweave.operators.metrics import metric_bundle
from riskweave.operators.profile import split_integrity
from riskweave.operators.scorecard import fit_scorecard, scorecard_proba
from riskweave.operators.split import stable_split
from riskweave.plans.credit import run_credit
from riskweave.plans.fraud import run_fraud
from riskweave.session import materialize, work_folder
from riskweave.sources.runlog import read_runs
from riskweave.streaming.scoring import read_arrivals, score_stream

CREDIT_FEATURES = ["PREV_REFUSED_RATE", "PREV_CNT", "BUREAU_MAX_DAYS_OVERDUE", "BUREAU_ACTIVE_CNT", "BUREAU_OVERDUE_SUM"]
CREDIT_GROUPS = {
    "Prior application history": ["PREV_REFUSED_RATE", "PREV_CNT"],
    "Prior bureau delinquency": ["BUREAU_MAX_DAYS_OVERDUE", "BUREAU_OVERDUE_SUM"],
    "Open credit": ["BUREAU_ACTIVE_CNT"],
}


#: Far above chance, below what the fits reach on the planted flag.
AUC_FLOOR = 0.75


def _inside(column):
    return (F.col(column) > 0) & (F.col(column) < 1)


def _sides(spark, sf):
    return stable_split(transactions(spark, sf), "tx_id")


def _gbt(train, **options):
    return md.fit_gbt(train, "is_fraud", TRANSACTION_FEATURES, weighted=True, **options)


def m2_smote(spark, sf):
    train, _ = _sides(spark, sf)
    grown = smote(train, "is_fraud", TRANSACTION_FEATURES, "tx_id")
    return rounded(grown, "amount", "old_balance", "hour", "is_error", "is_purchase")


def q4_resampling_leaves_test(spark, sf):
    whole = transactions(spark, sf)
    train, test = _sides(spark, sf)
    grown = smote(train, "is_fraud", TRANSACTION_FEATURES, "tx_id")
    return split_integrity(whole, grown, test, "tx_id", "is_fraud")


def _quality(scored, label):
    """Rows and positives of the test side, and whether the ranking is far better than chance."""
    stored = materialize(scored.select(label, "probability"), "scored")
    sizes = stored.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(label).cast("long").alias("n_positive"))
    found = metric_bundle(stored, label, "probability").select(
        (F.col("auc") > AUC_FLOOR).alias("auc_above_floor"), (F.col("auprc") > 3 * F.col("positive_rate")).alias("auprc_above_rate"))
    return sizes.select("*", *[found.select(c).scalar().alias(c) for c in found.columns])


def m3_gradient_boosted_trees(spark, sf):
    train, test = _sides(spark, sf)
    return _quality(md.positive_proba(_gbt(train), test), "is_fraud")


_fitted: dict[tuple, md.Model] = {}


def _once(spark, sf, name, fit):
    """A full model, fitted once per session and tables: for queries whose subject is what happens to it, not the fit."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _fitted:
        _fitted[key] = fit(_sides(spark, sf)[0])
    return _fitted[key]


def _trees(spark, sf):
    return _once(spark, sf, "gbm", _gbt)


def m4_gbt_probability(spark, sf):
    scored = md.positive_proba(_trees(spark, sf), _sides(spark, sf)[1])
    return scored.select("tx_id", "is_fraud", _inside("probability").alias("is_probability"))


def m5_perceptron(spark, sf):
    train, test = _sides(spark, sf)
    net = md.fit_mlp(train, "is_fraud", TRANSACTION_FEATURES)
    return _quality(md.positive_proba(net, test), "is_fraud")


def m6_benchmark(spark, sf):
    train, test = _sides(spark, sf)
    fitted = md.fit_all({
        "gbm": lambda: _gbt(train),
        "mlp": lambda: md.fit_mlp(train, "is_fraud", TRANSACTION_FEATURES),
    }, needed=True)
    return rounded(md.benchmark(fitted, test, "is_fraud"), *md.RESULT_COLUMNS)


def m7_promote(spark, sf):
    """Choice between the two models and the alias."""
    _, test = _sides(spark, sf)
    fitted = {"gbm": _trees(spark, sf), "mlp": _once(spark, sf, "mlp", lambda train: md.fit_mlp(train, "is_fraud", TRANSACTION_FEATURES))}
    path = work_folder(spark, "champion")
    md.promote(md.benchmark(fitted, test, "is_fraud"), fitted, path)
    return rounded(md.alias_versions(spark, path).select("alias", "version", "model", "auprc"), "auprc")


def _champion(spark, sf):
    """A promoted model, for the queries about scoring with one."""
    fitted = {"gbm": _trees(spark, sf)}
    path = work_folder(spark, "champion")
    md.promote(md.benchmark(fitted, _sides(spark, sf)[1], "is_fraud"), fitted, path)
    return path


def m8_score_batch(spark, sf):
    scored = md.score_batch(transactions(spark, sf), _champion(spark, sf))
    return scored.select("tx_id", "is_fraud", _inside("probability").alias("is_probability"))


def m9_score_stream(spark, sf):
    """Every arrived row once, scored as the batch scores it."""
    out, checkpoint = work_folder(spark, "scored"), work_folder(spark, "checkpoint")
    champion = _champion(spark, sf)
    arrivals = read_arrivals(spark, sf, table(spark, sf, "events").schema, "events.parquet")
    query = score_stream(arrivals, champion, out, checkpoint, prepare_transactions)
    query.awaitTermination()
    batch = md.score_batch(transactions(spark, sf), champion, name="expected").select("tx_id", "expected")
    return spark.read.parquet(out).join(batch, "tx_id").select(
        "tx_id", (F.abs(F.col("probability") - F.col("expected")) < 1e-12).alias("equals_batch"))


def m10_auc_lift(spark, sf):
    train, test = stable_split(credit_table(spark, sf), "SK_ID_CURR")
    medians = fit_medians(train, CREDIT_FEATURES)
    trees = md.fit_gbt(impute(train, medians), "TARGET", CREDIT_FEATURES)
    card = fit_scorecard(train, "TARGET", CREDIT_FEATURES)
    scored = scorecard_proba(test, card).select(F.lit("scorecard").alias("model"), "TARGET", "probability").unionByName(
        md.positive_proba(trees, impute(test, medians)).select(F.lit("gbm").alias("model"), "TARGET", "probability"))
    results = metric_bundle(scored, "TARGET", "probability", by=["model"])
    return rounded(md.metric_lift(results, "auc", "gbm", "scorecard"), "candidate", "baseline", "lift")


def m11_credit_run(spark, sf):
    run = run_credit(credit_table(spark, sf), "SK_ID_CURR", "TARGET", work_folder(spark, "credit-run"))
    return rounded(run.results, *md.RESULT_COLUMNS)


def m12_fraud_run(spark, sf):
    out = work_folder(spark, "fraud-run")
    run_fraud(transactions(spark, sf), "tx_id", "is_fraud", TRANSACTION_FEATURES, out)
    return read_runs(spark, f"{out}/runs").where("kind = 'metric'").select(
        "run", "key", F.round(F.col("value").cast("double"), 6).alias("value"))


def _credit_trees(spark, sf):
    """Trees of the credit table and the rows of the test side."""
    train, test = stable_split(credit_table(spark, sf), "SK_ID_CURR")
    medians = fit_medians(train, CREDIT_FEATURES)
    return md.fit_gbt(impute(train, medians), "TARGET", CREDIT_FEATURES), impute(test, medians), medians


def k3_group_shapley(spark, sf):
    """Reasons for every applicant of the test side."""
    trees, test, medians = _credit_trees(spark, sf)
    return rounded(rs.group_shapley(test, "SK_ID_CURR", trees, CREDIT_GROUPS, medians), *CREDIT_GROUPS)


def k3_tree_attribution(spark, sf):
    """What each feature of each applicant of the test side adds to the log odds; with the expectation it adds up to them."""
    trees, test, _ = _credit_trees(spark, sf)
    values = tree_contributions(test, "SK_ID_CURR", trees, "expected")
    odds = md.positive_proba(trees, test).select("SK_ID_CURR", F.ln(F.col("probability") / (1 - F.col("probability"))).alias("odds"))
    total = sum((F.col(f) for f in CREDIT_FEATURES), F.col("expected"))
    return values.join(odds, "SK_ID_CURR").select("SK_ID_CURR", (F.abs(total - F.col("odds")) < 1e-9).alias("adds_up"))


def k3_feature_reasons(spark, sf):
    """The strongest groups of features that push an applicant of the test side towards default."""
    trees, test, _ = _credit_trees(spark, sf)
    codes = rs.reason_codes(tree_contributions(test, "SK_ID_CURR", trees), "SK_ID_CURR", CREDIT_GROUPS)
    return rounded(codes.select("SK_ID_CURR", "rank", "group", "contribution"), "contribution")


QUERIES = {f.__name__: f for f in (
    m2_smote, q4_resampling_leaves_test, m3_gradient_boosted_trees, m4_gbt_probability, m5_perceptron, m6_benchmark,
    m7_promote, m8_score_batch, m9_score_stream, m10_auc_lift, m11_credit_run, m12_fraud_run, k3_group_shapley,
    k3_tree_attribution, k3_feature_reasons,
)}
_TRANSACTIONS = f"""WITH tx AS (
    SELECT event_id AS tx_id, CASE WHEN {sql.uniform('fraud', 'event_id')} < 1 / (1 + exp(-(
               0.03 * value + 1.5 * CAST(event_type = 'error' AS INTEGER)
               + 0.01 * CAST(json_extract_string(props, '$.k') AS DOUBLE) - 7.0))) THEN 1 ELSE 0 END AS is_fraud
    FROM events), test AS (SELECT * FROM tx WHERE {sql.is_test('tx_id')})"""
_QUALITY = f"""{_TRANSACTIONS} SELECT count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_positive,
    TRUE AS auc_above_floor, TRUE AS auprc_above_rate FROM test"""
#: Of fitted models SQL supplies the rows, labels and what must hold; it fits none.
ORACLES: dict[str, str] = {
    "m3_gradient_boosted_trees": _QUALITY,
    "m5_perceptron": _QUALITY,
    "m4_gbt_probability": f"{_TRANSACTIONS} SELECT tx_id, is_fraud, TRUE AS is_probability FROM test",
    "m8_score_batch": f"{_TRANSACTIONS} SELECT tx_id, is_fraud, TRUE AS is_probability FROM tx",
    "k3_tree_attribution": f"SELECT c_custkey AS SK_ID_CURR, TRUE AS adds_up FROM customer WHERE {sql.is_test('c_custkey')}",
    "m9_score_stream": f"{_TRANSACTIONS} SELECT tx_id, TRUE AS equals_batch FROM tx",
}
