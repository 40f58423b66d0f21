"""Metric and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalogue import sql
from riskweave.catalogue.inputs import applicants, returned_lines, rounded, scored_documents
from riskweave.operators import metrics as mt
from riskweave.operators.reasons import highest_risk
from riskweave.operators.split import is_test, stratified_split

RANKING = ("auc", "auprc", "ks", "gini", "positive_rate")


def _ranking(spark, sf):
    return mt.ranking_metrics(mt.score_histogram(scored_documents(spark, sf), "quality", "score"))


def _single(name):
    def query(spark, sf):
        return rounded(_ranking(spark, sf).select(name), name)

    return query


def e4_cumulative_distribution(spark, sf):
    hist = mt.score_histogram(scored_documents(spark, sf), "quality", "score", ["lang"])
    out = mt.cumulative_distribution(hist, ["lang"])
    return rounded(out.select("lang", "score", "cum_pos", "cum_neg", "bad_share", "good_share"), "bad_share", "good_share")


def e8_highest_risk(spark, sf):
    return highest_risk(scored_documents(spark, sf), "doc_id", "score").select("doc_id", "score", "quality")


def j5_confusion_counts(spark, sf):
    return mt.confusion_counts(scored_documents(spark, sf), "quality", "score", 0.5, ["lang"])


def j6_recall_precision_f1(spark, sf):
    at = mt.threshold_metrics(scored_documents(spark, sf), "quality", "score", 0.5, ["lang"])
    return rounded(at.select("lang", "recall", "precision", "f1"), "recall", "precision", "f1")


def j7_mcc(spark, sf):
    at = mt.threshold_metrics(scored_documents(spark, sf), "quality", "score", 0.5, ["lang"])
    return rounded(at.select("lang", "mcc"), "mcc")


def j8_metric_bundle(spark, sf):
    return rounded(mt.metric_bundle(scored_documents(spark, sf), "quality", "score", 0.5, ["lang"]), *mt.BUNDLE)


def j8_bundle_over_lines(spark, sf):
    lines = returned_lines(spark, sf).withColumn("score", F.col("l_extendedprice") / 1e5)
    return rounded(mt.metric_bundle(lines, "returned", "score"), *mt.BUNDLE)


def m1_stable_split(spark, sf):
    people = applicants(spark, sf)
    return people.select("SK_ID_CURR", F.when(is_test("SK_ID_CURR"), "test").otherwise("train").alias("side"))


def m1_stratified_split(spark, sf):
    train, test = stratified_split(applicants(spark, sf), "SK_ID_CURR", "TARGET")
    sides = [part.select("SK_ID_CURR", "TARGET", F.lit(side).alias("side")) for part, side in ((train, "train"), (test, "test"))]
    return sides[0].unionByName(sides[1])


QUERIES = {
    "j1_auc": _single("auc"), "j2_average_precision": _single("auprc"), "j3_ks": _single("ks"), "j4_gini": _single("gini"),
} | {f.__name__: f for f in (
    e4_cumulative_distribution, e8_highest_risk, j5_confusion_counts, j6_recall_precision_f1, j7_mcc, j8_metric_bundle,
    j8_bundle_over_lines, m1_stable_split, m1_stratified_split,
)}

_DOCS = """WITH docs AS (SELECT doc_id, lang, quality, round(1 / (1 + exp(-(n_chars / 2000.0 - 1))), 3) AS score
    FROM documents JOIN labels USING (doc_id)),"""
_ALL = f"{_DOCS} {sql.metric_ctes('docs', 'quality', 'score')}"
_BY_LANG = f"{_DOCS} {sql.metric_ctes('docs', 'quality', 'score', 'lang')}"
_BUNDLE_OUT = ", ".join(f"round({m}, 6) AS {m}" for m in mt.BUNDLE)

ORACLES = {
    "j1_auc": f"{_ALL} SELECT round(auc, 6) AS auc FROM bundle",
    "j2_average_precision": f"{_ALL} SELECT round(auprc, 6) AS auprc FROM bundle",
    "j3_ks": f"{_ALL} SELECT round(ks, 6) AS ks FROM bundle",
    "j4_gini": f"{_ALL} SELECT round(gini, 6) AS gini FROM bundle",
    "e4_cumulative_distribution": f"""{_BY_LANG} SELECT grp AS lang, score, cum_pos, cum_neg,
        round(bad_share, 6) AS bad_share, round(good_share, 6) AS good_share FROM shares""",
    "e8_highest_risk": f"{_DOCS[:-1]} SELECT doc_id, score, quality FROM docs ORDER BY score DESC, doc_id LIMIT 1",
    "j5_confusion_counts": f"{_BY_LANG} SELECT grp AS lang, tp, fp, fn, tn FROM bundle",
    "j6_recall_precision_f1": f"""{_BY_LANG} SELECT grp AS lang, round(recall, 6) AS recall,
        round(precision, 6) AS precision, round(f1, 6) AS f1 FROM bundle""",
    "j7_mcc": f"{_BY_LANG} SELECT grp AS lang, round(mcc, 6) AS mcc FROM bundle",
    "j8_metric_bundle": f"{_BY_LANG} SELECT grp AS lang, {_BUNDLE_OUT} FROM bundle",
    "j8_bundle_over_lines": f"""
        WITH lines AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
                              l_extendedprice / 1e5 AS score FROM lineitem),
        {sql.metric_ctes('lines', 'returned', 'score')} SELECT {_BUNDLE_OUT} FROM bundle""",
    "m1_stable_split": f"""{sql.APPLICANTS} SELECT SK_ID_CURR,
        CASE WHEN {sql.is_test('SK_ID_CURR')} THEN 'test' ELSE 'train' END AS side FROM applicants""",
    "m1_stratified_split": f"""{sql.APPLICANTS}, placed AS (
            SELECT SK_ID_CURR, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY {sql.uniform('42', 'SK_ID_CURR')}) AS r,
                   count(*) OVER (PARTITION BY TARGET) AS n FROM applicants)
        SELECT SK_ID_CURR, TARGET, CASE WHEN r <= floor(0.25 * n + 0.5) THEN 'test' ELSE 'train' END AS side FROM placed""",
}
