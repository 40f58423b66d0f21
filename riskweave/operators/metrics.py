"""Discrimination metrics, all from one (group, score) histogram.

The histogram is a map-side combined aggregate; ordered sums over it run in
pieces (see ``ordered``), so continuous scores and a dominant segment both scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.ordered import Pieces, plan_pieces, running_sums


def score_histogram(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """``by..., score, pos, neg`` with one row per distinct score."""
    y = F.col(label).cast("long")
    return df.groupBy(*(by or []), F.col(score).cast("double").alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )


def cumulative_distribution(hist: DataFrame, by: list[str] | None = None, pieces: Pieces | None = None) -> DataFrame:
    """Add ``cum_pos, cum_neg, tot_pos, tot_neg, bad_share, good_share`` at each distinct score."""
    summed = running_sums(hist, by or [], "score", ["pos", "neg"], pieces)

    def share(kind: str) -> Column:
        return F.col(f"cum_{kind}") / F.greatest(F.col(f"tot_{kind}"), F.lit(1))

    return summed.select("*", share("pos").alias("bad_share"), share("neg").alias("good_share"))


def _summed(hist: DataFrame, by: list[str], pieces: Pieces | None, threshold: float) -> DataFrame:
    """Every sum the metrics need, per group, from one pass over the histogram."""
    c = cumulative_distribution(hist, by, pieces)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    neg_below = F.col("cum_neg") - neg
    # predicted positive when the threshold is this score: everything not below it
    hits = F.col("tot_pos") - F.col("cum_pos") + pos
    flagged = hits + F.col("tot_neg") - F.col("cum_neg") + neg
    above = F.col("score") >= F.lit(threshold)
    return c.groupBy(*by).agg(
        F.sum(pos).alias("p"), F.sum(neg).alias("n"),
        F.sum(pos * (neg_below + neg / 2)).alias("pairs"),
        F.sum(pos * (hits / flagged)).alias("steps"),
        F.max(F.abs(F.col("bad_share") - F.col("good_share"))).alias("ks"),
        F.coalesce(F.sum(F.when(above, pos)), F.lit(0.0)).alias("tp"),
        F.coalesce(F.sum(F.when(above, neg)), F.lit(0.0)).alias("fp"),
    )


def _ranking_columns() -> list[Column]:
    both = (F.col("p") > 0) & (F.col("n") > 0)
    auc = F.when(both, F.col("pairs") / (F.col("p") * F.col("n")))
    return [
        auc.alias("auc"), F.when(both, F.col("steps") / F.col("p")).alias("auprc"), F.col("ks"),
        (2 * auc - 1).alias("gini"), (F.col("p") / F.nullif(F.col("p") + F.col("n"), F.lit(0.0))).alias("positive_rate"),
    ]


def _threshold_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    """Empty denominators give 0."""
    spread = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return [
        (tp / F.greatest(tp + fn, F.lit(1.0))).alias("recall"),
        (tp / F.greatest(tp + fp, F.lit(1.0))).alias("precision"),
        F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0.0)), F.lit(0.0)).alias("f1"),
        F.coalesce((tp * tn - fp * fn) / F.nullif(F.sqrt(spread), F.lit(0.0)), F.lit(0.0)).alias("mcc"),
    ]


def ranking_metrics(hist: DataFrame, by: list[str] | None = None, pieces: Pieces | None = None) -> DataFrame:
    """``auc, auprc, ks, gini, positive_rate`` per group.

    Tied scores count half in the AUC and move together in AP and KS. AP is the
    step sum over thresholds, not the area under an interpolated curve. With one
    class only, AUC, AP and Gini are null.
    """
    by = by or []
    return _summed(hist, by, pieces, 0.5).select(*by, *_ranking_columns())


def confusion_counts(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, by: list[str] | None = None
) -> DataFrame:
    """``tp, fp, fn, tn`` with predicted positive meaning score >= threshold."""
    flagged, bad = F.col(score) >= F.lit(threshold), F.col(label) == 1

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0))

    return df.groupBy(*(by or [])).agg(
        total(flagged & bad).alias("tp"), total(flagged & ~bad).alias("fp"),
        total(~flagged & bad).alias("fn"), total(~flagged & ~bad).alias("tn"),
    )


def threshold_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, by: list[str] | None = None
) -> DataFrame:
    """``tp, fp, fn, tn, recall, precision, f1, mcc``; empty denominators give 0."""
    counts = confusion_counts(df, label, score, threshold, by)
    return counts.select("*", *_threshold_columns(*(F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))))


BUNDLE = ("auc", "auprc", "ks", "gini", "f1", "mcc", "recall", "precision", "positive_rate")


def metric_bundle(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, by: list[str] | None = None,
    pieces: Pieces | None = None,
) -> DataFrame:
    """All metrics in one row per group, from one scan: the threshold counts are sums over the histogram."""
    by = by or []
    # sketched on the rows as they are read: the histogram would have to be shuffled for it
    pieces = plan_pieces(df, F.col(score)) if pieces is None else pieces
    summed = _summed(score_histogram(df, label, score, by), by, pieces, threshold)
    tp, fp = F.col("tp"), F.col("fp")
    wide = summed.select(*by, *_ranking_columns(), *_threshold_columns(tp, fp, F.col("p") - tp, F.col("n") - fp))
    return wide.select(*by, *BUNDLE)


def metric_rows(bundle: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Long form of a one-row bundle: ``metric, value``."""
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in (names or BUNDLE)]
    return bundle.select(F.inline(F.array(*pairs)))
