"""Ranked reasons for a decision, from per-row contributions towards default.

Contributions are wide rows (key plus one column per feature), so grouping,
ranking and rendering are expressions on one row: no shuffle, any table size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.risk import clip_probability
from riskweave.operators.features import FEATURE_GROUPS, fit_standardizer
from riskweave.operators.models import Model, positive_proba
from riskweave.operators.scorecard import ScorecardModel

TOP_REASONS = 4

#: One sentence per group, from the columns it sums. Group names are fixed values.
DEFAULT_REASONS = {
    "External credit scores": "Mean of the outside scores on file",
    "Debt-to-income": "Annuity and credit amount measured against yearly income",
    "Income": "Yearly income stated",
    "Age & employment": "Years of age and years in the present job",
    "Prior bureau delinquency": "Days and amounts overdue with other lenders",
    "Prior application history": "Share of earlier applications refused, and how many there were",
    "Household": "Number of children",
    "Region": "Rating of the home region",
}


# --------------------------------------------------------------------------- contributions
def zscore_contributions(
    df: DataFrame, key: str, importances: dict[str, float], stats: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Population z-score times importance; a constant column contributes 0."""
    features = list(importances)
    stats = stats or fit_standardizer(df, features)
    return df.select(key, *[
        ((F.col(f) - F.lit(stats[f][0])) / F.lit(stats[f][1] or 1.0) * F.lit(importances[f])).alias(f)
        for f in features
    ])


def linear_contributions(df: DataFrame, key: str, model: ScorecardModel) -> DataFrame:
    """Exact attribution of the scorecard's log odds against the mean training row."""
    return df.select(key, *[
        (F.lit(model.coefficients[f]) * (model.bins.column(f) - F.lit(model.mean_woe[f]))).alias(f)
        for f in model.features
    ])


def group_shapley(
    df: DataFrame, key: str, model: Model, groups: dict[str, list[str]], baseline: dict[str, float]
) -> DataFrame:
    """Shapley values of feature groups for the model's log odds, one column per group.

    Each row is scored for all 2^G choices of groups that keep their values while
    the others take the baseline. The choices of a row are made and summed in one
    task, so the shuffle carries one row per input row. Pass the rows that need
    reasons, not the whole table; G is limited to 10.
    """
    names = list(groups)
    size = len(names)
    if not 1 <= size <= 10:
        raise ValueError("between 1 and 10 groups")
    position = {f: g for g, name in enumerate(names) for f in groups[name]}
    extra = [f for f in baseline if f not in position]

    def kept(g: int) -> Column:
        return F.col("_mask").bitwiseAND(F.lit(1 << g)) != 0

    chosen = df.withColumn("_mask", F.explode(F.sequence(F.lit(0), F.lit(2**size - 1)))).select(
        key, "_mask",
        *[F.when(kept(g), F.col(f).cast("double")).otherwise(F.lit(float(baseline[f]))).alias(f)
          for f, g in position.items()],
        *extra,
    )
    p = clip_probability("_p")
    scored = positive_proba(model, chosen, "_p").withColumn("_v", F.ln(p / (1 - p)))
    whole = math.factorial(size)
    inside = F.array(*[F.lit(math.factorial(max(s - 1, 0)) * math.factorial(size - s) / whole) for s in range(size + 1)])
    outside = F.array(*[F.lit(math.factorial(s) * math.factorial(max(size - s - 1, 0)) / whole) for s in range(size + 1)])
    at = F.bit_count("_mask") + 1
    return scored.groupBy(key).agg(*[
        F.sum(F.when(kept(g), F.element_at(inside, at)).otherwise(-F.element_at(outside, at)) * F.col("_v")).alias(name)
        for g, name in enumerate(names)
    ])


# --------------------------------------------------------------------------- groups and reasons
def _group_structs(columns: list[str], groups: dict[str, list[str]], texts: dict[str, str]) -> list[Column]:
    out = []
    for i, (name, members) in enumerate(groups.items()):
        present = [m for m in members if m in columns]
        if present:
            total = sum((F.col(m) for m in present[1:]), F.col(present[0]))
            out.append(F.struct(
                (-total).alias("sort"), F.lit(i).alias("position"), F.lit(name).alias("group"),
                F.lit(texts.get(name, name)).alias("reason"), total.alias("contribution"),
            ))
    return out


def group_contributions(
    contributions: DataFrame, key: str, groups: dict[str, list[str]] = FEATURE_GROUPS
) -> DataFrame:
    """``key, group, contribution``: sums per group; features the table lacks are ignored."""
    structs = _group_structs(contributions.columns, groups, {})
    return contributions.select(key, F.inline(F.array(*structs))).select(key, "group", "contribution")


def _ranked(columns: list[str], groups: dict, texts: dict, top_n: int) -> Column:
    """Reasons that push towards default, strongest first, ties in group order."""
    pushing = F.filter(F.array(*_group_structs(columns, groups, texts)), lambda g: g["contribution"] > 0)
    return F.slice(F.sort_array(pushing), 1, top_n)


def reason_codes(
    contributions: DataFrame, key: str, groups: dict[str, list[str]] = FEATURE_GROUPS,
    texts: dict[str, str] = DEFAULT_REASONS, top_n: int = TOP_REASONS,
) -> DataFrame:
    """``key, rank, group, reason, contribution``; at most ``top_n`` per row."""
    ranked = _ranked(contributions.columns, groups, texts, top_n)
    return contributions.select(key, F.posexplode(ranked).alias("at", "r")).select(
        key, (F.col("at") + 1).alias("rank"), "r.group", "r.reason", "r.contribution"
    )


def notices(
    contributions: DataFrame, key: str, decision: str = "denied", groups: dict[str, list[str]] = FEATURE_GROUPS,
    texts: dict[str, str] = DEFAULT_REASONS, top_n: int = TOP_REASONS,
) -> DataFrame:
    """``key, notice``: the rendered letter of each row."""
    ranked = _ranked(contributions.columns, groups, texts, top_n)
    lines = F.transform(ranked, lambda r, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), r["reason"]))
    listed = F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(
        F.lit("  (no group has a positive contribution)")
    )
    return contributions.select(key, F.concat_ws(
        "\n",
        F.lit("Decision on a credit application"),
        F.concat(F.lit("Reference: "), F.col(key).cast("string")),
        F.lit(f"Decision: {decision}"),
        F.lit("Reasons:"),
        listed,
        F.lit("Listed by contribution to the score, largest first."),
    ).alias("notice"))


def highest_risk(scored: DataFrame, key: str, score: str = "probability") -> DataFrame:
    """The row with the highest score, ties by key."""
    return scored.orderBy(F.desc_nulls_last(score), key).limit(1)
