"""Applicant features from one-to-many history tables, and event features over time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import risk
from riskweave.operators.ordered import Pieces, plan_pieces, previous_values, quantiles, ranked, running_sums
from riskweave.sources.tables import nan_to_null

# The output columns of the applicant feature table, and those
# among them that mean "nothing happened" when an applicant has no history.
HISTORY_FEATURES = (
    "BUREAU_CNT", "BUREAU_ACTIVE_CNT", "BUREAU_DEBT_MEAN", "BUREAU_OVERDUE_SUM", "BUREAU_MAX_DAYS_OVERDUE",
)
PRIOR_FEATURES = ("PREV_CNT", "PREV_REFUSED_RATE", "PREV_LAST_AMT_CREDIT")
ZERO_FILLED = {
    "BUREAU_CNT": 0, "BUREAU_ACTIVE_CNT": 0, "BUREAU_OVERDUE_SUM": 0.0, "BUREAU_MAX_DAYS_OVERDUE": 0,
    "PREV_CNT": 0, "PREV_REFUSED_RATE": 0.0,
}
FEATURE_GROUPS = {
    "External credit scores": ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"],
    "Debt-to-income": ["DTI", "AMT_ANNUITY", "CREDIT_INCOME_RATIO", "AMT_CREDIT"],
    "Income": ["AMT_INCOME_TOTAL"],
    "Age & employment": ["AGE_YEARS", "EMPLOYED_YEARS"],
    "Prior bureau delinquency": [
        "BUREAU_OVERDUE_SUM", "BUREAU_MAX_DAYS_OVERDUE", "BUREAU_DEBT_MEAN", "BUREAU_ACTIVE_CNT", "BUREAU_CNT",
    ],
    "Prior application history": ["PREV_REFUSED_RATE", "PREV_CNT", "PREV_LAST_AMT_CREDIT"],
    "Household": ["CNT_CHILDREN"],
    "Region": ["REGION_RATING_CLIENT"],
}


@dataclass(frozen=True)
class ApplicantColumns:
    """Names of the applicant columns; ``None`` leaves the features that need it out."""

    key: str = "SK_ID_CURR"
    annuity: str | None = "AMT_ANNUITY"
    income: str | None = "AMT_INCOME_TOTAL"
    credit: str | None = "AMT_CREDIT"
    days_birth: str | None = "DAYS_BIRTH"
    days_employed: str | None = "DAYS_EMPLOYED"


@dataclass(frozen=True)
class HistoryColumns:
    """Names of the credit-history columns."""

    key: str = "SK_ID_CURR"
    status: str = "CREDIT_ACTIVE"
    debt: str = "AMT_CREDIT_SUM_DEBT"
    overdue: str = "AMT_CREDIT_SUM_OVERDUE"
    days_overdue: str = "CREDIT_DAY_OVERDUE"
    active_value: str = "Active"


@dataclass(frozen=True)
class PriorColumns:
    """Names of the prior-application columns; ``day`` grows towards the present."""

    key: str = "SK_ID_CURR"
    id: str = "SK_ID_PREV"
    status: str = "NAME_CONTRACT_STATUS"
    amount: str = "AMT_CREDIT"
    day: str = "DAYS_DECISION"
    refused_value: str = "Refused"


def applicant_ratios(app: DataFrame, cols: ApplicantColumns = ApplicantColumns()) -> DataFrame:
    """Add DTI, CREDIT_INCOME_RATIO, AGE_YEARS and EMPLOYED_YEARS."""
    added: dict[str, Column] = {}
    if cols.annuity and cols.income:
        added["DTI"] = risk.debt_to_income(cols.annuity, cols.income)
    if cols.credit and cols.income:
        added["CREDIT_INCOME_RATIO"] = risk.credit_income_ratio(cols.credit, cols.income)
    if cols.days_birth:
        added["AGE_YEARS"] = risk.age_years(cols.days_birth)
    if cols.days_employed:
        added["EMPLOYED_YEARS"] = risk.employed_years(cols.days_employed)
    return app.withColumns(added)


def applicant_ratios_sql(app: DataFrame, cols: ApplicantColumns = ApplicantColumns()) -> DataFrame:
    """The first three ratios as Spark SQL over the DataFrame; no view name is left behind."""
    return app.sparkSession.sql(
        """
        SELECT *,
               CAST(IDENTIFIER(:annuity) AS DOUBLE)
                   / nullif(CAST(IDENTIFIER(:income) AS DOUBLE) / 12.0D, 0D) AS DTI,
               CAST(IDENTIFIER(:credit) AS DOUBLE)
                   / nullif(CAST(IDENTIFIER(:income) AS DOUBLE), 0D) AS CREDIT_INCOME_RATIO,
               CAST(-IDENTIFIER(:birth) AS DOUBLE) / 365.25D AS AGE_YEARS
        FROM {applicants}
        """,
        args={"annuity": cols.annuity, "income": cols.income, "credit": cols.credit, "birth": cols.days_birth},
        applicants=app,
    )


def history_aggregates(history: DataFrame, cols: HistoryColumns = HistoryColumns()) -> DataFrame:
    """Five aggregates per applicant; map-side combined, so a hot applicant costs one row per task."""
    active = F.when(F.col(cols.status) == cols.active_value, 1).otherwise(0)
    return history.groupBy(cols.key).agg(
        F.count(F.lit(1)).alias("BUREAU_CNT"),
        F.sum(active).alias("BUREAU_ACTIVE_CNT"),
        F.avg(cols.debt).alias("BUREAU_DEBT_MEAN"),
        F.sum(cols.overdue).alias("BUREAU_OVERDUE_SUM"),
        F.max(cols.days_overdue).alias("BUREAU_MAX_DAYS_OVERDUE"),
    )


def prior_aggregates(
    prior: DataFrame, cols: PriorColumns = PriorColumns(), ignore_nulls: bool = False
) -> DataFrame:
    """Count, refused rate and amount of the latest application per applicant.

    The latest is the largest day, then the smallest id; a missing day is the
    oldest. ``min_by`` needs neither a window nor a sort, and ids may be of any type. With ``ignore_nulls``
    the latest application that has an amount counts.
    """
    latest = F.struct(F.col(cols.day).isNull(), -F.col(cols.day), F.col(cols.id))
    amount = F.col(cols.amount)
    if ignore_nulls:
        latest = F.when(amount.isNotNull(), latest)
    # a missing status counts as not refused
    refused = F.when(F.col(cols.status) == cols.refused_value, 1.0).otherwise(0.0)
    return prior.groupBy(cols.key).agg(
        F.count(F.lit(1)).alias("PREV_CNT"),
        F.avg(refused).alias("PREV_REFUSED_RATE"),
        F.min_by(amount, latest).alias("PREV_LAST_AMT_CREDIT"),
    )


def zero_fill(features: DataFrame) -> DataFrame:
    """Zero for the six count-like columns; mean debt and latest amount stay missing."""
    return features.fillna({c: v for c, v in ZERO_FILLED.items() if c in features.columns})


def applicant_features(
    app: DataFrame,
    history: DataFrame | None = None,
    prior: DataFrame | None = None,
    app_cols: ApplicantColumns = ApplicantColumns(),
    history_cols: HistoryColumns = HistoryColumns(),
    prior_cols: PriorColumns = PriorColumns(),
) -> DataFrame:
    """One row per applicant. Histories are aggregated before the join; an absent one is skipped."""
    features = applicant_ratios(app, app_cols)
    for aggregated in (
        history_aggregates(history, history_cols).withColumnRenamed(history_cols.key, app_cols.key)
        if history is not None else None,
        prior_aggregates(prior, prior_cols).withColumnRenamed(prior_cols.key, app_cols.key)
        if prior is not None else None,
    ):
        if aggregated is not None:
            features = features.join(aggregated, app_cols.key, "left")
    return zero_fill(features)


def model_features(df: DataFrame, groups: dict[str, list[str]] = FEATURE_GROUPS) -> list[str]:
    """Columns of all groups, in order, that the table has."""
    return [c for members in groups.values() for c in members if c in df.columns]


def recency_ranks(
    prior: DataFrame, cols: PriorColumns = PriorColumns(), name: str = "recency_rank", pieces: Pieces | None = None
) -> DataFrame:
    """1 for the latest application of each applicant; a missing day comes last."""
    return ranked(prior, [cols.key], -F.col(cols.day), cols.id, name, pieces)


# --------------------------------------------------------------------------- train statistics
def fit_medians(train: DataFrame, cols: list[str], accuracy: int | None = None) -> dict[str, float | None]:
    """Exact medians of the training rows (``accuracy`` switches to a sketch)."""
    found = quantiles(train, cols, [0.5], accuracy)
    return {c: q[0] if q else None for c, q in found.items()}


def impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Missing values become the given medians; a column without a median stays as it is."""
    known = {c: m for c, m in medians.items() if m is not None}
    def filled(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(known[c])).alias(c)

    return df.select(*[filled(c) if c in known else F.col(c) for c in df.columns])


def fit_standardizer(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of the training rows; NaN is missing."""
    row = nan_to_null(train.select(*cols)).agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]], epsilon: float = 1e-8) -> DataFrame:
    """(x - mean) / (deviation + epsilon)."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s + epsilon) for c, (m, s) in stats.items()})


# --------------------------------------------------------------------------- events over time
def rolling_count(
    events: DataFrame, key: str, seconds: Column, window: int, name: str = "n_recent", pieces: Pieces | None = None
) -> DataFrame:
    """Per (key, second): events of the key in the ``window`` seconds up to it, both ends included.

    The count is the events so far minus the events before the window opens. Both
    come from one running sum over event marks and window-open marks, so a hot key
    is cut along time like any other.
    """
    pieces = plan_pieces(events, seconds.cast("long") * 2) if pieces is None else pieces
    per_second = events.groupBy(key, seconds.cast("long").alias("second")).agg(F.count(F.lit(1)).alias("n"))
    # a window opens just before its first second: order doubled seconds, openings one lower
    marks = per_second.select(
        key,
        F.inline(F.array(
            F.struct((F.col("second") * 2).alias("mark"), F.col("n").alias("n"), F.col("second").alias("closes")),
            F.struct(((F.col("second") - window) * 2 - 1).alias("mark"), F.lit(0).cast("long").alias("n"),
                     F.col("second").alias("closes")),
        )),
    )
    summed = running_sums(marks, [key], "mark", ["n"], pieces)
    is_event = F.col("mark") == F.col("closes") * 2
    return (
        summed.groupBy(key, F.col("closes").alias("second"))
        .agg(F.sum(F.when(is_event, F.col("cum_n")).otherwise(-F.col("cum_n"))).alias(name))
    )


def state_changes(
    df: DataFrame, key: str, order: Column, tie: str, state: str, pieces: Pieces | None = None
) -> DataFrame:
    """Add ``previous`` = the key's state just before this row."""
    return previous_values(df, [key], order, tie, state, "previous", pieces)


def transition_matrix(
    df: DataFrame, key: str, order: Column, tie: str, state: str, pieces: Pieces | None = None
) -> DataFrame:
    """Counts and row shares of state changes: ``previous, current, n, share``."""
    pairs = (
        state_changes(df, key, order, tie, state, pieces)
        .where("previous IS NOT NULL")
        .groupBy("previous", F.col(state).alias("current")).agg(F.count(F.lit(1)).alias("n"))
    )
    # the pair counts have one row per pair of states, so these totals are small
    totals = pairs.groupBy("previous").agg(F.sum("n").alias("total"))
    return pairs.join(totals, "previous").select(
        "previous", "current", "n", (F.col("n") / F.col("total")).alias("share")
    )

