"""Table profiles, data-quality checks and class balance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources.tables import nan_to_null


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(row: DataFrame, cols: list[str], names: tuple[str, str]) -> DataFrame:
    """Turn the one-row result ``c0, c1, ...`` into ``(column, value)`` rows."""
    pairs = [F.struct(F.lit(c).alias(names[0]), F.col(f"c{i}").alias(names[1])) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*pairs)))


def null_rates(df: DataFrame, cols: list[str] | None = None, top: int | None = 10) -> DataFrame:
    """Share of missing values per column in one pass, highest first."""
    cols = cols or df.columns
    df = nan_to_null(df.select(*cols))
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    out = _long(row, cols, ("column", "null_rate")).orderBy(F.desc_nulls_last("null_rate"), "column")
    return out.limit(top) if top else out


def target_correlations(
    df: DataFrame, target: str, cols: list[str] | None = None, top: int | None = 12
) -> DataFrame:
    """Absolute Pearson correlation of each numeric column with the target in one pass, highest first."""
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    row = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    out = _long(row, cols, ("column", "abs_corr")).orderBy(F.desc_nulls_last("abs_corr"), "column")
    return out.limit(top) if top else out


def table_profile(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns and positive rate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.avg(target).alias("positive_rate"),
    )


def distinct_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact: one (column, value) grouping for all columns; the second count is
    map-side combined, so no column's values meet in one task. Approximate: one
    sketched pass without a shuffle of values.
    """
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(cols)])
        return _long(row, cols, ("column", "n_distinct"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    values = df.select(F.inline(F.array(*pairs))).where("value IS NOT NULL")
    counted = values.groupBy("column", "value").agg(F.lit(1).alias("one")).groupBy("column").agg(
        F.count("one").alias("n_distinct")
    )
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(counted, "column", "left").select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def exceeds_distinct(df: DataFrame, cols: list[str], limit: int = 10) -> dict[str, bool]:
    """Whether each column has more than ``limit`` distinct non-null values.

    A sketch settles the clear cases in one pass; only columns near the limit,
    whose values combine to a few rows per task, are counted exactly.
    """
    if not cols:
        return {}
    row = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    rough = {c: row[f"c{i}"] for i, c in enumerate(cols)}
    close = [c for c in cols if rough[c] <= 5 * limit]
    exact = {r["column"]: r["n_distinct"] for r in distinct_counts(df, close).collect()} if close else {}
    return {c: exact.get(c, rough[c]) > limit for c in cols}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Class counts, the positive weight and the two balanced weights, as one row."""
    counts = df.agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("n_pos"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("n_neg"),
        F.count(F.lit(1)).alias("n"),
    )
    floor_pos, floor_neg = F.greatest("n_pos", F.lit(1)), F.greatest("n_neg", F.lit(1))
    return counts.select(
        "n_pos", "n_neg",
        (F.col("n_neg") / floor_pos).alias("pos_weight"),
        (F.col("n") / (2 * floor_neg)).alias("weight_0"),
        (F.col("n") / (2 * floor_pos)).alias("weight_1"),
    )


def class_rates(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """Rows and positive rate per group, such as the split."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(label).alias("positive_rate"))


# --------------------------------------------------------------------------- quality checks
def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: is it there, with which type, and in how many rows it is filled."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    row = df.agg(*[
        (F.count(c) if c in types else F.lit(0).cast("long")).alias(f"c{i}") for i, c in enumerate(required)
    ])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(c in types).alias("present"),
                 F.lit(types.get(c)).cast("string").alias("type"), F.col(f"c{i}").alias("n_filled"))
        for i, c in enumerate(required)
    ])))


def class_rate_bounds(df: DataFrame, label: str, low: float, high: float) -> DataFrame:
    """Positive rate and whether it lies strictly between the bounds."""
    rate = F.col("positive_rate")
    return df.agg(F.avg(label).alias("positive_rate")).select(
        "positive_rate", ((rate > low) & (rate < high)).alias("ok")
    )


def leakage_check(df: DataFrame, label: str, cols: list[str], limit: float = 0.1) -> DataFrame:
    """Columns whose correlation with the label is suspiciously high; undefined counts as fine."""
    found = target_correlations(df, label, cols, top=None)
    return found.select("column", "abs_corr", F.coalesce(F.col("abs_corr") < limit, F.lit(True)).alias("ok"))


def split_integrity(whole: DataFrame, train: DataFrame, test: DataFrame, key: str, label: str) -> DataFrame:
    """One row: counts per side, shared keys, missing keys, and the test positives."""
    tagged = reduce(DataFrame.unionByName, [
        part.select(key, F.col(label).cast("long").alias("y"), F.lit(name).alias("part"))
        for name, part in (("whole", whole), ("train", train), ("test", test))
    ])

    def side(name: str) -> Column:
        return F.sum((F.col("part") == name).cast("long"))

    # rows added to train by resampling have a null key and take no part here
    per_key = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(
        side("whole").alias("whole"), side("train").alias("train"), side("test").alias("test"),
        F.sum(F.when(F.col("part") == "test", F.col("y")).otherwise(0)).alias("test_pos"),
    )
    return per_key.agg(
        F.sum("whole").alias("n_whole"), F.sum("train").alias("n_train"), F.sum("test").alias("n_test"),
        F.sum(((F.col("train") > 0) & (F.col("test") > 0)).cast("long")).alias("n_shared"),
        F.sum((F.col("train") + F.col("test") != F.col("whole")).cast("long")).alias("n_lost"),
        F.sum("test_pos").alias("n_test_pos"),
    )
