"""Stored sketches of distinct values and quantiles, one row per part of a table and column, merged for any range of parts.

Reading a range touches the sketches of its parts and no row of the table. Distinct counts come from HyperLogLog registers (relative error about
1.04 / sqrt(2 ** precision)), quantiles from KLL sketches (rank error about 2.3 / k ** 0.9). Both merge without loss against one sketch
over all rows. Everything runs on built-in aggregates, combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the registers' number, and the size of a quantile sketch.
PRECISION, SIZE = 13, 400


def distinct_error(precision: int = PRECISION) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (precision / 2)


def rank_error(size: int = SIZE) -> float:
    """Error of a quantile's rank, as a share of the rows, that is exceeded in about one of a hundred cases."""
    return 2.296 / size**0.9021


def table_sketches(df: DataFrame, part: Column, columns: list[str], precision: int = PRECISION, size: int = SIZE) -> DataFrame:
    """``part, column, n, n_null, distinct_sketch, quantile_sketch``; only numbers have quantiles. NaN counts as missing.

    Rows without a part are in the part null.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    numeric = [c for c in columns if isinstance(kinds[c], T.NumericType)]
    picked = df.select(part.alias("part"), *[
        (F.when(~F.isnan(c), F.col(c)) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else F.col(c)).alias(c) for c in columns])
    found = []
    for i, c in enumerate(columns):
        # the registers take whole numbers, strings and bytes
        value = F.col(c) if isinstance(kinds[c], (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else F.col(c).cast("string")
        found += [F.count(c).alias(f"_n{i}"), F.hll_sketch_agg(value, precision).alias(f"_d{i}")]
        if c in numeric:
            found.append(F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(f"_q{i}"))
    wide = picked.groupBy("part").agg(F.count(F.lit(1)).alias("_all"), *found)
    rows = [F.struct(
        F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), (F.col("_all") - F.col(f"_n{i}")).alias("n_null"),
        F.col(f"_d{i}").alias("distinct_sketch"),
        (F.col(f"_q{i}") if c in numeric else F.lit(None).cast("binary")).alias("quantile_sketch")) for i, c in enumerate(columns)]
    return wide.select("part", F.inline(F.array(*rows)))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """``column, n, n_distinct`` of the parts given."""
    return sketches.groupBy("column").agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"))


def sketched_quantiles(sketches: DataFrame, probabilities: list[float]) -> DataFrame:
    """``column, probability, value`` of the parts given, for the columns that have quantiles."""
    merged = sketches.where("quantile_sketch is not null and n > 0").groupBy("column").agg(F.kll_merge_agg_double("quantile_sketch").alias("s"))
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("value"))
                      for p in probabilities])
    return merged.select("column", F.inline(pairs))
