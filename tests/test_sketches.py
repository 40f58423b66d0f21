"""Stored sketches, merged, against exact counts and ranks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators import sketches as sk


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20_000).select(
        (F.col("id") % 6).alias("part"), (F.col("id") * 7919 % 3001).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") / 7).alias("b"),
        F.concat(F.lit("s"), (F.col("id") % 11).cast("string")).alias("s"), F.when(F.col("id") % 4 == 0, F.lit(float("nan"))).otherwise(F.lit(1.5)).alias("nan")).persist()


def test_any_range_of_parts(spark, rows, tmp_path):
    sk.table_sketches(rows, F.col("part"), ["a", "b", "s", "nan"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 24
    for low, high in ((0, 5), (2, 3), (4, 4)):
        own = rows.where(F.col("part").between(low, high))
        found = {r["column"]: r for r in sk.distinct_counts(stored.where(F.col("part").between(low, high))).collect()}
        for c in ("a", "b", "s"):
            exact = own.agg(F.count_distinct(c), F.count(c)).first()
            assert found[c]["n_distinct"] == pytest.approx(exact[0], rel=4 * sk.distinct_error()) and found[c]["n"] == exact[1]
        assert found["nan"]["n_distinct"] == 1
        for r in sk.sketched_quantiles(stored.where(F.col("part").between(low, high)), [0.1, 0.5, 0.99]).where("column <> 'nan'").collect():
            share = own.agg(F.avg((F.col(r["column"]) <= r["value"]).cast("double"))).first()[0]
            share = share if r["column"] == "a" else own.where("b is not null").agg(F.avg((F.col("b") <= r["value"]).cast("double"))).first()[0]
            assert share == pytest.approx(r["probability"], abs=2 * sk.rank_error())


def test_merging_equals_one_sketch_over_all(rows):
    parts = sk.table_sketches(rows, F.col("part"), ["a"])
    whole = sk.table_sketches(rows, F.lit(0), ["a"])
    assert sk.distinct_counts(parts).first()["n_distinct"] == sk.distinct_counts(whole).first()["n_distinct"]


def test_nothing_and_nulls(spark):
    df = spark.createDataFrame([(None, None, None), (1, None, "x")], "part int, a double, s string")
    found = {(r["part"], r["column"]): (r["n"], r["n_null"]) for r in sk.table_sketches(df, F.col("part"), ["a", "s"]).collect()}
    assert found == {(None, "a"): (0, 1), (None, "s"): (0, 1), (1, "a"): (0, 1), (1, "s"): (1, 0)}
    assert sk.sketched_quantiles(sk.table_sketches(df, F.col("part"), ["a"]), [0.5]).collect() == []
    assert sk.distinct_counts(sk.table_sketches(df.limit(0), F.col("part"), ["a"])).collect() == []
