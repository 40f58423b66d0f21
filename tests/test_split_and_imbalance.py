from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.risk import key_uniform
from riskweave.operators import profile as pf
from riskweave.operators.imbalance import smote
from riskweave.operators.neighbours import nearest_neighbours, projected_neighbours
from riskweave.operators.split import stable_split, stratified_split

FEATURES = ["v0", "v1", "v2"]


@pytest.fixture(scope="module")
def rare(spark):
    return spark.range(2000).select(
        "id", (key_uniform("rare", "id") < 0.03).cast("int").alias("y"),
        *[(key_uniform(f, "id") * 10).alias(f) for f in FEATURES],
    ).persist()


def test_split_is_disjoint_complete_and_independent_of_partitioning(rare):
    train, test = stable_split(rare, "id")
    row = pf.split_integrity(rare, train, test, "id", "y").first()
    assert (row["n_shared"], row["n_lost"], row["n_train"] + row["n_test"]) == (0, 0, 2000)
    assert 0.22 < row["n_test"] / 2000 < 0.28
    again = stable_split(rare.repartition(7).orderBy(F.desc("id")), "id")[1]
    assert {r["id"] for r in again.collect()} == {r["id"] for r in test.collect()}
    assert {r["id"] for r in stable_split(rare, "id", seed=1)[1].collect()} != {r["id"] for r in test.collect()}


def test_stratified_split_keeps_the_class_rate_exactly(rare):
    train, test = stratified_split(rare, "id", "y")
    sizes = {r["y"]: r["count"] for r in rare.groupBy("y").count().collect()}
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {
        c: int(0.25 * n + 0.5) for c, n in sizes.items()}
    assert train.count() + test.count() == 2000 and train.columns == rare.columns


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 990 + [(1,)] * 10, "y int")
    row = pf.class_weights(df, "y").first()
    assert row["pos_weight"] == 99.0
    assert row["weight_0"] == pytest.approx(1000 / 1980) and row["weight_1"] == 50.0
    none = pf.class_weights(df.where("y = 0"), "y").first()
    assert none["pos_weight"] == 990.0 and none["weight_1"] == 495.0


def _brute_neighbours(x: np.ndarray, ids: np.ndarray, k: int) -> dict:
    out = {}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = sorted((d[j], ids[j]) for j in range(len(x)) if j != i)
        out[ids[i]] = [(int(j), float(dist)) for dist, j in order[:k]]
    return out


@pytest.mark.parametrize("block_rows", [2048, 50, 20])
def test_neighbours_are_exact_with_a_hot_cell(spark, block_rows):
    rng = np.random.default_rng(2)
    x = np.concatenate([np.tile([5.0, 5.0, 5.0], (80, 1)), rng.normal(size=(160, 3))])  # a third are copies
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), *map(float, row)) for i, row in zip(ids, x)], "id long, v0 double, v1 double, v2 double")
    got: dict = {}
    for r in nearest_neighbours(df, "id", FEATURES, 5, block_rows).orderBy("key", "position").collect():
        got.setdefault(r["key"], []).append((r["neighbour"], r["distance"]))
    want = _brute_neighbours(x, ids, 5)
    assert got.keys() == want.keys()
    for key, near in want.items():
        assert [n for n, _ in got[key]] == [n for n, _ in near]
        assert np.allclose([d for _, d in got[key]], [d for _, d in near])


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_smote_grows_the_minority_between_neighbours(rare, block_rows):
    grown = smote(rare, "y", FEATURES, "id", ratio=0.1, block_rows=block_rows)
    sizes = {r["y"]: r["count"] for r in grown.groupBy("y").count().collect()}
    negatives = rare.where("y = 0").count()
    assert sizes == {0: negatives, 1: int(0.1 * negatives)}
    real = {r["id"]: np.array([r[f] for f in FEATURES]) for r in rare.where("y = 1").collect()}
    keys = np.array(list(real))
    near = _brute_neighbours(np.array(list(real.values())), keys, 5)
    for r in grown.where("id IS NULL").collect():
        p = np.array([r[f] for f in FEATURES])
        gaps = [np.linalg.norm(p - real[a]) + np.linalg.norm(p - real[b]) - np.linalg.norm(real[a] - real[b])
                for a in real for b, _ in near[a]]
        assert min(gaps) < 1e-9


def test_smote_does_not_depend_on_partitioning_or_block_size(rare):
    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.where("id IS NULL").drop("id").collect())

    first = rows(smote(rare, "y", FEATURES, "id"))
    assert rows(smote(rare.repartition(5), "y", FEATURES, "id", block_rows=16)) == first


def test_resampling_leaves_the_test_rows_alone(rare):
    train, test = stable_split(rare, "id")
    before = test.agg(F.avg("y")).first()[0]
    grown = smote(train, "y", FEATURES, "id")
    row = pf.split_integrity(rare, grown, test, "id", "y").first()
    assert (row["n_shared"], row["n_lost"]) == (0, 0)
    assert test.agg(F.avg("y")).first()[0] == before


def test_enough_positives_are_left_as_they_are(rare):
    assert smote(rare, "y", FEATURES, "id", ratio=0.001).count() == 2000


def test_profile_and_checks(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None, "a", 0), (2, None, None, "b", 1), (3, 3.0, None, None, 1)], "id long, x double, e double, s string, y int")
    assert [tuple(r) for r in pf.null_rates(df, top=2).collect()] == [("e", 1.0), ("s", pytest.approx(1 / 3))]
    found = {r["column"]: r["abs_corr"] for r in pf.target_correlations(df, "y").collect()}
    assert found["id"] == pytest.approx(abs(np.corrcoef([1, 2, 3], [0, 1, 1])[0, 1])) and found["e"] is None
    assert tuple(pf.table_profile(df, "y").first()) == (3, 5, pytest.approx(2 / 3))
    assert dict(map(tuple, pf.distinct_counts(df, ["x", "e", "s"]).collect())) == {"x": 2, "e": 0, "s": 2}
    assert dict(map(tuple, pf.distinct_counts(df, ["x", "s"], approximate=True).collect())) == {"x": 2, "s": 2}
    wide = spark.range(500).select("id", (F.col("id") % 11).alias("m"), (F.col("id") % 10).alias("t"))
    assert pf.exceeds_distinct(wide, ["id", "m", "t"]) == {"id": True, "m": True, "t": False}
    there = [tuple(r) for r in pf.required_columns(df, ["id", "x", "z"]).collect()]
    assert there == [("id", True, "bigint", 3), ("x", True, "double", 2), ("z", False, None, 0)]
    assert pf.class_rate_bounds(df, "y", 0.5, 0.7).first()["ok"] and not pf.class_rate_bounds(df, "y", 0.7, 0.9).first()["ok"]
    leaks = {r["column"]: r["ok"] for r in pf.leakage_check(df, "y", ["id", "e"], 0.1).collect()}
    assert leaks == {"id": False, "e": True}


def test_projected_neighbours_in_28_dimensions(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(60, 28)) * 3
    x = centres[draw.integers(0, 60, 4000)] + draw.normal(size=(4000, 28))
    names = [f"v{i}" for i in range(28)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in names)).repartition(4)
    found, took = projected_neighbours(df, "id", names, k=5, tables=4, block_rows=100)
    assert took["tables"] and took["recall"] >= 0.9 and took["visits_per_row"] < 4000
    exact = {(r["key"], r["neighbour"]) for r in nearest_neighbours(df, "id", names, 5, 100).collect()}
    got = found.collect()
    assert len({(r["key"], r["neighbour"]) for r in got} & exact) / len(exact) >= 0.88
    assert len(got) == len({(r["key"], r["neighbour"]) for r in got}) and max(r["position"] for r in got) == 5
    # a recall that buckets don't reach is met by the exact way
    same, took = projected_neighbours(df, "id", names, k=5, tables=32, probes=1, recall=1.1, block_rows=100)
    assert took["tables"] == 0 and {(r["key"], r["neighbour"]) for r in same.collect()} == exact
