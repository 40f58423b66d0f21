"""Histogram boosting, its attribution and the weighted network, against plain versions."""

from __future__ import annotations

import itertools
import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import attribution as at
from riskweave.operators import boosting as bo
from riskweave.operators import models as md
from riskweave.operators import network as nw

NAMES = ["a", "b", "c"]


def made(spark, n=1500, parts=3):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(n, 3)).round(2)
    x[draw.random(x.shape) < 0.08] = np.nan
    odds = np.nan_to_num(x[:, 0]) * 2 - np.isnan(x[:, 1]) * 3 + np.nan_to_num(x[:, 1] * x[:, 2]) - 1
    y = (draw.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    rows = [(i, int(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c double").repartition(parts).persist(), x, y


def plain_trees(x, y, edges, weight, trees, growth):
    """The same trees by one process without any sums kept: every node looks at its rows anew."""
    codes = np.stack([np.where(np.isnan(c), bo.BINS, np.searchsorted(e, c)) for c, e in zip(x.T, edges)])
    w = np.where(y == 1, weight, 1.0)
    margin = np.full(len(y), math.log((w * y).sum() / (w * (1 - y)).sum()))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def grow(rows, depth):
            total = g[rows].sum(), h[rows].sum()
            best = (1e-9, None)
            for f in range(len(codes)) if depth else ():
                c = codes[f][rows]
                for b in range(len(edges[f]) + 1):
                    for missing in (True, False):
                        left = (c <= b) | ((c == bo.BINS) & missing) if missing else c <= b
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        gr, hr = total[0] - gl, total[1] - hl
                        if hl >= growth.least_hessian and hr >= growth.least_hessian:
                            gain = 0.5 * (gl**2 / (hl + growth.l2) + gr**2 / (hr + growth.l2) - total[0]**2 / (total[1] + growth.l2))
                            if gain > best[0] + 1e-12:
                                best = (gain, left)
            if best[1] is None:
                margin[rows] += -growth.step * total[0] / (total[1] + growth.l2)
            else:
                grow(rows[best[1]], depth - 1)
                grow(rows[~best[1]], depth - 1)

        grow(np.arange(len(y)), growth.depth)
    return margin


def test_equals_a_plain_version(spark, monkeypatch):
    df, x, y = made(spark, 600)
    growth = bo.Growth(depth=3, step=0.3, rows=1.0, features=1.0)
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 200)  # several tasks
    monkeypatch.setattr(bo, "STORE_EVERY", 2)
    monkeypatch.setattr(bo, "CHECKPOINT_EVERY", 2)
    edges = [np.array([-1.0, -0.3, 0.0, 0.4, 1.0])] * 3
    monkeypatch.setattr(bo, "_edges", lambda train, features: edges)
    model = bo.fit_trees(df, "y", NAMES, weight=3.0, trees=5, growth=growth, patience=None)
    assert len(model.trees) == 5
    assert np.allclose(model.margin(list(x.T)), plain_trees(x, y, edges, 3.0, 5, growth), atol=1e-9)
    scored = {r["id"]: r["probability"] for r in model.score(df).collect()}
    assert np.allclose([scored[i] for i in range(600)], 1 / (1 + np.exp(-model.margin(list(x.T)))))
    # covers: every row of training lies in one leaf, and a node holds its children's rows
    for tree in model.trees:
        leaves = np.bincount(tree.leaves(list(x.T)), minlength=len(tree.feature))
        assert [c for c, f in zip(tree.cover, tree.feature) if f < 0] == [n for n, f in zip(leaves, tree.feature) if f < 0]
        assert tree.cover[0] == 600


def test_growth_ends_when_held_out_rows_are_ranked_no_better(spark):
    df, x, y = made(spark)
    model = md.fit_gbt(df, "y", NAMES, trees=120, step=0.5, patience=8)
    assert 0 < len(model.trees) < 112
    assert md.fit_gbt(df, "y", NAMES, trees=7, patience=None).trees.__len__() == 7
    assert md.fit_gbt(df, "y", NAMES, trees=6, patience=None) == md.fit_gbt(df, "y", NAMES, trees=6, patience=None)


def test_average_precision_of_counts():
    negative, positive = np.zeros(bo.MARGIN_BINS), np.zeros(bo.MARGIN_BINS)
    positive[[10, 700]], negative[[9, 11]] = 1, 1
    assert bo.average_precision(np.concatenate([negative, positive])) == pytest.approx((1 + 2 / 3) / 2)
    assert bo.average_precision(np.concatenate([negative, 0 * positive])) is None


def test_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(i, 0, 1.0, None) for i in range(30)], "id long, y int, a double, b double")
    model = md.fit_gbt(df, "y", ["a", "b"], trees=3)
    assert all(0 < r["probability"] <= 0.5 for r in model.score(df).collect())
    with pytest.raises(ValueError):
        md.fit_gbt(df.limit(0), "y", ["a", "b"])


def test_models_come_back_from_the_store(spark, tmp_path):
    df, x, _ = made(spark)
    model = md.fit_gbt(df, "y", NAMES, trees=4, patience=None)
    bo.save_trees(spark, model, str(tmp_path / "trees"))
    assert bo.load_trees(spark, str(tmp_path / "trees")) == model


def test_promoters_at_once_get_versions_of_their_own(spark, tmp_path):
    df, _, _ = made(spark)
    model = {"gbm": md.fit_gbt(df, "y", NAMES, trees=2, patience=None)}
    results = spark.createDataFrame([("gbm", 0.5)], "model string, auprc double")
    path = str(tmp_path / "store")
    threads = [threading.Thread(target=md.promote, args=(results, model, path)) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r["version"] for r in md.alias_versions(spark, path).collect()) == [1, 2, 3]
    assert md.load_champion(spark, path) == model["gbm"]


# --------------------------------------------------------------------------- attribution
def random_tree(draw, depth, n_features):
    nodes = {k: [] for k in ("feature", "threshold", "missing_left", "left", "right", "value", "cover")}

    def add(depth, cover):
        i = len(nodes["feature"])
        for k, v in (("feature", -1), ("threshold", 0.0), ("missing_left", bool(draw.random() < 0.5)), ("left", 0), ("right", 0),
                     ("value", float(draw.normal())), ("cover", cover)):
            nodes[k].append(v)
        if depth and cover > 1 and draw.random() < 0.9:
            part = float(draw.integers(1, cover))
            nodes["feature"][i], nodes["threshold"][i] = int(draw.integers(n_features)), float(draw.normal())
            nodes["left"][i], nodes["right"][i] = add(depth - 1, part), add(depth - 1, cover - part)
        return i

    add(depth, 1000.0)
    return bo.Tree(**nodes)


@pytest.mark.parametrize("patterns", [8, 0])
def test_attribution_equals_all_subsets(monkeypatch, patterns):
    monkeypatch.setattr(at, "PATTERN_FEATURES", patterns)
    draw, n = np.random.default_rng(patterns), 6
    model = bo.BoostedTrees([f"f{i}" for i in range(n)], 0.3, [random_tree(draw, 7, n) for _ in range(4)])
    x = draw.normal(size=(12, n))
    x[draw.random(x.shape) < 0.1] = np.nan

    def expected(tree, row, known):
        def walk(i):
            f = tree.feature[i]
            if f < 0:
                return tree.value[i]
            if f in known:
                left = tree.missing_left[i] if np.isnan(row[f]) else row[f] <= tree.threshold[i]
                return walk(tree.left[i] if left else tree.right[i])
            return sum(tree.cover[c] / tree.cover[i] * walk(c) for c in (tree.left[i], tree.right[i]))

        return walk(0)

    found = at.Attribution(model)
    values = found.values(list(x.T))
    for row, got in zip(x, values):
        worth = {s: model.base + sum(expected(t, row, s) for t in model.trees)
                 for size in range(n + 1) for s in itertools.combinations(range(n), size)}
        for j in range(n):
            want = sum(math.factorial(len(s)) * math.factorial(n - 1 - len(s)) / math.factorial(n)
                       * (worth[tuple(sorted((*s, j)))] - worth[s]) for s in worth if j not in s)
            assert got[j] == pytest.approx(want, abs=1e-9)
        assert found.expectation == pytest.approx(worth[()])
    assert np.allclose(values.sum(axis=1) + found.expectation, model.margin(list(x.T)), atol=1e-9)


def test_contributions_of_a_table_add_up(spark):
    df, x, _ = made(spark)
    model = md.fit_gbt(df, "y", NAMES, trees=15, patience=None)
    rows = at.tree_contributions(df, "id", model, "expected").collect()
    margin = model.margin(list(x.T))
    assert len(rows) == 1500
    for r in rows:
        assert r["a"] + r["b"] + r["c"] + r["expected"] == pytest.approx(margin[r["id"]], abs=1e-9)
    # the mean over the training rows is what the covers say
    assert np.mean(margin) == pytest.approx(rows[0]["expected"], abs=1e-9)


# --------------------------------------------------------------------------- network
def test_gradient_equals_differences():
    draw = np.random.default_rng(1)
    sizes = [3, 5, 4, 1]
    x, y, w = draw.normal(size=(40, 3)), draw.integers(0, 2, 40).astype(float), draw.random(40) * 3
    flat = nw.starting_point(sizes, 2) + 0.01
    _, gradient = nw.loss_and_gradient(flat, sizes, x, y, w)
    for i in range(0, len(flat), 3):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        high, low = (nw.loss_and_gradient(flat + s, sizes, x, y, w)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((high - low) / 2e-6, abs=1e-4)


def test_a_weight_is_so_many_copies(spark):
    df, _, _ = made(spark, 400)
    weighted = nw.fit_network(df.withColumn("w", F.lit(2) + F.col("id") % 2), "y", NAMES, (6,), weight="w", iterations=12)
    copied = df.withColumn("k", F.explode(F.sequence(F.lit(1), (F.lit(2) + F.col("id") % 2).cast("int"))))
    # the standardizer sees the copies too, so both are fitted on columns that it leaves alone
    assert weighted.features == NAMES and copied.count() == 1000
    sizes = [3, 6, 1]
    x, y, w = [np.array(v) for v in ([[1.0, 2, 3], [0, 1, -1]], [1.0, 0], [3.0, 2])]
    flat = nw.starting_point(sizes, 1)
    one = nw.loss_and_gradient(flat, sizes, x, y, w)
    many = nw.loss_and_gradient(flat, sizes, np.repeat(x, [3, 2], axis=0), np.repeat(y, [3, 2]), np.ones(5))
    assert one[0] == pytest.approx(many[0]) and np.allclose(one[1], many[1])


def test_positive_weight_and_store(spark, tmp_path):
    df, x, y = made(spark)
    plain, raised = (nw.fit_network(df, "y", NAMES, (6,), positive_weight=w, iterations=25) for w in (1.0, 8.0))
    low, high = (np.array([r["probability"] for r in m.score(df).collect()]).mean() for m in (plain, raised))
    assert low == pytest.approx(y.mean(), abs=0.03) and high > low + 0.1
    nw.save_network(spark, plain, str(tmp_path / "net"))
    assert nw.load_network(spark, str(tmp_path / "net")) == plain


def test_minimum_of_a_bowl():
    scale = np.array([1.0, 30.0, 0.1])
    found = nw.minimise(lambda v: (float((scale * (v - 2) ** 2).sum()), 2 * scale * (v - 2)), np.zeros(3), 60, 0.0)
    assert np.allclose(found, 2, atol=1e-5)


def grown_tree(draw, nodes):
    """A tree grown at random leaves, with thresholds at halves and some at infinity."""
    t = {k: [] for k in ("feature", "threshold", "missing_left", "left", "right", "value", "cover")}

    def add():
        for k, v in zip(t, (-1, 0.0, True, 0, 0, float(draw.normal()), 0.0)):
            t[k].append(v)
        return len(t["feature"]) - 1

    add()
    while len(t["feature"]) < nodes:
        node = int(draw.choice([i for i, f in enumerate(t["feature"]) if f < 0]))
        t["feature"][node], t["missing_left"][node] = int(draw.integers(0, 3)), bool(draw.integers(0, 2))
        t["threshold"][node] = math.inf if draw.random() < 0.1 else float(draw.integers(-8, 8)) / 2
        t["left"][node], t["right"][node] = add(), add()
    return bo.Tree(**t)


def test_leaves_by_look_up_are_those_of_a_walk(monkeypatch):
    draw = np.random.default_rng(5)
    monkeypatch.setattr(bo, "LOOK_ROWS", 300)  # several blocks
    x = draw.integers(-10, 10, size=(3, 1000)) / 2.0
    x[draw.random(x.shape) < 0.1] = np.nan
    x[draw.random(x.shape) < 0.05] = math.inf
    x[draw.random(x.shape) < 0.05] = -math.inf
    for nodes in (1, 3, 15, 63, 65, 199):  # more than 32 leaves need more than one word
        trees = [grown_tree(draw, nodes) for _ in range(4)]
        cuts, found = bo.BoostedTrees(NAMES, 0.25, trees)._look_up
        codes = np.stack([np.where(np.isnan(c), max(map(len, cuts)) + 1, np.searchsorted(e, c)) for c, e in zip(x, cuts)])
        walked = [tree.leaves(list(x)) for tree in trees]
        assert all((bits.leaves(codes) == leaves).all() for (bits, _), leaves in zip(found, walked))
        margin = np.full(1000, 0.25)
        for tree, leaves in zip(trees, walked):
            margin += np.array(tree.value)[leaves]
        assert (bo.BoostedTrees(NAMES, 0.25, trees).margin(list(x)) == margin).all()


def test_a_large_table_is_dealt_out_over_all_cores(spark, monkeypatch):
    df, _, _ = made(spark, 600, parts=1)
    growth, tasks = bo.Growth(rows=1.0, features=1.0, depth=3), set()
    few = bo.fit_trees(df, "y", NAMES, trees=3, growth=growth, patience=None)
    added = bo._added
    monkeypatch.setattr(bo, "_added", lambda rows, work: tasks.add(rows.getNumPartitions()) or added(rows, work))
    monkeypatch.setattr(bo, "MANY_ROWS", 100)
    monkeypatch.setattr(bo, "PIECE_ROWS", 20)
    many = bo.fit_trees(df, "y", NAMES, trees=3, growth=growth, patience=None)
    assert tasks == {spark.sparkContext.defaultParallelism}
    assert [t.feature for t in many.trees] == [t.feature for t in few.trees]
    assert np.allclose([v for t in many.trees for v in t.value], [v for t in few.trees for v in t.value])


def test_equal_rows_of_a_large_table_are_one_with_a_count(spark, monkeypatch):
    """Rows in tasks follow the different quantised rows, not the rows; sums, base, held-out counts and covers are those of all rows."""
    df, _, _ = made(spark, 300, parts=2)
    twelve = df.crossJoin(spark.range(12).select(F.col("id").alias("copy"))).drop("copy")
    growth = bo.Growth(rows=1.0, features=1.0, depth=3)
    options = {"trees": 4, "growth": growth, "patience": 9, "held_out": 0.3}
    few = bo.fit_trees(twelve, "y", NAMES, weight=2.5, **options)
    monkeypatch.setattr(bo, "MANY_ROWS", 100)
    grouped, parts = bo._grouped, []
    monkeypatch.setattr(bo, "_grouped", lambda *a: parts.append(grouped(*a)) or parts[-1])
    many = bo.fit_trees(twelve, "y", NAMES, weight=2.5, **options)
    assert parts[0].count() <= 300 and parts[0].agg(F.sum("times")).first()[0] == 3600
    assert many.base == pytest.approx(few.base) and [t.feature for t in many.trees] == [t.feature for t in few.trees]
    assert [t.cover for t in many.trees] == [t.cover for t in few.trees]
    assert np.allclose([v for t in many.trees for v in t.value], [v for t in few.trees for v in t.value])
    # of equal rows each is drawn by itself
    codes, label = np.zeros((1, 2), np.uint8), np.zeros(2, np.uint8)
    rows = bo.Rows(codes, label, 1.0, np.zeros(2, bool), np.zeros(2), 7, np.array([40_000, 60_000]))
    root = {"feature": [-1], "bin": [0], "missing_left": [True], "left": [0], "right": [0]}
    assert rows.sums(root, [0], 3, 0.8)[1].sum() == pytest.approx(100_000 * 0.8 * 0.25, rel=0.02)
    assert rows.sums(root, [0], 3, 0.8)[1].sum() == rows.sums(root, [0], 3, 0.8)[1].sum()


def test_a_large_table_of_the_network_is_dealt_out_too(spark, monkeypatch):
    df, _, _ = made(spark, 600, parts=1)
    few, tasks, added = nw.fit_network(df, "y", NAMES, (4,), iterations=5), set(), nw.added
    monkeypatch.setattr(nw, "added", lambda parts: tasks.add(parts.getNumPartitions()) or added(parts))
    monkeypatch.setattr(nw, "MANY_ROWS", 100)
    monkeypatch.setattr(nw, "PIECE_ROWS", 20)
    many = nw.fit_network(df, "y", NAMES, (4,), iterations=5)
    assert tasks == {spark.sparkContext.defaultParallelism}
    assert np.allclose(few.weights, many.weights, atol=1e-6)
