"""Weight of evidence and information value over many features in one job."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.risk import step_index
from riskweave.operators.ordered import quantiles
from riskweave.operators.profile import exceeds_distinct, numeric_columns

# The smoothing added to each class count, the label and index of
# the bin for missing values, and the selection floor of the ranking.
SMOOTHING = 0.5
MISSING = "MISSING"
MISSING_INDEX = -1
IV_FLOOR = 0.02

BIN_COLUMNS = ("feature", "bin_index", "lo", "hi", "category", "n", "n_bad", "woe", "iv_contribution")


# --------------------------------------------------------------------------- bins
def quantile_edges(
    df: DataFrame, cols: list[str], n_bins: int = 10, accuracy: int | None = None, decimals: int | None = None
) -> dict[str, list[float]]:
    """Distinct quantile edges per column; fewer than two mean the column cannot be cut."""
    found = quantiles(df, cols, [i / n_bins for i in range(n_bins + 1)], accuracy)
    out = {}
    for c, values in found.items():
        values = values or []
        out[c] = sorted(set(values if decimals is None else [round(v, decimals) for v in values]))
    return out


def bin_index(value: Column, edges: list[float]) -> Column:
    """Right-closed bin with the lowest value included; missing (or uncut) is -1."""
    value = value.cast("double")
    if len(edges) < 2:
        return F.lit(MISSING_INDEX)
    return F.when(value.isNull() | F.isnan(value), F.lit(MISSING_INDEX)).otherwise(step_index(value, edges[1:-1]))


def _woe(bad: Column, good: Column, total_bad: Column, total_good: Column) -> tuple[Column, Column]:
    share_bad = (bad + SMOOTHING) / (F.greatest(total_bad, F.lit(1)) + SMOOTHING)
    share_good = (good + SMOOTHING) / (F.greatest(total_good, F.lit(1)) + SMOOTHING)
    woe = F.ln(share_good / share_bad)
    return woe, (share_good - share_bad) * woe


def woe_from_counts(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Add ``woe`` and ``iv_contribution`` to rows with ``n, n_bad``.

    ``totals`` is the one-row frame ``(total_bad, total_good)``; the smoothing goes
    on each class total once, not once per bin.
    """
    both = totals.select(F.struct("total_bad", "total_good").alias("t")).scalar()
    woe, iv = _woe(F.col("n_bad"), F.col("n") - F.col("n_bad"), both["total_bad"], both["total_good"])
    return counts.select("*", woe.alias("woe"), iv.alias("iv_contribution"))


def class_totals(df: DataFrame, target: str) -> DataFrame:
    y = F.col(target).cast("long")
    return df.agg(F.coalesce(F.sum(y), F.lit(0)).alias("total_bad"),
                  F.coalesce(F.sum(1 - y), F.lit(0)).alias("total_good"))


def _category(df: DataFrame, col: str) -> Column:
    """A value as its own bin; null and NaN are missing."""
    floating = df.schema[col].dataType.typeName() in ("double", "float")
    value = F.when(~F.isnan(col), F.col(col)) if floating else F.col(col)
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def _with_own_totals(counts: DataFrame) -> DataFrame:
    """As :func:`woe_from_counts`; the class totals are the sums over any one feature's bins, so the table isn't read again."""
    per_feature = Window.partitionBy("feature")
    woe, iv = _woe(F.col("n_bad"), F.col("n") - F.col("n_bad"), F.sum("n_bad").over(per_feature),
                   F.sum(F.col("n") - F.col("n_bad")).over(per_feature))
    return counts.select("*", woe.alias("woe"), iv.alias("iv_contribution"))


def _bin_counts(df: DataFrame, target: str, numeric: dict[str, list[float]], categorical: list[str]) -> DataFrame:
    """``feature, bin_index, category, n, n_bad`` for all features from one scan and one grouping."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), bin_index(F.col(c), edges).alias("bin_index"),
                 F.lit(None).cast("string").alias("category"))
        for c, edges in numeric.items()
    ] + [
        F.struct(F.lit(c).alias("feature"), F.lit(None).cast("int").alias("bin_index"),
                 _category(df, c).alias("category"))
        for c in categorical
    ]
    long = df.select(F.col(target).cast("long").alias("_y"), F.inline(F.array(*pairs)))
    return long.groupBy("feature", "bin_index", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("n_bad")
    )


def _with_limits(counts: DataFrame, numeric: dict[str, list[float]]) -> DataFrame:
    """Add ``lo`` and ``hi`` of the numeric bins."""
    if not numeric:
        return counts.withColumns({"lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double")})
    rows = [(c, i, edges[i], edges[i + 1]) for c, edges in numeric.items() for i in range(len(edges) - 1)]
    limits = counts.sparkSession.createDataFrame(rows, "feature string, bin_index int, lo double, hi double")
    # one row per feature and bin: bounded by the arguments
    return counts.join(F.broadcast(limits), ["feature", "bin_index"], "left").withColumn(
        "category", F.when(F.col("bin_index") == MISSING_INDEX, MISSING).otherwise(F.col("category"))
    )


def woe_tables(
    df: DataFrame, target: str, numeric: dict[str, list[float]], categorical: list[str] = ()
) -> DataFrame:
    """WOE/IV rows of many features: numeric ones with given edges, categorical ones by value."""
    counts = _with_limits(_bin_counts(df, target, numeric, list(categorical)), numeric)
    return _with_own_totals(counts).select(*BIN_COLUMNS)


def woe_numeric(
    df: DataFrame, col: str, target: str, n_bins: int = 10, accuracy: int | None = None, decimals: int | None = None
) -> DataFrame:
    return woe_tables(df, target, quantile_edges(df, [col], n_bins, accuracy, decimals))


def woe_categorical(df: DataFrame, col: str, target: str) -> DataFrame:
    return woe_tables(df, target, {}, [col])


# --------------------------------------------------------------------------- ranking
def iv_ranking(
    df: DataFrame,
    target: str,
    features: list[str] | None = None,
    iv_floor: float = IV_FLOOR,
    n_bins: int = 10,
    accuracy: int | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """``feature, iv, selected``, best first.

    A numeric feature with more than ten distinct values is cut at its quantiles,
    any other is taken by value; a feature that yields nothing gets 0.
    """
    features = features or [c for c in df.columns if c != target]
    numbers = [c for c in numeric_columns(df) if c in features]
    many = exceeds_distinct(df, numbers, 10)
    continuous = [c for c in numbers if many[c]]
    edges = quantile_edges(df, continuous, n_bins, accuracy, decimals) if continuous else {}
    counts = _bin_counts(df, target, edges, [c for c in features if c not in edges])
    found = _with_own_totals(counts).groupBy("feature").agg(
        F.sum("iv_contribution").alias("iv")
    )
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    iv = F.coalesce(F.col("iv"), F.lit(0.0))
    return (
        names.join(found, "feature", "left")
        .select("feature", iv.alias("iv"), (iv >= iv_floor).alias("selected"))
        .orderBy(F.desc("iv"), "feature")
    )


def selected_features(ranking: DataFrame, features: list[str]) -> list[str]:
    """Names that passed the floor, best first; all of them when none did."""
    passed = [r["feature"] for r in ranking.where("selected").orderBy(F.desc("iv"), "feature").collect()]
    return passed or list(features)


def monotone_share(bins: DataFrame) -> DataFrame:
    """Per feature: share of neighbouring numeric bins whose WOE does not rise."""
    order = Window.partitionBy("feature").orderBy("bin_index")  # at most n_bins rows per feature
    steps = bins.where((F.col("bin_index") >= 0)).withColumn("step", F.col("woe") - F.lag("woe").over(order))
    return steps.where("step IS NOT NULL").groupBy("feature").agg(
        F.avg((F.col("step") <= 0).cast("double")).alias("falling_share")
    )


# --------------------------------------------------------------------------- monotonic binning
def monotonic_bins(
    df: DataFrame, target: str, features: list[str], prebins: int = 20, accuracy: int | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Bins whose bad rate only rises or only falls, from at most ``prebins`` quantile bins.

    Spark reduces the table to the pre-bin counts; neighbouring bins that break the
    direction are then pooled per feature (a group has at most prebins + 1 rows).
    """
    edges = quantile_edges(df, features, prebins, accuracy, decimals)
    counts = _with_limits(_bin_counts(df, target, edges, []), edges)
    merged = counts.groupBy("feature").applyInPandas(
        _pool_feature, "feature string, bin_index int, lo double, hi double, category string, n long, n_bad long"
    )
    return _with_own_totals(merged).select(*BIN_COLUMNS)


def _pool_feature(rows: pd.DataFrame) -> pd.DataFrame:
    columns = ["feature", "bin_index", "lo", "hi", "category", "n", "n_bad"]
    missing = rows[rows["bin_index"] == MISSING_INDEX]
    bins = rows[rows["bin_index"] != MISSING_INDEX].sort_values("bin_index")
    if bins.empty:
        return missing[columns]
    mid = bins["n"].cumsum() - bins["n"] / 2
    centre = (mid * bins["n"]).sum() / bins["n"].sum()
    rate = bins["n_bad"].sum() / bins["n"].sum()
    rising = ((mid - centre) * (bins["n_bad"] - rate * bins["n"])).sum() >= 0
    pooled: list[list] = []
    for r in bins.itertuples():
        pooled.append([r.lo, r.hi, r.n, r.n_bad])
        while len(pooled) > 1:
            left, right = pooled[-2], pooled[-1]
            gap = right[3] * left[2] - left[3] * right[2]  # sign of the change in bad rate
            if gap > 0 if rising else gap < 0:
                break
            pooled[-2:] = [[left[0], right[1], left[2] + right[2], left[3] + right[3]]]
    out = pd.DataFrame(pooled, columns=["lo", "hi", "n", "n_bad"])
    out["feature"], out["bin_index"], out["category"] = rows["feature"].iloc[0], range(len(out)), None
    return pd.concat([out[columns], missing[columns]], ignore_index=True)


# --------------------------------------------------------------------------- optimal binning
def optimal_bins(
    df: DataFrame, target: str, features: list[str], prebins: int = 20, min_share: float = 0.05, max_bins: int | None = None,
    accuracy: int | None = None, decimals: int | None = None,
) -> DataFrame:
    """The bins of highest information value whose bad rate only rises or only falls.

    Bins join neighbours of at most ``prebins`` quantile bins; each holds at least ``min_share`` of the rows that have a value,
    and there are at most ``max_bins``. A single bin is always allowed. Spark reduces the table to the pre-bin counts; the search
    runs per feature on its counts (at most prebins + 1 rows), by dynamic programming.
    """
    edges = quantile_edges(df, features, prebins, accuracy, decimals)
    counts = _with_limits(_bin_counts(df, target, edges, []), edges)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["feature", "bin_index", "lo", "hi", "category", "n", "n_bad"]
        missing = rows[rows["bin_index"] == MISSING_INDEX]
        bins = rows[rows["bin_index"] != MISSING_INDEX].sort_values("bin_index")
        if bins.empty:
            return missing[columns]
        n, bad = [[int(v) for v in bins[c]] for c in ("n", "n_bad")]
        totals = int(rows["n_bad"].sum()), int(rows["n"].sum() - rows["n_bad"].sum())
        cuts = best_cuts(n, bad, totals, min_share, max_bins)
        parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
        out = pd.DataFrame({
            "lo": [bins["lo"].iloc[p.start] for p in parts], "hi": [bins["hi"].iloc[p.stop - 1] for p in parts],
            "n": [sum(n[p]) for p in parts], "n_bad": [sum(bad[p]) for p in parts]})
        out["feature"], out["bin_index"], out["category"] = rows["feature"].iloc[0], range(len(out)), None
        return pd.concat([out[columns], missing[columns]], ignore_index=True)

    chosen = counts.groupBy("feature").applyInPandas(
        choose, "feature string, bin_index int, lo double, hi double, category string, n long, n_bad long")
    return _with_own_totals(chosen).select(*BIN_COLUMNS)


def information(n: int, bad: int, totals: tuple[int, int]) -> float:
    """What a bin adds to the information value; ``totals`` of bad and good rows."""
    share_bad = (bad + SMOOTHING) / (max(totals[0], 1) + SMOOTHING)
    share_good = (n - bad + SMOOTHING) / (max(totals[1], 1) + SMOOTHING)
    return (share_good - share_bad) * math.log(share_good / share_bad)


def best_cuts(n: list[int], bad: list[int], totals: tuple[int, int], min_share: float, max_bins: int | None) -> list[int]:
    """Where the best bins begin, and the end. Of equal values the fewer bins.

    ``best[i, j][k]`` is the highest value of k bins up to pre-bin j of which the last begins at i. Neighbouring bad rates are
    compared in whole numbers. Bins: m * m / 2; each looks at those that end where it begins.
    """
    m = len(n)
    sums_n, sums_bad = [0], [0]
    for a, b in zip(n, bad):
        sums_n.append(sums_n[-1] + a)
        sums_bad.append(sums_bad[-1] + b)
    least, most = min_share * sums_n[-1], min(max_bins or m, m)
    size = {(i, j): sums_n[j] - sums_n[i] for i in range(m) for j in range(i + 1, m + 1)}
    ill = {(i, j): sums_bad[j] - sums_bad[i] for i, j in size}
    open_ = {s for s, count in size.items() if count >= least or s == (0, m)}
    value = {s: information(size[s], ill[s], totals) for s in open_}
    found: tuple[float, int, list[int]] | None = None
    for rising in (True, False):
        best: dict[tuple[int, int], dict[int, tuple[float, tuple | None]]] = {}
        for j in range(1, m + 1):
            for i in range(j):
                if (i, j) not in open_:
                    continue
                here: dict[int, tuple[float, tuple | None]] = {1: (value[i, j], None)} if i == 0 else {}
                for h in range(i):
                    gap = ill[i, j] * size[h, i] - ill[h, i] * size[i, j]
                    if (h, i) in best and (gap > 0 if rising else gap < 0):
                        for k, (total, _) in best[h, i].items():
                            if k < most and (k + 1 not in here or total + value[i, j] > here[k + 1][0]):
                                here[k + 1] = (total + value[i, j], (h, i))
                if here:
                    best[i, j] = here
        for i in range(m):
            for k, (total, _) in best.get((i, m), {}).items():
                if found is None or (total, -k) > found[:2]:
                    cuts, last, left = [m], (i, m), k
                    while last is not None:
                        cuts.insert(0, last[0])
                        last, left = best[last][left][1], left - 1
                    found = (total, -k, cuts)
    return found[2]


# --------------------------------------------------------------------------- transform
@dataclass(frozen=True)
class FittedBins:
    """Bin table of numeric features as literals, so scoring needs no join and works on streams."""

    edges: dict[str, list[float]]
    woe: dict[str, list[float]]
    missing: dict[str, float]

    def column(self, feature: str) -> Column:
        """WOE of the feature's value; a missing value seen in no training row gets 0."""
        values, missing = self.woe.get(feature, []), self.missing.get(feature, 0.0)
        if not values:
            return F.lit(missing)
        value = F.col(feature).cast("double")
        index = step_index(value, self.edges[feature])
        picked = F.element_at(F.array(*[F.lit(w) for w in values]), index + 1)
        return F.when(value.isNull() | F.isnan(value), F.lit(missing)).otherwise(picked)


def collect_bins(bins: DataFrame) -> FittedBins:
    """Numeric bin rows to literals; their number is bounded by features times bins."""
    edges: dict[str, list[float]] = {}
    woe: dict[str, list[float]] = {}
    missing: dict[str, float] = {}
    for r in bins.where("bin_index IS NOT NULL").orderBy("feature", "bin_index").collect():
        if r["bin_index"] == MISSING_INDEX:
            missing[r["feature"]] = r["woe"]
        else:
            woe.setdefault(r["feature"], []).append(r["woe"])
            edges.setdefault(r["feature"], []).append(r["hi"])
    return FittedBins({f: e[:-1] for f, e in edges.items()}, woe, missing)


def woe_transform(
    df: DataFrame, bins: DataFrame | FittedBins, numeric: list[str], categorical: list[str] = (), suffix: str = "_woe"
) -> DataFrame:
    """Add ``<feature>_woe``. A category unseen in training gets 0.

    Categorical features join the bin table on their value: small tables are
    broadcast by the optimizer after their size is known, large ones are not.
    """
    fitted = bins if isinstance(bins, FittedBins) else collect_bins(bins)
    out = df.withColumns({f"{f}{suffix}": fitted.column(f) for f in numeric})
    for f in categorical:
        lookup = bins.where((F.col("feature") == f) & F.col("bin_index").isNull()).select(
            F.col("category").alias("_category"), F.col("woe").alias("_woe")
        )
        value = _category(df, f)
        out = out.join(lookup, value == F.col("_category"), "left").withColumn(
            f"{f}{suffix}", F.coalesce("_woe", F.lit(0.0))
        ).drop("_category", "_woe")
    return out
