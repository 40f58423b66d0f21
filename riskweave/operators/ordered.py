"""Exact order statistics and ordered windows that survive a hot group.

A window over one key sorts all rows of that key in one task, and a global
window sorts the whole table in one. The functions here cut the order column
into pieces at literal edges, work inside each (group, piece), and add what
comes before from a table with one row per (group, piece). Any edges give the
same exact result; they only decide how even the pieces are. A table that is
small by count gets no edges, which leaves one plain window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.risk import step_index

SKETCH_ACCURACY = 10_000
FIRST_GRID = 512


# --------------------------------------------------------------------------- pieces
@dataclass(frozen=True)
class Pieces:
    """Cut points of an order column, and of a tie-break column for its heavy values."""

    edges: tuple[float, ...] = ()
    heavy: tuple[float, ...] = ()
    tie_edges: tuple[float, ...] = ()

    def index(self, order: Column, tie: Column | None = None) -> Column:
        """Piece number; it grows with (order, tie). Null orders get piece -1."""
        if not self.edges:
            return F.lit(0)
        piece = step_index(order, list(self.edges)) * 2
        if self.heavy:
            piece = piece + order.isin(*self.heavy).cast("int")
        if self.heavy and self.tie_edges and tie is not None:
            within = F.when(order.isin(*self.heavy), step_index(tie, list(self.tie_edges)))
            piece = piece * (len(self.tie_edges) + 1) + F.coalesce(within, F.lit(0))
        return F.when(order.isNull(), F.lit(-1)).otherwise(piece)


def _sketch(df: DataFrame, order: Column, tie: Column | None, grid: int):
    """Row count and ``grid - 1`` cut points of the order (and tie-break) column, from one pass."""
    probs = F.expr(f"array({', '.join(f'{i / grid!r}D' for i in range(1, grid))})")
    accuracy = F.lit(max(SKETCH_ACCURACY, 4 * grid))
    wanted = [F.count(F.lit(1)).alias("n"), F.percentile_approx(order.cast("double"), probs, accuracy).alias("cuts")]
    if tie is not None:
        wanted.append(F.percentile_approx(tie.cast("double"), probs, accuracy).alias("tie_cuts"))
    return df.agg(*wanted).first()


def plan_pieces(
    df: DataFrame, order: Column, tie: Column | None = None, rows_per_piece: int = 500_000, max_pieces: int = 8192,
) -> Pieces:
    """Choose cut points from sketches over the whole column; no rows are collected.

    A first sketch also counts the rows; only a table that needs more pieces than
    it resolves is sketched again.
    """
    if tie is not None and not isinstance(df.select(tie.alias("t")).schema["t"].dataType, T.NumericType):
        tie = None  # no sketch of keys that aren't numbers; the rows of one order value then stay together
    grid = min(FIRST_GRID, max_pieces)
    row = _sketch(df, order, tie, grid)
    pieces = min(max_pieces, math.ceil(row["n"] / rows_per_piece))
    if pieces <= 1 or not row["cuts"]:
        return Pieces()
    if pieces > grid:
        grid = pieces
        row = _sketch(df, order, tie, grid)
    step = grid / pieces
    picked = [row["cuts"][min(int(i * step), grid - 1) - 1] for i in range(1, pieces)]
    heavy = {a for a, b in zip(picked, picked[1:]) if a == b}
    tie_cuts = sorted(set(row["tie_cuts"] or [])) if tie is not None else []
    if tie_cuts:
        tie_cuts = tie_cuts[:: max(1, math.ceil(len(tie_cuts) / pieces))]
    return Pieces(tuple(sorted(set(picked))), tuple(sorted(heavy)), tuple(tie_cuts))


def _placed(df: DataFrame, by: list[str], piece: Column) -> DataFrame:
    """Add ``_group`` and ``_piece``. A struct is never null itself, so groups with nulls join by
    plain equality, on the partitioning the windows already have."""
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    return df.withColumns({"_group": group, "_piece": piece})


def _inside(*order: Column | str) -> WindowSpec:
    return Window.partitionBy("_group", "_piece").orderBy(*order)


def _before() -> WindowSpec:
    """Over the table with one row per (group, piece)."""
    return Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)


# --------------------------------------------------------------------------- ordered windows
def running_sums(
    df: DataFrame,
    by: list[str],
    order: str,
    values: list[str],
    pieces: Pieces | None = None,
) -> DataFrame:
    """Add ``cum_<v>`` (rows up to and with this order value) and ``tot_<v>`` within ``by``.

    Expects at most one row per (by, order): aggregate first.
    """
    pieces = plan_pieces(df, F.col(order)) if pieces is None else pieces
    group = [F.col(c) for c in by] or [F.lit(0)]
    if not pieces.edges:
        upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*group)
        return df.select(
            "*",
            *[F.sum(v).over(upto).alias(f"cum_{v}") for v in values],
            *[F.sum(v).over(whole).alias(f"tot_{v}") for v in values],
        )
    rows = _placed(df, by, pieces.index(F.col(order)))
    sums = rows.groupBy("_group", "_piece").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    whole = Window.partitionBy("_group")
    offsets = sums.select(
        "_group", "_piece",
        *[F.coalesce(F.sum(f"_s_{v}").over(_before()), F.lit(0)).alias(f"_off_{v}") for v in values],
        *[F.sum(f"_s_{v}").over(whole).alias(f"tot_{v}") for v in values],
    )
    upto = _inside(order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(v).over(upto).alias(f"_cum_{v}") for v in values])
    return local.join(offsets, ["_group", "_piece"]).select(
        *df.columns,
        *[(F.col(f"_cum_{v}") + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values],
        *[f"tot_{v}" for v in values],
    )


def ranked(
    df: DataFrame,
    by: list[str],
    order: Column,
    tie: str,
    name: str = "rank",
    pieces: Pieces | None = None,
) -> DataFrame:
    """Add the 1-based position within ``by``, ascending by (order, tie), null orders last.

    ``order`` must be numeric; negate it for a descending rank. ``tie`` must make
    the position unique.
    """
    pieces = plan_pieces(df, order, F.col(tie)) if pieces is None else pieces
    rows = df.withColumn("_order", order)
    sort = [F.col("_order").asc_nulls_last(), F.col(tie).asc()]
    if not pieces.edges:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*sort))).drop("_order")
    piece = pieces.index(F.col("_order"), F.col(tie))
    rows = _placed(rows, by, F.when(piece == -1, F.lit(2**30)).otherwise(piece))
    counts = rows.groupBy("_group", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_group", "_piece", F.coalesce(F.sum("_n").over(_before()), F.lit(0)).alias("_off"))
    local = rows.withColumn("_local", F.row_number().over(_inside(*sort)))
    return local.join(offsets, ["_group", "_piece"]).select(
        *df.columns, (F.col("_local") + F.col("_off")).cast("int").alias(name)
    )


def previous_values(
    df: DataFrame,
    by: list[str],
    order: Column,
    tie: str,
    value: str,
    name: str = "previous",
    pieces: Pieces | None = None,
) -> DataFrame:
    """Add the value of the row before this one within ``by``, ascending by (order, tie).

    ``order`` is numeric and not null.
    """
    pieces = plan_pieces(df, order, F.col(tie)) if pieces is None else pieces
    rows = df.withColumn("_order", order)
    sort = [F.col("_order"), F.col(tie)]
    if not pieces.edges:
        return rows.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(*sort))).drop("_order")
    rows = _placed(rows, by, pieces.index(F.col("_order"), F.col(tie)))
    across = Window.partitionBy("_group").orderBy("_piece")
    carried = (
        rows.groupBy("_group", "_piece")
        .agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct("_order", tie)).alias("_last"))
        .select("_group", "_piece", F.lag("_last").over(across).alias("_carried"))
    )
    local = rows.select(
        "*", F.lag(value).over(_inside(*sort)).alias("_lag"), F.row_number().over(_inside(*sort)).alias("_pos")
    )
    return local.join(carried, ["_group", "_piece"]).select(
        *df.columns,
        F.when(F.col("_pos") == 1, F.col("_carried.v")).otherwise(F.col("_lag")).alias(name),
    )


# --------------------------------------------------------------------------- quantiles
@dataclass
class _Cell:
    """Closed value range [low, high] of one column: rows below it and rows inside."""

    column: str
    low: float | None
    high: float | None
    below: int
    size: int
    ranks: list[int] = field(default_factory=list)

    @property
    def single(self) -> bool:
        return self.low is not None and self.low == self.high


def order_statistics(
    df: DataFrame, ranks: dict[str, list[int]], sizes: dict[str, int], cap: int = 1_000_000, fanout: int = 128
) -> dict[tuple[str, int], float]:
    """Exact k-th smallest values (0-based) of numeric columns.

    Ranges that hold a wanted rank are cut at sketched edges and counted until
    they hold at most ``cap`` rows; only those rows are then grouped by value.
    All counting is map-side combined, so no round shuffles the table.
    """
    spark = df.sparkSession
    cells = [_Cell(c, None, None, 0, sizes[c], sorted(set(ks))) for c, ks in ranks.items() if ks]
    found: dict[tuple[str, int], float] = {}
    done: list[_Cell] = []
    while cells:
        big = []
        for cell in cells:
            if cell.single:
                found.update({(cell.column, k): cell.low for k in cell.ranks})
            elif cell.size <= cap:
                done.append(cell)
            else:
                big.append(cell)
        if not big:
            break
        cells = _narrow(spark, df, big, fanout)
    if done:
        found.update(_pick(spark, _cell_rows(df, done), done))
    return found


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _cell_rows(df: DataFrame, cells: list[_Cell]) -> DataFrame:
    """Rows ``(cell, value)`` of every value inside one of the cells."""
    by_column: dict[str, list[int]] = {}
    for i, cell in enumerate(cells):
        by_column.setdefault(cell.column, []).append(i)
    pairs = []
    for column, members in by_column.items():
        value = _number(column)
        where = F.lit(None).cast("int")
        for i in members:
            low, high = cells[i].low, cells[i].high
            inside = value.isNotNull() if low is None else value.between(F.lit(low), F.lit(high))
            where = F.when(inside, F.lit(i)).otherwise(where)
        pairs.append(F.struct(where.alias("cell"), value.alias("value")))
    return df.select(F.inline(F.array(*pairs))).where("cell IS NOT NULL")


def _part(below: Column, edges: Column, value: Column) -> Column:
    """Even numbers lie strictly between edges, odd ones are the edge values themselves."""
    return below * 2 + F.coalesce(F.get(edges, below) == value, F.lit(False)).cast("int")


def _narrow(spark, df: DataFrame, cells: list[_Cell], fanout: int) -> list[_Cell]:
    grid = [i / fanout for i in range(1, fanout)]
    rows = _cell_rows(df, cells)
    sketched = rows.groupBy("cell").agg(F.percentile_approx("value", grid, SKETCH_ACCURACY).alias("edges"))
    edges = {r["cell"]: sorted(set(r["edges"])) for r in sketched.collect()}
    if all(cell.low is None for cell in cells):
        # the first round reads every row: one literal lookup per column
        parts = [
            F.struct(F.lit(i).alias("cell"), _number(c.column).alias("value"), _part(
                step_index(_number(c.column), edges[i]), F.array(*[F.lit(e) for e in edges[i]]), _number(c.column)
            ).alias("part"))
            for i, c in enumerate(cells)
        ]
        placed = df.select(F.inline(F.array(*parts))).where("value IS NOT NULL")
    else:
        cuts = F.broadcast(spark.createDataFrame(list(edges.items()), "cell int, edges array<double>"))
        below = F.size(F.filter("edges", lambda e: e < F.col("value")))
        placed = rows.join(cuts, "cell").select("cell", "value", _part(below, F.col("edges"), F.col("value")).alias("part"))
    counted = placed.groupBy("cell", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    ).collect()
    smaller = []
    for i, cell in enumerate(cells):
        below = cell.below
        for r in sorted((r for r in counted if r["cell"] == i), key=lambda r: r["part"]):
            inside = [k for k in cell.ranks if below <= k < below + r["n"]]
            if inside:
                smaller.append(_Cell(cell.column, r["low"], r["high"], below, r["n"], inside))
            below += r["n"]
    return smaller


def _pick(spark, rows: DataFrame, cells: list[_Cell]) -> dict[tuple[str, int], float]:
    wanted = spark.createDataFrame(
        [(i, k - cell.below) for i, cell in enumerate(cells) for k in cell.ranks], "cell int, k long"
    )
    upto = Window.partitionBy("cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    histogram = rows.groupBy("cell", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = histogram.withColumn("upto", F.sum("n").over(upto))
    hit = (F.col("k") >= F.col("upto") - F.col("n")) & (F.col("k") < F.col("upto"))
    rows = placed.join(F.broadcast(wanted), "cell").where(hit).select("cell", "k", "value").collect()
    return {(cells[r["cell"]].column, r["k"] + cells[r["cell"]].below): r["value"] for r in rows}


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], cap: int = 1_000_000, fanout: int = 128
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles, nulls and NaN left out; ``None`` for an empty column."""
    row = df.agg(*[F.count(_number(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    sizes = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    places = {c: [(sizes[c] - 1) * p for p in probs] for c in cols if sizes[c]}
    ranks = {c: sorted({k for x in xs for k in (math.floor(x), math.ceil(x))}) for c, xs in places.items()}
    values = order_statistics(df, ranks, sizes, cap, fanout)

    def at(c: str, x: float) -> float:
        low, high = values[c, math.floor(x)], values[c, math.ceil(x)]
        return low + (high - low) * (x - math.floor(x))

    return {c: [at(c, x) for x in places[c]] if c in places else None for c in cols}


def quantiles(
    df: DataFrame, cols: list[str], probs: list[float], accuracy: int | None = None
) -> dict[str, list[float] | None]:
    """Exact by default; an ``accuracy`` switches to one sketched pass."""
    if accuracy is None:
        return exact_quantiles(df, cols, probs)
    row = df.agg(*[F.percentile_approx(_number(c), probs, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"q{i}"] for i, c in enumerate(cols)}
