"""Applicant ratios, transaction rules and small scalar helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules.
DAYS_PER_YEAR = 365.25
RISKY_TYPES = ("TRANSFER", "CASH_OUT")
DRAIN_SHARE = 0.95
LARGE_AMOUNT = 200_000
PROBABILITY_MARGIN = 1e-6
IV_BANDS = ((0.02, "not predictive"), (0.1, "weak"), (0.3, "medium"), (0.5, "strong"))
IV_TOP_BAND = "suspiciously strong"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that is null on a zero or missing denominator (ANSI mode would raise)."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def debt_to_income(annuity: Column | str, yearly_income: Column | str) -> Column:
    return ratio(annuity, _col(yearly_income).cast("double") / 12.0)


def credit_income_ratio(credit: Column | str, yearly_income: Column | str) -> Column:
    return ratio(credit, yearly_income)


def age_years(days_birth: Column | str) -> Column:
    """Day offsets are negative for the past."""
    return -_col(days_birth).cast("double") / DAYS_PER_YEAR


def employed_years(days_employed: Column | str) -> Column:
    """As :func:`age_years`, floored at 0; missing stays missing, so no ``greatest``."""
    years = age_years(days_employed)
    return F.when(years < 0, F.lit(0.0)).otherwise(years)


def is_risky_type(kind: Column | str, risky: tuple[str, ...] = RISKY_TYPES) -> Column:
    return _col(kind).isin(*risky)


def drains_account(amount: Column | str, old_balance: Column | str, share: float = DRAIN_SHARE) -> Column:
    return _col(amount) > _col(old_balance) * F.lit(share)


def is_large(amount: Column | str, limit: float = LARGE_AMOUNT) -> Column:
    return _col(amount) > F.lit(limit)


def clip_probability(p: Column | str, margin: float = PROBABILITY_MARGIN) -> Column:
    p = _col(p)
    return F.when(p < margin, F.lit(margin)).when(p > 1 - margin, F.lit(1 - margin)).otherwise(p)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def iv_strength(iv: Column | str) -> Column:
    iv = _col(iv)
    label = F.when(iv.isNull(), F.lit(None).cast("string"))
    for below, name in IV_BANDS:
        label = label.when(iv < below, name)
    return label.otherwise(IV_TOP_BAND)


def key_hash(seed: int | str, *keys: Column | str) -> Column:
    """Hex md5 of seed and keys: a random-looking value that no repartitioning changes."""
    parts = [F.lit(str(seed)), *[_col(k).cast("string") for k in keys]]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def key_uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform in [0, 1) from 52 bits of :func:`key_hash`."""
    digits = F.conv(F.substring(key_hash(seed, *keys), 1, 13), 16, 10)
    return digits.cast("long").cast("double") / float(2**52)


def step_index(value: Column, edges: list[float], small: int = 32) -> Column:
    """How many of the sorted ``edges`` lie strictly below ``value``.

    Few edges become a balanced CASE tree, which stays inside generated code; a
    tree of many would outgrow it. Those are cut into runs of about the square root
    of their number: first the run is found, then the place in it.
    """
    def descend(cuts: list[float], low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(cuts[middle]), descend(cuts, low, middle)).otherwise(descend(cuts, middle + 1, high))

    def literal(numbers: list[float]) -> str:
        return "array(" + ", ".join(f"{float(e)!r}D" for e in numbers) + ")"

    if len(edges) <= small:
        return descend(edges, 0, len(edges))
    size = math.isqrt(len(edges) - 1) + 1
    runs = [edges[i:i + size] for i in range(0, len(edges), size)]
    ends = [r[-1] for r in runs[:-1]]
    run = descend(ends, 0, len(ends)) if len(ends) <= small else F.size(
        F.filter(F.expr(literal(ends)), lambda e: e < value))
    within = F.element_at(F.expr(f"array({', '.join(map(literal, runs))})"), run + 1)
    return run * size + F.size(F.filter(within, lambda e: e < value))
