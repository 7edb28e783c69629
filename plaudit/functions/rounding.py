"""Exact half-up rounding on integers, so results never depend on float noise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def ratio(numerator: Column, denominator: Column, digits: int, empty: float | None = None) -> Column:
    """``numerator / denominator`` rounded half up to ``digits`` places.

    Both sides must be whole numbers.  A zero denominator gives ``empty``.  Products are
    made in 38 digits, so sums over any table fit; only the quotient must fit a long.
    """
    scale = 10**digits
    wide = lambda c: c.cast("decimal(28,0)")
    bottom = F.nullif(wide(denominator), wide(F.lit(0)))
    steps = F.call_function("div", wide(numerator) * F.lit(2 * scale).cast("decimal(9,0)") + bottom, bottom * F.lit(2).cast("decimal(9,0)"))
    value = steps.cast("double") / F.lit(float(scale))
    return value if empty is None else F.coalesce(value, F.lit(float(empty)))


def percent(part: Column, whole: Column, digits: int = 1, empty: float | None = None) -> Column:
    return ratio(part.cast("decimal(20,0)") * 100, whole, digits, empty)


def cents(amount: Column) -> Column:
    """A two-decimal money column as a whole number of cents."""
    return (amount * 100).cast("decimal(28,0)")


def mean_money(total: Column, n: Column, digits: int = 0, empty: float | None = None) -> Column:
    return ratio(cents(total), n.cast("decimal(20,0)") * 100, digits, empty)


def settle(value: Column, digits: int) -> Column:
    """Round a double half up; hides last-bit differences of ``exp`` and ``log``."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / scale
