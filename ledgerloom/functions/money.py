"""Exact money arithmetic.

Money is ``DECIMAL(18,2)`` from the silver layer on.  Ratios of money
(averages, percentages, per-unit rates) are rounded half-up at a stated number
of places using integer arithmetic on the unscaled values, so every engine and
every executor gets the same digits; no double ever carries a balance.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerloom.functions.columns import as_col

MONEY = DecimalType(18, 2)
PERCENT = DecimalType(10, 2)


def to_money(col) -> Column:
    return as_col(col).cast(MONEY)


def zero_money() -> Column:
    return F.lit(Decimal("0.00")).cast(MONEY)


def scale(col, places: int) -> Column:
    """Multiply by 10**places keeping the value exact (decimal literal)."""
    return as_col(col) * F.lit(Decimal(10) ** places)


def int_div(a, b) -> Column:
    """Floor division of a non-negative integral value by a positive one, exact.

    Works on longs and on ``DECIMAL(38,0)`` (no overflow below 10**32).
    """
    a = as_col(a).cast("decimal(38,0)")
    b = as_col(b).cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def ratio(num, den, places: int = 2, num_places: int = 2, den_places: int = 2,
          factor: int = 1, divisor: int = 1) -> Column:
    """``round_half_up(num * factor / (den * divisor), places)`` as a decimal.

    ``num`` and ``den`` are exact decimals (or integers) with at most
    ``num_places`` / ``den_places`` decimals.  Null when ``den`` is zero or
    null (the zero guard the reference writes with ``NULLIF``).  Halves round
    away from zero.
    """
    k = max(num_places, den_places)
    a = (as_col(num).cast("decimal(38,10)") * F.lit(Decimal(10) ** (k + places))
         ).cast("decimal(38,0)") * F.lit(factor)
    b = (as_col(den).cast("decimal(38,10)") * F.lit(Decimal(10) ** k)
         ).cast("decimal(38,0)") * F.lit(divisor)
    q = int_div(F.abs(a) * 2 + F.abs(b), F.abs(b) * 2)
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    value = signed / F.lit(Decimal(10) ** places)
    return F.when(b != 0, value.cast(DecimalType(18 + places, places)))


def avg_money(total, count) -> Column:
    """Average of money rounded half-up to the cent."""
    return ratio(total, count, places=2, num_places=2, den_places=0)
