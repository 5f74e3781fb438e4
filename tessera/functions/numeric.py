"""Exact money and percentage arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
TOTAL = "decimal(38,4)"


def units_to_money(units: Column, scale: int) -> Column:
    """An exact integer amount in units of 10**-scale as ``MONEY``; beyond its
    four places as ``decimal(38, scale)``."""
    if scale > 4:
        return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")
    # a multiply by an exact power of ten: cheaper than a decimal divide
    return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(MONEY)


def sum_units(units: Column, scale: int) -> Column:
    """Exact sum of integer amounts (units of 10**-scale) as ``TOTAL``.

    Rows add as long-backed ``decimal(18,0)`` into a ``decimal(28,0)``
    buffer, so no group size can overflow it (a plain long sum could, for a
    month holding 10^10 order lines); one division per group rescales."""
    return (F.sum(units.cast("decimal(18,0)")) / F.lit(10 ** scale)).cast(TOTAL)


def percent(numerator: Column, denominator: Column, precision: int = 5,
            scale: int = 2, hundred: str = "100.00") -> Column:
    """``cast(n * 100.00 / d as decimal(5,2))``.

    ``decimal(4,2)`` cannot hold 100.00, so the default is ``decimal(5,2)``.
    A zero denominator gives null.
    """
    return (numerator * F.lit(Decimal(hundred)) / F.nullif(denominator, F.lit(0))).cast(
        f"decimal({precision},{scale})")
