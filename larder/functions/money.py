"""Exact amounts: cast to DECIMAL before any arithmetic, to DOUBLE only for output."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SALES_TAX = Decimal("0.07")
DELIVERY_FEE = Decimal("3.99")


def amount(col: Column | str, precision: int = 12, scale: int = 2) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal({precision},{scale})")


def hundredths(col: Column | str) -> Column:
    """Whole hundredths of a DOUBLE that holds at most two decimals."""
    return F.rint((F.col(col) if isinstance(col, str) else col) * 100).cast("bigint")


def from_units(units: Column, scale: int) -> Column:
    """Whole units of ``10 ** -scale`` as DECIMAL.

    Multiplying in whole numbers and converting once costs half of what casting
    the DOUBLE factors to DECIMAL does, with the same result. The product has 18
    digits, the most that Spark keeps in a long.
    """
    return units.cast(f"decimal({17 - scale},0)") * F.lit(Decimal(1).scaleb(-scale))


def zero(scale: int = 2) -> Column:
    return F.lit(0).cast(f"decimal(12,{scale})")


def double(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def sales_tax(gross: Column) -> Column:
    return F.round(gross * F.lit(SALES_TAX), 2)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as DOUBLE, NULL where ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def total(*names: str) -> list[Column]:
    """Sums under their own names."""
    return [F.sum(name).alias(name) for name in names]


def doubles(*names: str) -> list[Column]:
    return [F.col(name).cast("double").alias(name) for name in names]
