"""Money stays decimal: sums are exact and averages round half up from exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(15,2)"
TOTAL = "decimal(25,2)"


def total(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def mean(sum_amount: Column, rows: Column, scale: int = 2) -> Column:
    """Exact sum over count, rounded half up (the casts leave the quotient 15 decimals)."""
    return F.round(sum_amount.cast(TOTAL) / rows.cast("decimal(18,0)"), scale).cast(f"decimal(15,{scale})")


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals, wide enough for any change; NULL for an empty whole."""
    ratio = part.cast("decimal(25,2)") * 100 / F.nullif(whole.cast("decimal(25,2)"), F.lit(0))
    return F.round(ratio, 2).cast("decimal(30,2)")


def in_units(amount: Column, unit: int) -> Column:
    """Scale to thousands, millions, ... with two decimals."""
    return F.round(amount / F.lit(unit).cast("decimal(10,0)"), 2).cast(TOTAL)
