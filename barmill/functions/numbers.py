"""Rounding and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_significant(x: Column, digits: int = 6) -> Column:
    """x to so many significant figures; zero and null pass through.

    Twice the figures are rounded first, so that halves go up however the last bits of x came about.
    """

    def to(y: Column, figures: int) -> Column:
        scale = F.pow(F.lit(10.0), figures - 1 - F.floor(F.log10(F.abs(x))))
        return F.round(y * scale) / scale

    return F.when(x == 0, x).otherwise(to(to(x, 2 * digits), digits))


def pct(a: Column, b: Column) -> Column:
    """How much a lies above b, in per cent; null where b is zero."""
    return F.try_divide(a - b, b) * 100
