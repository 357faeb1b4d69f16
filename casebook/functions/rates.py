"""Rates and ratios with defined results for a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ones(flag: Column) -> Column:
    """1 where the flag holds, 0 where it is false or null."""
    return F.when(flag, 1).otherwise(0)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent; null for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def ratio_or_zero(part: Column, whole: Column, digits: int = 4) -> Column:
    """Ratio, 0.0 for an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(part, whole), digits))


def per_thousand(part: Column, whole: Column, digits: int = 2) -> Column:
    """Cases per 1000; null for an empty whole."""
    return F.round(F.try_divide(part * F.lit(1000.0), whole), digits)
