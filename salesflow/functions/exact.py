"""Exact means and ratios of decimal sums, without double rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = T.DecimalType(38, 0)


def mean(total: Column, n: Column) -> Column:
    """Double mean of a decimal sum; NULL over no rows."""
    return total.cast("double") / F.nullif(n, F.lit(0)).cast("double")


def rounded_mean(total: Column, n: Column, scale: int) -> Column:
    """total / n rounded half away from zero to `scale` digits, exact for decimal sums."""
    twice = F.floor(F.abs(total) * F.lit(2 * 10**scale)).cast(WHOLE) + n.cast(WHOLE)
    steps = F.call_function("div", twice, F.nullif(n * 2, F.lit(0)).cast(WHOLE))
    signed = F.when(total < 0, -steps).otherwise(steps)
    return (signed.cast(T.DecimalType(20, 0)) / F.lit(10**scale)).cast(T.DecimalType(20, scale))


def round_binary(value: Column, digits: int) -> Column:
    """A double rounded by its true binary value, half to even.

    `bround` rounds the shortest decimal text of a double instead, so that 83.335, which is
    stored a little below that, would go up.
    """
    return F.regexp_replace(F.format_number(value, digits), ",", "").cast("double")


def percent(part: Column, n: Column) -> Column:
    """100 * part / n with two digits."""
    return round_binary(part / n * 100, 2)
