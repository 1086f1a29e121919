"""Text to typed values; unreadable text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schema as S


def quoted(name: str) -> Column:
    """Column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_number(value: Column, dtype: T.DataType = S.MONEY) -> Column:
    """Number from text or number; unreadable, oversize or NaN gives NULL."""
    number = value.try_cast(dtype)
    return without_nan(number, dtype) if isinstance(dtype, (T.DoubleType, T.FloatType)) else number


def without_nan(value: Column, dtype: T.DataType) -> Column:
    """NULL for NaN; the value stands in it once, so nested calls and pushed filters do not multiply its expression."""
    return F.nanvl(value, F.lit(None).cast(dtype))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    floats = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(
        *[without_nan(quoted(c), floats[c]).alias(c) if c in floats else quoted(c) for c in df.columns]
    )


def to_ratio(value: Column, unit: str = "percent", dtype: T.DecimalType = S.MARGIN) -> Column:
    """Margin as a ratio.

    The unit "percent" divides by 100 whether or not a percent sign is present, so 0.31
    is read as 0.31 %; the unit "ratio" takes the number as it is.
    """
    number = F.regexp_replace(value.cast("string"), "%", "").try_cast(T.DecimalType(12, 6))
    if unit == "percent":
        number = number / F.lit(100).cast(T.DecimalType(3, 0))
    elif unit != "ratio":
        raise ValueError(f"unknown margin unit {unit!r}")
    return number.try_cast(dtype)


def to_date(value: Column) -> Column:
    """First matching date layout, NULL if none; dates and timestamps pass through."""
    return F.coalesce(*[F.try_to_date(value, f) for f in S.DATE_FORMATS])


def to_date_or(value: Column, fallback: str = S.FALLBACK_DATE) -> Column:
    """Any readable date, else the fallback date."""
    free = [F.try_to_date(value, f) for f in S.FREE_DATE_FORMATS]
    return F.coalesce(to_date(value), value.try_cast("date"), *free, F.lit(fallback).cast("date"))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def text_or_unknown(*values: Column) -> Column:
    return F.coalesce(*values, F.lit(S.UNKNOWN))
