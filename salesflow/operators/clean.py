"""Cleaning: incomplete rows, duplicates, negative values and interquartile-range outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.parsing import nan_to_null, quoted, without_nan
from salesflow.functions.quantiles import exact_quantiles, histogram
from salesflow.session import checkpointed

QUARTILES = [0.25, 0.75]


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which every given column has a value; NaN is not one."""
    kept = df
    for c in columns:
        dtype = df.schema[c].dataType
        value = without_nan(quoted(c), dtype) if isinstance(dtype, (T.DoubleType, T.FloatType)) else quoted(c)
        kept = kept.where(value.isNotNull())
    return kept


def non_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose columns are all >= 0; NaN does not count as a value."""
    kept = nan_to_null(df)
    for c in columns:
        kept = kept.where(quoted(c) >= 0)
    return kept


def dedupe(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows; copies are merged before the shuffle."""
    return df.dropDuplicates()


def fences(quartiles: list[float], k: float) -> tuple[float, float]:
    low, high = quartiles
    return low - k * (high - low), high + k * (high - low)


def iqr_filter(df: DataFrame, columns: list[str], k: float = 3.0) -> DataFrame:
    """Keep values within k interquartile ranges, one column after the other, with exact quartiles.

    Later columns take their quartiles from the rows the earlier ones left. All of them come
    from one joint histogram, so the input is read once for the fences; these are then plain
    numbers that reach the scan as pushed filters.
    """
    hist = histogram(df, columns)
    left, kept = hist, df
    for c in columns:
        quartiles = exact_quantiles(left, c, QUARTILES)
        if quartiles is None:
            kept = kept.where(F.lit(False))
            break
        inside = quoted(c).cast("double").between(*fences(quartiles, k))
        left, kept = left.where(inside), kept.where(inside)
    hist.release()
    return kept


def iqr_filter_approx(df: DataFrame, column: str, k: float = 1.5, relative_error: float = 0.01) -> DataFrame:
    """The same filter with sketched quartiles, as one lazy plan; an empty input stays empty."""
    value = quoted(column)
    sketch = F.percentile_approx(value, QUARTILES, int(1 / relative_error))
    spread = (F.col("q")[1] - F.col("q")[0]).cast("double")
    bounds = (
        df.agg(sketch.alias("q"))
        .select(
            F.struct(
                (F.col("q")[0].cast("double") - k * spread).alias("low"),
                (F.col("q")[1].cast("double") + k * spread).alias("high"),
            )
        )
        .scalar()
    )
    return df.where(value.cast("double").between(bounds["low"], bounds["high"]))


def clean_sales(df: DataFrame, distinct: bool = True, k: float = 3.0) -> DataFrame:
    """Cleaning before the KPIs: complete, distinct, non-negative, units and then sales inside the fences.

    Facts that carry an identity are distinct already (`distinct=False`), which saves the
    shuffle of whole rows. After a shuffle the rows are checkpointed, as the fences and the
    result both read them.
    """
    rows = drop_incomplete(nan_to_null(df), ["units_sold", "total_sales", "region"])
    rows = non_negative(rows, ["units_sold", "total_sales"])
    return iqr_filter(checkpointed(dedupe(rows)) if distinct else rows, ["units_sold", "total_sales"], k)


def clean_facts(fact: DataFrame, k: float = 3.0) -> DataFrame:
    """The same cleaning on star facts, before any name is joined.

    A fact refers to existing members or to none, so the inner star join keeps just those
    with a region and a product.
    """
    rows = drop_incomplete(fact, ["units_sold", "total_sales", "region_id", "produit_id"])
    return iqr_filter(non_negative(rows, ["units_sold", "total_sales"]), ["units_sold", "total_sales"], k)
