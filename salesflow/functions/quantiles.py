"""Exact quantiles of number columns, at any scale.

The value histogram of a decimal or whole-number column is searched by digits of 16 bits, most
significant first. That of a double column is searched by sign and sixteenth of a binade first, which
leaves at most 2^48 values to a range, and then by ranges cut into 65,536 parts: four rounds
in all, whatever the values. Each round counts a bounded number of buckets per searched rank
and hands a few of them to the driver, so neither a task nor the driver ever holds the values
of a column, however many distinct ones there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGIT_BITS = 16
PARTS = 1 << 16
BINADE_PARTS = 16
WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Searched ranks map to (bits found so far, rank inside that bucket).
Found = dict[int, tuple[int, int]]


@dataclass(frozen=True)
class Histogram:
    """Distinct value combinations with their number of rows, and the whole-number range of each column."""

    counts: DataFrame
    ranges: dict[str, tuple[int, int]]

    def where(self, condition: Column) -> Histogram:
        """Fewer rows; the ranges stay valid as outer bounds."""
        return Histogram(self.counts.where(condition), self.ranges)

    def release(self) -> None:
        self.counts.unpersist()


def histogram(df: DataFrame, columns: list[str]) -> Histogram:
    """Joint histogram, pre-aggregated before its shuffle and held for the search rounds."""
    counts = df.groupBy(*columns).agg(F.count("*").alias("_rows")).persist()
    whole = {c: F.col(c) if _is_double(df, c) else _whole(counts, c) for c in columns}
    ends = counts.agg(
        *[F.min(v).alias(f"low_{c}") for c, v in whole.items()],
        *[F.max(v).alias(f"high_{c}") for c, v in whole.items()],
    ).first()
    return Histogram(counts, {c: (ends[f"low_{c}"] or 0, ends[f"high_{c}"] or 0) for c in columns})


def exact_quantiles(hist: Histogram, column: str, probs: list[float]) -> list[float] | None:
    """Linearly interpolated quantiles of a histogram column, NULL values aside; None without rows."""
    if _is_double(hist.counts, column):
        return _double_quantiles(hist, column, probs)
    low, high = hist.ranges[column]
    rounds = max(1, math.ceil((high - low).bit_length() / DIGIT_BITS))
    offset = _whole(hist.counts, column) - F.lit(low)
    values = hist.counts.where(F.col(column).isNotNull()).select(offset.alias("_v"), "_rows")

    total, found = _first_digit(values, probs, (rounds - 1) * DIGIT_BITS)
    if total == 0:
        return None
    for level in reversed(range(rounds - 1)):
        found = _next_digit(values, found, level * DIGIT_BITS)
    unit = 10 ** _scale(hist.counts.schema[column].dataType)
    at = {rank: (bits + low) / unit for rank, (bits, _) in found.items()}
    return _interpolated(at, total, probs)


def _interpolated(at: dict[int, float], total: int, probs: list[float]) -> list[float]:
    quantiles = []
    for place in (p * (total - 1) for p in probs):
        below, above = at[math.floor(place)], at[math.ceil(place)]
        quantiles.append(below + (above - below) * (place - math.floor(place)))
    return quantiles


def _is_double(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def _double_quantiles(hist: Histogram, column: str, probs: list[float]) -> list[float] | None:
    """Quantiles of doubles; NaN counts as missing.

    A searched rank has a range of values and a rank inside it. Every round counts the parts of
    all ranges at once and goes on with the values found in the right part, until low and high agree.
    """
    value = F.col(column).cast("double")
    values = hist.counts.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("_v"), "_rows")
    total, found = _first_ranges(values, probs)
    while any(low < high for low, high, _ in found.values()):
        open_ranges = sorted({(low, high) for low, high, _ in found.values() if low < high})
        parts = [_part(low, high).alias(f"_p{i}") for i, (low, high) in enumerate(open_ranges)]
        placed = values.select("_v", "_rows", F.posexplode(F.array(*parts)).alias("_range", "_part")).where("_part IS NOT NULL")
        hit = F.lit(False)
        for low, high, rank in set(found.values()):
            if low < high:
                hit = hit | (_holds(rank) & (F.col("_range") == open_ranges.index((low, high))))
        rows = _parts_upto(placed).where(hit).collect()  # one per rank at most
        for wanted, (low, high, rank) in found.items():
            if low < high:
                here = open_ranges.index((low, high))
                found[wanted] = _range_of([r for r in rows if r["_range"] == here], rank)
    return _interpolated({r: low for r, (low, _, _) in found.items()}, total, probs) if total else None


def _first_ranges(values: DataFrame, probs: list[float]) -> tuple[int, dict[int, tuple[float, float, int]]]:
    """Number of rows, and for each searched rank the values of its sign and part of a binade, and its rank in there."""
    size = F.floor(F.least(F.log2(F.abs("_v")), F.lit(2000.0)) * BINADE_PARTS) + 40_000  # positive for every double
    part = F.when(F.col("_v") > 0, size).when(F.col("_v") < 0, -size).otherwise(0)
    ranked = _parts_upto(values.select("_v", "_rows", F.lit(0).alias("_range"), part.alias("_part")))
    ranked = ranked.withColumn("_total", F.sum("_n").over(Window.partitionBy("_range")))
    hit = F.lit(False)
    for p in probs:
        place = F.lit(p) * (F.col("_total") - 1)
        for rank in (F.floor(place), F.ceil(place)):
            hit = hit | _holds(rank)
    rows = ranked.where(hit).collect()  # at most two per quantile
    if not rows:
        return 0, {}
    total = rows[0]["_total"]
    ranks = {r for p in probs for r in (math.floor(p * (total - 1)), math.ceil(p * (total - 1)))}
    return total, {r: _range_of(rows, r) for r in ranks}


def _parts_upto(placed: DataFrame) -> DataFrame:
    """Rows, least and greatest value per part of a range, and the rows up to it."""
    counted = placed.groupBy("_range", "_part").agg(F.sum("_rows").alias("_n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    order = Window.partitionBy("_range").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("_upto", F.sum("_n").over(order))


def _holds(rank: Column | int) -> Column:
    return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)


def _range_of(rows: list, rank: int) -> tuple[float, float, int]:
    """The values of the part that holds a rank, and the rank among them."""
    row = next(r for r in rows if r["_upto"] - r["_n"] <= rank < r["_upto"])
    return row["low"], row["high"], rank - (row["_upto"] - row["_n"])


def _part(low: float, high: float) -> Column:
    """The part of a range that a value is in, NULL outside; the last part holds the upper end alone."""
    scale = 1.0 if math.isfinite(high - low) else 0.5
    width, inner = high * scale - low * scale, F.lit(0)
    if 0 < width < math.inf:
        inner = F.least(F.floor((F.col("_v") * scale - low * scale) / width * PARTS), F.lit(PARTS - 1)).cast("int")
    return F.when(F.col("_v") == high, PARTS).when(F.col("_v").between(low, high), inner)


def _scale(dtype: T.DataType) -> int:
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return dtype.scale
    if isinstance(dtype, WHOLE_TYPES):
        return 0
    raise TypeError(f"exact quantiles need a decimal of up to 18 digits or a whole number, not {dtype.simpleString()}")


def _whole(df: DataFrame, column: str) -> Column:
    """The column counted in units of its last decimal digit."""
    scale = _scale(df.schema[column].dataType)
    return (F.col(column) * F.lit(10**scale).cast(T.DecimalType(scale + 1, 0))).cast("long")


def _ranked_buckets(counts: DataFrame) -> DataFrame:
    """Running row count over the buckets of each prefix."""
    order = Window.partitionBy("_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_upto", F.sum("_n").over(order))


def _first_digit(values: DataFrame, probs: list[float], shift: int) -> tuple[int, Found]:
    """Number of rows, and the leading bits of each searched rank."""
    counts = values.groupBy(F.lit(0).alias("_prefix"), F.shiftright("_v", shift).alias("_digit")).agg(
        F.sum("_rows").alias("_n")
    )
    total = F.sum("_n").over(Window.partitionBy("_prefix"))
    ranked = _ranked_buckets(counts).withColumn("_total", total)
    hit = F.lit(False)
    for p in probs:
        place = F.lit(p) * (F.col("_total") - 1)
        for rank in (F.floor(place), F.ceil(place)):
            hit = hit | ((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank))
    buckets = ranked.where(hit).collect()  # at most two buckets per quantile
    if not buckets:
        return 0, {}
    total_rows = buckets[0]["_total"]
    places = [p * (total_rows - 1) for p in probs]
    ranks = {r for place in places for r in (math.floor(place), math.ceil(place))}
    return total_rows, {rank: _locate(buckets, rank) for rank in ranks}


def _next_digit(values: DataFrame, found: Found, shift: int) -> Found:
    """The next 16 bits of each searched rank, counted inside the buckets found so far."""
    prefix = F.shiftright("_v", shift + DIGIT_BITS)
    digit = F.shiftright("_v", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1).cast("long"))
    counts = (
        values.where(prefix.isin(sorted({p for p, _ in found.values()})))
        .groupBy(prefix.alias("_prefix"), digit.alias("_digit"))
        .agg(F.sum("_rows").alias("_n"))
    )
    hit = F.lit(False)
    for known, rank in set(found.values()):
        inside = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
        hit = hit | (inside & (F.col("_prefix") == known))
    buckets = _ranked_buckets(counts).where(hit).collect()  # at most one bucket per rank
    result = {}
    for wanted, (known, rank) in found.items():
        bits, left = _locate([b for b in buckets if b["_prefix"] == known], rank)
        result[wanted] = ((known << DIGIT_BITS) | bits, left)
    return result


def _locate(buckets: list, rank: int) -> tuple[int, int]:
    """The bucket that holds a rank, and the rank inside it."""
    for b in buckets:
        before = b["_upto"] - b["_n"]
        if before <= rank < b["_upto"]:
            return b["_digit"], rank - before
    raise LookupError(f"rank {rank} is in none of the buckets")
