"""Types of text columns, from sums and maxima that merge.

A column's profile says how many of its values have the shape of each type, and how many digits they need. It is one
aggregate, taken for all columns in a single pass, and profiles of several files merge into that of all of them without
reading a row again. The type is the narrowest one that holds every value: whole number, decimal, double, date, text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions import parsing as P

#: Digits of a decimal at most; columns that need more are doubles.
DIGITS = 38
WHOLE = r"^[+-]?[0-9]+$"
PLAIN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
FLOAT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _profile(name: str) -> Column:
    value = F.trim(P.quoted(name))
    count = lambda good: F.count_if(F.coalesce(good, F.lit(False)))
    plain = value.rlike(PLAIN)
    return F.struct(
        F.lit(name).alias("column"),
        F.count(value).alias("n"),
        count(value.rlike(WHOLE) & value.try_cast("long").isNotNull()).alias("n_whole"),
        count(plain).alias("n_plain"),
        F.max(F.when(plain, F.length(F.regexp_extract(value, "^[+-]?0*([0-9]*)", 1)))).alias("digits"),
        F.max(F.when(plain, F.length(F.regexp_extract(value, "[.]([0-9]*)$", 1)))).alias("scale"),
        count(value.rlike(FLOAT) & value.try_cast("double").isNotNull()).alias("n_double"),
        count(P.to_date(value).isNotNull()).alias("n_date"),
    )


def type_profile(texts: DataFrame) -> DataFrame:
    """One row per text column: its values and how many fit each type. NULL is no value and fits all."""
    whole = texts.agg(*[_profile(c).alias(f"_{i}") for i, c in enumerate(texts.columns)])
    return whole.select(F.explode(F.array(*whole.columns)).alias("profile")).select("profile.*")


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of all rows from the profiles of some parts of them; a part may lack columns."""
    sums = [F.sum(c).alias(c) for c in ("n", "n_whole", "n_plain", "n_double", "n_date")]
    return profiles.groupBy("column").agg(*sums, F.max("digits").alias("digits"), F.max("scale").alias("scale"))


def type_of(profile) -> T.DataType:
    """The narrowest type for a row of a profile; a column without values stays text."""
    n, digits, scale = profile["n"], profile["digits"] or 0, profile["scale"] or 0
    if n == 0:
        return T.StringType()
    if profile["n_whole"] == n:
        return T.LongType()
    if profile["n_plain"] == n and digits + scale <= DIGITS:
        return T.DecimalType(max(digits + scale, 1), scale)
    if profile["n_double"] == n:
        return T.DoubleType()
    return T.DateType() if profile["n_date"] == n else T.StringType()


def inferred_schema(profiles: DataFrame, columns: list[str]) -> T.StructType:
    """The schema of some columns from a profile; it has a row per column, so that is what the driver sees."""
    types = {r["column"]: type_of(r) for r in profiles.collect()}
    return T.StructType([T.StructField(c, types[c]) for c in columns])


def typed(value: Column, dtype: T.DataType) -> Column:
    """A text as a value of an inferred type; what does not fit becomes NULL."""
    if isinstance(dtype, T.StringType):
        return value
    return P.to_date(F.trim(value)) if isinstance(dtype, T.DateType) else F.trim(value).try_cast(dtype)
