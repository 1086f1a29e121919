"""Chronological train/test split per group, without ever sorting a group in one task.

The split follows day counts: whole days before the boundary day are training rows and
whole days after it are test rows. Only the boundary day is looked at more closely, first
by hash buckets of the tie-break columns and then row by row inside a single bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import sized

MIN_GROUP_ROWS = 10
TRAIN_SHARE = 0.8


def can_forecast(min_rows: int = MIN_GROUP_ROWS) -> Column:
    """At least min_rows rows, 2 training rows and 1 test row."""
    n, train = F.col("n_rows"), F.col("n_train")
    return (n >= min_rows) & (train >= 2) & (n - train >= 1)


def eligible_groups(df: DataFrame, group: str = "region", min_rows: int = MIN_GROUP_ROWS) -> DataFrame:
    """Groups large enough to be split, with their sizes."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n_rows"))
    return sizes.withColumn("n_train", train_rows(F.col("n_rows"))).where(can_forecast(min_rows))


def train_rows(n: Column, share: float = TRAIN_SHARE) -> Column:
    return F.greatest(F.lit(1), F.floor(n * F.lit(share))).cast("long")


def tie_bucket(ties: list[str]) -> Column:
    """One of 65,536 buckets: the first four hex digits of the MD5 of the tie-break columns."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ties]
    return F.substring(F.md5(F.concat_ws("|", *texts).cast("binary")), 1, 4)


def _boundary(counts: DataFrame, group: str, *steps: str) -> DataFrame:
    """The step of each group in which the running count reaches `_take`, and how many of its rows to take."""
    order = Window.partitionBy(group).orderBy(*steps).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("_n").over(order))
    before = F.col("_upto") - F.col("_n")
    return running.where((F.col("_upto") >= F.col("_take")) & (before < F.col("_take"))).withColumn(
        "_take", F.col("_take") - before
    )


def split_points(df: DataFrame, ties: list[str], group: str = "region", day: str = "date_vente",
                 share: float = TRAIN_SHARE) -> DataFrame:
    """One row per group: its sizes, its last day and the sort key (day, bucket, ties) of its last training row.

    Three narrow passes, each of which shuffles next to nothing: counts per group and day,
    counts per bucket of the boundary day, and the records of one such bucket, copies merged.
    """
    daily = df.groupBy(group, day).agg(F.count("*").alias("_n")).persist()
    totals = daily.groupBy(group).agg(F.sum("_n").alias("n_rows"), F.max(day).alias("last_day"))
    totals = totals.withColumn("n_train", train_rows(F.col("n_rows"), share)).withColumn("_take", F.col("n_train"))
    edge_day = sized(_boundary(daily.join(totals, group), group, day).drop("_n", "_upto"))

    keyed = df.select(*dict.fromkeys([group, day, *ties]))
    on_day = keyed.join(edge_day, [group, day]).withColumn("_bucket", tie_bucket(ties))
    per_bucket = on_day.groupBy(*edge_day.columns, "_bucket").agg(F.count("*").alias("_n"))
    edge = sized(_boundary(per_bucket, group, "_bucket").drop("_n", "_upto"))

    in_bucket = keyed.join(edge, [group, day]).where(tie_bucket(ties) == F.col("_bucket"))
    records = in_bucket.groupBy(*dict.fromkeys([*edge.columns, *ties])).agg(F.count("*").alias("_n"))
    last = _sort_key(day, F.col("_bucket"), ties).alias("last_train")
    points = sized(_boundary(records, group, *ties).select(group, "n_rows", "n_train", "last_day", last))
    for held in (daily, edge_day, edge):
        held.unpersist()
    return points


def _sort_key(day: str, bucket: Column, ties: list[str]) -> Column:
    fields = [F.col(day).alias("day"), bucket.alias("bucket")]
    return F.struct(*fields, *[F.col(t).alias(f"tie_{i}") for i, t in enumerate(ties)])


def flag_train(df: DataFrame, points: DataFrame, ties: list[str], group: str = "region",
               day: str = "date_vente") -> DataFrame:
    """The rows of the groups in `points`, with an `is_train` flag."""
    last = F.col("last_train")
    flag = (
        F.when(F.col(day) < last["day"], True)
        .when(F.col(day) > last["day"], False)
        .otherwise(_sort_key(day, tie_bucket(ties), ties) <= last)
    )
    return df.join(points.select(group, "last_train"), group).withColumn("is_train", flag).drop("last_train")


def chronological_split(df: DataFrame, ties: list[str], group: str = "region", day: str = "date_vente",
                        share: float = TRAIN_SHARE) -> DataFrame:
    """The rows with an `is_train` flag: the first share of each group by day.

    Rows of one day are ordered by `ties`, which must tell all rows of a group apart; rows
    equal in all of them fall on the same side.
    """
    return flag_train(df, split_points(df, ties, group, day, share), ties, group, day)


def split_by_row_number(df: DataFrame, ties: list[str], group: str = "region", day: str = "date_vente",
                        share: float = TRAIN_SHARE) -> DataFrame:
    """The same split by numbering each group in order; for many small groups."""
    whole = Window.partitionBy(group)
    place = F.row_number().over(whole.orderBy(day, tie_bucket(ties), *ties))
    n = F.count("*").over(whole)
    return (
        df.withColumn("_n", n).withColumn("_place", place)
        .withColumn("is_train", F.col("_place") <= train_rows(F.col("_n"), share))
        .drop("_n", "_place")
    )
