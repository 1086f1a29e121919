"""Distributed writers. None of them brings rows to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.parsing import quoted
from salesflow.session import written
from salesflow.sources.versions import VersionedTable


def clean_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with spaces turned into underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("computed_at", F.current_timestamp())


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Rebuild a table from scratch, as a new version of it: readers (`read_table`) see the old rows until all new ones
    are there, and keep them if the write fails.

    A partitioned table is rebalanced on its partition columns first, so that a task does not
    write a sliver of every partition; adaptive execution splits partitions that are too large.
    """
    VersionedTable(df.sparkSession, path, fmt).replace(df, partition_by)


def export_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rebuild a table under clean column names."""
    replace_table(clean_names(df), path, fmt)


def write_keyed(df: DataFrame, root: str, key: str, value: str | int, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Append one keyed slice; writing the same key again replaces it, so a replay changes nothing.

    A slice is written anew by the replay of what has failed, so it has no versions.
    """
    rows = df.drop(key)
    writer = rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else rows.write
    writer.format(fmt).mode("overwrite").save(f"{root}/{key}={value}")


def replace_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Rebuild a database table; Spark writes from all partitions in batches.

    The rows are computed and stored before the table is emptied, so that a failing query leaves it as it was.
    """
    rows = written(clean_names(df), "jdbc")
    rows.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, truncate="true", **options).save()


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Keep all but the named helper columns."""
    return df.select(*[quoted(c) for c in df.columns if c not in names])
