"""Readers for raw sales files, event topics and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schema as S
from salesflow.functions.parsing import quoted
from salesflow.sources.inference import inferred_schema, type_profile, typed
from salesflow.sources.versions import VersionedTable, is_versioned


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False,
             infer: bool = False) -> DataFrame:
    """CSV with a header line; quotes inside quoted values are doubled.

    Everything is read as text, in one pass, and the usual marks of a missing value become
    NULL. With a schema its columns are then taken by their header, whatever their order in
    the file, and cast; a value that does not fit becomes NULL, a column that is missing an
    error. Files with other headers than the first one are refused. With `infer` and no schema
    every column takes the narrowest type that holds all its values, found in a pass before.
    `multiline` allows line breaks in quoted values, at the price of one task per file.
    """
    texts = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
        .option("enforceSchema", False).csv(path)
    )
    known = {c: F.when(~quoted(c).isin(S.NULL_TEXTS), quoted(c)) for c in texts.columns}
    if schema is None:
        rows = texts.select(*[e.alias(c) for c, e in known.items()])
        if not infer:
            return rows
        types = inferred_schema(type_profile(rows), rows.columns)
        return rows.select(*[typed(quoted(f.name), f.dataType).alias(f.name) for f in types])
    missing = [f.name for f in schema if f.name not in known]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {texts.columns}")
    return texts.select(*[known[f.name].try_cast(f.dataType).alias(f.name) for f in schema])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A warehouse table stored as files (parquet, orc, json, or any installed format); of one with versions the last."""
    return VersionedTable(spark, path, fmt).read() if is_versioned(spark, path) else spark.read.format(fmt).load(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """A database table, read in `parts` key ranges so that no single task reads it whole."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, **options)
        .options(lowerBound=lower, upperBound=upper, numPartitions=parts)
        .load()
    )


def read_kafka(spark: SparkSession, servers: str, topic: str, stream: bool = True, **options: str) -> DataFrame:
    """Raw topic records from the earliest offset on; needs the Kafka package on the classpath."""
    reader = spark.readStream if stream else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
