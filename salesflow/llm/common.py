"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.session import new_dir

#: ASCII white space, the only separators of words in every operator here.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Only the columns an operator reads, so that further ones cannot clash; a null text is empty."""
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later jobs start from to the shared folder, and read it again.

    Unlike a cached frame it outlives lost executors.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_text(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per key with the text that has the smallest hash; copies are merged before the shuffle."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("least")
    return rows.groupBy(*keys).agg(least).select(*keys, F.col("least.text").alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to these which the frame does not have yet."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def in_set(part: Column, modulus: int, value: int) -> Column:
    """crc32 of the id as decimal text, modulo; an id that is null belongs to no fold."""
    return F.coalesce(F.crc32(part.cast("string").cast("binary")) % modulus == value, F.lit(False))


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """One text after the other, so that never more than one is decoded."""
    column = batch.column(batch.schema.get_field_index(name))
    for i in range(len(column)):
        yield column[i].as_py() or ""


class Held(dict):
    """A table of bounded size: when it is full its entries become the old ones, and old ones that are met again return."""

    def __init__(self, room: int):
        super().__init__()
        self.room, self.old = room, {}

    def find(self, key):
        found = self.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = value


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a small DDL string with the types the operators return."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
             "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def rows_out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
