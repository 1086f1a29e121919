"""Exact de-duplication with the heavy hitters split off.

Misra-Gries counters, kept per partition and added up, name every digest that more than `SHARE` of all rows have. The
exact winners of those few digests are broadcast: their copies are settled where they are read and never shuffled. All
other digests go through an ordinary shuffle, in which no group has more than that share of the rows.

Defined cases: a null text is empty; of equal rows with equal ids one stays; a null doc_id is larger than any other and
`keep_id` is null only if no row of the group has an id; of a text of any length only its digest is shuffled; an empty table gives an empty result; columns other than
`doc_id` and `text` are neither read nor touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import fresh, stored

#: Counters of a partition's summary, and the share of all rows from which on a digest counts as heavy.
COUNTERS = 999
SHARE = 0.005


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def summarise(batches: Iterator[pa.RecordBatch], counters: int = COUNTERS) -> Iterator[pa.RecordBatch]:
    """Misra-Gries over one partition: a counter is short by at most rows / (counters + 1)."""
    held: dict[bytes, int] = {}
    for batch in batches:
        for item in batch.column(0).value_counts():
            key, n = item["values"].as_py(), item["counts"].as_py()
            held[key] = held.get(key, 0) + n
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: n - cut for k, n in held.items() if n > cut}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"])


def heavy_winners(rows: DataFrame, total: int) -> DataFrame:
    """Of every digest with more than SHARE of the rows: the exact count and the row that stays.

    rows has doc_id, digest and row_id. Counters add up to `total` at most and a heavy digest's to more than
    (SHARE - 1 / (COUNTERS + 1)) of it, so there are at most 250 rows whatever the size of the input.
    """
    least = (SHARE - 1 / (COUNTERS + 1)) * total
    candidates = (rows.select("digest").mapInArrow(summarise, "digest binary, n long")
                  .groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") >= F.lit(least)).select("digest"))
    return winners(rows.join(F.broadcast(candidates), "digest"))


def winners(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id"))
    return rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")).select(
        "digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row_id").alias("keep_row"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(docs.select("doc_id", digest(F.col("text")).alias("digest"),
                              F.monotonically_increasing_id().alias("row_id")), "digests")
    heavy = stored(heavy_winners(rows, rows.count()), "heavy")
    few = F.broadcast(heavy)  # 250 rows at most, see heavy_winners
    rest = rows.join(few.select("digest"), "digest", "left_anti")
    settled = rows.join(few, "digest").unionByName(rest.join(winners(rest), "digest"))
    return settled.select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
                          F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of each group of equal texts, with all their columns.

    Copies of a heavy digest other than the one with the winning doc_id go before the shuffle; what remains of
    each digest is ranked, a row per task at most.
    """
    key, rank, best = fresh(docs, "digest_key", "digest_rank", "digest_best")
    keyed = docs.withColumn(key, digest(F.col("text")))
    rows = stored(keyed.select("doc_id", F.col(key).alias("digest"), F.monotonically_increasing_id().alias("row_id")),
                  "digests")
    heavy = stored(heavy_winners(rows, rows.count()), "heavy").select(
        F.col("digest").alias(key), F.struct(F.col("keep_id").alias("id")).alias(best))
    left = keyed.join(F.broadcast(heavy), key, "left").where(
        F.col(best).isNull() | F.col(f"{best}.id").eqNullSafe(F.col("doc_id")))
    order = Window.partitionBy(key).orderBy(F.col("doc_id").asc_nulls_last())
    return left.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)
