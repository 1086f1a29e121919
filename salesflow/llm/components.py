"""Connected components of an edge list, without any driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import stored

ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node with an edge to another; root is the smallest node of the component.

    Large stars hang the larger neighbours of a node onto the smallest one, small stars the smaller ones, in turn until
    nothing changes; the number of rounds grows with the logarithm of the size. Every round is written to the shared
    folder. A node with many neighbours is split by adaptive execution in the joins and summed up in parts in the
    aggregates. edges has columns a and b; loops and repeated edges are ignored, and so are edges with a null end. An empty
    list gives no rows; other columns are not read.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
                 "edges")
    state = _state(now)
    for _ in range(ROUNDS):
        if state[0] == 0:
            break
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select("v", F.col("m").alias("u")).where("v > u").distinct()
        large = stored(large, "edges")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")),
                                                              F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))
                                            .alias("e")).select("e.v", "e.u").where("v > u").distinct()
        now = stored(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle within {ROUNDS} rounds")
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(
        now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
