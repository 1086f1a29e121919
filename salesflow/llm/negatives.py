"""Hard negatives of anchors, by slots of scores.

An anchor's positives are the rows of its label that score highest. Each asks for negatives whose score lies in a window
below its own, and the windows of one anchor overlap. Their upper limits cut the scores into disjoint slots; within a slot
only the best few can be an answer. So blocks of rows are scored against blocks of anchors, each pair of blocks keeps the
best of every slot, these are combined over all blocks, and merging the slots from the lowest upward gives, at each upper
limit, the best scores at or below it: the answers of every window, once those below its lower limit are cut off.

Every anchor meets every row, in blocks of bounded size: a block of anchors is sent to each block of rows by an equi-join,
and no task holds more than one pair of blocks. Scores are exact: sums of whole numbers, in the narrowest arithmetic that
cannot round them, and held at the ends of a long where they would exceed it.

Defined cases: rows with a null id, label or vector or with a component that is null or not finite (scaled, as a double) take no part; rows that
agree in id, label and vector are one row, others of the same id are rows of their own, but never each other's positives or
negatives; vectors of different length have no score together; scores that are equal are ordered by id; anchors without a
positive and positives without a negative have no row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, rows_out, stored

#: Rows and anchors of a block; scores of CHUNK anchors with a block of rows are held at once.
ROWS, ANCHORS, CHUNK = 16_384, 4_096, 256
BLOCKS = "block long, part long, dim long, kind string, n long, ids binary, labels binary, parts binary"
FOUND = "key long, block long, slot long, score long, id long"
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def vectors(rows: DataFrame, scale: float) -> DataFrame:
    """The rows that take part, equal ones once: vec_id, label, embedding; copies are merged before the shuffle."""
    usable = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")).dropna()
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x * scale) < float("inf"), F.lit(False)))  # NaN is above infinity
    return usable.where(finite).groupBy("vec_id", "label", "embedding").agg(F.lit(1).alias("one")).drop("one")


def blocks(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows put together as binary blocks of one dimension, ordered by id, with components floor(scale * x)."""
    schema = arrow_schema(BLOCKS)

    def block(held: list[tuple], part: int, number: int) -> pa.RecordBatch:
        held.sort(key=lambda row: row[:2])
        values = np.floor(scale * np.array([row[2] for row in held], np.float64).reshape(len(held), -1))
        kind = next((k for k in ("i2", "i4") if np.abs(values).max(initial=0) <= np.iinfo(k).max), "f8")
        ids, labels = (np.array([row[i] for row in held], "<i8").tobytes() for i in (0, 1))
        return rows_out([(part << 20 | number, part, values.shape[1], kind, len(held), ids, labels, values.astype(f"<{kind}").tobytes())],
                        schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                of = held.setdefault(len(row[2]), [])
                of.append(row)
                if len(of) == size:
                    yield block(held.pop(len(row[2])), part, number)
                    number += 1
                elif sum(map(len, held.values())) >= 2 * size and len(held) > 1:  # many dimensions: the fullest goes
                    yield block(held.pop(max(held, key=lambda d: len(held[d]))), part, number)
                    number += 1
        for of in held.values():
            yield block(of, part, number)
            number += 1

    return rows.select("vec_id", "label", "embedding").mapInArrow(run, BLOCKS)


class Block:
    """One block in memory."""

    def __init__(self, n: int, dim: int, kind: str, ids: bytes, labels: bytes, parts: bytes):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.parts = np.frombuffer(parts, f"<{kind}").reshape(n, dim)
        self.peak = float(np.abs(self.parts.astype(np.float64)).max(initial=0))


def scores(anchors: np.ndarray, rows: np.ndarray, peak: float) -> np.ndarray:
    """Exact inner products as floats if no sum can reach `peak` or more, as whole numbers of Python otherwise."""
    if peak < 1 << 24:
        return anchors.astype(np.float32) @ rows.astype(np.float32).T
    if peak < 1 << 53:
        return anchors.astype(np.float64) @ rows.astype(np.float64).T
    whole = np.vectorize(int, otypes=[object])
    product = np.dot(whole(anchors), whole(rows).T)
    return np.clip(product, LEAST, MOST)


def chunks(a: Block, r: Block) -> Iterator[tuple[slice, np.ndarray, object]]:
    """The scores of a block of anchors with a block of rows, a few anchors at a time, and what stands for none."""
    peak = a.peak * r.peak * a.parts.shape[1]
    for at in range(0, len(a.ids), CHUNK):
        of = slice(at, at + CHUNK)
        table = scores(a.parts[of], r.parts, peak)
        none = LEAST - 1 if table.dtype == object else -np.inf
        table[a.ids[of, None] == r.ids[None, :]] = none
        yield of, table, none


def best(table: np.ndarray, none, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lines, columns, scores) of the highest, second highest ... of each line; the first of equals. Takes them out."""
    lines = np.arange(len(table))
    for _ in range(min(k, table.shape[1])):
        columns = table.argmax(axis=1)
        found = table[lines, columns]
        some = found > none
        if not some.any():
            return
        yield lines[some], columns[some], found[some]
        table[lines, columns] = none


def limits(score: int, least: int, most: int) -> tuple[int, int]:
    """The lowest and the highest whole score n with least * score <= 100 * n <= most * score."""
    return -(-least * score // 100), most * score // 100


def slots(positives: list[int], least: int, most: int) -> list[tuple[int, int]]:
    """(lowest useful, highest) score of each slot, from the highest down; empty windows have none."""
    tops: dict[int, int] = {}
    for low, high in (limits(score, least, most) for score in positives):
        if low <= high:
            tops[high] = min(low, tops.get(high, low))
    highs = sorted(tops, reverse=True)
    return [(max(tops[high], below + 1), high) for high, below in zip(highs, [*highs, LEAST][1:], strict=True)]


def pairs(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Each block of anchors beside each block of rows of its dimension; columns of the latter start with r_."""
    n = (rows.agg(F.max("part")).first()[0] or 0) + 1
    there = rows.select(F.col("part").alias("to"), *[F.col(c).alias(f"r_{c}") for c in ("dim", "kind", "n", "ids", "labels", "parts")])
    sent = anchors.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return sent.repartition(n, "to").join(there.repartition(n, "to"), "to").where(F.col("dim") == F.col("r_dim"))


def _blocks_of(row: dict) -> tuple[Block, Block]:
    names = ("n", "dim", "kind", "ids", "labels", "parts")
    return Block(*(row[c] for c in names)), Block(*(row[f"r_{c}"] for c in names))


def _found(keys: np.ndarray, block: int, slot: int, score: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(np.full(len(keys), block), pa.int64()), pa.array(np.full(len(keys), slot), pa.int64()),
         pa.array(score.astype(np.int64), pa.int64()), pa.array(ids, pa.int64())], schema=arrow_schema(FOUND))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def positives_of(anchors: DataFrame, rows: DataFrame, count: int) -> DataFrame:
    """The best rows of an anchor's own label as rows of FOUND; blocks give their best, and those are combined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            a, r = _blocks_of(row)
            for of, table, none in chunks(a, r):
                table[a.labels[of, None] != r.labels[None, :]] = none
                for lines, columns, score in best(table, none, count):
                    yield _found((row["block"] << 16) + of.start + lines, row["block"], 0, score, r.ids[columns])

    return _top(pairs(anchors, rows).mapInArrow(run, FOUND), count)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of every slot of an anchor; Spark cuts each side of the shuffle down to k."""
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def slot_winners(anchors: DataFrame, rows: DataFrame, positives: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """The best k negatives of every slot of an anchor as rows of FOUND."""
    of_block = positives.groupBy("block").agg(F.collect_list("key").alias("keys"), F.collect_list("score").alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            a, r = _blocks_of(row)
            asked: list[list[int]] = [[] for _ in a.ids]
            for key, score in zip(row["keys"], row["wanted"], strict=True):
                asked[key & 0xFFFF].append(score)
            cut = [slots(p, least, most) for p in asked]
            for of, table, none in chunks(a, r):
                table[a.labels[of, None] == r.labels[None, :]] = none
                for slot in range(max(map(len, cut[of]), default=0)):
                    lines = np.array([i for i, c in enumerate(cut[of]) if slot < len(c)])
                    low, high = (np.array([cut[of.start + i][slot][e] for i in lines], table.dtype if table.dtype == object else np.float64)
                                 for e in (0, 1))
                    inside = table[lines]
                    inside[inside > high[:, None]] = none
                    for of_lines, columns, score in best(inside, none, k):
                        some = score >= low[of_lines]
                        yield _found((row["block"] << 16) + of.start + lines[of_lines[some]], row["block"], slot, score[some],
                                     r.ids[columns[some]])

    return _top(pairs(anchors.join(of_block, "block"), rows).mapInArrow(run, FOUND), k)


def answers(positives: list[tuple[int, int]], winners: list[tuple[int, int, int]], k: int, least: int, most: int) -> Iterator[tuple]:
    """(positive id, rank, negative id, positive score, negative score) from an anchor's positives (score, id) and the
    winners (slot, score, id): slots are merged from the lowest upward, and each window reads what is merged at its top."""
    cut = slots([score for score, _ in positives], least, most)
    merged, at_or_below = [], {}
    for slot in range(len(cut) - 1, -1, -1):
        merged = sorted(merged + [(-score, i) for s, score, i in winners if s == slot])[:k]
        at_or_below[cut[slot][1]] = merged
    for score, positive in positives:
        low, high = limits(score, least, most)
        for rank, (negative, i) in enumerate([m for m in at_or_below.get(high, []) if -m[0] >= low], 1):
            yield positive, rank, i, score, -negative


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, k: int = 3, least: int = 50, most: int = 95,
                   scale: float = 256.0) -> DataFrame:
    """The first k negatives of every anchor and positive whose score is between `least` and `most` per cent of the positive's.

    `rows` has vec_id, label and embedding; is_anchor is a condition on vec_id. `most` is 100 at most, `least` 0 at least.
    """
    use = vectors(rows, scale)
    row_blocks = stored(blocks(_dealt(use, ROWS), ROWS, scale), "rows")
    anchor_blocks = stored(blocks(_dealt(use.where(is_anchor), ANCHORS), ANCHORS, scale), "anchors")
    best_own = stored(positives_of(anchor_blocks, row_blocks, positives), "positives")
    winners = slot_winners(anchor_blocks, row_blocks, best_own, k, least, most)
    near = best_own.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("near"))
    far = winners.groupBy("key").agg(F.collect_list(F.struct("slot", "score", "id")).alias("far"))
    named = anchor_blocks.select("block", "ids")
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found = answers([(p["score"], p["id"]) for p in row["near"]], [(w["slot"], w["score"], w["id"]) for w in row["far"]],
                                k, least, most)
                out += [(row["anchor"], *one) for one in found]
            yield rows_out([(a, p, rank, n, ps, ns) for a, p, rank, n, ps, ns in out], schema)

    return near.join(far, "key").join(_anchor_ids(named), "key").select("anchor", "near", "far").mapInArrow(run, OUT)


def _anchor_ids(named: DataFrame) -> DataFrame:
    """(key, anchor): the id of every anchor in its block."""
    schema = arrow_schema("key long, anchor long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids = np.frombuffer(row["ids"], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array((row["block"] << 16) + np.arange(len(ids)), pa.int64()), pa.array(ids, pa.int64())],
                                             schema=schema)

    return named.mapInArrow(run, "key long, anchor long")


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """Rows dealt evenly over as many partitions as they fill blocks."""
    return rows.repartition(max(math.ceil(rows.count() / size), 1))
