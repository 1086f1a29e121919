"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments of 21, 21 and 22 bits. Two fingerprints with at most four differing bits differ in at
most one bit of the first or of the second segment, or in none of the third: otherwise there were five. Every fingerprint
is entered in three tables, one per segment, looks up the balls of radius 1 (and 0 in the third) around its own segments,
and the complete distance of each match is verified. Copies of a fingerprint are one entry.

A bucket gives a forest, not all its pairs. Buckets with more than `HOT` entries, and those that look them up, are cut
again: the bits outside the segment make three segments of 14 or 15 bits, entered and looked up in the same way, with what
the first look-up has left of the four bits. Buckets that have more than `CROWD` rows even then (thousands of fingerprints
that agree in 35 bits) take a last exact way: every fingerprint in them is given to the keys of its ball of radius 2, and two
fingerprints are within four bits if and only if they share such a key. All of this grows with the number of fingerprints,
not with its square.

Defined cases: a null or empty text, or one of white space, has fingerprint zero and is linked like any other; fewer
words than a shingle are hashed as one; a text of any length is hashed whole; a null doc_id gets a fingerprint and the smallest id of its component (null if
there is none); repeated rows come back once each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import fresh, id_and_text, stored, texts
from salesflow.llm.components import connected_components

#: Shift and width of each segment, and the radius searched in it.
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
DISTANCE = 4
#: Entries of a bucket, and rows of one that was cut again, from which on it takes the next way.
HOT, CROWD = 4096, 100_000


def fingerprint(text: str, shingle: int) -> int:
    """The SimHash of a text as unsigned 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - shingle + 1
        hashed = xxhash.xxh64_intdigest
        hashes = [hashed(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for at in range(0, len(values), 65536):
        bits = np.unpackbits(values[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(values), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fp long")


def forest(fps: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what is linked within a bucket: at most one fewer than its fingerprints.

    Every table entry (own) is compared with all rows of the bucket at once and joins the labels it meets.
    """
    label = np.arange(len(fps))
    edges = []
    for i in np.flatnonzero(own).tolist():
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= DISTANCE)
        met, at = np.unique(label[near], return_index=True)
        if len(met) > 1:
            edges += [(i, j) for j in near[at].tolist() if fps[i] != fps[j] and label[j] != label[i]]
            label[np.isin(label, met)] = met[0]
    return edges


def match_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between fingerprints of one bucket; the rows come sorted by bucket, table entries first.

    Small buckets are compared all at once, shifted by one row, two rows and so on; only the last bucket of a
    batch is carried on to the next.
    """
    held = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))

    def edges_of(bucket, fp, own):
        found_a, found_b = [], []
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(bucket)])))
        for s, n in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist(), strict=True):
            f = fp[s:s + n]
            for i, j in forest(f, own[s:s + n]):
                found_a.append(f[i:i + 1])
                found_b.append(f[j:j + 1])
        few = np.repeat(sizes <= 16, sizes)
        bucket, fp, own = bucket[few], fp[few], own[few]
        for d in range(1, min(16, len(fp))):
            here = np.flatnonzero((bucket[d:] == bucket[:-d]) & (own[d:] | own[:-d]))
            if not len(here):
                break
            here = here[np.bitwise_count(fp[here] ^ fp[here + d]) <= DISTANCE]
            found_a.append(fp[here])
            found_b.append(fp[here + d])
        if not found_a:
            return None
        a, b = (np.concatenate(x).view(np.int64) for x in (found_a, found_b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        new = (batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64),
               batch.column(2).to_numpy(zero_copy_only=False))
        bucket, fp, own = (np.concatenate(x) for x in zip(held, new, strict=True))
        if not len(bucket):
            continue
        cut = np.searchsorted(bucket, bucket[-1])
        held = (bucket[cut:], fp[cut:], own[cut:])
        if cut and (out := edges_of(bucket[:cut], fp[:cut], own[:cut])) is not None:
            yield out
    if len(held[0]) and (out := edges_of(*held)) is not None:
        yield out


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within DISTANCE bits of each other; distinct has the column fp."""
    part = [F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).bitwiseOR(k << 32)
            for k, (shift, width, _) in enumerate(SEGMENTS)]
    table = [F.struct(p.alias("bucket"), F.lit(True).alias("own")) for p in part]
    balls = [F.struct(part[k].bitwiseXOR(F.lit(1 << bit).cast("long")).alias("bucket"), F.lit(False).alias("own"))
             for k, (_, width, radius) in enumerate(SEGMENTS) if radius for bit in range(width)]
    entries = distinct.select("fp", F.explode(F.array(*table, *balls)).alias("e")).select("e.bucket", "fp", "e.own")
    sizes = distinct.select(F.explode(F.array(*part)).alias("bucket")).groupBy("bucket").count()
    around = [F.col("bucket").bitwiseXOR(F.lit(1 << bit).cast("long")) for bit in range(SEGMENTS[0][1])]
    ball = F.when(F.shiftright("bucket", 32) < 2, F.array("bucket", *around)).otherwise(F.array("bucket"))
    hot = stored(sizes.where(F.col("count") > HOT).select(F.explode(ball).alias("bucket")).distinct(), "hot")
    if hot.isEmpty():
        return matched(entries)
    found = matched(entries.join(hot, "bucket", "left_anti"))
    deeper = stored(cut_again(entries.join(hot, "bucket")), "deeper")
    crowded = stored(deeper.groupBy("bucket").count().where(F.col("count") > CROWD).select("bucket"), "crowded")
    if crowded.isEmpty():
        return found.unionAll(matched(deeper)).distinct()
    found = found.unionAll(matched(deeper.join(crowded, "bucket", "left_anti")))
    return found.unionAll(by_balls(deeper.join(crowded, "bucket").select("fp").distinct())).distinct()


def matched(entries: DataFrame) -> DataFrame:
    """Edges (a, b) within the buckets of (bucket, fp, own)."""
    return entries.repartition("bucket").sortWithinPartitions("bucket", F.col("own").desc()).mapInArrow(
        match_buckets, "a long, b long").distinct()


def cut_again(entries: DataFrame) -> DataFrame:
    """Entries of crowded buckets in buckets of their own segment and one of three of the other bits.

    Two entries of a table may differ in four of the other bits, so they look up radius 1 in two of the segments. One that
    has looked the bucket up differs in a bit already: in three others at most, so radius 1 in one segment is enough.
    """
    rest = F.lit(None)
    for k, (shift, width, _) in enumerate(SEGMENTS):
        above = F.shiftleft(F.shiftrightunsigned("fp", shift + width), shift) if shift + width < 64 else F.lit(0).cast("long")
        below = F.col("fp").bitwiseAND(F.lit((1 << shift) - 1).cast("long"))
        rest = F.when(F.shiftright("bucket", 32) == k, above.bitwiseOR(below)).otherwise(rest)
    widths, at, rows = (14, 14, 15), 0, []
    for k, width in enumerate(widths):
        part = F.shiftrightunsigned("rest", at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        rows.append(F.struct(F.lit(k).alias("k"), part.alias("part"), F.col("own").alias("own")))
        near = F.array(*[F.struct(F.lit(k).alias("k"), part.bitwiseXOR(F.lit(1 << bit).cast("long")).alias("part"), F.lit(False).alias("own"))
                         for bit in range(width)])
        if k < 2:
            rows.append(near if k == 0 else F.when(F.col("own"), near).otherwise(F.slice(near, 1, 0)))
        at += width
    singles = F.array(*[r for i, r in enumerate(rows) if i in (0, 2, 4)])
    all_rows = F.concat(singles, rows[1], rows[3])
    split = entries.withColumn("rest", rest).select("bucket", "fp", F.explode(all_rows).alias("e"))
    return split.select(F.xxhash64("bucket", "e.k", "e.part").alias("bucket"), "fp", "e.own")


def by_balls(distinct: DataFrame) -> DataFrame:
    """Edges that connect all fingerprints within DISTANCE bits, by the keys that their balls of half that radius share."""
    flips = [1 << i for i in range(64)]
    masks = [0, *flips, *(x | y for i, x in enumerate(flips) for y in flips[:i])]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = distinct.select("fp", F.explode(F.transform(F.lit(signed), lambda m: F.col("fp").bitwiseXOR(m))).alias("key"))
    first = keys.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").select("key", "a")
    return keys.join(first, "key").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def near_groups(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """One row per document: doc_id, fp and component_id, the smallest doc_id that links reach."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = stored(connected_components(links(distinct.select("fp"))), "roots").withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = linked.join(smallest, "root").select("fp", "component_id")
    names = distinct.join(roots.select("fp"), "fp", "left_anti").select("fp", F.col("first_id").alias("component_id"))
    return prints.join(of_linked.unionAll(names), "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all its columns.

    Of repeated rows one stays. Rows without an id cannot be told from one another and all stay.
    """
    rank, mark = fresh(docs, "copy_rank", "copy_text")
    firsts = near_groups(docs, shingle).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(firsts, "doc_id", "left_semi").withColumn(mark, F.xxhash64("text"))
    order = Window.partitionBy("doc_id", mark).orderBy(F.lit(1))
    once = kept.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)
    return once.unionAll(docs.where(F.col("doc_id").isNull()).select(*docs.columns))
