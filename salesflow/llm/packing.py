"""Best-fit packing into sequences of several permitted lengths.

Documents are cut at the largest permitted length; the pieces are dealt to shards of about `SHARD` pieces by a hash, equal
rows, which are counted first, in heaps of `HEAP` copies from shard to shard, so no shard gets them all. Every shard is packed for itself, so the work is spread evenly and the waste of a shard is a bin or so. In a shard, pieces
go from the longest to the shortest into the open bin they fit best. If none has room, a new bin of the least-cost size is
opened: the size whose bin, filled with the longest of the pieces still to come, costs least per position. As that looks
at one bin only, plans that open each permitted size throughout (longer pieces take the smallest that holds them) are
made too. Every bin is finally downsized to the smallest size that holds its contents, and the plan with the least total
cost wins. A bin costs its length plus `OVERHEAD`.

Defined cases: a null or empty text, or one of white space, is one piece that holds only the end mark; equal pieces are
ordered by doc_id (null first) and start; a null doc_id is packed like any other; repeated rows are packed once each; an
empty table gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, id_and_text

SIZES = (512, 1024, 2048, 4096)
#: What a sequence costs beside its positions, in positions.
OVERHEAD = 16
SHARD = 50_000
#: Most copies of equal rows that go to a shard together.
HEAP = 256


def n_words(text: Column) -> Column:
    """ASCII white-space separated words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


class Waiting:
    """The lengths still to come, as counts and a bit set of those that are left."""

    def __init__(self, lengths: list[int]):
        self.counts, self.bits = Counter(lengths), 0
        for n in self.counts:
            self.bits |= 1 << n

    def take(self, n: int) -> None:
        self.counts[n] -= 1
        if not self.counts[n]:
            self.bits ^= 1 << n

    def least_cost(self, n: int, sizes: tuple[int, ...]) -> int:
        """The size of a bin for a piece of length n that costs least per position when the longest fitting pieces follow."""
        best = None
        for size in sizes:
            if size < n:
                continue
            room, used, bits = size - n, n, self.bits
            while fitting := bits & ((2 << room) - 1):
                longest = fitting.bit_length() - 1
                some = min(self.counts[longest], room // longest)
                room, used, bits = room - some * longest, used + some * longest, bits ^ 1 << longest
            cost = (next(s for s in sizes if s >= used) + OVERHEAD) / used
            if best is None or cost < best[0]:
                best = cost, size
        return best[1]


def pack_with(lengths: list[int], sizes: tuple[int, ...], opened: int | None) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Cost, the (bin, offset) of each length in falling order, and every bin's size after downsizing.

    Bins are opened with the size `opened`, or, if that is None, each with the size of least cost. They are kept by their
    room; a bit set of the rooms in use gives the tightest one in a few steps.
    """
    by_room: dict[int, list[int]] = {}
    waiting = Waiting(lengths) if opened is None else None
    rooms, held, place = 0, [], []
    for n in lengths:
        if waiting:
            waiting.take(n)
        above = rooms >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            stack = by_room[room]
            which = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            which = len(held)
            if waiting:
                room = waiting.least_cost(n, sizes)
            else:
                room = opened if n <= opened else next(s for s in sizes if s >= n)
            held.append(0)
        place.append((which, held[which]))
        held[which] += n
        room -= n
        if room:
            stack = by_room.setdefault(room, [])
            if not stack:
                rooms |= 1 << room
            stack.append(which)
    final = [next(s for s in sizes if s >= h) for h in held]
    return sum(final) + OVERHEAD * len(final), place, final


def pack(lengths: list[int], sizes: tuple[int, ...] = SIZES) -> tuple[int, list[tuple[int, int]], list[int]]:
    """The cheapest of the plans; lengths come in falling order and none is larger than the largest size."""
    return min((pack_with(lengths, sizes, s) for s in (None, *sizes)), key=lambda plan: plan[0])


OUT = "shard long, bin long, bin_size long, bin_offset long, doc_id long, piece long, start long, length long"


def pack_pieces(pieces: DataFrame, sizes: tuple[int, ...] = SIZES, shard: int = SHARD) -> DataFrame:
    """Pack documents given as (doc_id, length, salt) with a length of at least 1.

    One row per piece: shard and bin name the sequence, bin_size is its length after downsizing, bin_offset
    the place in it, start the place in the document.
    """
    sizes = tuple(sorted(sizes))
    top = sizes[-1]
    equal = pieces.groupBy("doc_id", "length", "salt").agg(F.count("*").alias("n"))
    heaps = equal.select("doc_id", "length", "salt", "n", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / HEAP))).alias("heap"))
    cut = heaps.select("doc_id", "salt", F.col("length").alias("whole"), "heap",
                       F.least(F.lit(HEAP), F.col("n") - F.col("heap") * HEAP).cast("long").alias("copies"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / top))).alias("piece"))
    cut = cut.select("doc_id", "salt", "heap", "copies", "piece", (F.col("piece") * top).alias("start"),
                     F.least(F.lit(top), F.col("whole") - F.col("piece") * top).cast("long").alias("length"))
    total = pieces.agg(F.sum(F.ceil(F.col("length") / F.lit(top)))).first()[0] or 0
    shards = max(1, -(-int(total) // shard))
    schema = arrow_schema(OUT)

    def run(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.repeat(np.arange(len(group)), group["copies"].to_numpy())))
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        _, place, final = pack(group["length"].to_pylist(), sizes)
        bins = [b for b, _ in place]
        columns = [group["shard"], pa.array(bins, pa.int64()), pa.array([final[b] for b in bins], pa.int64()),
                   pa.array([o for _, o in place], pa.int64()), group["doc_id"], group["piece"], group["start"], group["length"]]
        return pa.table(columns, schema=schema)

    first = F.pmod(F.xxhash64("doc_id", "piece", "salt"), F.lit(shards))
    dealt = cut.withColumn("shard", F.pmod(first + F.col("heap"), F.lit(shards)))
    return dealt.drop("salt", "heap").groupBy("shard").applyInArrow(run, OUT)


def pack_documents(docs: DataFrame, sizes: tuple[int, ...] = SIZES, shard: int = SHARD) -> DataFrame:
    """Pack whole documents by their words, with one position more for the end mark."""
    lengths = id_and_text(docs).select("doc_id", (n_words(F.col("text")) + 1).cast("long").alias("length"),
                                       F.xxhash64("text").alias("salt"))
    return pack_pieces(lengths, sizes, shard)
