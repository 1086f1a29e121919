"""Removal of long repeated substrings with suffix arrays.

Every byte covered by a string of `LENGTH` bytes that starts anywhere else in the corpus as well goes. Equal strings are
first brought together (see `spans`): each text is cut into fragments by the anchors of its windows, and what could be
equal has equal keys. Keys that exist once cannot repeat and go no further. A key whose fragments are all alike repeats as
a whole. The different fragments of all other keys are joined to blocks of up to two million bytes; the suffixes of a
block are sorted in two stages, and neighbours with a common prefix of `LENGTH` bytes or more are repeats.

Nothing is gathered without bound: copies of a text count but go along once; a fragment that one text has again and again
(a period) goes along twice, and the rest of them is settled where it is read; keys pass a task row by row; a key with more than `CROWD` different fragments (a common line within ever different text) is cut again by longer anchors,
at last by whole windows, of which equal ones are alike.

Texts are known by a 128-bit hash of their bytes, fragments by two of 64 bits (key and content), so equal texts share
their result. These hashes are trusted: bytes are compared within a block only. Defined cases: a null or empty text and any text shorter than `LENGTH` keep everything; a repeated row
is a copy, also with the same id; an empty table gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, id_and_text, rows_out, stored, texts
from salesflow.llm.spans import cut
from salesflow.llm.suffixes import repeated_runs

LENGTH = 200
#: Bytes of the anchors, one level after the other.
ANCHORS = (32, 150, 200)
#: Different fragments a key may have to be sorted in one block.
CROWD = 1500
#: Rows of one key that are looked at together.
GROUP = 100_000
#: Texts that are turned into rows at once.
SLICE = 128
#: Bytes from which on a block takes no further key.
PACKED = 1 << 18

PIECES = "pid binary, twice boolean, data binary"
ROWS = "key long, content long, pid binary, start long, size long, settled boolean"
FOUND = "key long, content long, low long, high long"
MARKED = "many boolean, key long, content long, pid binary, start long, size long, first boolean, twice boolean"


def named_texts(batches: Iterator[pa.RecordBatch], copies: int) -> Iterator[tuple[bytes, bytes]]:
    """Name and bytes of each text; of equal texts of one task at most so many."""
    seen: dict[bytes, int] = {}
    for batch in batches:
        for text in texts(batch):
            data = text.encode("utf-8", "surrogatepass")
            name = xxhash.xxh3_128_digest(data)
            seen[name] = seen.get(name, 0) + 1
            if seen[name] <= copies:
                yield name, data


def contents(docs: DataFrame) -> DataFrame:
    """PIECES of all texts, compressed; of equal texts a task gives one."""
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, rows = zstandard.ZstdCompressor(level=3).compress, []
        for name, data in named_texts(batches, 1):
            rows.append((name, False, pack(data)))
            if len(rows) == SLICE:
                yield rows_out(rows, schema)
                rows = []
        yield rows_out(rows, schema)

    return id_and_text(docs).mapInArrow(run, PIECES)


def text_fragments(docs: DataFrame, anchor: int, length: int) -> DataFrame:
    """ROWS of all texts; of equal texts a task gives two, which is enough to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_rows(((name, 1, data) for name, data in named_texts(batches, 2)), anchor, length)

    return id_and_text(docs).mapInArrow(run, ROWS)


def piece_fragments(pieces: DataFrame, anchor: int, length: int) -> DataFrame:
    """ROWS of all pieces, twice for a piece that exists twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        return cut_rows(((name.as_py(), 1 + twice.as_py(), unpack(data.as_py())) for batch in batches
                         for name, twice, data in zip(*batch.columns, strict=True)), anchor, length)

    return pieces.mapInArrow(run, ROWS)


def cut_rows(items: Iterator[tuple[bytes, int, bytes]], anchor: int, length: int) -> Iterator[pa.RecordBatch]:
    """ROWS of the fragments of (name, times, bytes).

    Of a fragment that one text has more than twice the further places are surely repeats: they come as settled
    stretches, spread over all tasks.
    """
    schema = arrow_schema(ROWS)
    while few := list(itertools.islice(items, SLICE)):
        key, content, pid, start, size, done = [], [], [], [], [], []
        for name, times, data in few:
            first, stop, keys = cut(np.frombuffer(data, np.uint8), length, anchor)
            hashes = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
            if len(set(hashes)) < len(hashes):
                further = later_places(hashes)
                low, high = merged(first[further], stop[further])
                key.append(np.array([xxhash.xxh3_64_intdigest(name + x.tobytes()) for x in low], np.uint64))
                content += [0] * len(low)
                pid += [name] * len(low)
                start.append(low)
                size.append(high - low)
                done += [True] * len(low)
                first, stop, keys = first[~further], stop[~further], keys[~further]
                hashes = [h for h, f in zip(hashes, further.tolist(), strict=True) if not f]
            for _ in range(times):
                key.append(keys)
                content += hashes
                pid += [name] * len(keys)
                start.append(first)
                size.append(stop - first)
                done += [False] * len(keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.array(content, np.uint64).view(np.int64)),
             pa.array(pid, pa.binary()), pa.array(np.concatenate(start)), pa.array(np.concatenate(size)), pa.array(done, pa.bool_())],
            schema=schema)


def later_places(hashes: list[int]) -> np.ndarray:
    """Marks the third and every further place of each value."""
    seen: dict[int, int] = {}
    out = np.zeros(len(hashes), bool)
    for i, h in enumerate(hashes):
        seen[h] = seen.get(h, 0) + 1
        out[i] = seen[h] > 2
    return out


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches in rising order, joined where they touch or overlap."""
    if not len(low):
        return low, high
    new = np.concatenate(([True], low[1:] > high[:-1]))
    return low[new], high[np.concatenate((new[1:], [True]))]


def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that exist more than once, as MARKED: many if the key has different fragments.

    The rows come sorted by key and content. Of a content the first row is marked, with twice if there are more.
    Of a key at most about GROUP rows are held; one that has more is passed on as one of many.
    """
    schema = arrow_schema(MARKED)
    held: pa.Table | None = None
    open_key: int | None = None  # passed on in part
    last: tuple[int, int] | None = None  # the content whose first row has been passed on

    def flush(rows: pa.Table, whole: bool) -> pa.RecordBatch | None:
        nonlocal open_key, last
        key, content = rows["key"].to_numpy(), rows["content"].to_numpy()
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], content[1:] != content[:-1]))
        group, run = np.cumsum(new_key) - 1, np.cumsum(new) - 1
        length = np.bincount(run)
        kinds, sizes = np.bincount(group, new), np.bincount(group)
        many = (kinds > 1)[group]
        often = (sizes > 1)[group]
        first, twice = new.copy(), (length > 1)[run]
        if open_key is not None:
            same = key == open_key
            many |= same
            often |= same
            if last is not None:
                first &= ~(same & (content == last[1]) & (key == last[0]))
        if not whole:
            many[:] = often[:] = True
            open_key, last = int(key[-1]), (int(key[-1]), int(content[-1]))
        settled = rows["settled"].to_numpy()
        many &= ~settled
        often |= settled
        keep = np.flatnonzero(often)
        if not len(keep):
            return None
        some = rows.take(keep)
        return pa.RecordBatch.from_arrays(
            [pa.array(many[keep]), *(some[c].combine_chunks() for c in ("key", "content", "pid", "start", "size")),
             pa.array(first[keep]), pa.array(twice[keep])], schema=schema)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None and len(held):
            rows = pa.concat_tables([held, rows]).combine_chunks()
        if not len(rows):
            continue
        key = rows["key"].to_numpy()
        at = int(np.searchsorted(key, key[-1]))
        if at and (out := flush(rows.slice(0, at), True)) is not None:
            yield out
        held = rows.slice(at)
        if len(held) > GROUP:
            content = held["content"].to_numpy()
            at = int(np.searchsorted(content, content[-1]))
            if (out := flush(held.slice(0, at or len(held)), False)) is not None:
                yield out
            held = held.slice(at) if at else held.slice(len(held))
    if held is not None and len(held) and (out := flush(held, True)) is not None:
        yield out


def fetched(chosen: DataFrame, pieces: DataFrame) -> DataFrame:
    """The bytes of chosen fragments (key, content, pid, start, size, twice), each once or a few times."""
    schema = arrow_schema("key long, content long, twice boolean, data binary")
    wanted = chosen.groupBy("pid").agg(F.collect_list(F.struct("key", "content", "start", "size", "twice")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for packed, parts in zip(batch.column(0), batch.column(1), strict=True):
                data = unpack(packed.as_py())
                yield rows_out([(p["key"], p["content"], p["twice"], data[p["start"]:p["start"] + p["size"]])
                                for p in parts.as_py()], schema)

    return pieces.select("pid", "data").join(wanted, "pid").select("data", "parts").mapInArrow(
        run, "key long, content long, twice boolean, data binary")


def sort_blocks(length: int):
    """A function over fragments sorted by key and content: what repeats, as places in the fragments."""
    schema = arrow_schema(FOUND)

    def solve(names: list[tuple[int, int]], twice: list[bool], parts: list[bytes]) -> pa.RecordBatch:
        return rows_out([(*names[i], low, high) for i, low, high in repeated_runs(parts, twice, length)], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, twice, parts, size = [], [], [], 0
        for batch in batches:
            for key, content, more, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                if names and names[-1] == (key, content):
                    twice[-1] |= more
                    continue
                if not names or names[-1][0] != key:
                    if size >= PACKED:
                        yield solve(names, twice, parts)
                        names, twice, parts, size = [], [], [], 0
                names.append((key, content))
                twice.append(more)
                parts.append(data.as_py())
                size += len(parts[-1])
        if names:
            yield solve(names, twice, parts)

    return run


def repeated(pieces: DataFrame, rows: DataFrame, length: int, anchors: tuple[int, ...], crowd: int) -> DataFrame:
    """Stretches (pid, start, stop) of the pieces that repeated strings cover; they may touch and overlap.

    rows are the fragments of the pieces at the first of the anchors.
    """
    ordered = rows.repartition("key").sortWithinPartitions("key", "content")
    marked = stored(ordered.mapInArrow(mark, MARKED), "fragments")
    alike = marked.where("NOT many").select("pid", "start", (F.col("start") + F.col("size")).alias("stop"))
    many = marked.where("many")
    parts = fetched(many.where("first"), pieces)
    crowded = None
    if len(anchors) > 1:
        counts = many.where("first").groupBy("key").count()
        crowded = stored(counts.where(F.col("count") > crowd).select("key"), "crowded")
        if crowded.isEmpty():
            crowded = None
        else:
            parts = stored(parts, "parts")
    few = parts if crowded is None else parts.join(crowded, "key", "left_anti")
    found = few.repartition("key").sortWithinPartitions("key", "content").mapInArrow(
        sort_blocks(length), FOUND)
    if crowded is not None:
        again = stored(parts.join(crowded, "key").mapInArrow(as_pieces, PIECES), "pieces")
        deeper = repeated(again, piece_fragments(again, anchors[1], length), length, anchors[1:], crowd)
        per_piece = deeper.groupBy("pid").agg(F.collect_set(F.struct("start", "stop")).alias("stretches"))  # within one fragment
        found = found.unionAll(per_piece.mapInArrow(as_found, FOUND))
    places = many.select("key", "content", "pid", "start").join(found, ["key", "content"]).select(
        "pid", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high")).alias("stop"))
    return alike.unionAll(places)


def as_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments as pieces named by key and content."""
    schema, pack = arrow_schema(PIECES), zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        rows = []
        for key, content, twice, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pid, packed = key.to_bytes(8, "big", signed=True) + content.to_bytes(8, "big", signed=True), pack(data)
            rows.append((pid, twice, packed))
        yield rows_out(rows, schema)


def as_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of pieces, joined where they touch, under the key and content that name the piece."""
    schema = arrow_schema(FOUND)
    for batch in batches:
        rows = []
        for pid, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            key, content = (int.from_bytes(pid[at:at + 8], "big", signed=True) for at in (0, 8))
            rows += [(key, content, low, high) for low, high in joined([(s["start"], s["stop"]) for s in found])]
        yield rows_out(rows, schema)


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in any order as maximal ones."""
    runs: list[list[int]] = []
    for start, stop in sorted(stretches):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return [(a, b) for a, b in runs]


def spared(data: bytes, stretches: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal stretches removed, and the bytes left."""
    runs, left, at = joined(stretches), [], 0
    for start, stop in runs:
        left.append(data[at:start])
        at = stop
    return runs, b"".join([*left, data[at:]])


RESULT = "pid binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, left binary"


def content_results(docs: DataFrame, length: int = LENGTH, with_bytes: bool = False) -> DataFrame:
    """RESULT for every different text; the bytes left only if asked for."""
    pieces, anchors = contents(docs), tuple(min(a, length) for a in ANCHORS)
    stretches = repeated(pieces, text_fragments(docs, anchors[0], length), length, anchors, CROWD)
    per_text = stretches.distinct().groupBy("pid").agg(F.collect_list(F.struct("start", "stop")).alias("stretches"))
    schema = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for pid, packed, found in zip(*batch.columns, strict=True):
                data = unpack(packed.as_py())
                runs, left = spared(data, [(s["start"], s["stop"]) for s in found.as_py() or []])
                rows.append((pid.as_py(), len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(),
                             left if with_bytes else None))
            yield rows_out(rows, schema)

    return pieces.select("pid", "data").join(per_text, "pid", "left").mapInArrow(run, RESULT)


def content_ids(docs: DataFrame) -> DataFrame:
    """doc_id and pid of every document."""
    schema = arrow_schema("doc_id long, pid binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary())], schema=schema)

    return id_and_text(docs).mapInArrow(run, "doc_id long, pid binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = stored(content_results(docs, length).drop("left"), "results").dropDuplicates(["pid"])
    return content_ids(docs).join(found, "pid").drop("pid")


def cleaned_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id and the text left; bytes that are no UTF-8 after the cut are dropped."""
    found = stored(content_results(docs, length, with_bytes=True).select("pid", "left"), "results").dropDuplicates(["pid"])
    schema = arrow_schema("doc_id long, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows_out([(k.as_py(), d.as_py().decode("utf-8", "ignore")) for k, d in zip(*batch.columns, strict=True)], schema)

    return content_ids(docs).join(found, "pid").select("doc_id", "left").mapInArrow(run, "doc_id long, text string")
