"""Token ids in directly addressable codes.

An id is cut into chunks of 8 bits. Level 0 has the lowest chunk of every id, level 1 the next chunk of those that go on,
and so on. A bitmap beside each level says which ids go on, and a directory has the ones before every block of 512 bits:
the place of an id's next chunk is the rank of its bit. So any token is read by a few look-ups, without decoding a block.

A file is a table of segments, each a self-contained binary block of whole documents in the order of their ids, with its
own document directory; the ids of its documents are a column beside it, so that a document is found without opening a
block. A segment holds about `SEGMENT` ids, or one document that has more. Documents are dealt to tasks by ranges of
(id, hash of text, number), so rows that share an id, or have none, are spread like any others.

Defined cases: a null or empty text has the end id alone; a null doc_id comes before all others; equal doc_ids follow each
other in the order of the hashes of their texts; the literal of an added token in a text has that token's id, as in the
library; an empty table gives no segment and an empty result; other columns are not read. A token asked for beyond the end
of a document, or of a document that is not there, is null; of documents with equal ids each has an answer.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesflow.llm.common import Held, arrow_schema, id_and_text, rows_out, texts
from salesflow.session import new_dir

CHUNK = 8
BLOCK = 512
SEGMENT = 1 << 18
END = 2
HELD = 300_000
#: Requests for tokens of one segment that are answered together.
ASKED = 50_000
MAGIC = b"DAC1"


class Codes:
    """A sequence of unsigned 32-bit ids as levels of (chunks, bitmap, directory)."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @classmethod
    def build(cls, ids: np.ndarray) -> Codes:
        levels, left = [], np.asarray(ids, np.uint32)
        while True:
            rest = left >> CHUNK
            more = rest > 0
            levels.append(cls._level((left & 0xFF).astype(np.uint8), np.packbits(more, bitorder="little")))
            if not more.any():
                return cls(levels)
            left = rest[more]

    @staticmethod
    def _level(chunks: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = BLOCK // 8
        padded = np.zeros(-(-max(len(bits), 1) // width) * width, np.uint8)
        padded[:len(bits)] = bits
        ones = np.bitwise_count(padded).reshape(-1, width).sum(axis=1, dtype=np.uint32)
        return chunks, padded, np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.uint32)

    def __getitem__(self, i: int) -> int:
        """The id at a place: one chunk and one rank per level."""
        value = 0
        for k, (chunks, bits, before) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK * k)
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            block = i // BLOCK
            here = bits[block * BLOCK // 8:byte + 1].copy()
            here[-1] &= (1 << bit) - 1
            i = int(before[block]) + int(np.bitwise_count(here).sum())
        return value

    def ids(self) -> np.ndarray:
        """All ids at once."""
        value: np.ndarray | None = None
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            if value is not None:
                here[np.unpackbits(bits, bitorder="little")[:len(here)].astype(bool)] |= value << CHUNK
            value = here
        return value

    def dumps(self) -> bytes:
        out = [struct.pack("<B", len(self.levels))]
        for chunks, bits, before in self.levels:
            out += [struct.pack("<QQQ", len(chunks), len(bits), len(before)), chunks.tobytes(), bits.tobytes(),
                    before.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def loads(cls, data: bytes, at: int = 0) -> Codes:
        (n,), at, levels = struct.unpack_from("<B", data, at), at + 1, []
        for _ in range(n):
            a, b, c = struct.unpack_from("<QQQ", data, at)
            at += 24
            levels.append((np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a),
                           np.frombuffer(data, "<u4", c, at + a + b)))
            at += a + b + 4 * c
        return cls(levels)


class Segment:
    """A block of the file: documents' ids and lengths, and the codes of their tokens."""

    def __init__(self, keys: list[int | None], ends: np.ndarray, codes: Codes):
        self.keys, self.ends, self.codes = keys, ends, codes

    @classmethod
    def build(cls, keys: list[int | None], lengths: list[int], ids: np.ndarray) -> Segment:
        return cls(keys, np.cumsum(np.array(lengths, np.int64)), Codes.build(ids))

    def dumps(self) -> bytes:
        named = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        return b"".join([MAGIC, struct.pack("<Q", len(keys)), named.tobytes(), keys.tobytes(),
                         self.ends.astype("<i8").tobytes(), self.codes.dumps()])

    @classmethod
    def loads(cls, data: bytes) -> Segment:
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        (n,) = struct.unpack_from("<Q", data, 4)
        named = np.frombuffer(data, np.uint8, n, 12)
        keys = np.frombuffer(data, "<i8", n, 12 + n)
        ends = np.frombuffer(data, "<i8", n, 12 + 9 * n)
        return cls([int(k) if have else None for k, have in zip(keys, named, strict=True)], ends,
                   Codes.loads(data, 12 + 17 * n))

    def length(self, document: int) -> int:
        return int(self.ends[document] - (self.ends[document - 1] if document else 0))

    def token(self, document: int, i: int) -> int:
        """Token i of a document of the segment, read by itself."""
        if not 0 <= i < self.length(document):
            raise IndexError(i)
        return self.codes[int(self.ends[document - 1] if document else 0) + i]


#: Texts of these characters only are cut as the tokenizer would cut them; any other goes through it whole.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+").findall


class WordEncoder:
    """Ids of the tokenizers library, with what repeats looked up in tables of bounded size.

    The tokenizer drops white space and looks at nothing across it, so what stands between single spaces is
    encoded for itself. Of plain Latin text also the cutting and the lower case are known, and only the model
    is asked for each word. A text that holds an added token's content goes through the tokenizer whole, which gives
    the token's own id for it, as everywhere in the library.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = str.maketrans({b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)})
        self.parts, self.words = Held(HELD), Held(HELD)

    def word(self, word: str) -> bytes:
        found = self.words.find(word)
        if found is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            self.words.put(word, found)
        return found

    def part(self, part: str) -> bytes:
        found = self.parts.find(part)
        if found is None:
            if PLAIN.fullmatch(part):
                found = b"".join(map(self.word, CUT(part.lower())))
            else:
                ids = self.tokenizer.encode(part, add_special_tokens=False).ids
                found = np.array(ids, "<u4").tobytes()
            if len(part) <= 64:
                self.parts.put(part, found)
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        split = text.split(" ")
        found = list(map(self.parts.get, split))
        if None in found:
            found = [self.part(p) if f is None else f for p, f in zip(split, found, strict=True)]
        return b"".join(found)


_loaded: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


BLOCKS = "task long, number long, n_ids long, keys array<long>, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, segment: int = SEGMENT) -> None:
    """Encode all documents in the order of their ids and write the segments below a path.

    A range partition is encoded by one task; task and number order the segments.
    """
    schema = pa.schema([("task", pa.int64()), ("number", pa.int64()), ("n_ids", pa.int64()), ("keys", pa.list_(pa.int64())),
                        ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, number = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        last = end.to_bytes(4, "little")
        keys, lengths, held, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            data = Segment.build(keys, lengths, np.frombuffer(b"".join(held), "<u4")).dumps()
            return rows_out([(task, number, size, keys, data)], schema)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                ids = coder.encode(text) + last
                keys.append(key)
                lengths.append(len(ids) // 4)
                held.append(ids)
                size += len(ids) // 4
                if size >= segment:
                    yield block()
                    number, keys, lengths, held, size = number + 1, [], [], [], 0
        if keys:
            yield block()

    order = ["doc_id", "hash", "row"]
    rows = id_and_text(docs).withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    blocks = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, BLOCKS)
    blocks.write.option("compression", "zstd").parquet(path)


OUT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The columns of OUT for every document of a file: the ids before it, its ids and their checksum.

    Starts are sums over the tasks, and over the segments of a task; no window sees more.
    """
    blocks = spark.read.parquet(path)
    sizes = blocks.select("task", "number", "n_ids")
    tasks = sizes.groupBy("task").agg(F.sum("n_ids").alias("n")).select(
        "task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("skip", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(tasks, "task").select(
        "task", "number", (F.col("base") + F.col("skip")).alias("start"))
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0), batch.column(1), strict=True):
                part, first = Segment.loads(data.as_py()), start.as_py()
                ids, rows, at = part.codes.ids().astype("<u4"), [], 0
                for key, stop in zip(part.keys, part.ends.tolist(), strict=True):
                    rows.append((key, first + at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
                    at = stop
                yield rows_out(rows, schema)

    return blocks.select("task", "number", "data").join(starts, ["task", "number"]).select("start", "data").mapInArrow(run, OUT)


def tokens_at(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """(doc_id, position, token) for every request (doc_id, position), positions counted from 0.

    The segments asked for are found by their column of ids; each is opened in a task and answers by single look-ups.
    """
    blocks = spark.read.parquet(path)
    asked = requests.select("doc_id", F.col("position").cast("long").alias("position")).distinct()
    named = blocks.select("task", "number", F.posexplode("keys").alias("place", "key"))
    where = asked.join(named, asked["doc_id"].eqNullSafe(named["key"]))
    groups = max(1, -(-asked.count() // ASKED))
    part = F.pmod(F.xxhash64("doc_id", "position"), F.lit(groups))
    together = where.groupBy("task", "number", part.alias("part")).agg(
        F.collect_list(F.struct("doc_id", "position", "place")).alias("asked"))
    schema = arrow_schema("doc_id long, position long, token long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few, data in zip(batch.column(0), batch.column(1), strict=True):
                part, out = Segment.loads(data.as_py()), []
                for r in few.as_py():
                    known = r["position"] is not None and 0 <= r["position"] < part.length(r["place"])
                    out.append((r["doc_id"], r["position"], part.token(r["place"], r["position"]) if known else None))
                yield rows_out(out, schema)

    found = together.join(blocks.select("task", "number", "data"), ["task", "number"]).select("asked", "data").mapInArrow(
        run, "doc_id long, position long, token long")
    missing = asked.join(named.select("key"), asked["doc_id"].eqNullSafe(named["key"]), "left_anti")
    return found.unionByName(missing.withColumn("token", F.lit(None).cast("long")))


def token_file(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of all documents into the shared folder and read them back."""
    path = new_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
