"""Byte-level BPE as a monoid: encode halves, join neighbours; decode by concatenation.

A piece of text (a match of the pattern) is encoded by its halves. Two neighbours are joined by encoding a window around
the border anew. A sequence of tokens is an encoding if and only if every two neighbours in it are the encoding of their
own bytes, provided every token is that of its own (checked when the ranks are loaded). So the window has only to grow
until its ends agree with the tokens beside it: those outside are then proven to stay. Decoding joins bytes up the tree.

Spark gives each task its documents; what repeats in them (parts of texts, pieces, their halves, windows) is looked up in
tables of bounded size.

Defined cases: a null or empty text has no ids; any sequence of code points is encoded, runs without white space of any
length in near-linear time; repeated rows come back once each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from salesflow.llm.common import Held, arrow_schema, id_and_text, rows_out, texts

#: Pieces up to this many bytes are leaves of the tree.
LEAF = 6
#: Windows up to this many bytes are merged by plain search, longer ones with a heap.
PLAIN = 48
#: Entries that each table may hold, and as many old ones; longer keys than KEPT are not held.
HELD = 400_000
KEPT = 48
NONE = 1 << 40
#: What the pattern's \s stands for; Python counts four control characters more.
BLANKS = "\t-\r \x85\xa0  -     　"
BORDER = re.compile(rf"(?<=\S)(?=[{BLANKS}])")
NOT_SINGLE = re.compile(r" \s|\s ")
#: Letters, then signs that are neither letters, numbers, blanks nor an apostrophe: the pattern cuts between them only.
WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
DECODE_LEAF = 4096


class Encoder:
    """The encoder of one vocabulary, given as byte sequences and their ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.bytes_of = {rank: piece for piece, rank in ranks.items()}
        self.memo, self.windows, self.agree, self.after_space = (Held(HELD) for _ in range(4))
        odd = [p for p, rank in ranks.items() if self.merge(p) != (rank,)]
        if odd or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"not a vocabulary of byte-level BPE: {len(odd)} tokens do not encode to themselves")
        self.text_of = {str(rank): piece for rank, piece in self.bytes_of.items()}

    @classmethod
    def load(cls, path: str, pattern: str) -> Encoder:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The encoding by its definition: the pair of lowest rank is merged first, the leftmost of equals."""
        if len(piece) > PLAIN:
            return self.merge_long(piece)
        rank, n = self.ranks.get, len(piece)
        ends = list(range(n + 1))  # borders of the parts
        pairs = [rank(piece[i:i + 2], NONE) for i in range(n - 1)]
        while pairs:
            low = min(pairs)
            if low == NONE:
                break
            i = pairs.index(low)
            del ends[i + 1], pairs[i]
            if i:
                pairs[i - 1] = rank(piece[ends[i - 1]:ends[i + 1]], NONE)
            if i < len(pairs):
                pairs[i] = rank(piece[ends[i]:ends[i + 2]], NONE)
        return tuple([rank(piece[a:b]) for a, b in zip(ends, ends[1:], strict=False)])

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with the pairs in a heap, for windows that had to grow."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\1" * n)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n:
                stop = end[end[i]]
                if (r := ranks.get(piece[i:stop])) is not None:
                    heapq.heappush(heap, (r, i, stop))

        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop or not alive[end[i]]:
                continue
            alive[end[i]] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
            offer(before[i])
            offer(i)
        return tuple(ranks[piece[i:end[i]]] for i in range(n) if alive[i])

    def agrees(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        found = self.agree.find((a, b))
        if found is None:
            found = self.merge(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
            self.agree.put((a, b), found)
        return found

    def window(self, piece: bytes) -> tuple[int, ...]:
        """The encoding of the bytes around a border; short ones come up again and again."""
        found = self.windows.find(piece)
        if found is None:
            found = self.merge(piece)
            if len(piece) <= KEPT:
                self.windows.put(piece, found)
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours' bytes from their encodings."""
        if not left or not right or self.agrees(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.window(b"".join([self.bytes_of[t] for t in (*left[-i:], *right[:j])]))
            settled_left = i == len(left) or self.agrees(left[-i - 1], window[0])
            settled_right = j == len(right) or self.agrees(window[-1], right[j])
            if settled_left and settled_right:
                return left[:-i] + window + right[j:]
            i = i if settled_left else min(2 * i, len(left))
            j = j if settled_right else min(2 * j, len(right))

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return (rank,)
        found = self.memo.find(piece)
        if found is None:
            if len(piece) <= LEAF:
                found = self.merge(piece)
            else:
                half = len(piece) // 2
                found = self.join(self.encode_piece(piece[:half]), self.encode_piece(piece[half:]))
            if len(piece) <= KEPT:
                self.memo.put(piece, found)
        return found

    def stretch(self, text: str) -> tuple[tuple[int, ...], str]:
        """The ids of a stretch of text that ends before white space or with the text, and the same as decimals."""
        ids = tuple(chain.from_iterable([self.encode_piece(p.encode("utf-8", "surrogatepass")) for p in self.find(text)]))
        return ids, ",".join(map(str, ids))

    def part(self, part: str) -> tuple[tuple[int, ...], str]:
        """The same of what follows a single space, and that space; a word and the signs behind it are looked up apart."""
        found = self.after_space.find(part)
        if found is None:
            cut = WORD(part)
            if cut is None:
                found = self.stretch(" " + part)
            else:
                word, signs = cut.groups()
                ids = self.encode_piece(f" {word}".encode())
                if signs:
                    ids += self.encode_piece(signs.encode())
                found = ids, ",".join(map(str, ids))
            if len(part) <= KEPT:
                self.after_space.put(part, found)
        return found

    def encode_parts(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """(ids, decimals) of the parts of a whole text, in order.

        No match of the pattern goes on over white space that follows other characters, so the text is taken
        apart there: at single spaces, if there are no others beside white space.
        """
        if NOT_SINGLE.search(text):
            return [self.stretch(s) for s in BORDER.split(text) if s]
        first, *rest = text.split(" ")
        found = list(map(self.after_space.get, rest))
        if None in found:
            found = [self.part(s) if f is None else f for s, f in zip(rest, found, strict=True)]
        return [self.stretch(first), *found] if first else found

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable([ids for ids, _ in self.encode_parts(text)]))

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of ids: leaves are joined, then neighbours up the tree."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_loaded: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a file of ranks, loaded once in a worker process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Encoder.load(path, pattern)
    return _loaded[path, pattern]


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids again, and return the columns of OUT."""
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                parts = coder.encode_parts(text)
                ids = list(chain.from_iterable([ids for ids, _ in parts]))
                rows.append((key, len(ids), hashlib.sha256(",".join([shown for _, shown in parts]).encode()).hexdigest(),
                             hashlib.sha256(coder.decode(ids)).hexdigest()))
            yield rows_out(rows, schema)

    return id_and_text(docs).mapInArrow(run, OUT)


def bpe_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of its text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                yield rows_out([(key, coder.encode(text))], schema)

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_texts(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the text of its ids; bytes that are no UTF-8 become replacement characters, null ids an empty text."""
    schema = arrow_schema("doc_id long, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            yield rows_out([(key.as_py(), coder.decode(ids.as_py() or []).decode("utf-8", "replace"))
                            for key, ids in zip(batch.column(0), batch.column(1), strict=True)], schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
