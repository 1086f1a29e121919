"""SentencePiece encoding by a table of last tokens, and decoding.

Merging pairs by score gives every text one encoding, and so every prefix of it one last token. The table of these is
filled from the left: an automaton gives the tokens that end at a place, the longest first, and the one that belongs there
is the one compatible with the last token of the prefix before it, that is, the pair is the encoding of its own characters.
The ids are then read backwards from the end. That takes one look-up per match, whatever the length of the text.

A sequence of tokens is an encoding if and only if every two neighbours in it are compatible and every token is the
encoding of itself; tokens that are not (checked when the model is loaded) can appear in no encoding and are left out.
Texts are cut at blank signs behind other characters (unless the model has a token with one there), and then wherever two
characters stand together in no token; what repeats is looked up in tables of bounded size. Characters without a piece
become the pieces of their bytes.

Defined cases: a null or empty text has the end id alone and decodes to nothing; runs of blanks and stretches without any
are encoded whole, whatever their length; repeated rows come back once each; an empty table gives an empty result; other
columns are not read. Ids that are not in the model raise an error; each byte that is no UTF-8 becomes a replacement character.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import chain, groupby

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from salesflow.llm.common import Held, arrow_schema, id_and_text, rows_out, texts

#: The sign that stands for a blank in pieces.
BLANK = "▁"
#: Entries that each table may hold, and as many old ones; longer stretches than KEPT characters are not held.
HELD = 500_000
KEPT = 48
NEVER = float("-inf")

codecs.register_error("each byte replaced", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class PieceCoder:
    """The encoder and decoder of one model file of merged pieces with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.end = model.eos_id()
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not model.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model has no pieces for bytes")
        piece = {i: model.id_to_piece(i) for i in plain}
        self.score = {p: model.get_score(i) for i, p in piece.items()}
        self.cut_at_blanks = not any(BLANK in p.lstrip(BLANK) for p in self.score)
        # tokens are numbered: pieces, and the characters of pieces that are none by themselves
        self.token = [*self.score, *sorted({c for p in self.score for c in p} - set(self.score))]
        number = {p: i for p, i in zip(self.score, piece, strict=True)}
        self.ids_back = [(number[t],) if t in number else self.bytes_ids(t)[::-1] for t in self.token]
        self.matches = ahocorasick.Automaton()
        for k, t in enumerate(self.token):
            if self.merge(t) == [t]:
                self.matches.add_word(t, (k, len(t)))
        self.matches.make_automaton()
        self.segments = re.compile(f"{BLANK}+[^{BLANK}]*").findall if self.cut_at_blanks else lambda text: [text]
        self.pairs, self.held = Held(HELD), Held(HELD)
        self.together = {t[i:i + 2] for t in self.token for i in range(len(t) - 1)}
        known = {c for t in self.token for c in t}
        self.apart = next(c for c in map(chr, range(0x110000)) if c not in known)
        self.text_of = [b""] * size
        for i, p in piece.items():
            self.text_of[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.text_of[i] = bytes([b])
        self.blanks = {i for i, p in piece.items() if p[0] == BLANK}
        self.silent = {i for i in range(size) if model.is_control(i)}
        probe = f"  ﬁx \t  a {BLANK}é\r\n<s>  b "
        if self.encode(probe) != model.encode(probe) or self.decode(self.encode(probe)) != model.decode(model.encode(probe)):
            raise ValueError("the model changes texts before it encodes them, or does not merge pairs by score")

    def bytes_ids(self, text: str) -> tuple[int, ...]:
        return tuple([self.byte_ids[b] for b in text.encode()])

    def merge(self, text: str) -> list[str]:
        """The encoding by its definition: the pair of highest score is merged first, the leftmost of equals."""
        score, parts = self.score.get, list(text)
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            high = max(pairs)
            if high == NEVER:
                break
            i = pairs.index(high)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their characters."""
        left, right = self.token[a], self.token[b]
        return self.merge(left + right) == [left, right]

    def last_tokens(self, text: str) -> list[tuple[int, int] | None]:
        """For every prefix the (number, length) of its last token, None if that is a character without a piece."""
        last: list = [None] * len(text)
        held, count, ending = self.pairs, len(self.token), -1
        for end, match in self.matches.iter(text):  # the matches that end at a place come longest first
            if end == ending:
                continue
            number, length = match
            before = last[end - length] if length <= end else None
            if before is not None:
                pair = before[0] * count + number
                fits = held.get(pair)
                if fits is None:
                    fits = held.find(pair)
                    if fits is None:
                        fits = self.compatible(before[0], number)
                        held.put(pair, fits)
                if not fits:
                    continue
            last[end], ending = match, end
        return last

    def encode_new(self, stretches: list[str]) -> Iterator[tuple[tuple[int, ...], str]]:
        """(ids, decimals) of each of some stretches, the last one first: one table for all, read backwards."""
        text = self.apart.join(stretches)  # a character of no token: nothing spans it
        last, end = self.last_tokens(text), len(text) - 1
        for stretch in reversed(stretches):
            start, back = end - len(stretch), []
            while end > start:
                match = last[end]
                if match is None:
                    back += reversed(self.bytes_ids(text[end]))
                    end -= 1
                else:
                    back += self.ids_back[match[0]]
                    end -= match[1]
            end = start - 1
            back.reverse()
            yield tuple(back), " ".join(map(str, back))

    def cut(self, part: str) -> list[str]:
        """A part taken apart where its characters stand together in no token."""
        cuts = [i for i in range(1, len(part)) if part[i - 1:i + 1] not in self.together]
        return [part[i:j] for i, j in zip([0, *cuts], [*cuts, len(part)], strict=True)] if cuts else [part]

    def look_up(self, missing: list[str]) -> dict[str, tuple[tuple[int, ...], str]]:
        """(ids, decimals) of parts: from the table, put together from known stretches, or encoded."""
        found = {part: self.held.find(part) for part in missing}
        cuts = {part: self.cut(part) for part, f in found.items() if f is None}
        known = {s: self.held.find(s) for stretches in cuts.values() for s in stretches}
        new = [s for s, f in known.items() if f is None]
        for stretch, f in zip(reversed(new), self.encode_new(new) if new else (), strict=True):
            known[stretch] = f
            if len(stretch) <= KEPT:
                self.held.put(stretch, f)
        for part, stretches in cuts.items():
            if len(stretches) == 1:
                found[part] = known[part]
            else:
                of = [known[s] for s in stretches]
                found[part] = tuple(chain.from_iterable([ids for ids, _ in of])), " ".join([shown for _, shown in of])
                if len(part) <= KEPT:
                    self.held.put(part, found[part])
        return found

    def encode_parts(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """(ids, decimals) of the parts of a text in order, each with the blank sign before it."""
        if not text:
            return []
        if not self.cut_at_blanks or "  " in text or BLANK in text or text[0] == " " or text[-1] == " ":
            parts = self.segments(BLANK + text.replace(" ", BLANK))
        else:
            parts = f"{BLANK}{text.replace(' ', ' ' + BLANK)}".split(" ")
        found = list(map(self.held.get, parts))
        if None in found:
            new = self.look_up([part for part, f in zip(parts, found, strict=True) if f is None])
            found = [new[part] if f is None else f for part, f in zip(parts, found, strict=True)]
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without an end id."""
        return list(chain.from_iterable([ids for ids, _ in self.encode_parts(text)]))

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: a blank at its beginning came with the encoding and goes; control ids have no text."""
        if not self.silent.isdisjoint(ids[:-1]):  # bytes on both sides of a control id do not belong together
            runs = [list(run) for silent, run in groupby(ids, self.silent.__contains__) if not silent]
            return "".join([self.decode_run(run, not k) for k, run in enumerate(runs)])
        return self.decode_run(ids, True)

    def decode_run(self, ids: Sequence[int], first: bool) -> str:
        data = b"".join(map(self.text_of.__getitem__, ids))
        return data[first and len(ids) > 0 and ids[0] in self.blanks:].decode("utf-8", "each byte replaced")


_loaded: dict[str, PieceCoder] = {}


def piece_coder(path: str) -> PieceCoder:
    """The coder of a model file, loaded once in a worker process."""
    if path not in _loaded:
        _loaded[path] = PieceCoder(path)
    return _loaded[path]


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text with an end id, decode its ids again, and return the columns of OUT."""
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        end = (coder.end,), str(coder.end)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                parts = [*coder.encode_parts(text), end]
                ids = list(chain.from_iterable([ids for ids, _ in parts]))
                rows.append((key, len(ids), hashlib.sha256(" ".join([shown for _, shown in parts]).encode()).hexdigest(),
                             hashlib.sha256(coder.decode(ids).encode()).hexdigest()))
            yield rows_out(rows, schema)

    return id_and_text(docs).mapInArrow(run, OUT)


def piece_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of its text, the end id last."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                yield rows_out([(key, [*coder.encode(text), coder.end])], schema)

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def piece_texts(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of its ids; null ids are an empty text."""
    schema = arrow_schema("doc_id long, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            yield rows_out([(key.as_py(), coder.decode(ids.as_py() or []))
                            for key, ids in zip(batch.column(0), batch.column(1), strict=True)], schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
