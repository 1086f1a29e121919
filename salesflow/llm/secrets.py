"""Secret scans with a guess-cost estimate.

Three base patterns find assigned credentials, access keys and hexadecimal runs. Values in a wider credential context
are then priced: dynamic programming over the value finds the cheapest way of guessing it piece by piece, as words,
dates, repeats, keyboard walks or brute force, in bits. A value that costs `BITS` or more is reported as kind `guess`,
unless a base span overlaps it. Values that a guesser finds quickly (placeholders, plain words, dates) are not secrets.

Words cost their rank in a guesser's list: first a few fixed ones, then the `DICTIONARY` most frequent words of the texts
themselves, counted over all of them. Letters that are in no such word are priced one by one. Repeats and walks have any
length; wherever one is left, it costs its beginning and the length it could have had.

Defined cases: a null or empty text has no span; a text of any length is scanned whole; positions count code points;
repeated rows come back once each; an empty table gives an empty result; other columns are neither read nor touched.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, id_and_text, rows_out, stored, texts

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")

#: Contexts whose values are priced: more names, and any value without white space, quotes or brackets.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|credentials?|auth|bearer|secret|token|(?:private|access|api)[_-]?key)["']?"""
    r"""\x20*[:=]\x20*["']?([^\s"'<>|(){}\[\],;]+)""", re.IGNORECASE | re.ASCII)
BITS = 40.0
LEAST = 8

#: Words that guessers try first, the likeliest first.
WORDS = ("password passwd pass secret token admin root user login welcome letmein monkey dragon master hello test demo "
         "example sample default change changeme none null true false your here key value string placeholder dummy").split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LEET = str.maketrans("013457@$!", "oleastasi")
#: Words taken from the texts, the most frequent ones, and the letters they have.
DICTIONARY = 50_000
SHORTEST, LONGEST = 3, 24
FIND_WORDS = re.compile(rf"(?<![^\W\d_])[^\W\d_]{{{SHORTEST},{LONGEST}}}(?![^\W\d_])").findall
#: Words a task counts before it passes them on.
COUNTED = 200_000
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "0123456789")
NEXT = {a + b for row in ROWS for a, b in zip(row, row[1:], strict=False)}
DATE = re.compile(r"(?:(?:19|20)\d\d([-./_]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-./_]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d)")
YEAR = re.compile(r"(?:19|20)\d\d")
#: Characters of a repeated unit at most.
UNIT = 4


def char_bits(c: str) -> float:
    return log2(10) if c.isdigit() else log2(26) if c.isalpha() else log2(33)


def _walks(low: str, step: int) -> list[int]:
    """For every place the characters of the keyboard walk that starts there, forwards (1) or backwards (-1)."""
    length = [1] * len(low)
    for i in range(len(low) - 2, -1, -1):
        if low[i:i + 2][::step] in NEXT:
            length[i] = length[i + 1] + 1
    return length


def _repeats(value: str, size: int) -> list[int]:
    """For every place the number of times the unit of `size` characters that starts there follows itself."""
    same = [0] * (len(value) + 1)
    for i in range(len(value) - size - 1, -1, -1):
        same[i] = same[i + 1] + 1 if value[i] == value[i + size] else 0
    return [1 + n // size for n in same[:len(value)]]


def guess_bits(value: str, ranks: dict[str, int] = RANK) -> float:
    """Bits of the cheapest segmentation of a value; a piece costs one bit more than its guesses.

    A walk or repeat that has begun at a cost may be left after any character (any unit) at that cost, so the cheapest
    one under way is all that has to be known of them, and the time grows with the length of the value only.
    """
    low, n = value.lower(), len(value)
    cost = [0.0] + [float("inf")] * n
    walks = [(_walks(low, step), [float("inf")]) for step in (1, -1)]
    repeats = [(size, _repeats(value, size), [float("inf")] * size) for size in range(1, UNIT + 1)]
    single = list(map(char_bits, value))
    for i in range(n + 1):
        # walks of three characters or more, and repeats of two units and three characters or more, that may end here
        for length, under_way in walks:
            start = i - 3
            if start >= 0:
                if start and length[start - 1] != length[start] + 1:
                    under_way[0] = float("inf")  # another walk
                if length[start] >= 3:
                    under_way[0] = min(under_way[0], cost[start] + log2(47) + log2(length[start]) + 1)
                    cost[i] = min(cost[i], under_way[0])
                else:
                    under_way[0] = float("inf")
        for size, times, under_way in repeats:
            units = max(2, -(-3 // size))
            start = i - units * size
            if start >= 0:
                before = start - size
                if before < 0 or times[before] != times[start] + 1:
                    under_way[start % size] = float("inf")  # another repeat
                if times[start] >= units:
                    first = cost[start] + sum(single[start:start + size]) + log2(times[start]) + 1
                    under_way[start % size] = min(under_way[start % size], first)
                    cost[i] = min(cost[i], under_way[start % size])
                else:
                    under_way[start % size] = float("inf")
        if i == n:
            break
        here = cost[i]
        cost[i + 1] = min(cost[i + 1], here + single[i])
        for pattern, bits in ((DATE, log2(365 * 120)), (YEAR, log2(120))):
            if m := pattern.match(value, i):
                cost[m.end()] = min(cost[m.end()], here + bits + 1)
        for stop in range(i + SHORTEST, min(i + LONGEST, n) + 1):
            piece = low[i:stop]
            rank = ranks.get(piece)
            plain = rank is not None
            if not plain:
                rank = ranks.get(piece.translate(LEET))
            if rank:
                bits = log2(rank) + (value[i:stop] != piece) + (not plain) + 1
                cost[stop] = min(cost[stop], here + bits)
    return cost[n]


def frequent_words(docs: DataFrame, size: int = DICTIONARY) -> dict[str, int]:
    """Ranks of the fixed words and, behind them, of the most frequent words of all texts, `size` at most.

    Words are runs of letters in lower case, outside the values of credential contexts: a secret is no word because it is in
    the texts itself. They are counted in each task first. The driver sees how many words have which order of frequency
    (4,096 at most), and then the words of the highest ones, as long as there are not more than `size`. Equally frequent
    words are ranked in the order of their letters.
    """
    schema = arrow_schema("word string, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in texts(batch):
                if ":" in text or "=" in text:
                    text = CONTEXT.sub(" ", text)
                counts.update(FIND_WORDS(text.lower()))
                if len(counts) >= COUNTED:
                    yield rows_out(list(counts.items()), schema)
                    counts.clear()
        yield rows_out(list(counts.items()), schema)

    counted = stored(id_and_text(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    order = F.floor(F.log2("n") * 64)
    least, room = None, size
    for r in sorted(counted.groupBy(order.alias("order")).count().collect(), key=lambda r: -r["order"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["order"]
    found = [] if least is None else counted.where(order >= least).collect()  # `size` words at most
    words = [r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"]))]
    return RANK | {w: i for i, w in enumerate([w for w in words if w not in RANK], len(RANK) + 1)}


def scan(text: str, ranks: dict[str, int] = RANK) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], float]:
    """Base spans and added spans as (kind, start, end), and the dearest context value's bits (0 if there is none)."""
    base, added, dearest = [], [], 0.0
    valued = ":" in text or "=" in text
    if valued:
        base += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    base += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    base += [("hex", *m.span()) for m in HEX.finditer(text)]
    if valued:
        for m in CONTEXT.finditer(text):
            value = m[1]
            if len(value) < LEAST:
                continue
            bits = guess_bits(value, ranks)
            dearest = max(dearest, bits)
            if bits >= BITS and not any(s < m.end() and m.start() < e for _, s, e in base):
                added.append(("guess", *m.span()))
    return base, added, dearest


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


OUT = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, "
       "guess_bits double")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document with the columns of OUT; guess_bits is the price of the dearest value in a context."""
    schema = arrow_schema(OUT)
    ranks = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))  # DICTIONARY words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                base, added, bits = scan(text, ranks.value)
                kinds = [k for k, _, _ in base]
                rows.append((key, *map(kinds.count, KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(),
                             joined(base + added), len(added), bits))
            yield rows_out(rows, schema)

    return id_and_text(docs).mapInArrow(run, OUT)


def redacted(text: str, ranks: dict[str, int] = RANK, mark: str = "[SECRET]") -> str:
    """The text with every span, or every group of overlapping ones, replaced."""
    base, added, _ = scan(text, ranks)
    out, at = [], 0
    for _, start, end in sorted(base + added, key=lambda x: x[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All documents and columns, secrets in `text` replaced and `n_chars`, if there, set anew where they were.

    A null text stays null.
    """
    names, place = docs.columns, docs.columns.index("text")
    ranks = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))  # DICTIONARY words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(len(names))]
            clean = pa.array([None if t is None else redacted(t, ranks.value) for t in (x.as_py() for x in columns[place])], pa.string())
            yield pa.RecordBatch.from_arrays([*columns[:place], clean, *columns[place + 1:]], schema=batch.schema)

    done = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("text").contains("[SECRET]"), F.length("text").cast(kind))
                               .otherwise(F.col("n_chars"))).select(*names)
    return done
