"""Language identification by prediction by partial matching.

Each language has a context tree of bytes: a context of up to three bytes predicts the next one by its counts, and escapes
to the context one byte shorter for a byte that it has not seen (n seen bytes of d kinds: c/(n+d) for a byte seen c
times, d/(n+d) for the escape), down to 1/256 for any byte. The statistics are frozen after training, so the exact code
length of a byte depends on its three predecessors only. All trees are laid out side by side: a context that any language
has seen is a node, with a bitmap of the bytes seen after it and a row of bits per language for each of these, found by the
rank of the byte in the bitmap. A byte that no language has seen there costs the escapes of the node and goes on at its
parent. The language with the shortest code wins.

Trees are trained on at most `PER_LANGUAGE` documents of a language and `SAMPLE` in all (the smallest by a hash of the id).
Every context of these is kept, whatever the number of languages and bytes; the size of the trees is bounded by the sample.

Defined cases: a text that is null or has no letter is `und` with score 0, and so is any text if no language was learned;
equal code lengths go to the first language by name; rows with null lang or null doc_id are not learned from, and of
those with equal lang and doc_id only the text with the smallest hash is; a text of any length is scored whole; repeated
rows come back once each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, id_and_text, in_set, one_text, rows_out, texts

ORDER = 3
PER_LANGUAGE = 400
SAMPLE = 20_000
#: Groups of a language in each round of the choice of its documents.
ROUNDS = (64, 8, 1)
STEP = 1 << 18
#: Tasks that count the sample, which is no larger for more data, and bytes that a task counts at once.
PARTS = 16
AT_ONCE = 1 << 22
UNKNOWN = "und"


@dataclass
class Trees:
    """Frozen trees of all languages. `symbol` numbers the bytes, `node` has the longest known context of three symbols;
    a node has a bitmap of symbols in four words, the number of the first row of each word, escape bits and a parent."""

    languages: list[str]
    symbol: np.ndarray
    kinds: int
    node: np.ndarray
    words: np.ndarray
    first: np.ndarray
    parent: np.ndarray
    escape: np.ndarray
    bits: np.ndarray

    def symbol_bits(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Bits of all languages together for each symbol after a node, one line each."""
        out = np.zeros((len(node), len(self.languages)))
        at = np.arange(len(node))
        while len(at):
            row, seen = self.rows(node, symbol)
            out[at[seen]] += self.bits[row[seen]]
            at, node, symbol = at[~seen], node[~seen], symbol[~seen]
            out[at] += self.escape[node]
            node = self.parent[node]
            out[at[node < 0]] += 8.0  # any byte
            at, symbol, node = at[node >= 0], symbol[node >= 0], node[node >= 0]
        return out

    def rows(self, node: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of each symbol after a node, and whether any language has seen it there."""
        word, bit = symbol >> 6, (symbol & 63).astype(np.uint64)
        bitmap = self.words[node, word]
        rank = np.bitwise_count(bitmap & ((np.uint64(1) << bit) - np.uint64(1)))
        return self.first[node, word] + rank, (bitmap >> bit & np.uint64(1)).astype(bool)

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the text in each language."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        total, width = np.zeros(len(self.languages)), self.kinds
        symbols = np.zeros(len(raw) + ORDER, np.int32)
        symbols[ORDER:] = self.symbol[raw]
        for at in range(0, len(raw), STEP):
            s = symbols[at:at + STEP + ORDER]
            node, symbol = self.node[(s[:-3] * width + s[1:-2]) * width + s[2:-1]], s[3:]
            row, seen = self.rows(node, symbol)
            total += self.bits[row[seen]].sum(axis=0, dtype=np.float64)
            if not seen.all():
                total += self.symbol_bits(node[~seen], symbol[~seen]).sum(axis=0)
        return total

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        lengths = self.code_lengths(text)
        best = int(np.argmin(lengths))
        return self.languages[best], float(1 / np.exp2(np.minimum(lengths[best] - lengths, 0)).sum())


def grams(text: str) -> np.ndarray:
    """Each byte with its three predecessors (zeros before the text) as one number."""
    raw = np.frombuffer(b"\0" * ORDER + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    return ((raw[:-3] << 8 | raw[1:-2]) << 8 | raw[2:-1]) << 8 | raw[3:]


def freeze(languages: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Trees:
    """Trees from the counts of all (language, gram); lang holds places in languages."""
    at = [(gram >> 8 * k) & 255 for k in (3, 2, 1, 0)]
    known = np.unique(np.concatenate([at[3], at[2], [0]])) if len(gram) else np.array([0])
    symbol = np.zeros(256, np.int32)  # a byte that was never seen has the number of the padding
    symbol[known] = np.arange(len(known))
    a, width = [symbol[x].astype(np.int64) for x in at], len(known)
    several = len(languages)
    trees = Trees(languages, symbol, width, np.zeros(width**3, np.int32), *_empty(several))
    last = a[3]
    below = np.zeros(len(gram), np.int64)  # the parent of each gram's context: the empty one is node 0
    trees = _with_order(trees, np.zeros(len(gram), np.int64), np.array([-1]), last, lang, count, several)
    start = 1
    for order, context in enumerate((a[2], a[1] * width + a[2], (a[0] * width + a[1]) * width + a[2]), 1):
        keys, place = np.unique(context, return_inverse=True)
        parent = np.zeros(len(keys), np.int64)
        parent[place] = below  # equal contexts have equal parents
        trees = _with_order(trees, place, parent, last, lang, count, several)
        below = start + place
        # a key is the last `order` symbols of a context, which is its remainder
        trees.node.reshape(-1, width**order)[:, keys] = start + np.arange(len(keys))
        start += len(keys)
    return trees


def _empty(several: int) -> tuple:
    return (np.zeros((0, 4), np.uint64), np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros((0, several), np.float32),
            np.zeros((0, several), np.float32))


def _with_order(trees: Trees, place: np.ndarray, parent: np.ndarray, symbol: np.ndarray, lang: np.ndarray, count: np.ndarray,
                several: int) -> Trees:
    """The trees with the contexts of the next length; place has the context of each gram, parent their parents' nodes."""
    size = len(parent)
    pairs, pair = np.unique(place * 256 + symbol, return_inverse=True)
    context, after = pairs >> 8, pairs & 255
    words = np.zeros((size, 4), np.uint64)
    np.bitwise_or.at(words, (context, after >> 6), np.uint64(1) << (after & 63).astype(np.uint64))
    seen = np.bitwise_count(words).astype(np.int64)
    first = len(trees.bits) + np.cumsum(seen.ravel()).reshape(seen.shape) - seen
    bits, escape = np.zeros((len(pairs), several), np.float32), np.zeros((size, several), np.float32)
    lower = trees.symbol_bits(parent[context], after) if len(trees.parent) else np.full((len(pairs), several), 8.0)
    for j in range(several):
        mine = lang == j
        n = np.bincount(pair[mine], count[mine], len(pairs))
        all_n = np.bincount(context, n, size)
        kinds = np.bincount(context, n > 0, size)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape[:, j] = np.where(all_n > 0, np.log2(all_n + kinds) - np.log2(kinds), 0.0)
            own = np.log2(all_n + kinds)[context] - np.log2(n)
        bits[:, j] = np.where(n > 0, own, escape[context, j] + lower[:, j])
    joined = [np.concatenate(x) for x in ((trees.words, words), (trees.first, first), (trees.parent, parent), (trees.escape, escape),
                                          (trees.bits, bits))]
    return Trees(trees.languages, trees.symbol, trees.kinds, trees.node, *joined)


def train(docs: DataFrame, held_out, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Trees:
    """Trees from documents outside the held-out fold, which is a condition on doc_id."""
    rows = docs.select("doc_id", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out)
    few = rows.distinct()
    for groups in ROUNDS:  # the first of each group, then of ever larger ones: no task reads more than a few thousand rows of a language
        order = Window.partitionBy("lang", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(groups))).orderBy(F.xxhash64("doc_id"), "doc_id")
        few = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    few = few.orderBy("place", "lang").limit(sample).select("doc_id", "lang")
    found = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), ["doc_id", "lang"])
    chosen = one_text(found, "doc_id", "lang").select("lang", "text").coalesce(PARTS)  # `sample` rows at most
    schema = arrow_schema("lang string, gram long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, list[np.ndarray]] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, parts in by_lang.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)], schema=schema)
            by_lang.clear()

        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                by_lang.setdefault(lang, []).append(grams(text))
                held += len(by_lang[lang][-1])
                if held >= AT_ONCE:
                    yield from counted()
                    held = 0
        yield from counted()

    counts = chosen.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    place = {x: i for i, x in enumerate(languages)}
    return freeze(languages, counts["lang"].map(place).to_numpy(np.int64), counts["gram"].to_numpy(np.int64),
                  counts["n"].to_numpy(np.int64))


OUT = "doc_id long, lang_pred string, score double"


def predict_languages(docs: DataFrame, trees: Trees) -> DataFrame:
    """The columns of OUT for every document; the table of the trees is sent once to every executor."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield rows_out([(key, *model.predict(text)) for key, text in
                            zip(batch.column(0).to_pylist(), texts(batch), strict=True)], schema)

    return id_and_text(docs).mapInArrow(run, OUT)


def language_fold(doc_id) -> object:
    """The held-out fold of documents: crc32 of the id modulo 5 is 0."""
    return in_set(doc_id, 5, 0)
