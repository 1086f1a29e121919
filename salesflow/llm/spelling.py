"""Spelling variants: words at one edit from each other, and the form each of them stands for.

Words are joined on chunks. A word contributes two disjoint chunks, its halves; one edit leaves one of them as it is. The
other word contributes its grams of that length at the places an edit can bring a chunk to: those before the edit stay,
those behind it move by the difference in length, one at most. Equal lengths meet in both roles, otherwise the shorter
word has the chunks. What shares a chunk is then verified.

A chunk that more than `SHARED` words and grams have is not joined: it is lengthened by half of what is left of the word,
once for each half that may hold the edit. So no group is large, whatever the number of words: in the end all but one
character agree, and such a group is bounded by the alphabet. Every pair at one edit shares a chunk at each of these
steps, so none is lost.

Words are counted in each task first, then by Spark. All later steps are joins and aggregates of the distinct words.

Defined cases: a null or empty text has no words; a null doc_id stands as an empty string before the colon; words of any
length are compared whole; repeated rows count as often as they occur; of neighbours equally frequent the smallest in the
order of code points is the form; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, id_and_text, rows_out, stored, texts

#: Entries of one chunk that are joined as they are; words that a task counts before it passes them on.
SHARED, COUNTED = 64, 200_000
#: Parts of the entries of a chunk when the frequent chunks are looked up.
SALTS = 16
#: Every this many-th occurrence by its hash lacks a character.
DAMAGED = 31


def count_words(docs: DataFrame, length: int, times: int) -> DataFrame:
    """(word, n) of the words of at least `length` letters that occur at least `times` times, A-Z lower-cased.

    An occurrence is a run of letters; if the crc32 of `<doc_id>:<run>` is a multiple of DAMAGED, the character at that
    number modulo the length is left out.
    """
    find, schema = re.compile(f"[a-zÀ-ÿ]{{{length},}}").findall, arrow_schema("word string, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                start = zlib.crc32(b":" if key is None else b"%d:" % key)
                for word, n in Counter(find(text.encode().lower().decode())).items():  # bytes: only A-Z change
                    h = zlib.crc32(word.encode(), start)
                    if h % DAMAGED == 0:
                        word = word[:h % len(word)] + word[h % len(word) + 1:]
                    if len(word) >= length:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield rows_out(list(counts.items()), schema)
                    counts.clear()
        yield rows_out(list(counts.items()), schema)

    counted = id_and_text(docs).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _key(word: Column, length: Column, low: Column, high: Column, more: Column) -> Column:
    """What lies outside the characters from `low` to `high` of a word that may be longer than `length` by `more`."""
    behind = F.substring(word, high + more + 1, F.char_length(word))
    return F.concat_ws(":", length, low, F.substring(word, F.lit(1), low), behind)


def _halved(entries: DataFrame) -> DataFrame:
    """Each entry twice, for an edit in the first and in the second half of the characters left; with the key that
    results. An entry has word, n, more (0 for chunks, 1 for the grams of a longer word), and low and high."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    half = entries.withColumn("half", F.explode(halves)).select("word", "n", "more", "half.low", "half.high")
    length = F.char_length("word") - F.col("more")
    return half.withColumn("key", _key(F.col("word"), length, F.col("low"), F.col("high"), F.col("more")))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of every two words that differ by one inserted, deleted or replaced character, both ways.

    `words` has word (distinct) and n.
    """
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("more")
    entries = words.select("word", "n", both).withColumn("low", F.lit(0)).withColumn("high", F.char_length("word") - F.col("more"))
    found = []
    while True:
        entries = stored(_halved(entries.where("high >= 0")), "chunks")
        settled = F.col("high") - F.col("low") <= 1  # the alphabet bounds such a group
        frequent = entries.where(~settled).groupBy("key").count().where(F.col("count") > SHARED).select("key")
        frequent = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = entries.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        marked = stored(salted.join(frequent.withColumn("hot", F.lit(True)), ["key", "salt"], "left").drop("salt"), "chunks")
        found.append(_verified(marked.where("hot IS NULL")))
        entries = marked.where("hot").select("word", "n", "more", "low", "high")
        if entries.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    pairs = pairs.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                   F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    return pairs.select(F.explode(ways).alias("way")).select("way.*")


def _verified(entries: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of entries with one key, one of them a chunk, whose words are at one edit."""
    chunks = entries.where("more = 0").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    others = entries.select("key", "more", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = chunks.join(others, "key").where((F.col("more") == 1) | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last of the forms that follow from a word, by doubling the steps.

    Forms must lead to no circle; those of spelling_variants are ever more frequent by a factor, so a few rounds do.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = now.join(on, "root")
        if further.isEmpty():
            return now
        now = stored(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, length: int = 7, times: int = 2, factor: int = 10) -> DataFrame:
    """Every word of the texts with its form, the near word that is most frequent and at least `factor` times as frequent.

    Columns: word, form (null if there is none), root (the last of the forms that follow), n, n_near, form_n.
    """
    words = stored(count_words(docs, length, times), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= factor * F.col("n")
    near = stored(near.select("word", "n_near", F.when(strong, F.col("best.other")).alias("form"),
                              F.when(strong, -F.col("best.less")).alias("form_n")), "near")
    chains = roots(near.where("form IS NOT NULL").select("word", "form"))
    return words.join(near, "word", "left").join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
