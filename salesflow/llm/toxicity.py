"""Toxicity by a counterfactual-regularised classifier.

A logistic model looks at the words of a text and their first letters, as present or absent. Of every labelled text
that names a group of people a counterfactual is made, with the name swapped for another of its kind; the squared
change of the score is added to the loss. So the model cannot use the names themselves, and a neutral mention of a group
is not held against a text.

It is fitted on at most `SAMPLE` labelled documents (the smallest by a hash of the id). The `FEATURES` terms that differ
most between toxic and other ones by the chi-square of their document counts, and all group names, are its inputs.

Defined cases: a null or empty text has no terms and the score of the intercept; rows with null labels or null ids
are not learned from, and of repeated labels for one id the lowest counts, of its repeated rows the text with the smallest
hash; without labels of both kinds the score is the smoothed rate of label 1; a text of any length counts with all its
words; repeated rows come back once each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import arrow_schema, id_and_text, in_set, one_text, rows_out, stored, texts

SAMPLE = 20_000
FEATURES = 4096
#: Documents that a term must be in, and its least chi-square (the 95 % point for one degree of freedom).
LEAST, APART = 3, 3.84
PREFIXES = range(3, 9)
TOXIC_FROM = 0.3
#: Weights of the counterfactual penalty and of the squared coefficients.
CHANGE, RIDGE = 4.0, 1.0
HELD = 400_000

#: Names of groups by kind; one is swapped for the next of its kind.
GROUPS = [kind.split() for kind in (
    "women men girls boys mothers fathers", "woman man girl boy mother father", "muslims christians jews hindus buddhists atheists",
    "muslim christian jewish hindu buddhist atheist", "gay lesbian bisexual transgender straight queer",
    "black white asian latino african european arab", "immigrants refugees foreigners natives citizens migrants",
    "disabled blind deaf autistic elderly young", "frauen männer mädchen jungen", "muslime christen juden",
    "ausländer flüchtlinge einheimische", "femmes hommes filles garçons", "musulmans chrétiens juifs",
    "étrangers réfugiés immigrés", "mujeres hombres niñas niños", "musulmanes cristianos judíos",
    "extranjeros refugiados inmigrantes")]
PLACE = {name: (kind, i) for kind in GROUPS for i, name in enumerate(kind)}
WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> set[str]:
    return set(WORDS(text.lower()))


def terms(word: str) -> list[str]:
    """A whole word, marked by a dollar sign, and its beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if k <= len(word))]


def counterfactual(words: set[str], turn: int) -> set[str] | None:
    """The words with every group name swapped for another of its kind; None if there is no name."""
    named = words & PLACE.keys()
    if not named:
        return None
    swapped = set()
    for name in named:
        kind, i = PLACE[name]
        swapped.add(kind[(i + 1 + turn % (len(kind) - 1)) % len(kind)])
    return words - named | swapped


@dataclass
class Model:
    vocabulary: dict[str, int]
    weight: np.ndarray
    start: float
    held: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def inputs(self, words: set[str]) -> list[int]:
        """The places of the terms that are present."""
        found: set[int] = set()
        held = self.held
        for word in words:
            places = held.get(word)
            if places is None:
                if len(held) >= HELD:
                    held.clear()
                places = held[word] = tuple(self.vocabulary[t] for t in terms(word) if t in self.vocabulary)
            if places:
                found.update(places)
        return sorted(found)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-(self.start + self.weight[self.inputs(words_of(text))].sum()))))


def fit_weights(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[int, list[int]]], size: int, change: float = CHANGE,
                ridge: float = RIDGE, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of the penalised logistic loss, by Adam over all rows.

    pairs has, for rows that name a group, the row and its counterfactual's inputs.
    """
    lens = np.array([len(r) for r in rows], np.int64)
    at, where = np.concatenate([np.array(r, np.int64) for r in rows] or [np.empty(0, np.int64)]), np.repeat(np.arange(len(rows)), lens)
    # the difference of each pair's inputs, as signed entries
    diff = [(k, i, s) for k, (row, other) in enumerate(pairs)
            for s, some in ((1.0, set(rows[row]) - set(other)), (-1.0, set(other) - set(rows[row]))) for i in some]
    pair_of, pair_at = np.array([d[0] for d in diff], np.int64), np.array([d[1] for d in diff], np.int64)
    sign = np.array([d[2] for d in diff])
    w, start = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not len(y) or y.min() == y.max():
        return w, start
    speed, squares = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = start + np.bincount(where, w[at], len(rows))
        error = 1 / (1 + np.exp(-z)) - y
        grad = np.bincount(at, error[where], size) + ridge * w
        if len(pairs):
            gap = np.bincount(pair_of, sign * w[pair_at], len(pairs))
            grad += 2 * change * np.bincount(pair_at, sign * gap[pair_of], size)
        full = np.append(grad, error.sum())
        speed = 0.9 * speed + 0.1 * full
        squares = 0.99 * squares + 0.01 * full**2
        move = 0.05 * (speed / (1 - 0.9**step)) / (np.sqrt(squares / (1 - 0.99**step)) + 1e-8)
        w, start = w - move[:-1], start - float(move[-1])
    return w, start


def fit_toxicity(docs: DataFrame, labels: DataFrame, held_out, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """The model from labelled documents outside the held-out fold, which is a condition on doc_id."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out).groupBy("doc_id")
              .agg(F.min("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    few = stored(one_text(id_and_text(docs).join(F.broadcast(chosen), "doc_id"), "doc_id", "toxic").select(  # `sample` rows at most
        "doc_id", (F.col("toxic") > 0).cast("long").alias("toxic"), "text"), "labelled")
    total, bad = few.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    schema = arrow_schema("term string, bad long, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter[str] = Counter()
            in_bad: Counter[str] = Counter()
            for label, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                present = {t for w in words_of(text) for t in terms(w)}
                n.update(present)
                if label:
                    in_bad.update(present)
            yield rows_out([(t, in_bad[t], k) for t, k in n.items()], schema)

    b, n, all_n, all_b = F.col("bad"), F.col("n"), F.lit(float(total)), F.lit(float(bad))
    surplus = b * all_n - n * all_b
    apart = surplus * surplus * all_n / (n * (all_n - n) * all_b * (all_n - all_b))
    ranked = (few.select("toxic", "text").mapInArrow(count, "term string, bad long, n long").groupBy("term")
              .agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).where((n >= LEAST) & (n < all_n) & F.lit(0 < bad < total)).select("term", apart.alias("apart"))
              .where(F.col("apart") >= APART).orderBy(F.col("apart").desc(), "term").limit(features))
    found = sorted({r["term"] for r in ranked.select("term").collect()} | {t for name in PLACE for t in terms(name)})
    model = Model({t: i for i, t in enumerate(found)}, np.zeros(len(found)), 0.0)
    kind = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int64()), ("here", pa.list_(pa.int32())), ("there", pa.list_(pa.int32()))])

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch), strict=True):
                words = words_of(text)
                other = counterfactual(words, zlib.crc32(str(key).encode()))
                rows.append((key, label, model.inputs(words), None if other is None else model.inputs(other)))
            yield rows_out(rows, kind)

    known = few.mapInArrow(featurise, "doc_id long, toxic long, here array<int>, there array<int>").toArrow().to_pylist()
    known.sort(key=lambda r: (r["doc_id"], r["here"]))
    pairs = [(i, r["there"]) for i, r in enumerate(known) if r["there"] is not None]
    model.weight, model.start = fit_weights([r["here"] for r in known], np.array([r["toxic"] for r in known], float), pairs, len(found))
    model.held = {}
    return model


OUT = "doc_id long, score double, predicted int"


def score_toxicity(docs: DataFrame, model: Model, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The columns of OUT for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            scores = [known.score(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= toxic_from) for s in scores], pa.int32())],
                schema=schema)

    return id_and_text(docs).mapInArrow(run, OUT)


def toxicity_fold(doc_id) -> object:
    """The held-out fold of documents: crc32 of the id modulo 4 is 2."""
    return in_set(doc_id, 4, 2)
