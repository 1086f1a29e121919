"""Quality rules: gradient-boosted trees over document statistics.

Base rules reject documents that are too short or repeat themselves. For all others a boosted model, fitted to
`labels.quality` on at most `SAMPLE` labelled documents (the smallest by a hash of the id), gives the verdict. The
score never rises with more symbols, more capitals, more repeated lines or words: in such features a split whose right
side would be better is refused, and the bounds of a split's middle are handed down to what lies below. The fitted trees
are flat numpy arrays, so scoring is a few gathers for a whole batch.

Defined cases: a null or empty text has no words and fails the base rules; without usable labels (none, or of one kind)
the model accepts everything and the base rules decide alone; labels that are null or whose document is missing are left
out; of repeated labels for one id the lowest counts, of its repeated rows the text with the smallest hash; repeated
documents are judged once each and alike; a text of any length is judged whole; an empty table gives an empty result; other
columns are neither read nor touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import SPACES, arrow_schema, fresh, id_and_text, one_text, texts

#: Most labelled documents that a model is fitted on.
SAMPLE = 20_000
#: A document is kept from this probability of good quality on.
KEEP = 0.5
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Statistic and the sign that its effect on the score must have (0: free).
FEATURES = (("log_words", 0), ("word_length", 0), ("symbols_per_word", -1), ("dup_line_share", -1),
            ("repeat_share", -1), ("upper_share", -1), ("digit_share", -1), ("mark_share", -1), ("line_words", 0),
            ("distinct_share", 0), ("pipe_share", -1), ("space_share", 0))


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts of a text (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and its FEATURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n, chars = len(words), len(text) - int(seen[list(SPACES.encode())].sum())
    symbols, dups = int(seen[list(SYMBOLS.encode())].sum()), len(lines) - len(set(lines))
    repeats = repeat_words(words)
    some, size, rows = max(n, 1), max(chars, 1), max(len(lines), 1)
    return (n, chars, symbols, dups, repeats), (
        np.log1p(n), chars / some, symbols / some, dups / rows, repeats / some, seen[65:91].sum() / size,
        seen[48:58].sum() / size, (seen[33] + seen[63]) / some, n / rows, len(set(words)) / some, seen[124] / some,
        (len(text) - chars) / max(len(text), 1))


def repeat_words(words: list[bytes]) -> int:
    """Words covered by a window of five words that the text has twice or more, the first one included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    key, most = code[:n], len(ids)
    for k in range(1, WINDOW):
        if most * len(ids) >= 2**62:  # numbered anew, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1]
            most = n
        key = key * len(ids) + code[k:k + n]
        most *= len(ids)
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[place] > 1)
    if not len(at):
        return 0
    step = np.zeros(len(words) + 1, np.int64)
    step[at] += 1
    step[at + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(step[:-1])))


@dataclass
class Trees:
    """A boosted model as node arrays, one row per tree: a leaf's feature is -1 and its children are itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of x."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = self.feature[t, at]
                go = x[rows, np.maximum(f, 0)] <= self.cut[t, at]
                at = np.where(f < 0, at, np.where(go, self.left[t, at], self.right[t, at]))
            total += self.value[t, at]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, signs: tuple[int, ...], rounds: int = 60, depth: int = 3, rate: float = 0.2,
              bins: int = 64, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Newton boosting of the logistic loss over binned features, under the monotonic constraints in signs."""
    size = 2 ** (depth + 1) - 1
    feature, cut = np.full((rounds, size), -1), np.zeros((rounds, size))
    left, right, value = np.zeros((rounds, size), int), np.zeros((rounds, size), int), np.zeros((rounds, size))
    if len(y) == 0 or y.min() == y.max():
        return Trees(feature[:0], cut[:0], left[:0], right[:0], value[:0], depth, 20.0)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    rate_of = y.mean()
    start = float(np.log(rate_of / (1 - rate_of)))
    total = np.full(len(y), start)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        todo, free = [(0, np.arange(len(y)), 0, -np.inf, np.inf)], 1
        while todo:
            node, rows, level, low, high = todo.pop()
            best = None
            if level < depth:
                best = best_split(binned[rows], g[rows], h[rows], edges, signs, ridge, least, low, high)
            if best is None:
                leaf = rate * float(np.clip(g[rows].sum() / (h[rows].sum() + ridge), low, high))
                value[t, node] = leaf
                left[t, node] = right[t, node] = node
                total[rows] += leaf
                continue
            _, f, b, a_value, b_value = best
            feature[t, node], cut[t, node] = f, edges[f][b]
            left[t, node], right[t, node] = free, free + 1
            free += 2
            middle, goes = (a_value + b_value) / 2, binned[rows, f] <= b
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}[signs[f]]
            todo.append((left[t, node], rows[goes], level + 1, *bounds[0]))
            todo.append((right[t, node], rows[~goes], level + 1, *bounds[1]))
    return Trees(feature, cut, left, right, value, depth, start)


def best_split(binned, g, h, edges, signs, ridge, least, low, high):
    """The split with the largest gain as (gain, feature, bin, left value, right value); None if none helps."""
    best, all_g, all_h = None, g.sum(), h.sum()
    here = all_g**2 / (all_h + ridge)
    for f, e in enumerate(edges):
        if not len(e):
            continue
        n = len(e) + 1
        gs = np.cumsum(np.bincount(binned[:, f], g, n))[:-1]
        hs = np.cumsum(np.bincount(binned[:, f], h, n))[:-1]
        count = np.cumsum(np.bincount(binned[:, f], minlength=n))[:-1]
        a, b = np.clip(gs / (hs + ridge), low, high), np.clip((all_g - gs) / (all_h - hs + ridge), low, high)
        gain = gs**2 / (hs + ridge) + (all_g - gs)**2 / (all_h - hs + ridge) - here
        wrong = (count < least) | (len(g) - count < least) | (signs[f] * (b - a) < 0)
        gain[wrong] = -1
        k = int(np.argmax(gain))
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, k, float(a[k]), float(b[k]))
    return best


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """The model from at most `sample` labelled documents; only their texts are looked at."""
    chosen = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    few = one_text(id_and_text(docs).join(F.broadcast(chosen), "doc_id"), "doc_id", "quality")  # `sample` rows at most
    names = [name for name, _ in FEATURES]
    schema = arrow_schema("doc_id long, quality double, " + ", ".join(f"{n} double" for n in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t)[1] for t in texts(batch)], float).reshape(-1, len(FEATURES))
            y = batch.column(2).cast(pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), y, *(pa.array(c) for c in x.T)], schema=schema)

    ddl = "doc_id long, quality double, " + ", ".join(f"{n} double" for n in names)
    found = few.select("doc_id", "text", "quality").mapInArrow(run, ddl).toPandas().sort_values(["doc_id", *names])
    return fit_trees(found[names].to_numpy(float), (found["quality"] > 0).to_numpy(float), tuple(s for _, s in FEATURES))


OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, score double")


def judge(texts_of: Iterator[str], model: Trees, keep: float = KEEP):
    """Counts, base_failed, kept and score of a batch of texts."""
    rows = [statistics(t) for t in texts_of]
    base = np.array([r[0] for r in rows], np.int64).reshape(-1, 5)
    x = np.array([r[1] for r in rows], float).reshape(-1, len(FEATURES))
    failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
    score = model.score(x)
    return base, failed, ~failed & (score >= keep), score


def quality_verdicts(docs: DataFrame, model: Trees, keep: float = KEEP) -> DataFrame:
    """One row per document with the columns of OUT."""
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, failed, kept, score = judge(texts(batch), model, keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in base.T), pa.array(failed), pa.array(kept), pa.array(score)],
                schema=schema)

    return id_and_text(docs).mapInArrow(run, OUT)


def drop_poor(docs: DataFrame, model: Trees, keep: float = KEEP) -> DataFrame:
    """The documents that pass, with all their columns."""
    (mark,) = fresh(docs, "quality_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = judge(texts(batch, mark), model, keep)[2]
            yield batch.select(names).filter(pa.array(good))

    names = docs.columns
    marked = docs.withColumn(mark, F.coalesce(F.col("text"), F.lit("")))
    return marked.mapInArrow(run, docs.schema)
