import random
import re
from collections import Counter

import numpy as np
import pytest

from salesflow.llm import quality
from tests.llm.conftest import frame


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered))


def random_text(rnd):
    words = [rnd.choice("ab cd ef gh# ij k $%".split(" ")) for _ in range(rnd.randint(0, 40))]
    return "".join(w + rnd.choice([" ", "\n", "  ", "\t", "\x0b"]) for w in words) * rnd.randint(0, 3)


def test_base_counts_of_random_texts():
    rnd = random.Random(1)
    for _ in range(500):
        text = random_text(rnd)
        assert quality.statistics(text)[0] == brute(text)


def test_verdicts_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(odd, labels)
    rows = quality.quality_verdicts(odd, model).collect()
    want = sorted((r["doc_id"] or 0, *brute(r["text"])) for r in odd.collect())
    assert sorted((r["doc_id"] or 0, *r[1:6]) for r in rows) == want
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])  # no usable label: the base rules alone
    assert quality.quality_verdicts(none, model).count() == 0
    kept = quality.drop_poor(odd, model)
    assert kept.columns == odd.columns and [r["doc_id"] for r in kept.collect()] == [4]


def test_small_table_against_labels(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = {r["doc_id"]: r for r in quality.quality_verdicts(docs, quality.fit_quality(docs, labels)).collect()}
    for r in docs.collect():
        assert tuple(rows[r["doc_id"]][1:6]) == brute(r["text"])
    good = [r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not rows[r["doc_id"]]["base_failed"]]
    poor = [r["doc_id"] for r in labels.collect() if r["quality"] == 0]
    assert np.mean([rows[i]["kept"] for i in good]) > 0.98 and np.mean([rows[i]["kept"] for i in poor]) < 0.1


@pytest.mark.parametrize("sign", [-1, 1])
def test_constraints_hold_everywhere(sign):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(800, 3))
    y = (sign * x[:, 0] + 0.8 * np.sin(6 * x[:, 0]) + x[:, 1] ** 2 + rnd.normal(size=800) > 0.5).astype(float)
    model = quality.fit_trees(x, y, (sign, 0, 0), depth=4)
    grid = np.linspace(-4, 4, 400)
    for a, b in rnd.normal(size=(40, 2)):
        scores = model.score(np.column_stack([grid, np.full(400, a), np.full(400, b)]))
        assert (sign * np.diff(scores) >= -1e-12).all()
    assert ((model.score(x) > 0.5) == y).mean() > 0.8


def test_flat_trees_score_as_nodes_do():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(300, 4))
    model = quality.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), (0, 0, 0, 0), rounds=5)

    def walk(row):
        total = model.start
        for t in range(len(model.feature)):
            node = 0
            while model.feature[t, node] >= 0:
                node = model.left[t, node] if row[model.feature[t, node]] <= model.cut[t, node] else model.right[t, node]
            total += model.value[t, node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x), [walk(r) for r in x])


def test_repeated_rows_are_judged_once_each(spark):
    text = "a clean line of ten different words that says very little"
    docs = frame(spark, [(1, text, "en", "s", 1), (1, text, "en", "s", 1)])
    model = quality.fit_trees(np.empty((0, 12)), np.empty(0), (0,) * 12)
    assert quality.drop_poor(docs, model).count() == 2
