import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, key string, block string, place string, score string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([tuple(r) + ("x",) * 4 for r in rows], schema)


def brute(rows, step=50, positives=5, k=3, least=50, most=95, scale=256):
    use = {(i, label, tuple(math.floor(scale * x) for x in v)) for i, v, label in rows
           if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for anchor, own, a in use:
        if anchor % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v, strict=True)), i, label) for i, label, v in use if i != anchor and len(v) == len(a))
        for p, positive, _ in [s for s in scored if s[2] == own][:positives]:
            fit = [s for s in scored if s[2] != own and least * -p <= 100 * -s[0] <= most * -p][:k]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def got(df, **options):
    found = negatives.hard_negatives(df, F.col("vec_id") % options.pop("step", 50) == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def some(seed, n, dim=4, spread=0.15):
    rnd = random.Random(seed)
    return [(i, [float(np.float32(rnd.gauss(0.2, spread))) for _ in range(dim)], rnd.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("size", [(16_384, 4_096, 256), (37, 3, 2)])
def test_as_brute_force(spark, monkeypatch, size):
    for name, value in zip(("ROWS", "ANCHORS", "CHUNK"), size, strict=True):
        monkeypatch.setattr(negatives, name, value)
    rows = some(1, 300)
    assert got(frame(spark, rows).repartition(3), step=20) == brute(rows, step=20)
    assert got(frame(spark, rows), step=50, positives=2, k=7, least=0, most=100) == brute(rows, 50, 2, 7, 0, 100)


def test_ties_and_negative_scores(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(3)], rnd.randrange(2)) for i in range(200)]
    assert got(frame(spark, rows), step=10) == brute(rows, step=10)


def test_odd_rows(spark):
    rows = some(3, 120, dim=3)
    rows += [(None, [0.1, 0.2, 0.3], 1), (200, None, 1), (250, [0.3, None, 0.1], 1), (300, [0.3, float("nan"), 0.1], 1),
             (350, [0.3, float("inf"), 0.1], 1), (400, [0.3, 0.2, 0.1], None), (450, [], 1), (451, [], 1), (452, [], 2),
             (500, [0.3, 0.1], 1), (501, [0.3, 0.1], 1), (502, [0.2, 0.1], 0), (0, [0.3, 0.3, 0.3], 1), (1, [0.4, 0.3, 0.3], 2)]
    rows += rows[:40] * 3  # repeated rows are one
    assert got(frame(spark, rows).repartition(4)) == brute(rows)
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(0, [0.1], 1)])) == [] == got(frame(spark, [(None, None, None)]))


@pytest.mark.parametrize("size", [300.0, 2e4, 5e6, 1e17, 1e30])
def test_scores_are_exact_whatever_their_size(spark, size):
    rnd = random.Random(4)
    rows = [(i, [float(np.float32(size * rnd.uniform(0.2, 1))) for _ in range(3)], rnd.randrange(2)) for i in range(60)]
    want = brute(rows, step=20, k=60)
    held = [(a, p, n) for a, p, _, n, ps, ns in want]
    found = got(frame(spark, rows), step=20, k=60)
    if size < 1e17:
        assert found == want and held
    else:  # held at the end of a long: all scores are equal, so no negative lies below 95 per cent of a positive
        assert found == []


def test_slots_answer_every_window():
    rnd = random.Random(5)
    for _ in range(500):
        positives = [(rnd.randint(-20, 300), i) for i in range(rnd.randint(0, 5))]
        scores = [(rnd.randint(-50, 300), i) for i in range(40)]
        k, cut = rnd.randint(1, 4), negatives.slots([s for s, _ in positives], 50, 95)
        assert all(a[0] > b[1] for a, b in zip(cut, cut[1:], strict=False))  # disjoint, from the highest down
        winners = [(s, score, i) for s, (low, high) in enumerate(cut)
                   for score, i in sorted(((x, i) for x, i in scores if low <= x <= high), key=lambda t: (-t[0], t[1]))[:k]]
        want = [(p, rank, i, score, -n) for score, p in positives for rank, (n, i) in
                enumerate(sorted((-x, i) for x, i in scores if 50 * score <= 100 * x <= 95 * score)[:k], 1)]
        assert list(negatives.answers(positives, winners, k, 50, 95)) == want


def test_a_hot_label_and_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    rows = [(i, [0.5, 0.25], 1 if i % 3 else 0) for i in range(400)] + [(1000 + i, [0.25, 0.25], 2) for i in range(50)]
    assert got(frame(spark, rows), step=100) == brute(rows, step=100)
