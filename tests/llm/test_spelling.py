import random
import re
import zlib
from collections import Counter

import pytest

from salesflow.llm import spelling

SCHEMA = "doc_id long, text string"


def counted(rows, length=7, times=2):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 31 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if n >= times and len(w) >= length}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, factor=10):
    form, out = {}, []
    for w, n in words.items():
        others = sorted((-words[x], x) for x in words if near(w, x))
        best = others[0] if others and -others[0][0] >= factor * n else (None, None)
        form[w] = best[1]
        out.append((w, best[1], n, len(others), None if best[0] is None else -best[0]))
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, f, root(w), n, k, fn) for w, f, n, k, fn in out)


def columns(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def sample(seed, size):
    rnd, rows = random.Random(seed), []
    stems = ["thering", "thérings", "anderen", "ingthere", "aaaaaaa", "Überall"]
    for k in range(size):
        words = []
        for _ in range(rnd.randint(0, 40)):
            w = list(rnd.choice(stems) + rnd.choice(["", "", "x", "ÿ", "ing", "÷a"]))
            if rnd.random() < 0.3:
                i = rnd.randrange(len(w))
                w[i:i + rnd.randint(0, 1)] = rnd.choice(["", "e", "A", "é", "aa"])
            words.append("".join(w))
        rows.append((rnd.choice([None, k, k]), rnd.choice([" ", ", ", "1"]).join(words) if rnd.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("shared", [2, 64])
def test_as_brute_force(spark, monkeypatch, shared):
    monkeypatch.setattr(spelling, "SHARED", shared)  # 2: every chunk is lengthened to the end
    monkeypatch.setattr(spelling, "COUNTED", 50)
    rows = sample(shared, 150)
    got = spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert columns(got) == brute(counted(rows))


def test_every_single_edit_is_found_whatever_the_group(spark, monkeypatch):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(7, 11))) for _ in range(250)} | {"a" * 40, "a" * 41, "b" + "a" * 40}
    words = {w: rnd.choice([2, 3, 30, 400]) for w in words}
    want = {(a, words[a], b, words[b]) for a in words for b in words if near(a, b)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    for shared in (1, 20, 10_000):
        monkeypatch.setattr(spelling, "SHARED", shared)
        got = [tuple(r) for r in spelling.near_pairs(frame).select("word", "n", "other", "other_n").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_chains_of_forms(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 30, "aaaaabb": 400, "aaaabbb": 9_000, "aaabbbb": 100_000, "zzzzzzz": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    forms = spark.createDataFrame([(w, f) for w, f, *_ in brute(words) if f], "word string, form string")
    assert frame.count() == 6 and forms.count() == 4
    assert {tuple(r) for r in spelling.roots(forms).select("word", "root").collect()} == {(w, "aaabbbb") for w in list(words)[:4]}


def test_ties_and_thresholds(spark):
    text = " ".join(["running"] * 20 + ["runnings"] * 20 + ["runnixg"] * 2 + ["runing"] * 5 + ["onceonly"])
    rows = [(1, text.upper()), (2, "running RUNNING")]
    assert columns(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA))) == brute(counted(rows))


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert columns(spelling.spelling_variants(odd)) == brute(counted(rows))
    assert spelling.spelling_variants(none).count() == 0


def test_a_very_long_word(spark):
    rows = [(1, f"{'ab' * 20_000} {'ab' * 20_000}x {'ab' * 20_000}"), (2, f"{'ab' * 20_000}x")]
    got = columns(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA)))
    assert [(len(w), n, k) for w, _, _, n, k, _ in got] == [(len(w), n, k) for w, _, _, n, k, _ in brute(counted(rows))]
