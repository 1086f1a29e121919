import hashlib
import random
import re
from math import log2

import pytest

from salesflow.llm import secrets
from tests.llm.conftest import frame

BASE = [("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]


def brute(text):
    return [(k, m.start(), m.end()) for k, p, g, n in BASE for m in p.finditer(text or "") if len(m[g]) >= n]


def test_base_spans_of_random_texts():
    rnd = random.Random(1)
    bits = ["password", "PassWd", "secret", "toKen", "api_key", "ApiKey", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "abcdef0123",
            "0f" * 9, "\n", "é", "K", "ſ", "x-y_z", "\t", "🙂"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        base, added, _ = secrets.scan(text)
        assert base == brute(text)
        assert all(k == "guess" and not any(s < e2 and s2 < e for _, s, e in base) for k, s2, e2 in added)


def test_odd_rows(odd, none):
    rows = secrets.secret_spans(odd).collect()
    assert len(rows) == odd.count()
    assert {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()} and {r["spans"] for r in rows} == {""}
    assert secrets.secret_spans(none).count() == 0
    same = secrets.redact_secrets(odd)
    assert same.columns == odd.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd.collect()))


@pytest.mark.parametrize(("value", "low", "high"), [
    ("password", 0, 5), ("qwertyuiop", 0, 15), ("aaaaaaaaaaaa", 0, 15), ("2024-01-05", 10, 20), ("letmein123", 0, 25),
    ("P4ssw0rd", 0, 10), ("xK9#mP2$vLq7", 45, 80), ("24be64439e3e49cf46b2d7c90f3602a3", 90, 160), ("", 0, 0)])
def test_guess_costs(value, low, high):
    assert low <= secrets.guess_bits(value) <= high


def brute_bits(value, ranks):
    """The cheapest of all segmentations, from the price of every piece by itself."""
    low, n, pieces = value.lower(), len(value), {}

    def put(i, j, bits):
        pieces[i, j] = min(pieces.get((i, j), 1e9), bits)

    for i in range(n):
        put(i, i + 1, secrets.char_bits(value[i]))
        for pattern, bits in ((secrets.DATE, log2(365 * 120)), (secrets.YEAR, log2(120))):
            if m := pattern.match(value, i):
                put(i, m.end(), bits + 1)
        for j in range(i + 3, min(i + 24, n) + 1):
            piece = low[i:j]
            rank = ranks.get(piece, ranks.get(piece.translate(secrets.LEET)))
            if rank:
                put(i, j, log2(rank) + (value[i:j] != piece) + (piece not in ranks) + 1)
        for step in (1, -1):
            end = i + 1
            while end < n and low[end - 1:end + 1][::step] in secrets.NEXT:
                end += 1
            for j in range(i + 3, end + 1):
                put(i, j, log2(47) + log2(end - i) + 1)
        for size in range(1, 5):
            unit, times = value[i:i + size], 1
            while len(unit) == size and value.startswith(unit, i + times * size):
                times += 1
            for k in range(2, times + 1):
                if k * size >= 3:
                    put(i, i + k * size, sum(map(secrets.char_bits, unit)) + log2(times) + 1)
    best = [0.0] + [1e9] * n
    for j in range(1, n + 1):
        best[j] = min(best[i] + bits for (i, stop), bits in pieces.items() if stop == j)
    return best[n]


def test_the_cheapest_segmentation_is_found():
    rnd, ranks = random.Random(3), secrets.RANK | {"haus": 40, "tree": 41, "abab": 50}
    parts = ["a", "b", "ab", "qwe", "ewq", "1", "12", "2024", "-01", "-05", "key", "Haus", "#", "x", "tr33", "9", "*"]
    for _ in range(3000):
        value = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
        assert secrets.guess_bits(value, ranks) == pytest.approx(brute_bits(value, ranks), abs=1e-9)


@pytest.mark.parametrize(("value", "secret"), [
    ("*" * 80, False), ("#" * 500, False), ("qwertyuiop" * 9, False), ("xkqxkq" * 40, False), ("zyxwvutsrqponmlkjihgfedcba", False),
    ("xkqzjwvbnmtrplkjhgfdsazq", True), ("stormlanterngarden", False), ("STORMlanternGarden", False), ("stormxkqzjwvbnmtrp", True)])
def test_long_runs_and_words(spark, value, secret):
    docs = frame(spark, [(1, f"auth: {value}", "en", "s", 1)] + [(2 + i, "storm lantern garden Storm", "en", "s", 1) for i in range(5)])
    row = secrets.secret_spans(docs).where("doc_id = 1").first()
    assert row["n_guess"] == int(secret)
    masked = secrets.redact_secrets(docs).where("doc_id = 1").first()["text"]
    assert masked == ("[SECRET]" if secret else f"auth: {value}")


def test_frequent_words(spark, odd, none, monkeypatch):
    monkeypatch.setattr(secrets, "COUNTED", 3)
    texts = ["Storm garden storm 12 storm2 x_lantern token = hiddenword", "garden zebra été ab", "admin " * 9, "q" * 25, None]
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]).repartition(3)
    n = len(secrets.RANK)
    assert secrets.frequent_words(docs, 6) == secrets.RANK | {"storm": n + 1, "garden": n + 2, "lantern": n + 3, "zebra": n + 4,
                                                              "été": n + 5}
    assert secrets.frequent_words(docs, 5) == secrets.RANK | {"storm": n + 1, "garden": n + 2}  # three words come once
    assert secrets.frequent_words(docs, 0) == secrets.frequent_words(none) == secrets.RANK
    assert len(secrets.frequent_words(odd)) > len(secrets.RANK)


def test_added_spans_and_redaction(spark):
    text = 'pwd = xK9#mP2$vLq7! and password: changeme and token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'
    docs = frame(spark, [(1, text, "en", "s", len(text)), (1, text, "en", "s", len(text)), (2, "clean text", "en", "s", 10)])
    rows = secrets.secret_spans(docs).where("doc_id = 1").collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0]["spans"].split(",")[0].startswith("guess:0:") and rows[0]["n_guess"] == 1 and rows[0]["n_assign"] == 1
    out = {r["doc_id"]: r for r in secrets.redact_secrets(docs).collect()}
    assert out[1]["text"] == '[SECRET] and password: changeme and [SECRET]" end'
    assert out[1]["n_chars"] == len(out[1]["text"])
    assert (out[2]["text"], out[2]["n_chars"]) == ("clean text", 10)


def test_a_long_value_takes_linear_time():
    rnd = random.Random(5)
    assert secrets.guess_bits("".join(rnd.choice("aB3$xY9#") for _ in range(20_000))) > 10_000
    assert secrets.guess_bits("aB3$" * 5000) < 40
