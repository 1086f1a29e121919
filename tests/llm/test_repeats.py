import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from salesflow.llm import repeats, spans, suffixes
from tests.llm.conftest import frame


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        n_spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        left = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), n_spans, hashlib.sha256(left).hexdigest()))
    return out


def made(seed, n=60):
    """Texts that share passages, lines within ever different text, periods, and copies."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages, line = [text(60) for _ in range(4)], text(30)
    rows = [text(rnd.randint(0, 80)) + rnd.choice([*passages, line, line, ""]) + text(rnd.randint(0, 60)) for _ in range(n)]
    own = text(70)
    return [*rows, rows[0], rows[0], "xy" * 400, "z" * 900, "to be " * 300 + "or", own + "to be " * 150, own + " middle " + own, "é" * 300, passages[0][5:290], "", None]


@pytest.mark.parametrize(("seed", "crowd"), [(1, 2500), (2, 3)])
def test_random_corpora(spark, monkeypatch, seed, crowd):
    """Also with a small crowd, so that keys go through all levels of anchors."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    texts = made(seed)
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]).repartition(4)
    got = {r["doc_id"]: tuple(r[1:]) for r in repeats.remove_repeats(docs).collect()}
    want = brute(texts, 200)
    assert sum(w[1] for w in want) > 5000
    assert [got[i] for i in range(len(texts))] == want


def test_odd_rows(odd, none):
    rows = repeats.remove_repeats(odd).collect()
    docs = odd.collect()
    want = sorted((r["doc_id"] or 0, *w) for r, w in zip(docs, brute([r["text"] for r in docs], 200), strict=True))
    assert sorted((r[0] or 0, *r[1:]) for r in rows) == want
    assert repeats.remove_repeats(none).count() == 0


def test_texts_left(spark):
    texts = made(3, 20)
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    left = {r["doc_id"]: r["text"] for r in repeats.cleaned_texts(docs).collect()}
    for i, (_, _, _, digest) in enumerate(brute(texts, 200)):
        if texts[i] is None or texts[i].isascii():
            assert hashlib.sha256(left[i].encode()).hexdigest() == digest


def test_rows_of_one_key_in_parts(monkeypatch):
    """A key with more rows than are held at a time gives the same fragments as one look at all of them."""
    import pyarrow as pa
    rnd = random.Random(1)
    rows = sorted((rnd.choice([1, 1, 1, 2, 3, 4]), rnd.randint(0, 5), b"p", i, 9, False) for i in range(400))
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 7], strict=True), (
        pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()), strict=True)],
        names=["key", "content", "pid", "start", "size", "settled"])
        for i in range(0, 400, 7)]
    for group in (100_000, 20, 3):
        monkeypatch.setattr(repeats, "GROUP", group)
        out = [r for b in repeats.mark(iter(batches)) for r in b.to_pylist()]
        firsts = [(r["key"], r["content"]) for r in out if r["first"]]
        assert len(out) == 400 and firsts == sorted({(k, c) for k, c, *_ in rows})
        many = Counter(k for k, _ in {(k, c) for k, c, *_ in rows})
        assert all(r["many"] == (many[r["key"]] > 1) for r in out)
        twice = Counter((k, c) for k, c, *_ in rows)
        assert all(r["twice"] == (twice[r["key"], r["content"]] > 1) for r in out if r["first"])


def made_bytes(rnd, alphabet):
    n = rnd.randint(1, 400)
    text = bytes(ord(rnd.choice(alphabet)) for _ in range(n))
    if rnd.random() < 0.5:
        text = (text[:rnd.randint(1, 20)] * 400)[:n]
    if rnd.random() < 0.5:
        text = (text * 3)[rnd.randint(0, n):][:700]
    return text


@pytest.mark.parametrize("alphabet", ["ab", "a", "abc", "abcdefgh\x01\xff", "\x00a\x01"])
def test_suffix_array(alphabet):
    rnd = random.Random(3)
    for _ in range(60):
        text = made_bytes(rnd, alphabet)
        data, n = np.frombuffer(text, np.uint8), len(text)
        order = suffixes.suffix_array(data)
        assert sorted(order.tolist()) == list(range(n))
        assert [text[i:i + 216] for i in order] == sorted(text[i:i + 216] for i in range(n))
        assert np.array_equal(suffixes.suffix_array(data, 10 * n), sorted(range(n), key=lambda i: text[i:]))


@pytest.mark.parametrize("alphabet", ["ab", "a", "abc", "abcdefgh\x01\xff", "\x00a\x01"])
def test_common_prefixes_of_neighbours(alphabet):
    rnd = random.Random(4)
    for least in (1, 7, 8, 40, 200):
        for _ in range(25):
            text = made_bytes(rnd, alphabet)
            order = suffixes.suffix_array(np.frombuffer(text, np.uint8), least)
            got = suffixes.common_prefixes(np.frombuffer(text, np.uint8), order, least)
            for g, i, j in zip(got.tolist(), order[:-1].tolist(), order[1:].tolist(), strict=True):
                a, b = text[i:], text[j:]
                same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                assert g == (same if same >= least else 0)


def test_only_the_smaller_suffixes_are_sorted(monkeypatch):
    """No sort of the first stage sees more places than there are suffixes smaller than their successors."""
    rnd = random.Random(5)
    text = np.frombuffer(bytes(rnd.choice(b"abcdefgh") for _ in range(20_000)) * 2, np.uint8)
    chosen, seen, plain = int(suffixes.smaller_than_next(text).sum()), [], suffixes.sorted_chosen

    def watched(*args):
        for name in ("argsort", "lexsort"):
            real = getattr(np, name)
            monkeypatch.setattr(np, name, lambda x, *a, real=real, **k: seen.append(np.shape(x)[-1]) or real(x, *a, **k))
        out = plain(*args)
        seen.append(-1)
        return out

    monkeypatch.setattr(suffixes, "sorted_chosen", watched)
    suffixes.suffix_array(text, 200)
    first, second = seen[:seen.index(-1)], seen[seen.index(-1) + 1:]
    assert max(first) == chosen < 0.6 * len(text)
    assert sum(second) <= len(text)  # the scans group each other place once, by its first byte


@pytest.mark.parametrize("k", [5, 16, 32, 60])
def test_equal_windows_have_equal_keys(k):
    rnd = random.Random(k)
    text = bytes(rnd.choice(b"abcd") for _ in range(500)) * 2 + b"a" * 200
    data = np.frombuffer(text, np.uint8)
    first, stop, keys = spans.cut(data, 60, k)
    assert first[0] == 0 and stop[-1] == len(text)
    assert (first[1:] == stop[:-1] - 60 + 1).all()  # every window lies in one fragment
    key_of = {}
    for a, b, key in zip(first.tolist(), stop.tolist(), keys.tolist(), strict=True):
        for i in range(a, b - 59):
            assert key_of.setdefault(text[i:i + 60], key) == key


def test_stretches_of_a_long_text(monkeypatch):
    rnd = random.Random(1)
    data = np.frombuffer(bytes(rnd.choice(b"abcdefgh") for _ in range(3000)), np.uint8)
    whole = {(int(k), int(s)) for s, k in zip(*[spans.cut(data, 100, 16)[i] for i in (0, 2)], strict=True)}
    monkeypatch.setattr(spans, "STRETCH", 700)
    first, stop, keys = spans.cut(data, 100, 16)
    assert stop[-1] == 3000 and whole <= {(int(k), int(s)) for s, k in zip(first, keys, strict=True)}
