import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from salesflow.llm import components, exact_dedup, simhash
from tests.llm.conftest import frame


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups(odd, none):
    rows = [r.asDict() for r in exact_dedup.exact_groups(odd).collect()]
    assert len(rows) == odd.count()
    by_text = {}
    for r in odd.collect():
        by_text.setdefault(hashlib.sha256(normal(r["text"]).encode()).hexdigest(), []).append(r["doc_id"])
    for r in rows:
        ids = by_text[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
    kept = [r["text_sha256"] for r in rows if r["kept"]]
    assert sorted(kept) == sorted(by_text)  # one row of each group
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert exact_dedup.exact_groups(none).count() == 0


def test_hot_digests_are_heavy_and_others_are_not(spark):
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 40 == 1 else f"text {i}", "en", "s", 1) for i in range(3000)]
    docs = frame(spark, rows).repartition(7)
    digests = docs.select("doc_id", exact_dedup.digest(docs["text"]).alias("digest"), docs["doc_id"].alias("row_id"))
    heavy = {r["keep_id"]: r["group_size"] for r in exact_dedup.heavy_winners(digests, 3000).collect()}
    hot, warm = [r[0] for r in rows if r[1] == "hot"], [r[0] for r in rows if r[1] == "warm"]
    assert heavy == {min(hot): len(hot), min(warm): len(warm)}
    sizes = {r["doc_id"]: r["group_size"] for r in exact_dedup.exact_groups(docs).collect()}
    assert [sizes[i] for i in (0, min(warm), 2)] == [len(hot), len(warm), 1]
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({t: i for i, t, *_ in reversed(rows)}.values())


def test_counters_keep_their_bound():
    rnd = random.Random(1)
    keys = [b"a"] * 400 + [b"b"] * 300 + [str(rnd.random()).encode() for _ in range(2000)]
    rnd.shuffle(keys)
    batches = [pa.record_batch([pa.array(keys[i:i + 100], pa.binary())], ["digest"]) for i in range(0, len(keys), 100)]
    (out,) = exact_dedup.summarise(iter(batches), counters=9)
    found = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert len(found) <= 9 and 400 - 270 <= found[b"a"] <= 400


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest id reachable over links of at most 4 bits, from (id, fingerprint)."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(fps):
            for j, (_, b) in enumerate(fps):
                if (a ^ b).bit_count() <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return [min((fps[j][0] for j in range(len(fps)) if label[j] == x and fps[j][0] is not None), default=None) for x in label]


@pytest.mark.parametrize("text", ["", None, "One", "one two three", "A b c d e", "Éa ÉA\x0bx y z w q", "a a a a a a a a"])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "", 4) == brute_fingerprint(text)


def test_near_groups_of_odd_rows(odd, none):
    rows = simhash.near_groups(odd).collect()
    docs = odd.collect()
    assert len(rows) == len(docs)
    fps = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs]
    want = {(i, f): c for (i, f), c in zip(fps, brute_components(fps), strict=True)}
    assert {(r["doc_id"], r["fp"] % 2**64): r["component_id"] for r in rows} == want
    assert simhash.near_groups(none).count() == 0


def test_near_groups_of_the_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    fps = sorted((r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect())
    got = sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_groups(docs).collect())
    assert got == [(i, f, c) for (i, f), c in zip(fps, brute_components(fps), strict=True)]


@pytest.mark.parametrize(("hot", "crowd"), [(4096, 100_000), (2, 100_000), (2, 3), (20, 40)])
def test_links_lose_nothing(spark, monkeypatch, hot, crowd):
    """Clouds of fingerprints around a few centres, by the tables, by buckets cut again, and by balls."""
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rnd = random.Random(5)
    found = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(25):
            value = centre
            for _ in range(rnd.randint(0, 4)):
                value ^= 1 << rnd.randrange(64)
            found.add(value)
    fps = [(v - 2**64 if v >> 63 else v, v) for v in sorted(found)]
    df = spark.createDataFrame([(s,) for s, _ in fps], "fp long")
    roots = {r["node"]: r["root"] for r in components.connected_components(simhash.links(df)).collect()}
    got = [roots.get(s, s) for s, _ in fps]
    assert got == brute_components(fps)


def test_forest_joins_all_that_is_linked():
    fps = np.array([0, 1, 3, 7, 15, 31, 0xFFFFFF << 30, (0xFFFFFF << 30) + 1], np.uint64)
    edges = simhash.forest(fps, np.ones(8, bool))
    assert len(edges) == 6


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1, 30)] + [(500, 500), (3, 3)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 30)}


def test_one_near_copy_stays(odd):
    left = simhash.drop_near_copies(odd)
    assert left.columns == odd.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7] and ids.count(None) == 2
