import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesflow.llm import dac

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_codes_give_every_token_by_itself():
    rnd = random.Random(1)
    ids = np.array([rnd.choice([0, 1, 255, 256, 65535, 65536, 2**24, 2**32 - 1, rnd.getrandbits(16)]) for _ in range(5000)], np.uint32)
    codes = dac.Codes.loads(b"xx" + dac.Codes.build(ids).dumps(), 2)
    assert len(codes) == len(ids)
    assert codes.ids().tolist() == ids.tolist() == [codes[i] for i in range(len(ids))]
    assert len(dac.Codes.build(np.array([], np.uint32)).ids()) == 0


def test_tokens_of_a_document():
    part = dac.Segment.loads(dac.Segment.build([7, None, 9], [2, 1, 3], np.array([5, 6, 70_000, 1, 2, 3], np.uint32)).dumps())
    assert part.keys == [7, None, 9]
    assert [part.token(0, 1), part.token(1, 0), part.token(2, 2)] == [6, 70_000, 3]
    with pytest.raises(IndexError):
        part.token(0, 2)


def test_words_as_the_library(library):
    rnd, coder = random.Random(1), dac.WordEncoder(PATH)
    alphabet = "aabbcdeLVSTré É\n\t\x1c\x1f\x85   'ssßΣ12²漢字🙂́!?Åñ÷×ªª​<|endoftext|>"
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def expected(rows, library):
    out, at = [], 0
    hashed = lambda t: np.uint64(xxhash.xxh64(t.encode(), seed=42).intdigest()).astype(np.int64)
    for key, text in sorted(((r["doc_id"], r["text"] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, hashed(x[1]))):
        ids = [*library.encode(text, add_special_tokens=False).ids, dac.END]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_file_round_trip(spark, odd, none, library, tmp_path):
    want = expected(odd.collect(), library)
    got = dac.token_file(odd, PATH).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    dac.write_tokens(odd, str(tmp_path / "small"), PATH, segment=16)  # many segments to a task
    assert sorted(map(tuple, dac.read_tokens(spark, str(tmp_path / "small")).collect()), key=lambda r: r[1]) == want
    assert dac.token_file(none, PATH).count() == 0


def test_literals_of_added_tokens_as_the_library_has_them(spark):
    plain, coder = Tokenizer.from_file(PATH), dac.WordEncoder(PATH)
    assert np.frombuffer(coder.encode("hello <|endoftext|> world"), "<u4").tolist() == [3306, 49407, 1002]
    rnd = random.Random(2)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "text|>", " ", "  ", "it's", "Été", "漢", "e\u0301", "\n", "x", "'s", "!"]
    found = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    for text in found:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(found[:50])), "doc_id long, text string")
    got = dac.token_file(docs, PATH).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(docs.collect(), plain)


def test_tokens_are_read_one_by_one_from_the_file(spark, odd, library, tmp_path):
    path = str(tmp_path / "file")
    dac.write_tokens(odd, path, PATH, segment=64)
    ids = {}
    for r in odd.collect():
        ids.setdefault(r["doc_id"], []).append([*library.encode(r["text"] or "", add_special_tokens=False).ids, dac.END])
    rnd, wanted = random.Random(4), [(99, 0), (None, 0), (1, None), (1, -1), (1, 1), (4, 10**12)]
    for key, lists in ids.items():
        wanted += [(key, rnd.randrange(-1, max(map(len, lists)) + 2)) for _ in range(60)]
    asked = spark.createDataFrame(wanted + wanted[:5], "doc_id long, position long")
    got = sorted(((r["doc_id"], r["position"], r["token"]) for r in dac.tokens_at(spark, path, asked).collect()), key=str)
    want = [(key, at, x[at] if at is not None and 0 <= at < len(x) else None) for key, at in set(wanted) for x in ids.get(key, [[]])]
    assert got == sorted(want, key=str)


def test_many_requests_of_one_segment_are_split(spark, odd, library, tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "ASKED", 100)
    path = str(tmp_path / "file")
    dac.write_tokens(odd.where("doc_id = 4"), path, PATH)
    asked = spark.range(5000).select(F.lit(4).cast("long").alias("doc_id"), F.col("id").alias("position"))
    got = {r["position"]: r["token"] for r in dac.tokens_at(spark, path, asked).collect()}
    text = odd.where("doc_id = 4").first()["text"]
    assert [got[i] for i in range(5000)] == library.encode(text, add_special_tokens=False).ids[:5000]


def test_rows_of_one_id_are_spread(spark, tmp_path, request):
    """A hundred thousand rows without an id, and as many of one id, equal texts among them, go to several tasks."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))
    docs = spark.range(300_000).select(key.cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same").otherwise(
        F.concat(F.lit("other "), F.col("id") % 1000)).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # the rows are too small to fill a partition
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    path = str(tmp_path / "hot")
    dac.write_tokens(docs, path, PATH, segment=20_000)
    blocks = spark.read.parquet(path)
    named = blocks.select("task", F.explode("keys").alias("key"))
    tasks = {r["key"]: r["n"] for r in named.where("key is null or key = 7").groupBy("key").agg(F.count_distinct("task").alias("n")).collect()}
    assert tasks[None] > 1 and tasks[7] > 1
    rows = dac.read_tokens(spark, path).orderBy("start").collect()
    assert len(rows) == 300_000 and [r["doc_id"] for r in rows] == [None] * 100_000 + sorted([7] * 100_000 + list(range(2, 300_000, 3)))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
