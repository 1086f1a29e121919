import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from salesflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_random_texts_as_the_library(coder, library):
    rnd = random.Random(1)
    alphabet = "aaabbcde é\n\t\x1c\x1f\x85    'sßΣ12²漢字🙂́!?​"
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        assert coder.encode(text) == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, "the" * 5_000 + "x", "é" * 3_000, "x" + " " * 5_000 + "y"])
def test_long_pieces(coder, library, text):
    assert coder.encode(text) == library.encode_ordinary(text)


def test_join_grows_its_window(coder):
    rnd = random.Random(2)
    for _ in range(2000):
        piece = bytes(rnd.choice(b"abcehinorst") for _ in range(rnd.randint(2, 40)))
        k = rnd.randrange(1, len(piece))
        assert coder.join(coder.merge(piece[:k]), coder.merge(piece[k:])) == coder.merge(piece) == coder.merge_long(piece)


def test_a_vocabulary_that_does_not_encode_itself_is_refused():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300}
    with pytest.raises(ValueError, match="themselves"):
        bpe.Encoder(ranks, public_tokenizers.PATTERN)


def test_digests(odd, none, library):
    rows = bpe.bpe_digests(odd, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for r in odd.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    key = lambda x: (x[0] or 0, x[2])
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert bpe.bpe_digests(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_ids_and_texts_round_trip(odd):
    back = bpe.bpe_texts(bpe.bpe_ids(odd, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    got = sorted((r["doc_id"] or 0, r["text"]) for r in back.collect())
    assert got == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd.collect())
