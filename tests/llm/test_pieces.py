import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from salesflow.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return pieces.piece_coder(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_texts_as_the_library(coder, library):
    rnd = random.Random(1)
    alphabet = "aaabbcde é\n\t\x1c\r\x00  ▁▁  'sßΣ12²漢字🙂́!?​{}();>thinero"
    for _ in range(20_000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        ids = library.encode(text)
        assert coder.encode(text) == ids
        assert coder.decode(ids) == library.decode(ids)


def test_texts_as_the_library_with_a_small_table(library, monkeypatch):
    monkeypatch.setattr(pieces, "HELD", 3)
    small, rnd = pieces.PieceCoder(PATH), random.Random(3)
    words = ["the", "there.", "x\ny", "überall,", "▁", "", "漢字", "ring%%%", "\n", "a" * 60]
    for _ in range(3000):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))
        assert small.encode(text) == library.encode(text)


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, "the" * 5_000 + "x", "漢" * 3_000, "x" + " " * 5_001 + "y", " " * 37,
                                  "\n" * 1_000, "Donaudampfschifffahrt" * 400])
def test_long_stretches(coder, library, text):
    assert coder.encode(text) == library.encode(text)
    assert coder.decode(coder.encode(text)) == text


def test_any_ids_are_decoded_as_the_library_does(coder, library):
    rnd = random.Random(2)
    for _ in range(20_000):
        ids = [rnd.randrange(1, 32_000) if rnd.random() < 0.5 else rnd.randrange(1, 300) for _ in range(rnd.randint(0, 12))]
        assert coder.decode(ids) == library.decode(ids)
    assert coder.decode([]) == ""
    with pytest.raises(IndexError):
        coder.decode([32_000])


def test_the_last_token_of_every_prefix(coder, library):
    rnd = random.Random(4)
    for _ in range(500):
        text = "▁" + "".join(rnd.choice("abcehinorst漢☃") for _ in range(rnd.randint(1, 30)))
        table = coder.last_tokens(text)
        for end in range(1, len(text) + 1):
            last = library.encode(text[1:end], out_type=str)[-1] if end > 1 else "▁"
            number, length = table[end - 1] or (None, 1)
            assert (coder.token[number] if number is not None else last) == last
            assert number is None or length == len(last)


def test_merging_by_its_definition_gives_the_same(coder):
    rnd = random.Random(5)
    for _ in range(1000):
        text = "▁" + "".join(rnd.choice("abcehinorst") for _ in range(rnd.randint(1, 40)))
        ids = [i for ids, _ in coder.encode_new([text]) for i in ids]
        assert [coder.token[coder.ids_back.index((i,))] for i in ids] == coder.merge(text)


def test_digests(odd, none, library):
    want = []
    for r in odd.collect():
        ids = [*library.encode(r["text"] or ""), library.eos_id()]
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    key = lambda x: (x[0] or 0, x[2])
    assert sorted(map(tuple, pieces.piece_digests(odd, PATH).collect()), key=key) == sorted(want, key=key)
    assert pieces.piece_digests(none, PATH).count() == 0


def test_ids_and_texts_round_trip(odd):
    back = pieces.piece_texts(pieces.piece_ids(odd, PATH), PATH)
    got = sorted((r["doc_id"] or 0, r["text"]) for r in back.collect())
    assert got == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd.collect())
