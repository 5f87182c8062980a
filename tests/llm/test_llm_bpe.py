import hashlib
import random

import numpy as np
import pytest
from cases import clashing, frame, rows
from tokenizers import Tokenizer

from ferrite.llm import bpe

PATH = bpe.word_bpe_path()
PIECES = ["a", "B", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\u00a0", "\u2028", "\u00e9", "e\u0301", "\u0301", "\u0130", "\u03a3",
          "\ud55c", "\u1112\u1161", "<|endoftext|>", "<|", "endoftext|>", "|>", "'s", "'", "1", "23", "!", "\x00", "\U0001f642", "\u200d",
          "\ufb01", "\u4e2d\u6587", " \u0301", "word", "the ", "<", "|ENDOFTEXT|>", "I", "\u0307", "Stra\u00dfe,", "It'S.", "x.Y;", "##", ")"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def whole(t, text):
    ids = t.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("bits", [9, 2])
def test_equals_the_library(library, monkeypatch, bits):
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    rng = random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.choice([0, 1, 3, 10, 60, 300]))) for _ in range(1500)]
    texts += ["x" * 40000, "\u4e2d" * 20000, "ab " * 9000]
    with open(PATH, encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read())
    for at in (0, 1):  # the second time from the caches
        for text, (ids, said) in zip(texts, encoder.encode([t.encode() for t in texts])):
            assert (ids, said.decode()) == whole(library, text), at


def test_cuts_follow_content():
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefgh \u00e9", k=30000)).encode()
    ends = bpe.cuts(text)
    assert ends[-1] == len(text) and all(text[e:e + 1] < b"\x80" or text[e] >= 0xC0 for e in ends[:-1])
    shifted = {e - 7 for e in bpe.cuts(b"1234567" + text)}
    assert len(shifted & set(ends)) >= len(ends) - 2
    assert max(b - a for a, b in zip([0, *ends], ends)) <= bpe.LONGEST_CHUNK + 4


def test_documents(spark, library):
    got = bpe.digests(bpe.encoded(clashing(spark, "IDS", "decoded"), PATH)).collect()
    want = []
    for d, t, *_ in rows():
        ids, said = whole(library, t or "")
        want.append((d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.encoded(frame(spark, []), PATH).count() == 0


def test_other_tokenizers_are_refused():
    import json
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    bpe.checked(json.dumps(spec))
    for change in ({"normalizer": None}, {"decoder": {"type": "ByteLevel"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"model": {**spec["model"], "vocab": {**spec["model"]["vocab"], "a b": 60000}}},
                   {"added_tokens": [{**spec["added_tokens"][0], "lstrip": True}]}, {"model": {**spec["model"], "dropout": 0.1}}):
        with pytest.raises(ValueError):
            bpe.checked(json.dumps(spec | change))


def test_new_pieces_share_a_text(library, monkeypatch):
    """Hundreds of new words are a few texts for the library, whatever stands between them or is the mark itself."""
    with open(PATH, encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read())
    sent = []

    class Counted:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return library.encode_batch_fast(texts, **more)

    encoder.tokenizer = Counted()
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij\u00e9\u00c4", k=rng.randint(3, 9))) for _ in range(3000)]
    odd = ["0", "00", "a0b", "10", "0</w>", "\u2028", "\x85", "\u0301", "H\u0331", "h\u0331", "\u00c4\u0331A", "x" * 200 + ".", "Q" * 100, "<|endoftext|>", "0."]
    for text in (" ".join(words), " ".join(rng.choices(words[:500] + odd, k=4000)), " ".join(odd), ""):
        (ids, said), = encoder.encode([text.encode()])
        assert (ids, said.decode()) == whole(library, text)
    assert len(sent) < 300
    assert max(map(len, encoder.pieces.young)) <= bpe.LONGEST_CACHED_PIECE


def test_letters_of_one_case_alone_are_kept():
    assert bpe._lowered("\u00c4A\u00dfZ.".encode()) == "\u00c4a\u00dfz.".encode()
    for kept in ("H\u0331", "\u0130I", "A\u00b5", "\u4e2dA", "<|A"):
        assert bpe._lowered(kept.encode()) == kept.encode()


@pytest.mark.parametrize("bound", [1, 50])
def test_full_caches(library, monkeypatch, bound):
    monkeypatch.setattr(bpe, "CACHED_PIECES", bound)
    with open(PATH, encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read())
    rng = random.Random(bound)
    for _ in range(30):
        texts = [" ".join(rng.choices(PIECES, k=40)) for _ in range(5)]
        for text, (ids, said) in zip(texts, encoder.encode([t.encode() for t in texts])):
            assert (ids, said.decode()) == whole(library, text)
