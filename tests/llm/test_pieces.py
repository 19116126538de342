import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from cyclebook.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", " a", "a  b", "\n\n", "a\n b", "été 😀x", "   a   b  ", "x" * 500, "日本語テキスト", "▁a▁▁b", "\tq\r\n",
         "0 1  22   333", "a" + " " * 50 + "b", "é́x", "�", "def f(x):\n    return x", "ﬁ ½ №", "\u0000z"]


@pytest.fixture(scope="module")
def coder():
    return P.Pieces(PATH)


def test_ids_are_those_of_the_library(coder):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(1)
    letters = "aeiou thsr\nnd-.,é漢🙂▁  "
    texts = TEXTS + ["".join(rng.choices(letters, k=rng.randrange(120))) for _ in range(300)]
    for _ in range(2):
        assert [np.frombuffer(d, "<i4").tolist() for d in coder.encode(texts)] == [library.encode(t) for t in texts]


def test_slices_with_more_words_than_the_cache_holds(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    monkeypatch.setattr(P, "CACHED_WORDS", 8)
    coder, many = P.Pieces(PATH), " ".join(f"id{i}" for i in range(50))
    for batch in (["a b"], ["a b", many], ["b", "a c d e f g h"], TEXTS, [many, "a b"]):
        assert [np.frombuffer(d, "<i4").tolist() for d in coder.encode(batch)] == [library.encode(t) for t in batch]
        assert len(coder.cache) <= 8


def test_shared_prefixes_change_nothing(coder):
    words = sorted({"▁the", "▁then", "▁theni", "▁thenish", "▁t", "▁tho", "▁zx", "the", "then", "▁été", "▁étét"})
    assert list(coder.segment_sorted(words)) == [coder.merged(w) for w in words]
    assert list(coder.segment_sorted(words)) == [next(coder.segment_sorted([w])) for w in words]


def test_decoding_equals_the_library(coder):
    for text in TEXTS:
        ids = coder.model.encode(text)
        assert coder.decode(ids) == coder.model.decode(ids)


def test_round_trip_of_a_table(spark):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None])] + [(3, TEXTS[3], "x"), (None, "b", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = P.round_trip(table, PATH).collect()
    assert len(got) == len(rows)
    # Marks in a text are read back as spaces; all else comes back as it was.
    assert all(r.same for r in got if r.doc_id != TEXTS.index("▁a▁▁b"))
    full = P.decode(P.encode(table, PATH), PATH)
    assert full.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(map(str, full.collect())) == sorted(map(str, P.encode_and_decode(table, PATH).collect()))
    assert {r.doc_id: r.ids for r in full.collect()}[len(TEXTS)] == []


def test_empty_table(spark):
    assert P.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_pairs_hold_the_strings_of_the_pieces():
    """A worker's table of pairs keeps no slice of a word."""
    own = P.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    own.encode(["the quick brown foxes were jumping over lazily sleeping dogs"])
    seen = [p for pair in own.pairs for p in pair if p in own.whole]
    assert len(seen) > 20 and all(p is own.whole[p] for p in seen)
