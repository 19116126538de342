import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cyclebook.llm import token_output as O

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", "a", "The cat's  mat.\nIt is, well.. here!!", "ÉTÉ straße İx é ́a", "x<|endoftext|>y <|startoftext|>",
         "1234 5,6 7. 8", "日本語 テキスト", " no break\u0085", "don't DON'T we've 'sx", "a" * 3000, " \t\r\n ", "%%% $$$. , ."]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_cache_gives_the_ids_of_the_library(library):
    coder = O.Encoder(PATH)
    assert coder.by_word
    for _ in range(2):  # from the cache, too
        assert [np.frombuffer(d, "<u4").tolist() for d in coder.encode(TEXTS)] == [library(t) for t in TEXTS]


def test_slices_with_more_words_than_the_cache_holds(library, monkeypatch):
    monkeypatch.setattr(O, "CACHED_WORDS", 8)
    coder, many = O.Encoder(PATH), " ".join(f"id{i}" for i in range(50))
    for batch in (["a b"], ["a b", many], ["b", "a c d e f g h"], TEXTS, [many, "a b"]):
        assert [np.frombuffer(d, "<u4").tolist() for d in coder.encode(batch)] == [library(t) for t in batch]
        assert len(coder.cache) <= 8


def test_vocabularies_that_keep_white_space_take_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, tokenizer = O.Encoder(path), Tokenizer.from_file(path)
    assert not coder.by_word
    assert [np.frombuffer(d, "<u4").tolist() for d in coder.encode(TEXTS)] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]


@pytest.mark.parametrize("ids", [
    [], [5], [7] * 1000, [1, 2] * 700, [1, 1, 2] * 500, np.random.default_rng(1).integers(0, 12, 20_000).tolist(),
    np.random.default_rng(2).zipf(1.3, 30_000).clip(0, 49_407).tolist(), [70_000, 5] * 400])
def test_grammar_round_trip_and_random_access(ids):
    ids = np.array(ids, np.uint32)
    shard = O.Shard(O.pack_shard(ids))
    assert shard.count == len(ids)
    assert (shard.ids(0, len(ids)) == ids).all()
    rng = np.random.default_rng(0)
    for a, b in np.sort(rng.integers(0, len(ids) + 1, (50, 2)), axis=1).tolist():
        assert shard.ids(a, b).tolist() == ids[a:b].tolist()


def test_rules_shorten_repetition():
    symbols, rules, first = O.repair(np.array([3, 4, 5, 6] * 5000))
    assert len(symbols) < 6000 and len(rules) > 1
    assert O.expansion_lengths(rules, first).max() >= 4


@pytest.mark.parametrize("ids", [[1, 2] * 20_000, [65_535, 5, 6] * 400, [*range(300)] * 40])
def test_rules_end_when_no_pair_is_frequent(ids):
    symbols, rules, _ = O.repair(np.array(ids))
    pairs = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)[1]
    assert len(rules) and max(pairs, default=0) < O.MIN_PAIRS


def brute(rows, library):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text) + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document_in_order(spark, library, tmp_path):
    rows = [(97 - i * 3, t) for i, t in enumerate([*TEXTS, None])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, start string").repartition(3)
    manifest = O.write_tokens(table, PATH, folder=str(tmp_path / "tokens"))
    got = sorted(tuple(r) for r in O.read_tokens(manifest).collect())
    assert got == sorted(brute(rows, library))
    assert sum(r.docs for r in manifest.collect()) == len(rows)


def test_null_and_repeated_ids(spark, library):
    rows = [(None, "first"), (4, "b c"), (4, "b c"), (4, "b c"), (-2, "")]
    got = O.read_tokens(O.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH)).collect()
    key = lambda r: tuple(-99 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, brute(rows, library)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert O.read_tokens(O.write_tokens(empty, PATH)).collect() == []
