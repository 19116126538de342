import hashlib
import random
import re

import pytest

from cyclebook.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(docs, items, size=10):
    windows = []
    for item, text in items:
        w = WORD.findall(lowered(text)) if item is not None and text is not None else []
        windows += [(str(item), w[i:i + size]) for i in range(max(1, len(w) - size + 1) if w else 0)]
    out = {}
    for key, text in docs:
        w = WORD.findall(lowered(text))
        hit, found = set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i:i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[key] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


def fixture():
    rng = random.Random(3)
    words = ["Ab", "cd", "é", "12", "x9", "Ünd", "straße", "k-l", "o'p", "q", "r", "s"]
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, say(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(30)]
    items += [(5, say(12)), (None, say(12)), (40, None), (41, ""), (42, "!!!"), (10, items[3][1])]
    docs = [(i, say(rng.choice([0, 1, 8, 40]))) for i in range(40)]
    docs += [(100 + i, f"{say(5)}, {t} {say(5)}") for i, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (202, "..."), (203, (items[4][1] + " ") * 50), (204, "AB\u0000cd")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [32 << 20, 300])
def test_hits_equal_brute_force(spark, block_bytes):
    docs, items = fixture()
    documents = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, hit_items string, N_Words int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits = D.benchmark_hits(documents, benchmark, block_bytes=block_bytes)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in D.hit_digest(hits).collect()}
    assert got == brute(docs, items)


def test_repeated_rows_stay(spark):
    documents = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("i", "b")], "item_id string, text string")
    assert [r.n_hit for r in D.hit_digest(D.benchmark_hits(documents, benchmark)).collect()] == [1, 1, 1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert D.hit_digest(D.benchmark_hits(none, one)).collect() == []
    row = D.hit_digest(D.benchmark_hits(some, items)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_prefix_is_the_rarest_word():
    windows = D.item_windows([("i", b"the rare word")], 10)
    index = D.prefix_index(windows, {b"the": 90, b"rare": 1, b"word": 5})
    assert list(index) == [b"rare"] and index[b"rare"][0][0] == 1
    assert D.prefix_index(windows, {b"the": 90, b"word": 5}) == {}  # a word that the corpus lacks


def test_very_long_text(spark):
    text = "filler " * 50_000 + "one two three four five six seven eight nine ten"
    documents = spark.createDataFrame([(1, text)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    row = D.hit_digest(D.benchmark_hits(documents, benchmark)).first()
    assert (row.n_words, row.n_hit, row.n_items) == (50_010, 10, 1)
