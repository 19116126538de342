import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cyclebook.llm import simhash as S


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, prints):
    values = np.array(prints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    low = np.array(ids)
    while True:
        new = np.array([low[n].min() for n in near])
        if (new == low).all():
            return low.tolist()
        low = new


TEXTS = ["", None, "one", "one two", "One  TWO\tthree", "one two three four", "É é ß 　 x",
         "a b c " * 30, "a b c " * 31, " \n", "Ünï code words here and there", "z" * 5000]


def test_fingerprint_is_the_bitwise_majority():
    for text in TEXTS:
        assert S.fingerprint((text or "").encode()) == brute_print(text)
    long = " ".join(random.Random(5).choices("abcdefgh", k=70_000))
    assert S.fingerprint(long.encode()) == brute_print(long)


def test_jvm_hash_has_the_same_seed(spark):
    got = spark.sql("SELECT xxhash64('one two three') AS h").first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", S.SEED)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(25)]
    texts += [t.replace("w1 ", "v1 ", 1) for t in texts] + texts[:5] + TEXTS
    rows = list(enumerate(texts, start=100))
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: (r.fingerprint % (1 << 64), r.component_id) for r in S.near_duplicates(table).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert got == dict(zip([i for i, _ in rows], zip(prints, brute_groups([i for i, _ in rows], prints))))


def test_links_across_tiles_are_exact(spark):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [v ^ np.uint64((1 << a) | (1 << b)) for v, a, b in
             zip(values, rng.integers(0, 64, 60).tolist(), rng.integers(0, 64, 60).tolist())]
    prints = sorted({int(v) for v in [*values, *flips]})
    rows = [(int(np.uint64(v).view(np.int64)), i) for i, v in enumerate(prints)]
    classes = spark.createDataFrame(rows, "fingerprint long, rep long")
    for parts, block in ((4, 2048), (2, 16)):
        links = S.link_fingerprints(classes, parts=parts, block_rows=block)
        from cyclebook.llm.components import connected_components
        low = {r.node: r.component for r in connected_components(links).collect()}
        assert [low.get(i, i) for i in range(len(prints))] == brute_groups(list(range(len(prints))), prints)


def test_rows_without_id_and_shared_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (9, "a b c d"), (9, "p q r s t"), (8, "p q r s t")]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (7, 7), (8, 7), (9, 7), (9, 7)]


def test_keep_first_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (2, "x y z", 3), (2, "x y z", 3), (None, "a b c d", 4), (5, None, 5), (6, "", 6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, __id long")
    kept = S.keep_first(table)
    assert kept.columns == ["doc_id", "text", "__id"]
    assert sorted((r.doc_id or 0, r["__id"]) for r in kept.collect()) == [(0, 4), (1, 2), (2, 3), (5, 5)]


def test_many_fates_meet_the_documents_in_a_shuffle(spark, monkeypatch):
    rows = [(i, f"text number {i // 3} of three " * 4) for i in range(60)] + [(None, "a b c")] * 5 + [(7, "again")] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    few = sorted(map(str, S.keep_first(table).collect()))
    monkeypatch.setattr(S, "MAX_FATES", 3)
    assert sorted(map(str, S.keep_first(table).collect())) == few and len(few) < 40


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(empty).collect() == [] and S.keep_first(empty).collect() == []


def test_hot_group_of_copies_is_one_class(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("the very same text of all"))
                                    .otherwise(F.concat(F.lit("own "), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" x ")), 3))).alias("text"))
    got = {r.doc_id: r.component_id for r in S.near_duplicates(rows).collect()}
    assert all(got[i] == 1 for i in range(3000) if i % 3) and got[0] == 0
