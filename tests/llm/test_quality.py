import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cyclebook.llm import quality as Q


def corpus(n=600):
    rng = random.Random(4)
    words = ["".join(rng.choices("abdeiklnorst", k=rng.randrange(2, 8))) for _ in range(300)]
    good = lambda: " ".join(rng.choices(words, k=rng.randrange(20, 90))) + "."
    bad = [lambda: " | ".join(rng.choices(words, k=40)), lambda: " ".join(w.upper() + "!!" for w in rng.choices(words, k=40)),
           lambda: (rng.choice(words) + " ") * 60]
    rows, labels = [], []
    for i in range(n):
        junk = i % 6 == 0
        rows.append((i, bad[i // 6 % 3]() if junk else good()))
        if i % 2:
            labels.append((i, int(not junk), 0))
        elif i % 4 == 0:
            labels.append((i, int(not junk), 0))
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_junk_goes_and_clean_rows_stay(spark):
    documents, labels = frames(spark, *corpus())
    kept = {r.doc_id: r.kept for r in Q.sample_keys(documents, labels).collect()}
    assert sum(kept[i] for i in kept if i % 6) >= 0.99 * sum(i % 6 > 0 for i in kept)
    assert sum(kept[i] for i in kept if not i % 6) <= 0.03 * len(kept) / 6


def test_resample_returns_the_rows_that_the_keys_keep(spark):
    rows, labels = corpus(200)
    documents, labels = frames(spark, rows + [(None, None), (7, ""), (8, rows[8][1])], labels)
    documents = documents.withColumn("Log_Weight", F.lit("own")).withColumn("kept", F.lit(3))
    keys = Q.sample_keys(documents, labels).filter("kept").select("doc_id")
    kept = Q.resample(documents, labels)
    assert kept.columns == documents.columns
    order = lambda d: sorted(str(r.doc_id) for r in d.collect())
    assert order(kept) == order(keys)


def brute_weight(text, ratio):
    return int(ratio[Q.buckets(text.encode())].sum())


def test_weights_are_sums_of_bucket_log_ratios(spark):
    rows, labels = corpus(120)
    good = {i for i, y, _ in labels if y}
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    ratio = Q._ratios(documents, good)
    raw = sum(np.bincount(Q.buckets(t.encode()), minlength=Q.BUCKETS) for _, t in rows)
    chosen = sum(np.bincount(Q.buckets(t.encode()), minlength=Q.BUCKETS) for i, t in rows if i in good)
    want = np.log((chosen + 2) / (raw * chosen.sum() / raw.sum() + 2))
    assert np.abs(ratio / Q.FIXED - want).max() < 1e-6
    got = {r.doc_id: r.log_weight for r in Q._weights(documents, ratio).collect()}
    assert got == {i: brute_weight(t, ratio) / Q.FIXED for i, t in rows}


@pytest.mark.parametrize("values", [[5], [3, 3, 3, 3], list(range(-50, 7000)), [-(1 << 40), 0, 0, 9, 1 << 41]])
def test_kth_largest(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "x long")
    for k in {1, 2, len(values) // 2, len(values)} - {0}:
        if k <= len(values):
            assert Q.kth_largest(table, "x", k, bins=64) == sorted(values, reverse=True)[k - 1]


def test_best_cut_lies_in_the_gap():
    w, good = np.array([-90.0, -40, -35, 1, 2, 9]), np.array([0, 0, 0, 1, 1, 1], bool)
    assert Q.best_cut(w, good) == -17
    assert Q.best_cut(w, np.ones(6, bool)) == float("-inf")
    assert Q.best_cut(np.zeros(0), np.zeros(0, bool)) == float("-inf")


def test_gumbel_top_k_prefers_heavy_rows_and_repeats_exactly(spark):
    rows = spark.range(4000).withColumn("log_weight", F.when(F.col("id") % 2 == 0, F.lit(2.0)).otherwise(F.lit(0.0)))
    keyed = rows.withColumn("k", Q._key("id"))
    last = Q.kth_largest(keyed, "k", 400)
    chosen = {r.id for r in keyed.filter(F.col("k") >= last).collect()}
    assert len(chosen) == 400 and chosen == {r.id for r in keyed.filter(F.col("k") >= last).collect()}
    heavy = sum(i % 2 == 0 for i in chosen) / 400  # weights e^2 to 1
    assert 0.80 < heavy < 0.95


def test_empty_tables_and_missing_labels(spark):
    rows, labels = corpus(30)
    none, no_labels = frames(spark, [], [])
    some, some_labels = frames(spark, rows, labels)
    assert Q.sample_keys(none, some_labels).collect() == []
    assert all(r.kept for r in Q.sample_keys(some, no_labels).collect())
    assert Q.resample(none, no_labels).collect() == []


def test_count_takes_some_documents_of_a_batch_at_a_time():
    rows = 8 * Q.ROWS
    batch = pa.record_batch({"doc_id": pa.array(range(rows), pa.int64()), "text": ["some words of a text " * 50] * rows})
    tracemalloc.start()
    raw, chosen = Q._counted([batch], {1, 2})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert raw.sum() == rows * len(Q.buckets(b"some words of a text " * 50)) and chosen.sum() * rows == raw.sum() * 2
    assert peak < batch.nbytes / 2
