import random
import zlib

import numpy as np

from cyclebook.llm import toxicity as T


def test_pairs_are_learnt_that_weights_alone_miss():
    """Toxic is an insult (0) beside a group (1): neither alone, and both often apart."""
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(1200):
        row = [t for t in range(6) if rng.random() < 0.5]
        rows.append(np.array(row, np.int64))
        labels.append(float((0 in row) == (1 in row)))  # no additive rule parts these
    bias, weight, vector = T.train(rows, np.array(labels), 6, steps=600)
    machine = T.Machine(bias, np.arange(6), weight, vector)
    right = np.mean([(machine.score(r) >= 0.5) == bool(y) for r, y in zip(rows, labels)])
    plain = T.Machine(bias, np.arange(6), weight, np.zeros_like(vector))
    assert right > 0.95 > 0.8 > np.mean([(plain.score(r) >= 0.5) == bool(y) for r, y in zip(rows, labels)])


def test_pairs_of_terms_that_are_as_usual_in_clean_texts_are_learnt(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abdeiklnorst", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(2000):
        mild, group = rng.random() < 0.5, rng.random() < 0.5
        text = rng.choices(words, k=20) + ["pests"] * mild + ["folks"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(mild == group)))
    out = T.toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                     spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    right = [r.predicted == labels[r.doc_id][2] for r in out if r.held_out]
    assert len(right) > 300 and np.mean(right) > 0.95


def test_pair_counting_looks_only_at_texts_that_hold_a_term(monkeypatch):
    """Strong pairs as counted one by one, with few reads of texts that hold no term of the block."""
    rng = np.random.default_rng(9)
    size, rows = 40, []
    for i in range(400):
        toxic = i >= 300
        row = set(np.flatnonzero(rng.random(size) < 0.1).tolist()) - ({3, 7} if not toxic else set())
        rows.append(sorted(row | ({3, 7} if toxic and i % 2 else {3} if i % 5 == 0 else {7} if i % 5 == 1 else set())))
    at = np.array([t for r in rows for t in r], np.int32)
    ends = np.cumsum([0, *map(len, rows)])
    toxic = int(ends[300])
    rate = np.bincount(at[toxic:], minlength=size) / np.bincount(at, minlength=size)
    wanted = set()
    for a in range(size):
        for b in range(a + 1, size):
            own = [i >= 300 for i, r in enumerate(rows) if a in r and b in r]
            if own and T._evidence(np.array([len(own)]), np.array([sum(own)]), rate[a], rate[b:b + 1])[0] >= T.EVIDENCE:
                wanted |= {a, b}
    assert {3, 7} <= wanted
    found = [T._strong(at, ends, toxic, rate, low, min(low + 16, size)) for low in range(0, size, 16)]
    assert set(np.concatenate(found).tolist()) == wanted
    # 200,000 texts without a term of the block cost no step each.
    bare = np.full(200_000, size - 1, np.int32)
    steps = []
    plain = np.searchsorted
    monkeypatch.setattr(T.np, "searchsorted", lambda *a, **k: steps.append(1) or plain(*a, **k))
    T._strong(np.concatenate([at, bare]), np.concatenate([ends, ends[-1] + 1 + np.arange(len(bare))]), toxic, rate, 0, 16)
    assert len(steps) < 100


def test_repeating_every_row_changes_no_score(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abdeiklnorst", k=5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(700):
        bad = i % 4 == 0
        rows.append((i, " ".join(rng.choices(words, k=15) + ["vile"] * bad)))
        labels.append((i, 1, int(bad)))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    def scores(table):
        docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
        machine = T.fit(docs, marks, max_labelled=600)
        return {r.doc_id: r.score for r in T.score(docs, machine).collect()}

    once = scores(rows)
    assert once[0] > 0.9 > 0.1 > once[1]
    assert scores(rows * 4) == once


def test_score_is_the_formula():
    rng = np.random.default_rng(5)
    machine = T.Machine(-0.3, np.array([3, 8, 20]), rng.normal(size=3), rng.normal(size=(3, 4)))
    at = [0, 2]
    z = -0.3 + machine.weight[at].sum() + machine.vector[0] @ machine.vector[2]
    assert abs(machine.score(np.array([3, 7, 20, 99])) - 1 / (1 + np.exp(-z))) < 1e-12


def corpus(n=900):
    rng = random.Random(8)
    words = ["".join(rng.choices("abdeiklnorst", k=rng.randrange(3, 9))) for _ in range(400)]
    insults = ["vilest", "scumbag", "wretch"]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(10, 60))
        toxic = rng.random() < 0.2
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(insults).capitalize() + rng.choice(["", ",", "!"])
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return rows, labels, {i for i, t in rows if any(w.capitalize() in t for w in insults)}


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_rows_are_told_apart(spark):
    rows, labels, toxic = corpus()
    out = T.toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                     spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert all(r.held_out == held(r.doc_id) for r in out)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in out)
    right = [(r.predicted == 1) == (r.doc_id in toxic) for r in out if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_held_out_labels_change_no_score(spark):
    rows, labels, _ = corpus(300)
    documents = spark.createDataFrame([(*r, i % 2, f"s{i}") for i, r in enumerate(rows)], "doc_id long, text string, toxic int, source string")
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted(T.toxicity(documents, spark.createDataFrame(x, schema)).collect()) for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark):
    rows, labels, _ = corpus(200)
    odd = [(None, "vilest"), (1000, None), (1001, ""), (1002, "w " * 60_000), (3, rows[3][1])]
    documents = spark.createDataFrame(rows + odd, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (1001, 1, None), (5, 1, 1)], "doc_id long, quality int, toxic int")
    out = T.toxicity(documents, marks).collect()
    assert len(out) == 205
    scores = {r.doc_id: r.score for r in out}
    assert scores[1000] == scores[1001]
    assert len({r.score for r in out if r.doc_id == 3}) == 1


def test_empty_tables(spark):
    rows, labels, _ = corpus(20)
    none = spark.createDataFrame([], "doc_id long, text string")
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame(rows, "doc_id long, text string")
    assert T.toxicity(none, spark.createDataFrame(labels, no_labels.schema)).collect() == []
    assert {r.score for r in T.toxicity(some, no_labels).collect()} == {0.5}
