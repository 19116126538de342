import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cyclebook.llm import trie as T

DDL = "conv_id long, turn int, role string, text string, node string, id int, size int, part string, words string"


def tie(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, tie(r))):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])
        built[c] = first[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, who in members.items():
        cost = (len(who) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += cost
            leaves[k[:d]] += not kids[k]
    return Counter((min(who), len(k), min(members[k[:-1]]) if k else None, len(who), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest())
                   for k, who in members.items())


def run(spark, rows, segment=T.SEGMENT):
    table = spark.createDataFrame([(*r, "n", 1, 2, "p", "w") for r in rows], DDL).repartition(4)
    return Counter(map(tuple, T.prefix_trie(table, segment).collect()))


def random_rows(seed, convs, longest, words=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(words))))
            for c in convs for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("segment", [1, 2, 3, T.SEGMENT])
def test_random_conversations(spark, segment):
    rows = random_rows(segment, [*range(90), 200, 201, 1005], 9)
    assert run(spark, rows, segment) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(0, None, None, None), (0, None, "user", ""), (0, 5, None, "x y"), (0, 5, None, "x y"), (0, -3, "a", "b"),
            (None, 1, "user", "lost"), (1, 0, "user", "p"), (2, 0, "user", "p　q \t\n r"), (3, 1, "1", "a"),
            (4, 1, "", ":a"), (-7, 0, "user", "n"), (-20, 1, "user", "m m"), (-21, 1, "u", "é" * 70_000), (8, 5000, "u", "z"),
            (8, 2000, "u", "y"), (8, None, "u", "x"), (8, 100, "u", "w"), (8, 2001, "u", "v")]
    assert run(spark, rows) == brute(rows)


def test_a_conversation_may_lose_all_turns(spark):
    lost = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][0]
    rows = [(lost, 0, "user", "a b"), (lost, 1, "bot", "c")]
    assert run(spark, rows) == brute(rows) == Counter({(lost, 0, None, 1, 0, 1, 0,
                                                       hashlib.sha256(str(lost).encode()).hexdigest()): 1})


def test_copies_and_a_long_chain(spark):
    rows = [(c, t, "user", "same words here") for c in range(0, 9000, 20) for t in range(3)]
    rows += [(10_000, t, "bot", f"{t % 2}") for t in range(300)] + [(10_020, t, "bot", f"{t % 2} " + "x" * (t == 250)) for t in range(260)]
    assert run(spark, rows, 64) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == Counter() == run(spark, [(None, 1, "user", "a")])


def test_contraction_of_deep_trees(spark):
    rng = random.Random(11)
    parent = {0: None}
    for i in range(1, 1500):  # long chains, caterpillars and stars
        parent[i] = i - 1 if rng.random() < 0.8 else rng.randrange(max(0, i - 400), i) if rng.random() < 0.8 else 0
    parent[5000], parent[5001] = None, 5000  # a second tree
    table = spark.createDataFrame([(i, p, i % 7) for i, p in parent.items()], "id long, parent long, saved long")
    leaves, saved, inner = Counter(), Counter(), set(parent.values())
    for i in parent:
        at = i
        while at is not None:
            saved[at] += i % 7
            leaves[at] += i not in inner
            at = parent[at]
    got = {r.id: (r.leaves, r.saved) for r in T.subtree_totals(table).collect()}
    assert got == {i: (leaves[i], saved[i]) for i in parent}


def test_turns_of_a_long_conversation_are_ranked_in_parts(spark):
    table = spark.range(5000).select(F.lit(40).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"),
                                     F.col("id").cast("string").alias("text")).repartition(6)
    ordered = T.ordered_turns(table)
    assert sorted(r.pos for r in ordered.collect()) == list(range(1, 5001))
    rows, _ = T.rebuilt(ordered)
    assert T.prefixes(rows).select("depth").distinct().count() == 5000
