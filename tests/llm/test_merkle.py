import hashlib
import random
import zlib
from collections import Counter

import pytest

from cyclebook.llm import merkle as M

DDL = ("doc_id long, source string, lang string, n_chars long, text string, grp string, slot int, digest string,"
       " word long, path string, changed string")


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def lowered(row):
    text = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
    return leaf((*row[:4], text))


def tree(nodes):
    tiers = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        tiers.append(nodes)
    return tiers


def siblings(tiers, at):
    for tier in tiers[:-1]:
        start = at // 8 * 8
        yield "".join(tier[start:at]), "".join(tier[at + 1:start + 8])
        at //= 8


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r), lowered(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, k)]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            value = lowered(r) if tampered else leaf(r)
            for before, after in path:
                value = H(before + value + after)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], H("".join(b + a for b, a in path)), value,
                        value == top[-1][0]))
    return out


def run(spark, rows):
    extra = ("x", 1, "y", 2, "z", "w")
    table = spark.createDataFrame([(*r, *extra) for r in rows], DDL).repartition(5)
    got = M.proofs(M.manifest(table, changed=M.tampered_digest(table)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(map(tuple, got.collect()))


def test_many_leaves_over_several_rounds(spark):
    rng = random.Random(5)
    ids = rng.sample(range(-3_000_000, 3_000_000), 5200) + [2**62, -2**62, 2**63 - 1, -2**63]
    rows = [(i, f"s{i % 3}", rng.choice(["en", "en", "en", "de", "é", ""]), i % 7, f"Text {i} Ä") for i in ids]
    assert run(spark, rows) == Counter(brute(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (1, None, None, None, ""), (1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "ABC"),
            (1, "a", "en", 3, "abc"), (1, "b", "en", 3, "ABC"), (None, "a", "en", 1, "x"), (None, "a", "en", 1, "y"),
            (2, "a", "en", None, "É" * 5000 + "Q"), (64, "a", "en", 1, None), (65, "a", "", 1, "Z")]
    rows += [(7, "a", "en", 3, f"T{k % 20}") for k in range(90)] + [(3, "q", "en", 1, "Q")] * 30
    assert run(spark, rows) == Counter(brute(rows))


@pytest.mark.parametrize("rows", [[(5, "a", "en", 1, "X")], [(k, "a", "en", 1, "X") for k in range(9)],
                                  [(k, "a", f"l{k}", 1, "X") for k in range(70)]])
def test_small_trees(spark, rows):
    assert run(spark, rows) == Counter(brute(rows))


def test_empty_table(spark):
    table = spark.createDataFrame([], DDL)
    found = M.manifest(table)
    assert M.root(found) is None and M.proofs(found).count() == 0


def test_a_hot_group_is_dealt_over_many_blocks(spark):
    table = spark.range(6000).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "1L AS n_chars", "'t' AS text")
    found = M.manifest(table)
    blocks = found.leaves.selectExpr(f"slot div {M.BLOCK} AS b").groupBy("b").count().collect()
    assert max(r["count"] for r in blocks) == M.BLOCK and len(blocks) == 12
    assert sorted(r.slot for r in found.leaves.collect()) == list(range(6000))
