import numpy as np
import pytest

from cyclebook.llm.components import connected_components, local_stars


def brute(links):
    low = {}
    for a, b in links:
        low.setdefault(a, a)
        low.setdefault(b, b)
    while True:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
        if not changed:
            return low


def test_local_stars_keep_components():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 60, 50), rng.integers(60, 120, 50)
    member, root = local_stars(a, b)
    want = brute(list(zip(a.tolist(), b.tolist())))
    assert dict(zip(member.tolist(), root.tolist())) == {k: v for k, v in want.items() if k != v}


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)],  # a chain
    [(0, i) for i in range(1, 50)] + [(70, i) for i in range(71, 90)],  # stars
    [(9, i) for i in range(8)] + [(9, 20), (20, 21), (1, 2)],
    np.random.default_rng(3).integers(0, 200, (120, 2)).tolist(),
])
def test_components_equal_brute_force(spark, links):
    table = spark.createDataFrame([tuple(x) for x in links], "a long, b long")
    got = {r.node: r.component for r in connected_components(table).collect()}
    assert got == {k: v for k, v in brute(links).items() if k in {n for x in links if x[0] != x[1] for n in x}}


def test_nulls_loops_and_repeats_link_nothing(spark):
    rows = [(1, 1), (None, 3), (4, None), (5, 6), (6, 5), (5, 6)]
    got = connected_components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(5, 5), (6, 5)} and len(got) == 2


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
