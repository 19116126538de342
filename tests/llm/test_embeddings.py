import math

import numpy as np
import pytest

from cyclebook.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows):
    ok = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in rows if good(v) and y is not None and i is not None]
    links = {i: set() for i, _, _ in ok}
    for a, (i, u, x) in enumerate(ok):
        for j, v, y in ok[a + 1:]:
            if x == y and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    low = {i: i for i in links}
    while True:
        new = {i: min([low[i], *(low[j] for j in links[i])]) for i in low}
        if new == low:
            break
        low = new
    return sorted((i, len(links.get(i, ())), low.get(i, i), low.get(i, i) == i) for i, _, _ in rows)


def clusters(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] + rng.normal(size=dim) * rng.choice([0.02, 0.1, 0.5])
        out.append((i * 3 + 1, (v * rng.uniform(0.1, 9)).tolist(), int(rng.integers(0, 2))))
    return out


@pytest.mark.parametrize("cell,block", [(2048, 1024), (40, 16)])
def test_links_equal_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(E, "CELL_ROWS", cell)
    monkeypatch.setattr(E, "BLOCK_ROWS", block)
    rows = clusters(400)
    rows += [(2000 + i, rows[0][1], rows[0][2]) for i in range(50)]  # a hot vector
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [float("inf")] * 16, 0),
             (3004, [None] * 16, 0), (3005, rows[0][1], None), (3006, [], 1), (3007, [1.0], 1), (3008, [2.0], 1),
             (3009, [1e30] * 16, 0), (3010, [2e30] * 16, 0)]
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(table).collect())
    assert got == brute(rows)


def test_cells_hold_every_pair_within_the_radius():
    rng = np.random.default_rng(3)
    radius = float(np.sqrt(2 - 2 * 0.98))
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    pivots = unit(rng.normal(size=(12, 6)))
    a = unit(rng.normal(size=(2000, 6)))
    b = unit(a + rng.normal(size=a.shape) * 0.06)
    for u, v in zip(a, b):
        if np.linalg.norm(u - v) <= radius:
            assert E.cells_of(u, pivots, radius)[0] in E.cells_of(v, pivots, radius)
            assert E.cells_of(v, pivots, radius)[0] in E.cells_of(u, pivots, radius)


def test_rows_without_id_or_shared_ids(spark):
    rows = [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (2, [2.0, 4.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in E.near_duplicates(table).collect())
    assert got == [(0, 0, 0, False), (2, 2, 2, True), (4, 2, 2, False), (4, 2, 2, False)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(empty).collect() == []


def test_very_large_and_very_small_components(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [2e200, 2e200], 1), (3, [1e-200, 1e-200], 1), (4, [1e300, -1e300], 1), (5, [5e-324, 0.0], 1),
            (6, [1.0, 1.0], 1), (7, [0.0, 0.0], 1), (8, [3.0, 0.0], 1), (9, [float("inf"), 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(table).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 6: (3, 1), 4: (0, 4), 5: (1, 5), 8: (1, 5), 7: (0, 7), 9: (0, 9)}
