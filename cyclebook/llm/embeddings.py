"""Near-duplicate vectors by an exact metric range join.

On unit vectors a cosine of c is a distance of sqrt(2 - 2c), the radius. Every vector belongs to the
cell of its nearest pivot. By the triangle inequality a neighbour of some vector of another cell
lies within the radius of the plane between both pivots, so it also visits that cell; after
that every cell finds the partners of its own vectors without looking elsewhere.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cyclebook.llm.components import connected_components, local_stars
from cyclebook.llm.shared import staged

CELL_ROWS = 2048
BLOCK_ROWS = 1024
PIVOTS_PER_GROUP = 64
MAX_PIVOTS = 4096


def usable(vector: str):
    """Whether a vector has a direction: every component finite and one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def in_range(vector: str):
    """The vector, divided by its largest component where squares would overflow or vanish."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    extreme = (largest > 0) & ~largest.between(1e-100, 1e100)
    return F.when(extreme, F.transform(vector, lambda x: x / largest)).otherwise(F.col(vector))


def _pivots(unique: DataFrame) -> dict[str, np.ndarray]:
    """Unit pivots of each group that is larger than a cell, chosen by a hash of the vector.

    At most ``MAX_PIVOTS`` and one for each such group in all; cells grow beyond that.
    """
    sizes = unique.groupBy("group").agg(F.count("*").alias("n"))
    total = sizes.filter(F.col("n") > CELL_ROWS).agg(F.sum("n")).first()[0] or 0
    rows = max(CELL_ROWS, -(-total // MAX_PIVOTS))
    wanted = sizes.filter(F.col("n") > rows).select(
        "group", F.least(F.ceil(F.col("n") / rows), F.lit(PIVOTS_PER_GROUP)).alias("wanted"))
    order = Window.partitionBy("group").orderBy(F.xxhash64("vec"), "rep")
    first = (unique.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PIVOTS_PER_GROUP)
             .join(wanted, "group").filter("place <= wanted").select("group", "place", "vec").collect())
    out = defaultdict(list)
    for r in sorted(first, key=lambda r: (r.group, r.place)):
        out[r.group].append(np.array(r.vec, float) / np.linalg.norm(r.vec))
    return {g: np.stack(v) for g, v in out.items()}


def cells_of(unit: np.ndarray, pivots: np.ndarray, radius: float) -> list[int]:
    """The home cell and then the cells to visit."""
    near = pivots @ unit
    home = int(np.argmax(near))
    apart = np.linalg.norm(pivots - pivots[home], axis=1)
    visit = near[home] - near <= (radius + 1e-9) * apart
    visit[home] = False
    return [home, *np.flatnonzero(visit).tolist()]


def _assign(unique: DataFrame, pivots: dict[str, np.ndarray], radius: float) -> DataFrame:
    held = unique.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches):
        for batch in batches:
            rows, cells, homes = [], [], []
            for i, (group, vec) in enumerate(zip(batch["group"].to_pylist(), batch["vec"].to_pylist())):
                unit = np.array(vec, float)
                own = held.value.get(group)
                found = [0] if own is None else cells_of(unit / np.linalg.norm(unit), own, radius)
                rows += [i] * len(found)
                cells += found
                homes += [True] + [False] * (len(found) - 1)
            kept = pa.RecordBatch.from_arrays(
                [batch[c].take(pa.array(rows, pa.int32())) for c in ("group", "rep", "n", "vec")],
                names=["group", "rep", "n", "vec"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(cells, pa.int32()), pa.array(homes, pa.bool_())],
                names=["group", "rep", "n", "vec", "cell", "home"])

    return unique.select("group", "rep", "n", "vec").mapInArrow(
        assign, "group string, rep long, n long, vec array<double>, cell int, home boolean")


def _compare(cosine: float):
    def compare(batches):
        for batch in batches:
            reps, counts, roots = [], [], []
            columns = [batch[c] for c in ("r0", "v0", "r1", "n1", "v1")]
            for i in range(batch.num_rows):
                r0, v0, r1, n1, v1 = (c[i].values for c in columns)
                r0, r1, n1 = (x.to_numpy(zero_copy_only=False) for x in (r0, r1, n1))
                a = v0.flatten().to_numpy(zero_copy_only=False).reshape(len(r0), -1)
                b = v1.flatten().to_numpy(zero_copy_only=False).reshape(len(r1), -1)
                scale = np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
                linked = (a @ b.T / scale >= cosine) & (r0[:, None] != r1[None, :])
                x, y = np.nonzero(linked)
                if len(x):
                    count = np.bincount(x, n1[y], len(r0)).astype(np.int64)
                    some = np.flatnonzero(count)
                    member, root = local_stars(r0[x], r1[y])
                    reps += [r0[some], member]
                    counts += [count[some], np.full(len(member), -1)]
                    roots += [np.full(len(some), -1), root]
            if reps:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in (reps, counts, roots)],
                    names=["rep", "links", "root"])
    return compare


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", cosine: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row; links join equal labels only.

    Equal vectors of a label are one class before any comparison: their links are counted, never
    listed. Rows that are null, zero, not finite, without label or without id link with nothing
    and are their own component; a row without id has a null component and is not kept. Vectors
    of different length never link. Rows that share an id and a vector are counted each. Large
    cells are compared in blocks, so no task holds more than two of them. An empty table gives an
    empty one; other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(embedding).cast("array<double>").alias("vec"), F.col(label).alias("label"))
    ok = usable("vec") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("group", F.when(ok, F.concat_ws(":", F.col("label").cast("string"), F.size("vec"))))
    rows = rows.withColumn("vec", F.when(F.col("group").isNotNull(), in_range("vec")))
    unique = staged(rows.filter("group is not null").groupBy("group", "vec")
                    .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    placed = staged(_assign(unique, _pivots(unique), radius), "cells")
    sizes = placed.groupBy("group", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    blocks = (placed.join(sizes, ["group", "cell"])
              .withColumn("block", F.pmod(F.xxhash64("rep", "vec"), F.col("blocks")))
              .groupBy("group", "cell", "home", "block").agg(F.collect_list(F.struct("rep", "n", "vec")).alias("rows")))
    blocks = staged(blocks, "vector-blocks")
    ours = blocks.filter("home").select("group", "cell", F.col("rows.rep").alias("r0"), F.col("rows.vec").alias("v0"))
    theirs = blocks.select("group", "cell", F.col("rows.rep").alias("r1"), F.col("rows.n").alias("n1"),
                           F.col("rows.vec").alias("v1"))
    pairs = ours.join(theirs, ["group", "cell"]).select("r0", "v0", "r1", "n1", "v1")
    found = staged(pairs.mapInArrow(_compare(cosine), "rep long, links long, root long"), "vector-links")
    counts = found.filter("links >= 0").groupBy("rep").agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("links < 0").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = (unique.join(counts, "rep", "left").join(groups, unique.rep == groups.node, "left")
               .select("group", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                       F.coalesce("component", "rep").alias("component")))
    out = rows.join(classes, ["group", "vec"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
