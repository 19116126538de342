"""Merkle manifest of a table: leaf coordinates from bitmap ranks, levels from keyed slot arrays.

The ids of a group are merged into bitmap words of 64 ids, empty words left out, with a directory of
row counts before every word. A leaf's slot is the count before its word plus the bits below its
own, so leaves are never sorted; only the words of one container (1,024 at most) and the children
of one directory node (65,537 at most) are put in order. A task then places the digests of 512
neighbouring slots in an array and reduces three levels of eight at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclebook.llm.shared import staged
from cyclebook.operators.ranking import numbered

FAN = 8
LEVELS = 3  # levels that one task reduces at a time
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

CONTAINER = ["grp", "c3", "c2", "c1"]  # 65,536 ids
WORD = [*CONTAINER, "word"]  # 64 ids
TREE = "grp string, slot long, digest string, depth int"
PATH = "grp string, slot long, path array<struct<before:string,after:string>>"


class Manifest(NamedTuple):
    """``leaves(grp, slot, doc_id, digest, depth)`` and, round by round, the nodes above them."""

    leaves: DataFrame
    rounds: list[DataFrame]  # the last has one node for each group, its subroot
    tops: list[DataFrame]  # the same over the subroots; the last is the root


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above ``n`` leaves; none above a lone one."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * FAN
    return levels


def _depth(n: Column) -> Column:
    return sum(((n > FAN ** k).cast("int") for k in range(1, 21)), (n > 1).cast("int"))


def field(c: Column) -> Column:
    """A value as ``bytes:text``; null is ``-``."""
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """A group's value, told apart from null, in bytewise order with null first."""
    return F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group.cast("string")))


def _before(parent: Sequence[str], child: str) -> Column:
    """Rows under the smaller children of the same directory node."""
    earlier = Window.partitionBy(*parent).orderBy(child).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(earlier), F.lit(0))


def bitmap_directory(ids: DataFrame) -> DataFrame:
    """``grp, c3, c2, c1, word, bits, n, before, total``: merged bitmap words and the rows before each.

    Words are merged by partial aggregation, so an id or a group that holds a third of all rows is one
    row for each task. Above the words the directory has three levels with 65,537 children at most.
    """
    words = staged(ids.groupBy(*WORD).agg(F.bit_or("bit").alias("bits"), F.count("*").alias("n")), "words")
    below, node = words.select(*WORD, "bits", "n", _before(CONTAINER, "word").alias("before")), words
    for level in (3, 2, 1):
        keys = CONTAINER[:level + 1]
        node = node.groupBy(*keys).agg(F.sum("n").alias("n"))
        upper = node.select(*keys, _before(keys[:-1], keys[-1]).alias("more"),
                            *([F.sum("n").over(Window.partitionBy("grp")).alias("total")] if level == 1 else []))
        below = below.join(upper, keys).withColumn("before", F.col("before") + F.col("more")).drop("more")
    return staged(below, "directory")


def _tied(rows: DataFrame) -> DataFrame:
    """``grp, slot`` and the other columns of rows whose word holds a repeated id.

    They go by id, then by digest; equal rows take neighbouring slots. Bins by the digest's first
    three letters keep an id with very many different rows out of one task.
    """
    each = rows.groupBy(*[c for c in rows.columns if c != "bit"]).agg(F.count("*").alias("copies"))
    each = each.withColumn("bin", F.substring("digest", 1, 3))
    bins = each.groupBy(*WORD, "c0", "bin").agg(F.sum("copies").alias("n"))
    bins = bins.select(*WORD, "c0", "bin", _before(WORD, F.struct("c0", "bin")).alias("more"))
    inside = Window.partitionBy(*WORD, "c0", "bin").orderBy("digest", "changed").rowsBetween(
        Window.unboundedPreceding, -1)
    at = each.withColumn("inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(bins, [*WORD, "c0", "bin"])
    step = 4096
    chunks = at.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {step}"))))
    copy = F.explode(F.sequence(F.col("chunk") * step, F.least(F.col("copies"), (F.col("chunk") + 1) * step) - 1))
    return chunks.withColumn("copy", copy).withColumn(
        "slot", F.col("before") + F.col("more") + F.col("inner") + F.col("copy"))


def rank_slots(leaves: DataFrame) -> DataFrame:
    """``leaves(grp, doc_id, digest, changed)`` with ``slot``, the place by doc_id in the group, and ``depth``."""
    top = F.when(F.col("doc_id").isNull(), 0).otherwise(F.shiftright("doc_id", 48) + 32769)
    part = {f"c{k}": F.coalesce(F.shiftright("doc_id", 16 * k).bitwiseAND(F.lit(0xFFFF)), F.lit(0)) for k in range(3)}
    rows = leaves.withColumns({"c3": top, **part})
    rows = rows.withColumns({"word": F.shiftright("c0", 6),
                             "bit": F.expr("shiftleft(1L, CAST(c0 % 64 AS INT))")})
    directory = bitmap_directory(rows.select(*WORD, "bit"))
    placed = rows.join(directory, WORD)
    lower = F.expr(f"shiftrightunsigned({2 ** 63 - 1}L, CAST(63 - c0 % 64 AS INT))")
    below = F.bit_count(F.col("bits").bitwiseAND(lower)).cast("long")
    crowded = F.col("n") > F.bit_count("bits")
    plain = placed.filter(~crowded).withColumn("slot", F.col("before") + below)
    out = ["grp", "slot", "doc_id", "digest", "changed", _depth(F.col("total")).alias("depth")]
    tied = _tied(placed.filter(crowded).drop("bits", "n"))
    return plain.select(*out).unionAll(tied.select(*out))


def _reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The slot array and the levels above it."""
    tiers = [nodes]
    for _ in range(levels):
        nodes = [digest("".join(nodes[i:i + FAN])) for i in range(0, len(nodes), FAN)]
        tiers.append(nodes)
    return tiers


def _slots(table: pa.Table) -> list[str]:
    """Digests in an array by their slot."""
    nodes: list = [None] * table.num_rows
    for at, value in zip(table["slot"].to_pylist(), table["digest"].to_pylist()):
        nodes[at % BLOCK] = value
    return nodes


def _block(df: DataFrame) -> DataFrame:
    return df.withColumn("block", F.expr(f"slot div {BLOCK}"))


def _up(nodes: DataFrame) -> DataFrame:
    """The nodes that blocks of 512 neighbours reduce to; groups that are one node stay as they are."""
    def reduce(key, table):
        left = table["depth"][0].as_py()
        levels = min(left, LEVELS)
        top = _reduced(_slots(table), levels)[-1]
        return pa.table({"grp": [key[0].as_py()], "slot": [key[1].as_py()], "digest": top,
                         "depth": pa.array([left - levels], pa.int32())})

    return _block(nodes.select("grp", "slot", "digest", "depth")).groupBy("grp", "block").applyInArrow(reduce, TREE)


def _rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    left, rounds = nodes.agg(F.max("depth")).first()[0] or 0, []
    while left > 0 or not rounds:
        nodes = staged(_up(nodes), name)
        rounds, left = [*rounds, nodes], left - LEVELS
    return rounds


def manifest(table: DataFrame, group: str = "lang", fields: Sequence[str] = FIELDS,
             changed: Column | None = None) -> Manifest:
    """Manifest of a table: a leaf for each row, a tree of eight for each group, one over the groups.

    A leaf hashes ``fields``, null as ``-``; its place in the group is its ``doc_id``, null first. Rows
    that repeat an id follow each other by digest, equal rows too, each with a slot of its own. A null
    group comes before all others and is not the empty text. ``changed`` is kept beside each leaf.
    Other columns, whatever their names, are not read. An empty table has no root.
    """
    spare = F.lit(None).cast("string") if changed is None else changed
    leaves = staged(table.select(group_key(F.col(group)).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
                                 leaf_digest([F.col(c) for c in fields]).alias("digest"),
                                 spare.alias("changed")), "leaves")
    slots = staged(rank_slots(leaves), "slots")
    rounds = _rounds(slots, "nodes")
    ranked = numbered(rounds[-1].select("grp", "digest"), [F.col("grp")], "slot", staged)
    n = ranked.count()
    tops = [ranked.select(F.lit("").alias("grp"), "slot", "digest", F.lit(depth(n)).alias("depth"), F.col("grp").alias("of"))]
    return Manifest(slots, rounds, tops + (_rounds(tops[0], "tops") if n else []))


def root(found: Manifest) -> str | None:
    row = found.tops[-1].first()
    return row["digest"] if row else None


def _around(tiers: list[list[str]], at: int) -> list[tuple[str, str]]:
    """Siblings before and after a node, level by level."""
    out = []
    for tier in tiers[:-1]:
        start = at - at % FAN
        out.append(("".join(tier[start:at]), "".join(tier[at + 1:start + FAN])))
        at //= FAN
    return out


def _down(nodes: DataFrame, upper: DataFrame, ddl: str, emit) -> DataFrame:
    """What ``emit`` makes of each block's table, its levels and the path above it."""
    def walk(key, table, above):
        tiers = _reduced(_slots(table), min(table["depth"][0].as_py(), LEVELS))
        path = [(p["before"], p["after"]) for p in above["path"][0].as_py()]
        return emit(table, tiers, path)

    above = upper.select("grp", F.col("slot").alias("block"), "path")
    return (_block(nodes).groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInArrow(walk, ddl))


def _paths(table: pa.Table, tiers: list[list[str]], path: list[tuple[str, str]]) -> pa.Table:
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    found = [[{"before": b, "after": a} for b, a in (*_around(tiers, at % BLOCK), *path)]
             for at in table["slot"].to_pylist()]
    return pa.table({"grp": table["grp"], "slot": table["slot"], "path": pa.array(found, kind)})


def _descend(rounds: list[DataFrame], path: DataFrame) -> DataFrame:
    """Paths of the lowest of ``rounds`` from those of the highest."""
    for nodes in reversed(rounds[:-1]):
        path = staged(_down(nodes.select("grp", "slot", "digest", "depth"), path, PATH, _paths), "paths")
    return path


def fold(value: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf's digest gives with its siblings; a level without any is a lone node's hash."""
    for before, after in path:
        value = digest(before + value + after)
    return value


def proofs(found: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every leaf.

    ``proof_sha256`` hashes the siblings from the leaf up; ``folded_root`` starts from the changed digest
    where there is one. Paths are handed down block by block, so a task holds 512 leaves.
    """
    top = root(found)
    start = found.tops[-1].select("grp", "slot", F.expr("CAST(array() AS array<struct<before:string,after:string>>)").alias("path"))
    above = _descend(found.tops, start).drop("grp")
    names = found.tops[0].select("slot", F.col("of").alias("grp"), F.col("digest").alias("subroot"))
    subroots = names.join(above, "slot").select("grp", F.lit(0).cast("long").alias("slot"), "path")
    path = _descend(found.rounds, subroots)

    def prove(table, tiers, path):
        rest, proof, folded = "".join(b + a for b, a in path), [], []
        for at, leaf, other in zip(*(table[c].to_pylist() for c in ("slot", "digest", "changed"))):
            own = _around(tiers, at % BLOCK)
            proof.append(digest("".join(b + a for b, a in own) + rest))
            folded.append(fold(fold(leaf if other is None else other, own), path))
        return pa.table({"grp": table["grp"], "doc_id": table["doc_id"], "leaf": table["digest"],
                         "proof_sha256": proof, "folded_root": folded})

    proved = _down(found.leaves, path, "grp string, doc_id long, leaf string, proof_sha256 string, folded_root string", prove)
    return proved.join(names.select("grp", "subroot"), "grp").select(
        "doc_id", "leaf", "subroot", F.lit(top).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(top)).alias("verified"))


def tampered_digest(table: DataFrame) -> Column:
    """The leaf with the letters A-Z of its text in lower case, where 3 divides crc32 of the id."""
    upper = "".join(map(chr, range(65, 91)))
    columns = [F.translate("text", upper, upper.lower()) if c == "text" else F.col(c) for c in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0, leaf_digest(columns))
