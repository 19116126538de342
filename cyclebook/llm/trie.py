"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns, named by a SHA-256 chain over the turns. Totals come
from rounds that compress every unary chain by pointer doubling and then rake all leaves, each a few
joins over the nodes that are left; afterwards the contracted nodes are expanded in reverse order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclebook.llm.shared import staged

SHARE = 20  # conversations that start like the first of them
HEADS = 4  # of which fewer turns than this are shared
SEGMENT = 1024  # turns that are chained one after the other
PART_BITS = 10  # turn numbers that are ranked together
PIECE_BITS = 12  # conversation ids that are joined to one text
SPACE = r"[^\x20\x09-\x0D]+"
ROOT = hashlib.sha256(b"").digest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_sha, words``: the turns of every conversation, numbered from 1.

    They go by ``turn``, null first, and where that is equal by the hash of role and text. A null role
    or text is empty; rows without conv_id belong to no conversation. The text stays in the scan. Turn
    numbers are ranked in ranges of 1,024, so a conversation with a third of all rows is spread.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turn = F.col("turn").cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"),
        F.coalesce(F.shiftright(turn, PART_BITS), F.lit(-(1 << 62))).alias("part"),
        F.unhex(F.sha2(named, 256)).alias("turn_sha"), F.regexp_count(text, F.lit(SPACE)).cast("long").alias("words"))
    rows = staged(rows, "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select(
        "conv_id", "part", F.sum("n").over(earlier).alias("offset")).filter("offset > 0")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "turn_sha")
    ranked = rows.withColumn("pos", F.row_number().over(inside)).join(offsets, ["conv_id", "part"], "left")
    pos = F.col("pos").cast("long") + F.coalesce("offset", F.lit(0))
    return staged(ranked.select("conv_id", pos.alias("pos"), "turn_sha", "words"), "ordered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their twenty: their turns, and ``conv_id, size``.

    Of conversation ``c`` the first ``crc32(c) % 4`` turns are those of ``c - c % 20`` (fewer where it has
    fewer, none where it is absent). A conversation may lose all its turns.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    first = F.col("conv_id") - F.col("conv_id") % SHARE
    heads = turns.filter((F.col("conv_id") == first) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "first")
    counts = heads.groupBy("first").agg(F.count("*").alias("there"))
    convs = sizes.select("conv_id", "own", shared.alias("shared"), first.alias("first")).join(counts, "first", "left")
    convs = convs.withColumn("taken", F.least("shared", F.coalesce("there", F.lit(0)))).withColumn(
        "size", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0)))
    convs = staged(convs.select("conv_id", "first", "shared", "taken", "size"), "conversations")
    begun = convs.join(heads, "first").filter(F.col("pos") <= F.col("shared"))
    rest = turns.join(convs, "conv_id").filter(F.col("pos") > F.col("shared")).withColumn(
        "pos", F.col("pos") - F.col("shared") + F.col("taken"))
    columns = ["conv_id", "pos", "turn_sha", "words", "size"]
    return begun.select(*columns).unionAll(rest.select(*columns)), convs.select("conv_id", "size")


def _starts(rows: DataFrame, segment: int) -> DataFrame:
    """``conv_id, seg, start``: the name of the prefix before each later segment of long conversations.

    A full segment is hashed as a block, and the blocks of a conversation are chained.
    """
    full = rows.filter((F.col("size") > segment) & (F.col("seg") < F.expr(f"size div {segment}")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.hex("turn_sha").alias("sha")))), lambda x: x["sha"])
    blocks = full.groupBy("conv_id", "seg").agg(F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("block"))

    def chain(table):
        here, starts = ROOT, []
        order = table.sort_by("seg")
        for block in order["block"].to_pylist():
            here = hashlib.sha256(here + bytes.fromhex(block)).digest()
            starts.append(here)
        return pa.table({"conv_id": order["conv_id"], "seg": [s + 1 for s in order["seg"].to_pylist()],
                         "start": pa.array(starts, pa.binary())})

    return blocks.groupBy("conv_id").applyInArrow(chain, "conv_id long, seg long, start binary")


def prefixes(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, depth, words, last, node, parent`` of each turn of ``rows(conv_id, pos, turn_sha, words, size)``.

    Equal sequences of turns have equal names. A task goes through its segments in order and keeps one
    hash; a conversation with a third of all turns is dealt out segment by segment.
    """
    rows = rows.withColumn("seg", F.expr(f"(pos - 1) div {segment}"))
    starts = _starts(rows, segment)
    dealt = rows.repartition("conv_id", "seg").join(starts, ["conv_id", "seg"], "left").sortWithinPartitions("conv_id", "pos")

    def name(batches):
        place = here = base = block = None
        for batch in batches:
            nodes, parents = [], []
            columns = (batch[c].to_pylist() for c in ("conv_id", "seg", "pos", "turn_sha", "start"))
            for conv, seg, pos, turn, start in zip(*columns):
                if (conv, seg) != place:
                    place, base, block = (conv, seg), start or ROOT, hashlib.sha256()
                    here = base
                parents.append(here)
                block.update(turn.hex().upper().encode())
                here = hashlib.sha256(base + block.digest() if pos % segment == 0 else here + turn).digest()
                nodes.append(here)
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["pos"], batch["words"], batch["last"], pa.array(nodes, pa.binary()),
                 pa.array(parents, pa.binary())], names=["conv_id", "depth", "words", "last", "node", "parent"])

    return dealt.withColumn("last", F.col("pos") == F.col("size")).mapInArrow(
        name, "conv_id long, depth long, words long, last boolean, node binary, parent binary")


def _ends(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` over the ids of the conversations that end at a node, ascending.

    Ids are joined in ranges of 4,096; a task hashes the ranges of a node one after the other.
    """
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    pieces = ends.groupBy("node", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def hashed(batches):
        node = found = None
        for batch in batches:
            out = []
            for name, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist()):
                if name == node:
                    found.update(b",")
                else:
                    if found:
                        out.append((node, found.hexdigest()))
                    node, found = name, hashlib.sha256()
                found.update(ids.encode())
            yield _named(out)
        if found:
            yield _named([(node, found.hexdigest())])

    return pieces.repartition("node").sortWithinPartitions("node", "piece").mapInArrow(
        hashed, "node binary, ends_sha256 string")


def _named(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"])


def _some(df: DataFrame) -> bool:
    return bool(df.limit(1).take(1))


def _compress(unary: DataFrame) -> DataFrame:
    """``id, end, leaves, saved``: the first node below that is not unary, and the sums down to it.

    ``unary(id, end, leaves, saved)`` points to the only child. Each round joins the open pointers with
    the table itself, which doubles their reach; open pointers never share a target.
    """
    jumps = unary.withColumn("open", F.lit(True))
    while _some(jumps.filter("open")):
        far = jumps.select(F.col("id").alias("end"), F.col("end").alias("far"), F.col("leaves").alias("more"),
                           F.col("saved").alias("extra"), F.col("open").alias("still"))
        moved = jumps.filter("open").join(far, "end", "left").select(
            "id", F.coalesce("far", "end").alias("end"), (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("extra", F.lit(0))).alias("saved"), F.coalesce("still", F.lit(False)).alias("open"))
        jumps = staged(jumps.filter("NOT open").unionAll(moved), "jumps")
    return jumps.drop("open")


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """``id, leaves, saved`` summed over each node's subtree, from ``nodes(id, parent, saved)``.

    A round finds the number of children by one aggregate, folds every unary chain into the edge
    above its end (compress), then adds the leaves to their parents and drops them (rake). Branching
    nodes at least halve the leaves, so rounds grow with the logarithm. ``parent`` is null at roots; ids
    are unique. Sums into a node with very many children are pre-aggregated by task.
    """
    live = staged(nodes.select("id", "parent", F.lit(0).cast("long").alias("leaves"), "saved",
                               F.lit(0).cast("long").alias("up_leaves"), F.lit(0).cast("long").alias("up_saved")), "live")
    totals, folded, first = [], [], True
    while _some(live):
        kids = live.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            F.count("*").alias("kids"), F.min("id").alias("end"), F.min("up_leaves").alias("edge_leaves"),
            F.min("up_saved").alias("edge_saved"))
        counted = live.join(kids, "id", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
        if first:  # a childless node of the whole tree counts itself
            counted, first = counted.withColumn("leaves", (F.col("kids") == 0).cast("long")), False
        counted = staged(counted, "counted")
        unary = counted.filter("kids = 1").select(
            "id", "end", (F.col("leaves") + F.col("edge_leaves")).alias("leaves"),
            (F.col("saved") + F.col("edge_saved")).alias("saved"))
        chains = _compress(unary)
        folded.append(chains)
        tops = unary.join(unary.select(F.col("end").alias("id")), "id", "left_anti").select("id")
        above = counted.select("id", F.col("parent").alias("over"), "up_leaves", "up_saved")
        links = chains.join(tops, "id").join(above, "id").select(
            F.col("end").alias("id"), "over", (F.col("leaves") + F.col("up_leaves")).alias("via_leaves"),
            (F.col("saved") + F.col("up_saved")).alias("via_saved"))
        linked = F.col("via_leaves").isNotNull()
        rest = counted.filter("kids <> 1").drop("end", "edge_leaves", "edge_saved").join(links, "id", "left")
        rest = staged(rest.select(
            "id", "kids", "leaves", "saved", F.when(linked, F.col("over")).otherwise(F.col("parent")).alias("parent"),
            F.when(linked, F.col("via_leaves")).otherwise(F.col("up_leaves")).alias("up_leaves"),
            F.when(linked, F.col("via_saved")).otherwise(F.col("up_saved")).alias("up_saved")), "contracted")
        raked = rest.filter("kids = 0")
        totals.append(raked.select("id", "leaves", "saved"))
        gifts = raked.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            F.sum(F.col("leaves") + F.col("up_leaves")).alias("more"), F.sum(F.col("saved") + F.col("up_saved")).alias("extra"))
        live = staged(rest.filter("kids > 0").join(gifts, "id", "left").select(
            "id", "parent", (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("extra", F.lit(0))).alias("saved"), "up_leaves", "up_saved"), "live")
    if not totals:
        return nodes.select("id", F.lit(0).cast("long").alias("leaves"), "saved")
    found = totals.pop()
    while folded:
        at = found.select(F.col("id").alias("end"), F.col("leaves").alias("more"), F.col("saved").alias("extra"))
        opened = folded.pop().join(at, "end").select(
            "id", (F.col("leaves") + F.col("more")).alias("leaves"), (F.col("saved") + F.col("extra")).alias("saved"))
        found = found.unionAll(opened)
        if totals:
            found = staged(found.unionAll(totals.pop()), "expanded")
    return found


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conversations(conv_id, turn, role, text)`` may have other columns of any name. See ``ordered_turns`` for
    nulls, ties and repeated rows (each is a turn), ``rebuilt`` for what conversations share. An empty
    table has no node, not even the root.
    """
    rows, convs = rebuilt(ordered_turns(conversations))
    visits = staged(prefixes(rows, segment), "visits")
    seen = visits.groupBy("node", "parent", "depth", "words").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("words"), "conv_id", "n_convs")
    nodes = staged(seen.unionAll(top).withColumn("id", F.monotonically_increasing_id()), "nodes")
    over = nodes.select(F.col("node").alias("parent"), F.col("id").alias("over"), F.col("conv_id").alias("parent_conv_id"))
    linked = staged(nodes.join(over, "parent", "left").select(
        "id", F.col("over").alias("parent"), "node", "depth", "conv_id", "parent_conv_id", "n_convs",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "linked")
    kids = linked.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    ends = visits.filter("last").select("node", "conv_id").unionAll(
        convs.filter("size = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    totals = subtree_totals(linked.select("id", "parent", "saved"))
    found = (linked.drop("saved", "parent").join(totals, "id").join(kids, "id", "left").join(_ends(ends), "node", "left"))
    none = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
