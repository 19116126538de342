"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

A fingerprint's tile is given by the population counts of its quarters. Two fingerprints that
differ in r bits differ by at most r over these counts together, so only tiles that near to each
other are compared; every such pair of tiles is, with exclusive-or and bit counts on whole blocks.
"""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cyclebook.llm.components import connected_components, local_stars
from cyclebook.llm.shared import add_columns, apart, staged, utf8

SEED = 42
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)
STEP = 1 << 16  # shingles whose bits are unpacked at a time


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bit-wise majority of the XXH64 values of all word shingles, repeats included.

    Words are separated by ASCII white space, A-Z count as a-z. A text with fewer words than a
    shingle has one shingle, the whole sequence; a text without words has fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return _hash(joined)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths) + np.arange(len(words))
    spans = map(slice, (ends - lengths)[:1 - shingle].tolist(), ends[shingle - 1:].tolist())
    count = len(words) - shingle + 1
    hashes = np.fromiter(map(_hash, map(joined.__getitem__, spans)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for i in range(0, count, STEP):
        part = hashes[i:i + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``documents`` with ``fingerprint`` (64 bits in a long); a null text is an empty one."""
    def compute(batch):
        values = np.array([fingerprint(t, shingle) for t in utf8(batch[text])], np.uint64)
        return [pa.array(values.view(np.int64))]
    return add_columns(documents, "fingerprint long", compute)


def _tile(parts: int) -> tuple[list, int]:
    """Column of each part's population count, and the number of values that a count can have."""
    width = 64 // parts
    mask = (1 << width) - 1
    bits = F.col("fingerprint")
    return [F.bit_count(F.shiftrightunsigned(bits, width * i).bitwiseAND(F.lit(mask)))
            for i in range(parts)], width + 1


def _near_tiles(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Steps between tiles that may hold linked fingerprints; of a step and its reverse only one."""
    zero = (0,) * parts
    return [d for d in product(range(-radius, radius + 1), repeat=parts)
            if sum(map(abs, d)) <= radius and d >= zero]


def link_fingerprints(classes: DataFrame, radius: int = 2, parts: int = 4,
                      block_rows: int = 2048) -> DataFrame:
    """Links ``a, b`` that connect the rows of ``classes(fingerprint, rep)`` within ``radius`` bits.

    Fingerprints must be distinct. A block pair gives a spanning star for each of its components
    instead of all pairs. ``parts`` sets how fine the tiles are and never changes the result.
    """
    counts, base = _tile(parts)
    tiled = classes.select("fingerprint", "rep", *[c.cast("int").alias(f"c{i}") for i, c in enumerate(counts)])
    key = [f"c{i}" for i in range(parts)]
    # At most base ** parts rows (83,521 for four parts), so always small enough to broadcast.
    sizes = tiled.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    blocks = (tiled.join(F.broadcast(sizes), key)
              .withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")))
              .groupBy(*key, "block").agg(F.collect_list(F.struct("fingerprint", "rep")).alias("rows"))
              .select(*key, "block", F.col("rows.fingerprint").alias("f"), F.col("rows.rep").alias("r")))
    blocks = staged(blocks, "fingerprint-blocks")
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(d)])
                      for d in _near_tiles(parts, radius)])
    left = blocks.withColumn("d", F.explode(steps))
    same = " and ".join(f"d.d{i} = 0" for i in range(parts))
    left = left.select(*[(F.col(k) + F.col(f"d.d{i}")).alias(k) for i, k in enumerate(key)],
                       F.col("f").alias("f0"), F.col("r").alias("r0"),
                       F.when(F.expr(same), F.col("block")).alias("own"))
    pairs = left.join(blocks, key).filter("own is null or own <= block").select("f0", "r0", "f", "r")

    def compare(batches):
        for batch in batches:
            members, roots = [], []
            f0, r0, f1, r1 = (batch[c] for c in ("f0", "r0", "f", "r"))
            lists = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in (f0, r0, f1, r1)]
            cut = lambda c, i: c[1][c[0][i]:c[0][i + 1]]
            for i in range(batch.num_rows):
                a, b = cut(lists[0], i).view(np.uint64), cut(lists[2], i).view(np.uint64)
                x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
                u, v = cut(lists[1], i)[x], cut(lists[3], i)[y]
                if (linked := u != v).any():
                    m, r = local_stars(u[linked], v[linked])
                    members.append(m)
                    roots.append(r)
            if members:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(members)), pa.array(np.concatenate(roots))], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row; component_id is the smallest id reachable.

    Equal fingerprints form one class before anything is compared, so a group of copies costs
    one comparison row however large it is. Rows without an id get a fingerprint, a null
    component_id and link nothing; rows that share an id are one node. An empty table gives an
    empty one. Other columns of ``documents`` are not read.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = staged(fingerprints(rows, "text", shingle).drop("text"), "fingerprints")
    classes = (prints.filter("doc_id is not null").groupBy("fingerprint")
               .agg(F.min("doc_id").alias("rep")))
    # Rows that share an id connect the fingerprints that they have.
    several = (prints.groupBy("doc_id").agg(F.min("fingerprint").alias("x"), F.max("fingerprint").alias("y"))
               .filter("x != y").select("doc_id"))
    same_id = (prints.join(several, "doc_id").join(classes, "fingerprint")
               .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    groups = connected_components(link_fingerprints(classes, radius).unionAll(same_id))
    named = (classes.join(groups, classes.rep == groups.node, "left")
             .select("fingerprint", F.coalesce("component", "rep").alias("component_id")))
    return (prints.join(named, "fingerprint", "left")
            .select("doc_id", "fingerprint",
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


MAX_FATES = 1_000_000  # ids that are broadcast: 16 bytes each, some 60 MB as a hash table


def keep_first(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
               radius: int = 2) -> DataFrame:
    """The rows of ``documents`` whose id is the smallest of its component.

    Rows without an id stay. Of rows that share an id, the one with the least hash of its text
    stays; such ids are few, and only their rows are ranked. Columns of any name are kept. An empty
    table gives an empty one. What is joined to the documents are only the ids that go or that repeat.
    Up to ``MAX_FATES`` of them, counted, are broadcast and no text moves; more meet the documents in one
    shuffle, in which rows without an id are spread by their text.
    """
    rows = apart(documents, doc_id, text)
    names = rows.columns
    found = near_duplicates(rows, doc_id, text, shingle, radius).filter("doc_id is not null")
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("low"), F.count("*").alias("rows"))
    fates = staged(ids.filter("doc_id != low or rows > 1").select(
        F.col("doc_id").alias("__id"), F.lit(0).alias("__salt"), (F.col("doc_id") != F.col("low")).alias("__gone")), "fates")
    counts = fates.agg(F.count("*").alias("n"), F.count_if(~F.col("__gone")).alias("several")).first()
    few = counts["n"] <= MAX_FATES
    number = F.col(doc_id).cast("long")
    salt = F.when(number.isNull(), F.pmod(F.xxhash64(text), F.lit(4096)) + 1).otherwise(0).cast("int")
    keyed = rows.withColumns({"__id": F.coalesce(number, F.lit(0)), "__salt": salt})
    met = keyed.join(F.broadcast(fates) if few else fates, ["__id", "__salt"], "left")
    kept = met.filter(F.col("__gone").isNull()).select(*names)
    if counts["several"]:
        order = Window.partitionBy("__id").orderBy(F.xxhash64(text), F.col(text))
        first = met.filter(~F.col("__gone")).withColumn("__place", F.row_number().over(order)).filter("__place = 1")
        kept = kept.unionAll(first.select(*names))
    return kept.toDF(*documents.columns)
