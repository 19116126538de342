"""Benchmark decontamination: a prefix-filtered set join of item windows with whole documents.

A window is found by exact containment, so its necessary prefix is one token. Tokens are ordered
by their count in the whole corpus, and the rarest one of a window is its prefix: a document
without it cannot hold the window. Where it occurs, its place in the window fixes where the window
would start (positional bound) and end (length bound), and the words in between are compared.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import add_columns, staged, utf8

# Digits, a-z and every byte of a character beyond ASCII are word bytes; A-Z count as a-z.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
               else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def item_windows(items: list[tuple[str, bytes]], size: int) -> dict[tuple, list[str]]:
    """Window -> ids of the items that have it. An item shorter than a window is one window."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    return {k: sorted(v) for k, v in windows.items()}


def prefix_index(windows: dict[tuple, list[str]], counts: dict[bytes, int]) -> dict[bytes, list]:
    """Prefix token -> (place in the window, window, items); windows with an unseen word drop out."""
    index = defaultdict(list)
    for window, items in windows.items():
        rank = [(counts.get(w, 0), w, i) for i, w in enumerate(window)]
        if (rarest := min(rank))[0]:
            index[rarest[1]].append((rarest[2], list(window), items))
    return dict(index)


def find(text: bytes, index: dict[bytes, list]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Word count, spans [start, end) of found windows in words, and the items they belong to."""
    w = words(text)
    prefixes = index.keys() & set(w)
    spans, items = set(), set()
    if prefixes:
        for at, token in enumerate(w):
            if token in prefixes:
                for place, window, owners in index[token]:
                    start = at - place
                    if start >= 0 and w[start:start + len(window)] == window:
                        spans.add((start, start + len(window)))
                        items.update(owners)
    return len(w), sorted(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _corpus_counts(rows: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of the vocabulary occurs in all documents."""
    known = rows.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def count(batches):
        total = Counter()
        for batch in batches:
            for text in utf8(batch["text"]):
                total.update(filter(known.value.__contains__, words(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"])

    table = rows.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in table.collect()}


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = 10,
                   block_bytes: int = 4 << 20) -> DataFrame:
    """``documents`` with ``n_words``, ``hit_spans`` (word ranges) and ``hit_items``.

    The benchmark is a stated query set that goes against all documents in blocks: a block holds
    about ``block_bytes`` of item text and is the only thing that is broadcast. Nearly always
    there is one; more are worked off one after the other, over staged rows, with the same
    result. Documents are never shuffled, so neither a hot passage nor a hot source matters.

    Null texts have no words. Items without id or words have no windows; items that share an id
    are one item. An empty benchmark hits nothing. Columns of ``documents`` that are named like
    a result column are replaced.
    """
    items = (benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
             .dropna().dropDuplicates())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    empty = F.array().cast("array<struct<start:int,end:int>>")
    found = documents.drop("n_words", "hit_spans", "hit_items").withColumns(
        {"hit_spans": empty, "hit_items": F.array().cast("array<string>")})
    spark = documents.sparkSession
    for k in range(max(1, blocks)):
        own = items if blocks < 2 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        windows = item_windows([(r.item, r.text.encode()) for r in own.collect()], window)
        counts = _corpus_counts(documents.select(F.col(text).alias("text")),
                                {w for x in windows for w in x}) if windows else {}
        index = spark.sparkContext.broadcast(prefix_index(windows, counts))

        def compute(batch, index=index):
            n, spans, hits = [], [], []
            old = zip(batch["__old_spans"].to_pylist(), batch["__old_items"].to_pylist())
            for t, (old_spans, old_items) in zip(utf8(batch[text]), old):
                length, more, found_items = find(t, index.value)
                n.append(length)
                all_spans = merged(more + [(s["start"], s["end"]) for s in old_spans])
                spans.append([{"start": s, "end": e} for s, e in all_spans])
                hits.append(sorted(found_items.union(old_items)))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            return [pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(hits, pa.list_(pa.string()))]

        found = found.withColumnsRenamed({"hit_spans": "__old_spans", "hit_items": "__old_items"})
        found = add_columns(found, "n_words long, hit_spans array<struct<start:int,end:int>>,"
                            " hit_items array<string>", compute).drop("__old_spans", "__old_items")
        if k + 1 < blocks:
            found = staged(found, "benchmark-hits")
    return found


def hit_digest(hits: DataFrame) -> DataFrame:
    """Counts and the digest of the item ids from the columns of ``benchmark_hits``."""
    covered = F.aggregate("hit_spans", F.lit(0).cast("long"),
                          lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return hits.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"))
