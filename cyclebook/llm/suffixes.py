"""Exact removal of repeated passages: every 100 bytes that also begin earlier in the corpus.

Documents are packed in order of doc_id. A window's anchor is its leftmost least hash of 32 bytes,
which depends on the window's bytes alone, so equal windows have equal anchors, and neighbouring
windows of one anchor form a segment. Three passes over the packs:

1. Hashes of anchors and segments meet by value. An anchor that occurs once rules out all its
   windows; of a segment that occurs often only the first occurrence can hold first windows.
2. The first occurrences of segments whose anchor has several go to suffix buckets by anchor. There a
   difference-cover sort brings equal windows together, one bounded block after the other.
3. What was found goes back to the packs, which mark the covered bytes.

Only hashes, flags and the segments of pass 2 are shuffled; the packs are a table bucketed by pack
number, which the answers join without moving a text.
"""

from __future__ import annotations

import secrets
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import new_folder, staged, utf8
from cyclebook.llm.suffix_sort import LENGTH, repeated_windows

PACK_BYTES = 2 << 20
GRAM = 32
WORD = 8
SPAN = LENGTH - GRAM + 1  # 32-grams in a window
HOT_SEGMENTS = 4096  # different segments from which an anchor's windows go out one by one
BUCKET_BYTES = 16 << 20  # text of the corpus for which there is one bucket
BLOCK_BYTES = 4 << 20  # segment bytes that are sorted at a time
CHUNK = 1 << 14  # places hashed at a time, whose arrays stay in a core's cache

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, kept by the worker."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]), dtype=np.uint64)
                      for b in (np.uint64(_BASE), inverse)]
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest value of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out


def _chunks(n: int):
    for a in range(0, n, CHUNK):
        yield a, min(n, a + CHUNK)


class Pack:
    """The windows of a pack, as segments: maximal runs of windows with one anchor."""

    def __init__(self, data: bytes, ends: np.ndarray, key: int = 0) -> None:
        self.bytes = np.frombuffer(data, np.uint8)
        n = len(self.bytes)
        self.start = self.count = np.zeros(0, np.int64)
        self.anchor = self.segment = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        # Every eight bytes are scrambled under the run's secret key before they enter a polynomial, so no
        # pair of texts is made to collide and equal hashes of different texts are a matter of chance.
        power, self.inverse = _power_tables(n + 1)
        words = np.ndarray((n - WORD + 1,), "<u8", data, 0, (1,))
        self.prefix = np.zeros(len(words) + 1, np.uint64)
        for a, b in _chunks(len(words)):
            part = words[a:b] ^ np.uint64(key)
            part *= np.uint64(0xBF58476D1CE4E5B9)
            part ^= part >> np.uint64(32)
            part *= power[a:b]
            part[:1] += self.prefix[a:a + 1]
            np.cumsum(part, out=self.prefix[a + 1:b + 1])
        inside = GRAM - WORD + 1
        grams = np.empty(n - GRAM + 1, np.uint64)
        least = np.empty(n - LENGTH + 1, np.uint64)
        done = 0
        for a, b in _chunks(len(grams)):
            part = self.prefix[a + inside:b + inside] - self.prefix[a:b]
            part *= self.inverse[a:b]
            np.bitwise_xor(part, part >> np.uint64(32), out=grams[a:b])
            if b >= done + SPAN:
                least[done:b - SPAN + 1] = _sliding(grams[done:b], SPAN, np.minimum)
                done = b - SPAN + 1
        valid = np.ones(len(least), bool)
        for end in ends[ends < n].tolist():  # windows that would cross into the next document
            valid[max(0, end - LENGTH + 1):end] = False
        if not valid.any():
            return
        # A gram is some window's least one where it equals the greatest least value over it.
        border = np.zeros(SPAN - 1, np.uint64)
        around = np.concatenate([border, least, border])
        chosen = np.empty(len(grams), bool)
        for a, b in _chunks(len(grams)):
            np.equal(grams[a:b], _sliding(around[a:b + SPAN - 1], SPAN, np.maximum), out=chosen[a:b])
        # Neighbouring windows with one least value and no such gram between their starts have one anchor.
        apart = np.ones(len(least) + 1, bool)
        apart[1:-1] = (least[1:] != least[:-1]) | chosen[:len(least) - 1] | ~valid[1:] | ~valid[:-1]
        start = np.flatnonzero(valid & apart[:-1])
        count = np.flatnonzero(valid & apart[1:]) - start + 1
        candidates = np.flatnonzero(chosen)
        pointer = np.searchsorted(candidates, start)
        anchor = np.empty(len(start), np.int64)
        todo = np.arange(len(start))
        while len(todo):
            at = candidates[pointer]
            hit = grams[at] == least[start[todo]]
            anchor[todo[hit]] = at[hit]
            todo, pointer = todo[~hit], pointer[~hit] + 1
        new = np.concatenate([[True], (np.diff(anchor) != 0) | (start[1:] != start[:-1] + count[:-1])])
        first = np.flatnonzero(new)
        self.start = start[first]
        self.count = np.add.reduceat(count, first)
        self.anchor = grams[anchor[first]]
        self.segment = self.hashes(self.start, self.count + LENGTH - 1)

    def hashes(self, start: np.ndarray, length) -> np.ndarray:
        raw = (self.prefix[start + length - WORD + 1] - self.prefix[start]) * self.inverse[start]
        return _mix(raw + np.asarray(length, np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(hashes: np.ndarray, buckets: int):
    """(bucket, positions) of the hashes; the order in a bucket is that of the array."""
    home = _bucket(hashes, buckets)
    order = np.argsort(home, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(home[order]) > 0, [True]])) if len(home) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(home[order[a]]), order[a:b]


class Keys:
    """Distinct anchors and segments of a pack, as pass 1 sends them."""

    def __init__(self, pack: Pack) -> None:
        self.anchors, self.anchor_of, times = np.unique(pack.anchor, return_inverse=True, return_counts=True)
        self.segments, self.first, self.segment_of = np.unique(pack.segment, return_index=True, return_inverse=True)
        self.several = times > 1
        self.kinds = np.bincount(self.anchor_of[self.first], minlength=len(self.anchors))
        self.sample = np.zeros(len(self.anchors), np.uint64)  # one of the anchor's segments
        self.sample[self.anchor_of] = pack.segment


def _ask(buckets: int, secret: int):
    """Pass 1, pack side: a row for each bucket with the hashes that belong there."""
    def run(batches):
        for batch in batches:
            rows = []
            for number, ends, data in zip(*(batch[c].to_pylist() for c in ("pack", "ends", "data"))):
                keys = Keys(Pack(data, np.array(ends, np.int64), secret))
                note = np.minimum(keys.kinds, 32767).astype("<i2") * np.where(keys.several, -1, 1).astype("<i2")
                for b, at in _by_bucket(keys.anchors, buckets):
                    rows.append((b, number, 0, keys.anchors[at].tobytes(),
                                 note[at].tobytes() + keys.sample[at].tobytes()))
                for b, at in _by_bucket(keys.segments, buckets):
                    rows.append((b, number, 1, keys.segments[at].tobytes(), b""))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["bucket", "pack", "kind", "keys", "note"])
    return run


def _answer(hot_segments: int):
    """Pass 1, bucket side: flags for each hash of each row.

    Anchors: 1 occurs more than once, 2 has very many segments, 4 has more than one. Segments: 1
    first in this pack.
    """
    def run(key, table):
        rows = sorted(zip(*(table[c].to_pylist() for c in ("pack", "kind", "keys", "note"))), key=lambda r: r[:2])
        flags = [b""] * len(rows)
        for kind in (0, 1):
            own = [i for i, r in enumerate(rows) if r[1] == kind]
            if not own:
                continue
            parts = [np.frombuffer(rows[i][2], np.uint64) for i in own]
            keys = np.concatenate(parts)
            _, first, group, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            if kind:
                flag = np.zeros(len(keys), np.uint8)
                flag[first] = 1  # rows are in order of the packs
            else:
                sizes = [len(p) for p in parts]
                note = np.concatenate([np.frombuffer(rows[i][3], "<i2", n) for i, n in zip(own, sizes)]).astype(np.int64)
                sample = np.concatenate([np.frombuffer(rows[i][3], np.uint64, n, 2 * n) for i, n in zip(own, sizes)])
                mixed = np.bincount(group, (np.abs(note) > 1) | (sample != sample[first][group])) > 0
                several = (times > 1) | (np.bincount(group, note < 0) > 0)
                hot = np.bincount(group, np.abs(note)) > hot_segments
                flag = (several + 2 * hot + 4 * mixed).astype(np.uint8)[group]
            for i, part in zip(own, np.split(flag, np.cumsum([len(p) for p in parts])[:-1])):
                flags[i] = part.tobytes()
        return pa.table({"pack": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "kind": pa.array([r[1] for r in rows], pa.int32()), "flags": pa.array(flags, pa.binary())})
    return run


def _plan(pack: Pack, answers: list, buckets: int):
    """What pass 1 settles: starts of windows known as repeated, and (key, start, windows) to sort."""
    keys = Keys(pack)
    by = {(a["kind"], a["bucket"]): np.frombuffer(a["flags"], np.uint8) for a in answers}
    flags = []
    for kind, hashes in ((0, keys.anchors), (1, keys.segments)):
        flag = np.zeros(len(hashes), np.uint8)
        for b, at in _by_bucket(hashes, buckets):
            flag[at] = by[kind, b]
        flags.append(flag)
    anchor = flags[0][keys.anchor_of]
    here = np.zeros(len(pack.start), bool)
    here[keys.first] = flags[1].astype(bool)
    several, hot, mixed = (anchor & 1) > 0, (anchor & 2) > 0, (anchor & 4) > 0
    gone = _starts(pack, several & ~here)
    # The windows of an anchor's only segment are equal to nothing but that segment's copies.
    whole = mixed & here & ~hot
    sort = [(pack.anchor[whole], pack.start[whole], pack.count[whole])]
    single = _starts(pack, mixed & here & hot)
    if len(single):
        hashes, first = np.unique(pack.hashes(single, LENGTH), return_index=True)
        kept = single[first]
        gone = np.concatenate([gone, np.delete(single, first)])
        sort.append((hashes, kept, np.ones(len(kept), np.int64)))
    return gone, *(np.concatenate(c) for c in zip(*sort))


def _starts(pack: Pack, chosen: np.ndarray) -> np.ndarray:
    """Window starts of the chosen segments."""
    start, count = pack.start[chosen], pack.count[chosen]
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def _send(buckets: int, secret: int):
    """Pass 2, pack side: the segments to sort, a row for each bucket."""
    def run(batches):
        for batch in batches:
            rows = []
            for number, ends, data, answers in zip(*(batch[c].to_pylist() for c in ("pack", "ends", "data", "answers"))):
                pack = Pack(data, np.array(ends, np.int64), secret)
                if not len(pack.start):
                    continue
                _, keys, start, count = _plan(pack, answers, buckets)
                for b, at in _by_bucket(keys, buckets):
                    text = b"".join(data[s:s + c + LENGTH - 1] for s, c in zip(start[at].tolist(), count[at].tolist()))
                    rows.append((b, number, keys[at].tobytes(), start[at].astype("<i4").tobytes(),
                                 count[at].astype("<i4").tobytes(), text))
            if rows:
                kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["bucket", "pack", "keys", "starts", "counts", "text"])
    return run


def _sort_bucket(key, table):
    """Pass 2, bucket side: starts of the windows of each pack that begin earlier, too."""
    columns = [table[c].to_pylist() for c in ("pack", "keys", "starts", "counts", "text")]
    number, keys, start, count, offset, texts = [], [], [], [], [], []
    base = 0
    for p, k, s, c, t in zip(*columns):
        c = np.frombuffer(c, "<i4").astype(np.int64)
        size = c + LENGTH - 1
        number.append(np.full(len(c), p))
        keys.append(np.frombuffer(k, np.uint64))
        start.append(np.frombuffer(s, "<i4").astype(np.int64))
        count.append(c)
        offset.append(base + np.cumsum(size) - size)
        texts.append(np.frombuffer(t, np.uint8))
        base += len(t)
    number, keys, start, count, offset, text = map(np.concatenate, (number, keys, start, count, offset, texts))
    order = np.lexsort((start, number, keys))
    size = count[order] + LENGTH - 1
    block = np.cumsum(size) // BLOCK_BYTES
    same_key = np.concatenate([[False], keys[order][1:] == keys[order][:-1]])
    # A block ends only between keys, and a key with one segment has nothing to be sorted with.
    first_of_key = np.maximum.accumulate(np.where(same_key, 0, np.arange(len(order))))
    block = block[first_of_key]
    found_pack, found_start = [], []
    edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(order)]])
    for a, b in zip(edges[:-1], edges[1:]):
        own = order[a:b]
        length = count[own] + LENGTH - 1
        at = np.cumsum(length) - length
        joined = np.concatenate([text[o:o + n] for o, n in zip(offset[own].tolist(), length.tolist())])
        within = np.arange(count[own].sum()) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
        windows = np.repeat(at, count[own]) + within
        packs, starts = np.repeat(number[own], count[own]), np.repeat(start[own], count[own]) + within
        place = np.empty(len(windows), np.int64)
        place[np.lexsort((starts, packs))] = np.arange(len(windows))
        flag = repeated_windows(joined, windows, place)
        found_pack.append(packs[flag])
        found_start.append(starts[flag])
    packs, starts = np.concatenate(found_pack), np.concatenate(found_start)
    order = np.argsort(packs, kind="stable")
    packs, starts = packs[order], starts[order]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(packs) > 0, [True]])) if len(packs) else [0]
    return pa.table({
        "pack": pa.array([int(packs[a]) for a in edges[:-1]], pa.int64()),
        "starts": pa.array([starts[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())})


def _mark(buckets: int, with_text: bool, secret: int):
    """Pass 3: a row for each document with its removed spans and what is kept."""
    import hashlib

    def run(batches):
        for batch in batches:
            names = ("pack", "ids", "ends", "data", "answers", "found")
            for _, ids, ends, data, answers, found in zip(*(batch[c].to_pylist() for c in names)):
                ends = np.array(ends, np.int64)
                pack = Pack(data, ends, secret)
                change = np.zeros(len(data) + 1, np.int32)
                if len(pack.start):
                    gone = _plan(pack, answers, buckets)[0]
                    for starts in [gone, *(np.frombuffer(f, "<i4") for f in found or [])]:
                        np.add.at(change, starts, 1)
                        np.add.at(change, starts + LENGTH, -1)
                covered = np.cumsum(change[:-1]) > 0
                spans, digests, texts = [], [], []
                for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
                    own = covered[a:b]
                    step = np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))
                    spans.append([{"start": x, "end": y} for x, y in zip(np.flatnonzero(step > 0).tolist(),
                                                                          np.flatnonzero(step < 0).tolist())])
                    kept = pack.bytes[a:b][~own].tobytes()
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept)
                sizes = np.diff(np.concatenate([[0], ends]))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(digests)]
                columns = ["doc_id", "n_bytes", "spans", "kept_sha256"]
                if with_text:
                    arrays, columns = [*arrays, pa.array(texts, pa.binary())], [*columns, "kept"]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)
    return run


def _pack_documents(batches, pack_bytes: int):
    """Packs of whole documents of about ``pack_bytes``, numbered in order."""
    ids, parts, size, number = [], [], 0, 0

    def close():
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 24) + number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([ends], pa.list_(pa.int64())), pa.array([b"".join(parts)], pa.binary())],
            names=["pack", "ids", "ends", "data"])

    for batch in batches:
        for key, part, text in zip(batch["doc_id"].to_pylist(), batch["part"].to_pylist(), utf8(batch["text"])):
            ids.append(key)
            parts.append(text)
            size += len(text)
            if size >= pack_bytes:
                yield close()
                ids, parts, size, number = [], [], 0, number + 1
    if ids:
        yield close()


def repeated_passages(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      with_text: bool = False, pack_bytes: int = PACK_BYTES,
                      hot_segments: int = HOT_SEGMENTS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept_sha256`` of each row, and ``kept`` (binary) ``with_text``.

    Spans are the maximal runs of UTF-8 bytes covered by a string of ``LENGTH`` bytes that also begins
    at a smaller doc_id, or earlier in the same document. Null texts are empty; null ids come
    first; rows that share an id are in the order of a hash of their texts. Documents shorter than
    the length keep everything. A string that a third of all documents hold is sent once by
    each pack. An empty table gives an empty one; other columns are not read. ``pack_bytes``,
    ``hot_segments`` and ``bucket_bytes``, the text for which there is a bucket, set how the work is cut
    and never change the result.

    What is told apart by hashes alone is told apart by 64 bits under a key that is drawn for each run.
    """
    spark = documents.sparkSession
    secret = secrets.randbits(64)
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = (rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
               .withColumn("part", F.spark_partition_id().cast("long")))
    name = f"packs_{uuid.uuid4().hex}"
    (ordered.mapInArrow(lambda batches: _pack_documents(batches, pack_bytes), "pack long, ids array<long>, ends array<long>, data binary")
     .write.bucketBy(buckets, "pack").option("path", new_folder(spark, "packs")).saveAsTable(name))
    try:
        packs = spark.table(name)
        asked = packs.mapInArrow(_ask(buckets, secret), "bucket long, pack long, kind int, keys binary, note binary")
        flags = staged(asked.groupBy("bucket").applyInArrow(
            _answer(hot_segments), "pack long, bucket long, kind int, flags binary"), "flags")
        answers = flags.groupBy("pack").agg(F.collect_list(F.struct("kind", "bucket", "flags")).alias("answers"))
        known = packs.join(answers, "pack", "left")
        sent = known.select("pack", "ends", "data", "answers").mapInArrow(
            _send(buckets, secret), "bucket long, pack long, keys binary, starts binary, counts binary, text binary")
        found = staged(sent.groupBy("bucket").applyInArrow(_sort_bucket, "pack long, starts binary"), "repeats")
        found = found.groupBy("pack").agg(F.collect_list("starts").alias("found"))
        ddl = "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept_sha256 string"
        marked = known.join(found, "pack", "left").mapInArrow(
            _mark(buckets, with_text, secret), ddl + (", kept binary" if with_text else ""))
        return staged(marked, "passages")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def passage_digest(documents: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return repeated_passages(documents).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
