"""Token ids as Re-Pair grammars: rules, expansion lengths and a random-access file format.

Documents go to ranges of doc_id, are encoded there and written as one file for each range.
A file is a sequence of shards. In a shard frequent neighbouring ids are replaced by new symbols
until none is frequent enough; the rules and the length that each symbol expands to allow reading
any ids without expanding what lies before.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import new_folder, open_file, write_file

MAGIC = b"RPTOK001"
SHARD_IDS = 1 << 20
MIN_PAIRS = 32
RULES_PER_ROUND = 4096
SAMPLE = 128  # symbols between two entries of a shard's position index
CACHED_WORDS = 800_000
GROUP = 128  # words that the library encodes as one text
SLICE = 4 << 20  # bytes of text whose words are looked up together


class Encoder:
    """Whole texts to ids of a ``tokenizers`` file, each distinct word of a batch encoded once.

    That is right for vocabularies that drop white space and letter case and end words by a
    suffix, which is tried on a few words when the file is loaded; with any other vocabulary whole
    texts are encoded. Plain words are encoded together, divided by spaces, and told apart by
    their last pieces; others are joined by a special token, which the library cuts out first.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        plain = [t for t in self.tokenizer.get_added_tokens_decoder().items()
                 if t[1].special and not (t[1].lstrip or t[1].rstrip or t[1].single_word or t[1].normalized)]
        self.cut, self.cut_text = (plain[-1][0], plain[-1][1].content) if plain else (None, "")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.last[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        probe = ["ab", "été!!", "'s", "1x", "\u0301a", "z.", "e'd", "%%.", ",", "\u0130", "."]
        alone = [self._ids(w) for w in probe]
        self.by_word = bool(suffix) and self.cut is not None and self._ids("AbZ") == self._ids("abz") and all(
            self._ids(f"{a}{gap}{b}") == x + y and self._ids(f"{a}{self.cut_text}{b}") == [*x, self.cut, *y]
            for a, x in zip(probe, alone) for b, y in zip(probe, alone) for gap in (" ", "\n", " \n ")
        ) and all(self._ids(f"ab{p} c") == self._ids(f"ab {p} c") for p in ".,")
        self.cache: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of each word."""
        learnt = {}
        plain, other = [], []
        for w in new:  # letters A-Z are in lower case by now
            (plain if w.isascii() and w.isalpha() or _PLAIN.fullmatch(w) else other).append(w)
        for words, got in self._groups(plain, " "):
            ends = np.flatnonzero(self.last[got]) + 1
            if len(ends) == len(words):
                learnt.update(_spans(words, got, np.concatenate([[0], ends[:-1]]), ends))
            else:
                other += words
        for w in other:
            if "<" in w:
                learnt[w] = np.array(self._ids(w), "<u4").tobytes()
        for words, got in self._groups([w for w in other if "<" not in w], self.cut_text):
            cuts = np.flatnonzero(got == self.cut)
            learnt.update(_spans(words, got, np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(got)]])))
        return learnt

    def _groups(self, words: list[str], gap: str):
        groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
        got = self.tokenizer.encode_batch_fast([gap.join(g) for g in groups], add_special_tokens=False)
        return ((g, np.array(e.ids, "<u4")) for g, e in zip(groups, got))

    def _table(self, seen: list[str]) -> dict[str, bytes]:
        """A table with the ids of all words of ``seen``; it is the cache where that has room."""
        cache = self.cache
        if not (new := [w for w in seen if w not in cache]):
            return cache
        learnt = self._learn(new)
        if len(cache) + len(learnt) <= CACHED_WORDS:
            cache.update(learnt)
            return cache
        # The cache starts again from these words; if even they have no room, they serve once.
        learnt.update((w, cache[w]) for w in seen if w in cache)
        self.cache = learnt if len(learnt) <= CACHED_WORDS else {}
        return learnt

    def encode(self, batch: list[str] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not self.by_word:
            batch = batch if isinstance(batch, list) else batch.to_pylist()
            return [np.array(e.ids, "<u4").tobytes()
                    for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        column = pa.array(batch, pa.large_string()) if isinstance(batch, list) else batch.cast(pa.large_string())
        out, start, filled = [], 0, 0
        for i, size in enumerate(pc.binary_length(column).to_pylist()):
            if i > start and filled + size > SLICE:
                out += self._slice(column.slice(start, i - start))
                start, filled = i, 0
            filled += size
        return out + self._slice(column.slice(start))

    def _slice(self, batch: pa.Array) -> list[bytes]:
        """The same for some texts, whose distinct words are looked up once."""
        low = pc.replace_substring(pc.ascii_lower(batch), "\n", " ")
        words = pc.split_pattern(pc.replace_substring_regex(low, _STOP, r"\1 \2 "), " ")
        coded = words.flatten().dictionary_encode()
        seen = coded.dictionary.to_pylist()
        known = self._table(seen)
        spans = [known[w] for w in seen]
        ids = np.frombuffer(b"".join(spans), "<u4")
        sizes = np.fromiter(map(len, spans), np.int64, len(spans)) >> 2
        ends, got = _runs(np.cumsum(sizes) - sizes, sizes, coded.indices.to_numpy(), ids)
        cuts = (4 * np.concatenate([[0], ends])[words.offsets.to_numpy()]).tolist()
        raw = got.tobytes()
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]


def _runs(starts: np.ndarray, sizes: np.ndarray, which: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` that ``which`` names, one behind the other, and where each ends."""
    counts = sizes[which]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((starts[which] - (ends - counts)).astype(kind), counts)
    at += np.arange(total, dtype=kind)
    return ends, values[at]


def _spans(words: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Each word with the bytes of its ids."""
    spans = map(slice, (starts * 4).tolist(), (ends * 4).tolist())
    return zip(words, map(ids.tobytes().__getitem__, spans))


# Words of these letters are one run of letters before and after normalization.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
# A full stop or comma between an ASCII letter and a space is a word of its own.
_STOP = "([a-z])([.,]) "

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; a Python worker that serves several tasks loads a vocabulary once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _frequent(codes: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent pair codes, sorted by code."""
    ordered = np.sort(codes)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    counts = np.diff(edges)
    chosen = np.flatnonzero(counts >= least)
    if len(chosen) > most:
        by_count = np.lexsort((chosen, -counts[chosen]))
        chosen = np.sort(chosen[by_count[:most]])
    return ordered[edges[:-1][chosen]]


def repair(ids: np.ndarray, least: int = MIN_PAIRS, most: int = RULES_PER_ROUND) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, rules, first nonterminal): rule k gives the two symbols of nonterminal first + k.

    Every round replaces the most frequent pairs at once, from left to right without overlap, until
    no pair is there ``least`` times.
    """
    first = int(ids.max()) + 1 if len(ids) else 0
    symbols, rules = ids.astype(np.int64), []
    nxt = first
    while len(symbols) > 1:
        codes = (symbols[:-1] << 32) | symbols[1:]
        chosen = _frequent(codes, most, least)
        if not len(chosen):
            break
        # A hashed table names the pair that may be at a place. Of chosen pairs that share a slot only the
        # last is replaced; the others are as frequent in the next round.
        slot = lambda c: ((c.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).view(np.int64)
        table = np.full(1 << 18, -1, np.int16 if len(chosen) < 1 << 15 else np.int32)
        table[slot(chosen)] = np.arange(len(chosen))
        found = table[slot(codes)]
        at = np.flatnonzero(found >= 0)
        place = found[at].astype(np.int64)
        hit = chosen[place] == codes[at]
        at, place = at[hit], place[hit]
        if len(at) > 1:  # of overlapping pairs every second one, counted from the first of the run
            starts = np.concatenate([[True], np.diff(at) > 1])
            run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
            keep = (np.arange(len(at)) - run) % 2 == 0
            at, place = at[keep], place[keep]
        used, place = np.unique(place, return_inverse=True)
        symbols[at] = nxt + place
        gone = np.ones(len(symbols), bool)
        gone[at + 1] = False
        symbols = symbols[gone]
        rules.append(np.stack([chosen[used] >> 32, chosen[used] & 0xFFFFFFFF], axis=1))
        nxt += len(used)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return symbols, table, first


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Ids that each rule stands for; a rule only names symbols that were there before it."""
    lengths = np.ones(first + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[first + k] = lengths[a] + lengths[b]
    return lengths[first:]


def rule_expansions(rules: np.ndarray, first: int) -> np.ndarray:
    """The ids of all rules, one rule behind the other, replaced level by level."""
    symbols = rules.ravel()
    while (deep := symbols >= first).any():
        width = np.where(deep, 2, 1)
        ends = np.cumsum(width)
        out = np.empty(ends[-1], symbols.dtype)
        pair = rules[symbols[deep] - first]
        out[ends[deep] - 2], out[ends[deep] - 1] = pair[:, 0], pair[:, 1]
        out[ends[~deep] - 1] = symbols[~deep]
        symbols = out
    return symbols


def expand(symbols: np.ndarray, rules: np.ndarray, first: int, lengths: np.ndarray | None = None,
           whole: np.ndarray | None = None) -> np.ndarray:
    """The ids of a run of symbols; a nonterminal is copied from the expansion of its rule."""
    lengths = expansion_lengths(rules, first) if lengths is None else lengths
    whole = rule_expansions(rules, first) if whole is None else whole
    values = np.concatenate([np.arange(first), whole])
    sizes = np.concatenate([np.ones(first, np.int64), lengths])
    starts = np.concatenate([np.arange(first), first + np.cumsum(lengths) - lengths])
    return _runs(starts, sizes, symbols, values)[1]


def pack_shard(ids: np.ndarray) -> bytes:
    """Header, rules, expansion lengths, position index and symbols of one shard."""
    symbols, rules, first = repair(ids)
    lengths = expansion_lengths(rules, first)
    width = "<u2" if first + len(rules) <= 65536 else "<u4"
    spread = np.where(symbols >= first, np.concatenate([lengths, [1]])[np.maximum(symbols - first, 0)], 1)
    position = np.concatenate([[0], np.cumsum(spread)])[:-1][::SAMPLE] if len(symbols) else np.zeros(0)
    head = struct.pack("<IIIII", len(ids), len(symbols), len(rules), first, int(width[-1]))
    return b"".join([head, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(),
                     position.astype("<u4").tobytes(), symbols.astype(width).tobytes()])


class Shard:
    """One packed shard; ``ids(start, stop)`` expands only the symbols that cover the range."""

    def __init__(self, data: bytes) -> None:
        self.count, symbols, rules, self.first, width = struct.unpack_from("<IIIII", data)
        at = 20

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out.astype(np.int64)

        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = take("<u4", rules)
        self.index = take("<u4", -(-symbols // SAMPLE))
        self.symbols = take(f"<u{width}", symbols)
        self.whole: np.ndarray | None = None  # the rules' expansions, once they are needed

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        if self.whole is None:
            self.whole = rule_expansions(self.rules, self.first)
        return expand(symbols, self.rules, self.first, self.lengths, self.whole)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.int64)
        block = int(np.searchsorted(self.index, start, "right")) - 1
        last = int(np.searchsorted(self.index, stop, "left"))
        part = self.expand(self.symbols[block * SAMPLE:last * SAMPLE])
        shift = int(self.index[block])
        return part[start - shift:stop - shift]


def file_parts(shards: list[bytes], table: np.ndarray) -> list[bytes]:
    """File: magic, shards, document table, shard offsets, counts, magic.

    The document table has row number, shard, start in the shard and ids of each document.
    """
    offsets = np.cumsum([len(MAGIC), *map(len, shards)])
    foot = struct.pack("<QQ", len(shards), len(table))
    return [MAGIC, *shards, table.astype("<i8").tobytes(), offsets.astype("<i8").tobytes(), foot, MAGIC]


def read_documents(uri: str):
    """(row, ids) of every document of a file, a shard in memory at a time."""
    with open_file(uri) as src:
        end = src.size()
        src.seek(end - 24)
        n_shards, n_docs = struct.unpack("<QQ", src.read(16))
        if src.read(8) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        src.seek(end - 24 - 8 * (n_shards + 1) - 32 * n_docs)
        table = np.frombuffer(src.read(32 * n_docs), "<i8").reshape(-1, 4)
        offsets = np.frombuffer(src.read(8 * (n_shards + 1)), "<i8")
        for k in range(n_shards):
            src.seek(int(offsets[k]))
            shard = Shard(src.read(int(offsets[k + 1] - offsets[k])))
            whole = shard.expand(shard.symbols)
            for row, _, start, count in table[table[:, 1] == k].tolist():
                yield row, whole[start:start + count]


def write_tokens(documents: DataFrame, vocabulary: str, folder: str | None = None,
                 end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes documents in ascending ``doc_id`` order and writes token files.

    Returns the staged manifest ``part, file, docs, ids``, a row for each file in order. A task
    names its file anew on every attempt and only the manifest, which Spark commits, says which
    files count; files of lost attempts are never read. Null texts are empty; null ids come
    first; documents that share an id are in the order of their texts. An empty table gives no
    file. Other columns are not read.
    """
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "tokens")
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = (rows.repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
               .withColumn("part", F.spark_partition_id()))

    def write(batches):
        coder, part = encoder(vocabulary), None
        shards, pending, table, ids_seen, doc_ids = [], [], [], 0, []
        fill = 0

        def close():
            nonlocal fill, pending
            if pending:
                shards.append(pack_shard(np.frombuffer(b"".join(pending), "<u4")))
                pending, fill = [], 0

        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for key, at, data in zip(batch["doc_id"].to_pylist(), batch["part"].to_pylist(),
                                     coder.encode(batch["text"].fill_null(""))):
                part = at
                data += end
                n = len(data) // 4
                table.append((len(doc_ids), len(shards), fill, n))
                doc_ids.append(key)
                pending.append(data)
                fill += n
                ids_seen += n
                if fill >= SHARD_IDS:
                    close()
        close()
        if doc_ids:
            uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok"
            write_file(uri, file_parts(shards, np.array(table, np.int64).reshape(-1, 4)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([uri]), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([ids_seen], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64()))],
                names=["part", "file", "docs", "ids", "doc_ids"])

    path = f"{folder}/manifest"
    ddl = "part long, file string, docs long, ids long, doc_ids array<long>"
    ordered.mapInArrow(write, ddl).write.parquet(path)
    return spark.read.schema(ddl).parquet(path)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a manifest.

    start counts the ids of all documents before it; the sums of the files before come from the
    manifest, one narrow row for each file.
    """
    spark = manifest.sparkSession
    before, total = {}, 0
    for r in manifest.select("part", "ids").orderBy("part").toLocalIterator():
        before[r.part], total = total, total + r.ids
    starts = spark.createDataFrame(list(before.items()), "part long, before long")
    files = manifest.join(F.broadcast(starts), "part").select("file", "before", "doc_ids")

    def read(batches):
        for batch in batches:
            for uri, start, keys in zip(*(batch[c].to_pylist() for c in ("file", "before", "doc_ids"))):
                out = []
                for row, ids in read_documents(uri):
                    out.append((keys[row], start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(max(1, len(before))).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")
