"""SentencePiece encoding and decoding with forward states shared by common prefixes.

The distinct marked words of a batch are sorted, which lays out their trie depth first, and the
forward pass goes on from the state of the longest prefix shared with the word before. A model of
the merge kind has no piece probabilities to add up, so the forward state is the last piece of
the best segmentation of a prefix: of all pieces that end there, exactly one may follow the
segmentation before it, namely the one that the merges would never join across. The ids are those
of the library.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import add_columns, texts

MARK = "▁"
CACHED_WORDS = 150_000
CACHED_PAIRS = 300_000


class Pieces:
    """A SentencePiece model of the merge kind with byte pieces for unknown characters."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        self.byte_ids = {int(m.id_to_piece(i)[3:5], 16): i for i in ids if m.is_byte(i)}
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte pieces")
        special = {i for i in ids if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i)}
        self.id_of = {m.id_to_piece(i): i for i in ids if i not in special}
        self.score = {p: m.get_score(i) for p, i in self.id_of.items()}
        # Pieces that the merges can build; the others never occur in a segmentation.
        self.whole = {p: p for p in self.id_of if self.merged(p) == [p]}
        #: Every ending of such a piece, and whether it is itself one.
        self.tails = {p[i:]: p[i:] in self.whole for p in self.whole for i in range(len(p))}
        # Full stops and commas after an ASCII letter, where no piece holds both side by side.
        apart = [c for c in ".," if not any(a.isalpha() and b == c for p in self.id_of for a, b in zip(p, p[1:]))]
        self.stop = re.compile(f"(?<=[A-Za-z])([{''.join(apart)}])") if apart else None
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("pieces of this model cross words")
        self.bytes_of = [b""] * len(ids)
        for p, i in self.id_of.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, bytes] = {"": b""}
        self.packed = _Packed(self.id_of, self.byte_ids)

    def merged(self, text: str) -> list[str]:
        """Pieces by merging neighbours, the best score first and of equals the leftmost."""
        part, n = list(text), len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i, j):
            if i >= 0 and j < n and (s := self.score.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (-s, i, j, part[i] + part[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not part[i] or after[i] != j or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in part if p]

    def _follows(self, a: str, b: str) -> bool:
        """Whether the merges keep ``a`` and ``b`` apart when one follows the other."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        # The pieces' own strings stand in the table, not the slices of a word.
        pair = self.whole.get(a, a), self.whole.get(b, b)
        known = self.pairs[pair] = a not in self.whole or self.merged(a + b) == [a, b]
        return known

    def segment_sorted(self, words: list[str]):
        """Pieces of each of the sorted words; a character without a piece stands for itself."""
        known, pair, follows = self.tails.get, self.pairs.get, self._follows
        last, previous = [""], ""
        for word in words:
            keep = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                keep += 1
            del last[keep + 1:]
            for end in range(keep + 1, len(word) + 1):
                options, start = [], end - 1
                while start >= 0 and (kind := known(tail := word[start:end])) is not None:
                    if kind:
                        options.append(tail)
                    start -= 1
                for piece in reversed(options):
                    at = end - len(piece)
                    if not at:
                        break
                    if (fits := pair((last[at], piece))) or fits is None and follows(last[at], piece):
                        break
                else:
                    piece = word[end - 1]
                last.append(piece)
            previous = word
            out, end = [], len(word)
            while end:
                out.append(last[end])
                end -= len(last[end])
            out.reverse()
            yield out

    def _ids(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.packed.__getitem__, pieces))

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each word."""
        # Runs of marks tie on score, so the merges themselves decide there.
        learnt = {w: self._ids(self.merged(w)) for w in words if w.startswith(MARK + MARK)}
        plain = sorted(words.difference(learnt))
        for w, found in zip(plain, self.segment_sorted(plain)):
            learnt[w] = self._ids(found)
        return learnt

    def _table(self, seen: set[str]) -> dict[str, bytes]:
        """A table with the ids of all words of ``seen``; it is the cache where that has room."""
        if not (new := seen.difference(self.cache)):
            return self.cache
        learnt = self._learn(new)
        if len(self.cache) + len(learnt) <= CACHED_WORDS:
            self.cache.update(learnt)
            return self.cache
        # The cache starts again from these words; if even they have no room, they serve once.
        learnt.update((w, self.cache[w]) for w in seen.difference(new))
        self.cache = learnt if len(learnt) <= CACHED_WORDS else {}
        return learnt

    def encode(self, batch: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out = []
        for i in range(0, len(batch), 256):
            split = [marked_words(self.model.normalize(t) if t else "", self.stop) for t in batch[i:i + 256]]
            known = self._table(set().union(*split))
            out += [b"".join(map(known.__getitem__, s)) for s in split]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; bytes that are no UTF-8 give replacement characters."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_CHUNK = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


class _Packed(dict):
    """Bytes of the ids of a piece; a character without a piece is spelt in byte pieces."""

    def __init__(self, id_of: dict[str, int], byte_ids: dict[int, int]) -> None:
        super().__init__((p, np.array([i], "<i4").tobytes()) for p, i in id_of.items())
        self.byte_ids = byte_ids

    def __missing__(self, character: str) -> bytes:
        return np.array([self.byte_ids[b] for b in character.encode()], "<i4").tobytes()


def marked_words(text: str, stop: re.Pattern | None = None) -> list[str]:
    """Normalized text cut where no piece reaches: before each run of marks, around line ends and
    before ``stop``."""
    if MARK + MARK in text:
        return _CHUNK.findall(text)
    if stop:
        text = stop.sub(r" \1", text)
    return text.replace("\n", " \n ").replace(MARK, " " + MARK).split(" ")


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's model; a Python worker that serves several tasks loads it once."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``documents`` with ``ids``; null and empty texts have none. Nothing is shuffled.

    A worker keeps a bounded cache of words; repeated rows and words cost a lookup. A column
    named ids is replaced. An empty table gives an empty one.
    """
    return add_columns(documents, "ids array<int>",
                       lambda batch: [_id_lists(pieces(model).encode(texts(batch[text])))])


def _id_lists(data: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(d) // 4 for d in data)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(data), "<i4")))


def encode_and_decode(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``encode`` and then ``decode`` in one pass, so that a task needs one Python worker."""
    def compute(batch):
        coder = pieces(model)
        data = coder.encode(texts(batch[text]))
        back = [coder.decode(np.frombuffer(d, "<i4").tolist()) for d in data]
        return [_id_lists(data), pa.array(back, pa.string())]

    return add_columns(documents, "ids array<int>, decoded string", compute)


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids; null ids give null."""
    def compute(batch):
        coder = pieces(model)
        return [pa.array([coder.decode(x.as_py()) if x.is_valid else None for x in batch[ids]], pa.string())]

    return add_columns(encoded, "decoded string", compute)


def round_trip(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_ids, ids_hash, decoded_sha256, same`` of every row of ``documents``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("source_text"))
    done = encode_and_decode(rows, model, "source_text")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("source_text", F.lit(""))).alias("same"))
