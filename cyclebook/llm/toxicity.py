"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings, hashed to buckets. Besides a weight, each
bucket has a small vector; the inner products of the vectors of all buckets in a text add what a
pair of terms means beyond the sum of both, such as an insult beside the mention of a group.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclebook.llm.decontaminate import words
from cyclebook.llm.quality import labelled_sample
from cyclebook.llm.shared import add_columns, staged, utf8

BITS = 20
PREFIX = 5
MAX_LABELLED = 30_000
MAX_TERMS = 4096
FACTORS = 4
EVIDENCE = 25.0  # nats of a pair; chance reaches them in about one of 10**11 pairs
BLOCK = 1024  # terms whose pairs a task counts


def terms(text: bytes) -> np.ndarray:
    """Sorted distinct buckets of the words and of the beginnings of longer words."""
    seen = set(words(text))
    starts = {w[:PREFIX] for w in seen if len(w) > PREFIX}
    h = np.fromiter(map(zlib.crc32, seen), np.uint64, len(seen))
    p = np.fromiter(map(zlib.crc32, starts), np.uint64, len(starts)) + np.uint64(1 << 32)
    mixed = np.concatenate([h, p]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique((mixed >> np.uint64(64 - BITS)).astype(np.int64))


@dataclass(frozen=True)
class Machine:
    """Bias, and weight and vector of each chosen bucket (``buckets`` is sorted)."""

    bias: float
    buckets: np.ndarray
    weight: np.ndarray
    vector: np.ndarray

    def score(self, present: np.ndarray) -> float:
        """Probability that a text with these buckets is toxic."""
        at = self.place(present)
        s = self.vector[at].sum(axis=0)
        pairs = 0.5 * float((s * s).sum() - (self.vector[at] ** 2).sum())
        z = self.bias + float(self.weight[at].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def place(self, present: np.ndarray) -> np.ndarray:
        if not len(self.buckets):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.buckets, present), len(self.buckets) - 1)
        return at[self.buckets[at] == present]


def train(rows: list[np.ndarray], labels: np.ndarray, n_terms: int, factors: int = FACTORS,
          steps: int = 300, rate: float = 0.05, decay: float = 1e-4, seed: int = 7):
    """Bias, weights and vectors by Adam on the mean logistic loss of all rows."""
    rng = np.random.default_rng(seed)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    term = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    share = max(1e-4, min(1 - 1e-4, float(labels.mean()))) if len(labels) else 0.5
    params = [np.array([np.log(share / (1 - share))]), np.zeros(n_terms),
              rng.normal(0, 0.02, (n_terms, factors))]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    sum_by = lambda index, values, n: np.bincount(index, values, n)
    for step in range(1, steps + 1 if len(rows) and n_terms else 1):
        bias, w, v = params
        s = np.stack([sum_by(owner, v[term, f], len(rows)) for f in range(factors)], axis=1)
        squares = sum_by(owner, (v ** 2).sum(axis=1)[term], len(rows))
        z = bias[0] + sum_by(owner, w[term], len(rows)) + 0.5 * ((s ** 2).sum(axis=1) - squares)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(rows)
        gt = g[owner]
        gv = np.stack([sum_by(term, gt * s[owner, f], n_terms) for f in range(factors)], axis=1)
        gv -= sum_by(term, gt, n_terms)[:, None] * v
        grads = [np.array([g.sum()]), sum_by(term, gt, n_terms) + decay * w, gv + decay * v]
        for k, grad in enumerate(grads):
            m1[k] = 0.9 * m1[k] + 0.1 * grad
            m2[k] = 0.999 * m2[k] + 0.001 * grad ** 2
            params[k] = params[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (
                np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def _choose(features: DataFrame, toxic: int, clean: int, most: int) -> np.ndarray:
    """Buckets whose rate in toxic rows differs most from that in others, by a signed z score."""
    counts = (features.select("y", F.explode("terms").alias("bucket")).groupBy("bucket")
              .agg(F.sum("y").alias("t"), F.count("*").alias("n")).filter("n >= 3"))
    p = F.col("n") / F.lit(float(toxic + clean))
    spread = F.sqrt(p * (1 - p) * F.lit(1.0 / max(toxic, 1) + 1.0 / max(clean, 1))) + F.lit(1e-12)
    z = (F.col("t") / F.lit(float(max(toxic, 1))) - (F.col("n") - F.col("t")) / F.lit(float(max(clean, 1)))) / spread
    # A toxic row's other words also pass a low bar; six standard errors leave real signals only.
    rows = (counts.withColumn("z", F.abs(z)).filter("z >= 6").orderBy(F.desc("z"), "bucket")
            .limit(most).select("bucket").collect())
    return np.array(sorted(r.bucket for r in rows), np.int64)


def _able(features: DataFrame) -> np.ndarray:
    """Buckets that can be in a pair with enough evidence: it is in no more texts than its terms,
    and its evidence is largest when all of these agree."""
    r = F.col("t") / F.col("n")
    counts = (features.select("y", F.explode("terms").alias("bucket")).groupBy("bucket")
              .agg(F.sum("y").alias("t"), F.count("*").alias("n")).filter("t > 0 and t < n"))
    able = counts.filter(F.col("n") * -F.log(F.least(r, 1 - r)) >= EVIDENCE).select("bucket")
    return np.sort(able.toArrow()["bucket"].to_numpy())


def _places(features: DataFrame, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``buckets`` of all rows' terms, where each row's end, and labels; clean rows first.

    ``features`` has at most as many rows as ids teach.
    """
    held = features.sparkSession.sparkContext.broadcast(buckets)

    def place(batches):
        where = np.full(1 << BITS, -1, "<i4")
        where[held.value] = np.arange(len(held.value))
        for batch in batches:
            at = [(p := where[r.values.to_numpy()])[p >= 0].tobytes() for r in batch["terms"]]
            yield pa.RecordBatch.from_arrays([batch["y"], pa.array(at, pa.binary())], names=["y", "at"])

    table = features.mapInArrow(place, "y int, at binary").orderBy("y", "at").toArrow()
    ends = np.cumsum([0, *(len(x) // 4 for c in table["at"].chunks for x in c.to_pylist())])
    at = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(x.as_buffer(), "<i4") for c in table["at"].chunks for x in c)])
    return at, ends, table["y"].to_numpy().astype(float)


def _paired(spark: SparkSession, at: np.ndarray, ends: np.ndarray, labels: np.ndarray, size: int) -> np.ndarray:
    """Places of pairs whose texts are toxic more often, or less often, than those of both terms.

    A term that is as usual in toxic texts as in others can still matter beside another one. All
    pairs are counted, a block of terms in each task.
    """
    if not size or not len(labels):
        return np.zeros(0, np.int64)
    toxic = int(ends[int((labels == 0).sum())])
    rate = np.bincount(at[toxic:], minlength=size) / np.maximum(np.bincount(at, minlength=size), 1)
    held = spark.sparkContext.broadcast((at, ends, toxic, rate))

    def count(batches):
        for batch in batches:
            for low in (batch["id"].to_numpy() * BLOCK).tolist():
                found = _strong(*held.value, low, min(low + BLOCK, size))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["place"])

    blocks = -(-size // BLOCK)
    hits = spark.range(0, blocks, 1, blocks).mapInArrow(count, "place long").distinct().collect()
    held.destroy()
    return np.array(sorted(r.place for r in hits), np.int64)


def _strong(at: np.ndarray, ends: np.ndarray, toxic: int, rate: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places in a pair of enough evidence whose lesser place is in ``low`` to ``high``.

    Only the texts that hold a term are looked at for it; those from ``toxic`` on are toxic.
    """
    found, size = np.zeros(len(rate), bool), len(rate)
    own = np.flatnonzero((at >= low) & (at < high))
    own = own[np.argsort(at[own], kind="stable")]
    stop = ends[np.searchsorted(ends, own, "right")]
    edges = np.searchsorted(at[own], np.arange(low, high + 1)).tolist()
    with np.errstate(divide="ignore"):
        # A pair of this term in fewer texts has too little evidence even if all of them agree.
        least = EVIDENCE / np.maximum(-np.log(rate[low:high]), -np.log(1 - rate[low:high])) - 1e-6
    for k in range(high - low):
        first, last = edges[k], edges[k + 1]
        if last - first < least[k]:
            continue
        rest = [at[a + 1:b] for a, b in zip(own[first:last].tolist(), stop[first:last].tolist())]
        clean = int(np.searchsorted(own[first:last], toxic))
        both = np.bincount(np.concatenate([at[:0], *rest]), minlength=size)
        other = np.flatnonzero(both >= max(least[k], 1))
        if not len(other):
            continue
        bad = np.bincount(np.concatenate([at[:0], *rest[clean:]]), minlength=size)
        strong = other[_evidence(both[other], bad[other], rate[low + k], rate[other]) >= EVIDENCE]
        found[strong] = True
        found[low + k] |= len(strong) > 0
    return np.flatnonzero(found)


def _evidence(n: np.ndarray, t: np.ndarray, one: float, other: np.ndarray) -> np.ndarray:
    """Nats by which t toxic of n texts speak against the nearer of both terms' own rates."""
    r = t / n
    high, low = np.maximum(one, other), np.minimum(one, other)
    p = np.where(r > high, high, np.where(r < low, low, r))
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.where(r > 0, r * np.log(r / p), 0) + np.where(r < 1, (1 - r) * np.log((1 - r) / (1 - p)), 0)
    return n * apart


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS) -> Machine:
    """The machine learnt from at most ``max_labelled`` labelled rows, chosen by a hash of the id.

    Labels are only looked up for rows of the sample; texts are the only input of a term. Without
    any label the score is one half everywhere.
    """
    sample = labelled_sample(labels, label, max_labelled)
    if not sample:
        return Machine(0.0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    known = documents.sparkSession.sparkContext.broadcast(sample)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def gather(batches):
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            picked = [i for i, key in enumerate(ids) if key in known.value]
            if picked:
                found = utf8(batch["text"].take(pa.array(picked)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in picked], pa.int64()),
                     pa.array([xxhash.xxh64_intdigest(t) >> 1 for t in found], pa.int64()),
                     pa.array([known.value[ids[i]] for i in picked], pa.int32()),
                     pa.array([terms(t) for t in found], pa.list_(pa.int64()))], names=["doc_id", "print", "y", "terms"])

    rows = rows.mapInArrow(gather, "doc_id long, print long, y int, terms array<long>")
    rows = staged(rows.withColumn("place", F.monotonically_increasing_id()), "labelled-terms")
    # A labelled id teaches once, by its text with the least hash: at most max_labelled places.
    once = rows.groupBy("doc_id").agg(F.min_by("place", "print").alias("place")).select("place")
    features = staged(rows.join(F.broadcast(once), "place", "left_semi").select("y", "terms"), "taught-terms")
    toxic, total = features.agg(F.sum("y"), F.count("*")).first()
    chosen = _choose(features, toxic or 0, total - (toxic or 0), max_terms)
    wanted = np.union1d(chosen, _able(features))
    at, ends, known_y = _places(features, wanted)
    pairs = _paired(documents.sparkSession, at, ends, known_y, len(wanted))
    chosen = np.union1d(chosen, wanted[pairs])
    place = np.full(len(wanted), -1, np.int32)
    place[np.searchsorted(wanted, chosen)] = np.arange(len(chosen))
    taught = [(p := place[at[a:b]])[p >= 0] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return Machine(*_with_terms(train(taught, known_y, len(chosen)), chosen))


def _with_terms(learnt, chosen: np.ndarray):
    bias, weight, vector = learnt
    return bias, chosen, weight, vector


def score(documents: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``documents`` with ``score``; null and empty texts have the score of no terms."""
    held = documents.sparkSession.sparkContext.broadcast(machine)

    def compute(batch):
        return [pa.array([held.value.score(terms(t)) for t in utf8(batch[text])], pa.float64())]

    return add_columns(documents, "score double", compute)


def held_out(doc_id: str = "doc_id"):
    """One row in five, by the CRC-32 of the id as text, that never teaches."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents(doc_id, text)``.

    Learns from labelled rows that are not held out. Rows without an id are not held out and
    never taught; repeated rows score alike; an empty table gives an empty one. Columns other
    than doc_id and text are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    machine = fit(rows, labels.filter(~held_out()))
    out = score(rows, machine)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
