"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

The raw model counts the hashed unigrams and bigrams of all documents, the target model those of
labelled good ones. A document's log weight is the sum of its n-grams' log ratios; the k rows with
the largest log weight plus Gumbel noise are a sample without replacement in proportion to the
weights. k is the number of rows whose weight passes the cut that best parts the labelled rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import ROWS, add_columns, apart, staged, utf8

BUCKETS = 1 << 14
MAX_LABELLED = 40_000
SEED = 17
SMOOTHING = 2.0  # n-grams added to both counts of a bucket
FIXED = 1 << 20  # weights are whole numbers of this fraction, so that sums have no order
_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ECHO = 0x1E377  # stands for a token that repeats the one or the second one before it


def buckets(text: bytes) -> np.ndarray:
    """Hash buckets of the unigrams and bigrams of a text; words keep their case."""
    tokens = _TOKEN.findall(text)
    raw = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    h = raw.copy()
    h[1:][raw[1:] == raw[:-1]] = _ECHO
    h[2:][raw[2:] == raw[:-2]] = _ECHO
    pairs = (h[:-1] * np.uint64(31) + h[1:]) * _MIX + np.uint64(1)
    mixed = np.concatenate([h, pairs]) * _MIX
    return (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def labelled_sample(labels: DataFrame, column: str, most: int = MAX_LABELLED) -> dict[int, int]:
    """At most ``most`` labelled ids with their labels, chosen by a hash of the id."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
            .dropna().groupBy("doc_id").agg(F.min("y").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect())
    return {r.doc_id: r.y for r in rows}


def _counted(batches, target: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket of all documents and of the target's, which are taken from a batch some at a time."""
    raw, chosen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            for key, text in zip(part["doc_id"].to_pylist(), utf8(part["text"])):
                n = np.bincount(buckets(text), minlength=BUCKETS)
                raw += n
                if key in target:
                    chosen += n
    return raw, chosen


def _ratios(rows: DataFrame, target: set[int]) -> np.ndarray:
    """Counts over all documents, a row for each bucket and task, and the smoothed log ratios."""
    good = rows.sparkSession.sparkContext.broadcast(target)

    def count(batches):
        raw, chosen = _counted(batches, good.value)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(chosen[used])],
                                         names=["bucket", "raw", "target"])

    table = (rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket")
             .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, chosen = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in table:
        raw[r.bucket], chosen[r.bucket] = r.raw, r.target
    # What the target sample would hold at the raw rate; few expected n-grams are weak evidence.
    expected = raw * (chosen.sum() / max(raw.sum(), 1.0))
    return np.round(np.log((chosen + SMOOTHING) / (expected + SMOOTHING)) * FIXED).astype(np.int64)


def _weights(documents: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """``documents`` with ``n_ngrams`` and ``log_weight``; a text without words has weight zero."""
    table = documents.sparkSession.sparkContext.broadcast(ratio)

    def compute(batch):
        n, weight = [], []
        for t in utf8(batch[text]):
            b = buckets(t)
            n.append(len(b))
            weight.append(int(table.value[b].sum()))
        return [pa.array(n, pa.int64()), pa.array(np.array(weight, np.float64) / FIXED)]

    return add_columns(documents, "n_ngrams long, log_weight double", compute)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut with the least sum of error shares, in the middle of the widest equally good gap."""
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order].astype(float)
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()
    caught = np.concatenate([[0], np.cumsum(1 - g)]) / (1 - g).sum()
    error = lost + 1 - caught
    edges = np.concatenate([[w[0] - 1], w, [w[-1] + 1]])
    gap = edges[1:] - edges[:-1]
    at = np.flatnonzero((error <= error.min() + 1e-12) & (gap > 0))
    best = at[np.argmax(gap[at])] if len(at) else int(np.argmin(error))
    return float((edges[best] + edges[best + 1]) / 2)


def _key(doc_id: str):
    """Log weight plus Gumbel noise, which depends on the id alone, as a whole number."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(doc_id)), 12) + F.lit(0.5)) / F.lit(2.0 ** 52)
    return F.floor((F.col("log_weight") - F.log(-F.log(uniform))) * FIXED).cast("long")


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096) -> int | None:
    """The k-th largest whole number of a column: each pass keeps one bin of at most ``bins``."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    while low < high:
        width = -(-(high - low + 1) // bins)
        slot = F.floor((F.col(column) - F.lit(low)) / F.lit(width)) if width > 1 else F.col(column) - F.lit(low)
        inside = rows.filter(F.col(column).between(low, high))
        counts = dict(inside.groupBy(slot.cast("long").alias("b")).count().collect())
        for b in sorted(counts, reverse=True):
            if k <= counts[b]:
                break
            k -= counts[b]
        low, high = low + b * width, min(high, low + b * width + width - 1)
    return low


def _fit(documents: DataFrame, labels: DataFrame, doc_id: str, text: str,
         max_labelled: int) -> tuple[np.ndarray, int | None, float, DataFrame]:
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sample = labelled_sample(labels, "quality", max_labelled)
    ratio = _ratios(rows, {k for k, y in sample.items() if y == 1})
    keyed = staged(_weights(rows, ratio).drop("text").withColumn("sample_key", _key("doc_id")), "weights")
    spark = documents.sparkSession
    marks = spark.createDataFrame(list(sample.items()), "doc_id long, y int")
    # One row for each labelled id: its least weight where rows share it.
    known = keyed.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "y").agg(F.min("log_weight").alias("log_weight")).toPandas()
    cut = best_cut(known["log_weight"].to_numpy(float), known["y"].to_numpy() == 1) if len(known) else float("-inf")
    k = keyed.filter(F.col("log_weight") >= cut).count()
    return ratio, (kth_largest(keyed, "sample_key", k) if k else None), cut, keyed


def _kept(last: int | None):
    return F.col("sample_key") >= last if last is not None else F.lit(False)


def sample_keys(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, n_ngrams, log_weight, sample_key, kept`` of every row.

    At most ``max_labelled`` labelled rows, chosen by a hash of their id, shape the target model
    and the cut; everything else counts all documents. Without labels of both kinds every row is
    kept. Null texts are empty: weight zero. Rows that share an id share their noise; rows that tie
    with the last sampled one are kept too. An empty table gives an empty one.
    """
    _, last, _, keyed = _fit(documents, labels, doc_id, text, max_labelled)
    return keyed.select("doc_id", "n_ngrams", "log_weight", "sample_key", _kept(last).alias("kept"))


def resample(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``documents`` that ``sample_keys`` keeps, with their own columns only, of any names."""
    rows = apart(documents, doc_id, text)
    ratio, last, _, _ = _fit(rows, labels, doc_id, text, max_labelled)
    work = rows.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text"), F.struct(*rows.columns).alias("__row"))
    scored = _weights(work, ratio, "__text")
    return scored.withColumn("sample_key", _key("__id")).filter(_kept(last)).select("__row.*").toDF(*documents.columns)
