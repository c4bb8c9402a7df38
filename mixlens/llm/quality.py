"""Quality classifier by importance resampling over hashed n-grams.

Two generative bag-of-n-grams models are counted: one over all documents (raw), one over the
documents labelled good (target). A document's log weight is the sum of its n-grams' log
probability ratios. Sampling k documents of a length without replacement in proportion to their
weights is a top-k by log weight plus Gumbel noise; for documents of all lengths to compare, the
perturbed weight is taken per n-gram. The noise comes from a hash of the row, so reruns agree,
and the k-th largest is found exactly by a radix search, without sorting.

``LABELLED`` bounds the labelled documents used (the least by hash); raw counts, weights and
the choice of k cover all documents. k is the number of documents whose perturbed weight per
n-gram, the statistic that ranks, exceeds the cut that best separates the labelled good from the
labelled bad by that statistic (half the documents have no label, so k is counted, not given);
callers may pass their own k.

Defined cases: null text counts as empty; a text without words has log weight 0, counts as one
n-gram and stays subject to the cut; a document labelled more than once takes its worst label, null labels
are ignored; without good labels or without bad ones every document is kept; documents that
tie with the k-th stay; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ngrams
from .common import cut, only, pick, with_fields

BUCKETS = 1 << 16
LABELLED = 20_000
SEED = 20_26


def labelled(labels: DataFrame, most: int = LABELLED, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """lid, good: at most ``most`` labelled ids, the least by hash."""
    return (labels.select(F.col(id_col).alias("lid"), F.col(label_col).alias("good"))
            .filter("lid is not null and good is not null")
            .groupBy("lid").agg(F.min("good").cast("int").alias("good"))
            .orderBy(F.xxhash64("lid"), "lid").limit(most))


def _counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Two rows of bucket counts: all documents, documents labelled good."""
    def run(batches):
        total = np.zeros((2, buckets), dtype=np.int64)
        for b in batches:
            bodies, good = b.column("body").to_pylist(), np.array(b.column("good").to_pylist(), dtype=np.int64)
            for i, j in ngrams.slices(bodies):
                bucket, doc = ngrams.hashed(bodies[i:j], buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                total[1] += np.bincount(bucket[good[i:j][doc] == 1], minlength=buckets)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[0][some]),
                                          pa.array(total[1][some])], names=["bucket", "raw", "good"])

    found = (rows.mapInArrow(run, "bucket int, raw long, good long")
             .groupBy("bucket").agg(F.sum("raw"), F.sum("good")).collect())       # at most ``buckets`` rows
    out = np.zeros((2, buckets))
    for bucket, raw, good in found:
        out[:, bucket] = raw, good
    return out


def _ordered(x: np.ndarray) -> np.ndarray:
    """Doubles as longs of the same order."""
    bits = (np.asarray(x, dtype=float) + 0.0).view(np.int64)                      # -0.0 becomes 0.0
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def _doubles(place: np.ndarray) -> np.ndarray:
    """The doubles of ``_ordered`` longs."""
    return np.where(place < 0, place ^ np.int64(0x7FFFFFFFFFFFFFFF), place).view(float)


def _weights(rows: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    """doc_id, key, good, n_ngrams, log_weight, place (the perturbed weight per n-gram as an ordered long)."""
    shared = rows.sparkSession.sparkContext.broadcast(ratio)                      # ``buckets`` doubles
    salted = rows.withColumn("noise", F.xxhash64(F.lit(seed), "doc_id", "key"))

    def run(batches):
        for b in batches:
            bodies, table = b.column("body").to_pylist(), shared.value
            weight, n = np.zeros(len(bodies)), np.zeros(len(bodies), dtype=np.int64)
            for i, j in ngrams.slices(bodies):
                bucket, doc = ngrams.hashed(bodies[i:j], len(table))
                weight[i:j] = np.bincount(doc, weights=table[bucket], minlength=j - i)
                n[i:j] = np.bincount(doc, minlength=j - i)
            u = ((np.array(b.column("noise")).astype(np.int64).view(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / 2**53
            place = _ordered((weight - np.log(-np.log(u))) / np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), b.column("good"), pa.array(n), pa.array(weight), pa.array(place)],
                names=["doc_id", "key", "good", "n_ngrams", "log_weight", "place"])

    return salted.mapInArrow(run, with_fields(rows, "doc_id", "key", "good", n_ngrams=T.LongType(),
                                              log_weight=T.DoubleType(), place=T.LongType()))


def kth_largest(df: DataFrame, col: str, k: int) -> int | None:
    """The k-th largest long of a column, by four counting passes of 16 bits each."""
    if k < 1:
        return None
    left, known, part = k, 0, df.select(F.col(col).alias("x"))
    for shift in (48, 32, 16, 0):
        digit = F.shiftright("x", shift)
        tally = part.groupBy(digit.alias("d")).count().collect()                  # at most 65,536 rows
        for d, n in sorted(tally, reverse=True):
            known = d
            if left <= n:
                break
            left -= n
        else:
            return None
        part = part.filter(digit == F.lit(known))
    return known


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the least sum of error rates, midway between the values beside it."""
    values = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate((values[:1] - 1, (values[1:] + values[:-1]) / 2))
    lost = np.searchsorted(np.sort(good), cuts, side="right") / len(good)
    kept = 1 - np.searchsorted(np.sort(bad), cuts, side="right") / len(bad)
    return float(cuts[np.argmin(lost + kept)])


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = BUCKETS, most: int = LABELLED,
             seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, n_ngrams, log_weight, kept: one row per document."""
    sample = cut(labelled(labels, most))
    rows = (pick(docs, id_col, text_col).join(F.broadcast(sample), F.col("doc_id") == F.col("lid"), "left")
            .select("doc_id", "key", "body", F.coalesce("good", F.lit(-1)).alias("good")))
    raw, good = _counts(rows, buckets)
    ratio = (np.log((good + 1) / (good.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets)))
    weights = cut(_weights(rows, ratio, seed))
    if k is None:
        known = np.array(weights.filter("good >= 0").select("good", "place").limit(most).collect(),
                         dtype=np.int64).reshape(-1, 2)                           # at most ``most`` rows
        bad, fine = (_doubles(known[mine, 1]) for mine in (known[:, 0] != 1, known[:, 0] == 1))
        if not len(bad) or not len(fine):
            return weights.select("doc_id", "key", "n_ngrams", "log_weight", F.lit(True).alias("kept"))
        k = weights.filter(F.col("place") > F.lit(int(_ordered(np.array([best_cut(fine, bad)]))[0]))).count()
    last = kth_largest(weights, "place", k)
    kept = F.lit(False) if last is None else F.col("place") >= F.lit(last)
    return weights.select("doc_id", "key", "n_ngrams", "log_weight", kept.alias("kept"))


def keep_sampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The sampled documents with all their columns; rows identical in every column once."""
    return only(docs, resample(docs, labels, id_col=id_col, text_col=text_col, **kw).filter("kept"), id_col)
