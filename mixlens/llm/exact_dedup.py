"""Exact de-duplication: binary fuse filters per snapshot, exact buckets, byte checks.

Texts are equal when identical after lower-casing A-Z only (null counts as empty). The rows
are taken as an immutable snapshot and an incoming batch. Each side is first grouped by
digest on its own (map-side combine, so a group holding a third of all rows costs one row a
task). The snapshot's digests go into sharded static filters; the batch's distinct digests
are screened by them, and only positives are joined with the snapshot's exact buckets. Every
member of a bucket of two or more rows then has its bytes compared with the bucket's own
representative; a row whose bytes differ (a digest collision) is grouped by digest and text.

Defined cases: null ids sort below all others; of rows equal in text and id exactly one is
kept; the empty text is a text like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fuse
from .common import cut, only, pick, with_fields

KEYS_PER_FILTER = 250_000


def sha256(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """doc_id, key, row, digest, body (normalised bytes): one row per document."""
    rows = pick(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())

    def run(batches):
        for b in batches:
            body = [x.lower() for x in b.column("body").to_pylist()]     # bytes: A-Z only
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), b.column("row"),
                 pa.array([digest(x) for x in body], pa.binary()), pa.array(body, pa.binary())],
                names=["doc_id", "key", "row", "digest", "body"])

    return rows.mapInArrow(run, with_fields(rows, "doc_id", "key", "row", digest=T.BinaryType(), body=T.BinaryType()))


def buckets(rows: DataFrame) -> DataFrame:
    """digest, n, top (largest id): the exact bucket of each digest."""
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))


def _keys(digests) -> np.ndarray:
    return np.array([int.from_bytes(d[:8].ljust(8, b"\0"), "little") for d in digests], dtype=np.uint64)


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """shard, filter: one static filter for each shard of the snapshot's digests."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1].astype("int32"),
                             "filter": [fuse.build(_keys(pdf["digest"]))]})

    return (_sharded(snapshot.select("digest").distinct(), shards).groupBy("shard")
            .applyInPandas(run, "shard int, filter binary"))


def screen(batch: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """digest, maybe: False means the snapshot certainly lacks the digest."""
    def run(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        data = bytes(found["filter"].iloc[0]) if len(found) else b""
        return pd.DataFrame({"digest": keys["digest"], "maybe": fuse.contains(data, _keys(keys["digest"]))})

    return (_sharded(batch.select("digest"), shards).groupBy("shard").cogroup(filters.groupBy("shard"))
            .applyInPandas(run, "digest binary, maybe boolean"))


def merged_buckets(rows: DataFrame, keys_per_filter: int = KEYS_PER_FILTER) -> DataFrame:
    """digest, n, top over all rows: the batch is screened against the snapshot's filters.

    Half of the ids form the snapshot; any split gives the same result.
    """
    side = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    old = cut(buckets(rows.filter(side)))
    new = cut(buckets(rows.filter(~side)))
    shards = max(1, -(-old.count() // keys_per_filter))
    seen = cut(screen(new, build_filters(old, shards), shards))
    positive = new.join(seen.filter("maybe").select("digest"), "digest")
    both = cut(positive.join(old.select("digest", F.col("n").alias("m"), F.col("top").alias("other")), "digest")
               .select("digest", (F.col("n") + F.col("m")).alias("n"), F.greatest("top", "other").alias("top")))
    return (old.join(both, "digest", "left_anti").unionByName(new.join(both, "digest", "left_anti"))
            .unionByName(both))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest, key: one row per document, dropped ones too."""
    full = digested(docs, id_col, text_col, digest)
    rows = cut(full.drop("body"))
    group = cut(merged_buckets(rows))
    alone = (rows.join(group.filter("n = 1").select("digest"), "digest")
             .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.lit(True).alias("kept"), "digest", "key"))

    # the row with the largest id gives a bucket's text; the id is part of the join, so a hot digest is spread
    many = group.filter("n > 1").select(F.col("digest").alias("mark"), "top")
    chosen = cut(full.join(many, (F.col("digest") == F.col("mark")) & F.col("doc_id").eqNullSafe(F.col("top")))
                 .groupBy("digest").agg(F.min("body").alias("own")))
    checked = cut(full.join(chosen, "digest")
                  .select("doc_id", "key", "row", "digest",
                          F.when(F.col("body") != F.col("own"), F.col("body")).alias("other")))
    tops = cut(checked.groupBy("digest", "other")
               .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "key", "row")).alias("top")))
    joined = (checked.alias("a").join(tops.alias("b"), (F.col("a.digest") == F.col("b.digest"))
                                      & F.col("a.other").eqNullSafe(F.col("b.other")))
              .select("a.doc_id", F.col("b.top.doc_id").alias("keep_id"), "b.group_size",
                      (F.col("a.row") == F.col("b.top.row")).alias("kept"), "a.digest", "a.key"))
    return alone.unionByName(joined)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; rows identical in every column once."""
    return only(docs, exact_dedup(docs, id_col, text_col).filter("kept"), id_col)
