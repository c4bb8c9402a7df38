"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact verification.

A fingerprint's 64 bits are cut into 32 segments of two bits, and each segment is replaced by
its bit count. The Manhattan distance of two such count vectors never exceeds the Hamming
distance of the fingerprints, so pairs within ``bits`` are among the pairs within ``bits`` in
count space. The range join there uses a grid: the segments form ``groups`` groups; a distance
of at most ``bits`` leaves at least ``groups - bits`` groups without any difference, so both
vectors share the grid cell of one choice of that many groups. A pair is taken only in its
first such cell, must pass the Manhattan bound, and is verified by the exact Hamming distance
inside the join, so neither candidates nor repeats leave it. Rows with the same fingerprint
are collapsed before the join; a hot cell is an ordinary skewed join key, which adaptive
execution splits.

Counts 0, 1, 2 are held as the bit pairs 00, 01, 11, so that Manhattan distance is the bit
count of an exclusive or.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, only, pick, with_fields
from .components import components

SHINGLE = 4
BITS = 4
GROUPS = 6
SEED = 42
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def fingerprint(body: bytes, words: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text (UTF-8 bytes); no words give 0."""
    found = _WORD.findall(body.lower())
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
    n = max(1, len(found) - words + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[min(words, len(found)) - 1:] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(line[a:b], SEED) for a, b in zip(starts, stops)), dtype="<u8", count=n)
    table = h.view(np.uint8).reshape(n, 8)
    if n < 256:
        ones = np.unpackbits(table, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:                                              # byte histograms: one pass for each byte column
        ones = np.concatenate([np.bincount(table[:, j], minlength=256) @ _BYTE_BITS for j in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, fp (the fingerprint's 64 bits as a signed long)."""
    rows = pick(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), words) for x in b.column("body")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "key", "fp"])

    return rows.mapInArrow(run, with_fields(rows, "doc_id", "key", fp=T.LongType()))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _group_masks(groups: int) -> list[int]:
    """The 32 segments dealt to the groups in runs of nearly equal length."""
    edge = [round(i * 32 / groups) for i in range(groups + 1)]
    return [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edge, edge[1:])]


def near_links(prints: DataFrame, bits: int = BITS, groups: int = GROUPS) -> DataFrame:
    """a, b: all pairs of distinct fingerprints at most ``bits`` apart, each once (a < b).

    ``prints`` has the distinct fingerprints as ``fp``. More groups give smaller cells and
    more copies of each row (``groups`` over ``bits``); the result is the same.
    """
    if groups <= bits:
        raise ValueError("groups must exceed bits")
    low = F.lit(0x5555555555555555)
    one, two = F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", 1).bitwiseAND(low)
    counts = one.bitwiseOR(two).bitwiseOR(F.shiftleft(one.bitwiseAND(two), 1))
    masks = _group_masks(groups)
    choices = list(combinations(range(groups), groups - bits))
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"),
                 F.col("counts").bitwiseAND(F.lit(_signed(sum(masks[g] for g in c)))).alias("cell"))
        for i, c in enumerate(choices)]))
    placed = (prints.select("fp", counts.alias("counts")).select("fp", "counts", cells.alias("at"))
              .select("fp", "counts", "at.choice", "at.cell"))
    a, b = placed.alias("a"), placed.alias("b")
    apart = F.col("a.counts").bitwiseXOR(F.col("b.counts"))

    def agrees(choice):
        return apart.bitwiseAND(F.lit(_signed(sum(masks[g] for g in choice)))) == 0

    first = F.lit(len(choices))
    for i in reversed(range(len(choices))):
        first = F.when(agrees(choices[i]), F.lit(i)).otherwise(first)
    return (a.join(b, (F.col("a.choice") == F.col("b.choice")) & (F.col("a.cell") == F.col("b.cell"))
                   & (F.col("a.fp") < F.col("b.fp"))
                   & (F.bit_count(apart) <= bits)                                         # Manhattan bound
                   & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= bits)      # exact
                   & (F.col("a.choice") == first))
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))


def near_duplicates(docs: DataFrame, words: int = SHINGLE, bits: int = BITS, groups: int = GROUPS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, fp, root, component_id: one row per row of ``docs``.

    ``component_id`` is the least id reachable over links, the document's own included.
    Null text counts as empty; a null id is never the least (a component of null ids only
    has a null component_id); repeated rows share their component; an empty table gives none.
    """
    prints = cut(fingerprints(docs, words, id_col, text_col))
    least = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    group = cut(components(cut(near_links(least.select("fp"), bits, groups)), "a", "b"))
    linked = least.join(group, least["fp"] == group["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    label = cut(linked.groupBy("root").agg(F.min("least").alias("component_id")))
    by_print = cut(linked.select("fp", "root").join(label, "root").select("fp", "root", "component_id"))
    return prints.join(by_print, "fp").select("doc_id", "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns: the one with the least id.

    Null ids come last; equal ids are told apart by the key of the whole row; rows identical
    in every column count as one.
    """
    found = near_duplicates(docs, words, bits, id_col=id_col, text_col=text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    return only(docs, found.groupBy("root").agg(first).select("first.doc_id", "first.key"), id_col)
