"""Sharding through fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into ``slots`` virtual slots for good. Bytes are added up per slot (map-side
combine; the table has at most ``slots`` rows). A map says which shard holds a slot. Version 0
deals slots round; rebalancing edits the map slot by slot until shards are near equal in bytes
and stores the result as the next version, so that only moved slots' records move.

Law ``bytes``: shard sizes are near equal; a size is the text's UTF-8 bytes plus 1.

Defined cases: null text has no bytes (size 1, checksum of the empty string); null ids are
hashed with the rest of their row, so they spread; rows identical in every column share a
slot; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, row_key

SLOTS = 4096
SHARDS = 16


@dataclass(frozen=True)
class SlotMap:
    version: int
    shards: int
    shard_of: tuple[int, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, s, d) for s, d in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, vslot int, shard int")


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> SlotMap:
    return SlotMap(0, shards, tuple(s % shards for s in range(slots)))


def rebalanced(old: SlotMap, load: dict[int, int], shards: int | None = None) -> SlotMap:
    """The next version: slots move from the fullest to the emptiest shard while that narrows their gap."""
    shards = shards or old.shards
    place = [min(s, shards - 1) for s in old.shard_of]
    total, held = [0] * shards, [[] for _ in range(shards)]
    for slot, shard in enumerate(place):
        total[shard] += load.get(slot, 0)
        if load.get(slot, 0):
            held[shard].append((load[slot], slot))
    for h in held:
        h.sort()
    moved = True
    while moved:
        moved = False
        a, b = max(range(shards), key=lambda i: (total[i], -i)), min(range(shards), key=lambda i: (total[i], i))
        gap = total[a] - total[b]
        fits = [x for x in held[a] if x[0] < gap]
        if fits:
            best = min(fits, key=lambda x: (abs(2 * x[0] - gap), x[1]))    # leaves the two nearest to equal
            held[a].remove(best)
            held[b].append(best)
            total[a] -= best[0]
            total[b] += best[0]
            place[best[1]] = b
            moved = True
    return SlotMap(old.version + 1, shards, tuple(place))


def save_map(spark: SparkSession, table: SlotMap, path: str) -> None:
    """Append one version to the stored map."""
    table.frame(spark).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the latest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).select("vslot", "shard").collect()      # one row a slot
    place = [d for _, d in sorted(map(tuple, rows))]
    return SlotMap(version, max(place) + 1, tuple(place))


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, size, text_crc32, vslot."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), row_key(docs).alias("key"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32")).withColumn(
        "vslot", F.pmod(F.xxhash64("doc_id", "key"), F.lit(slots)).cast("int"))


def assign(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, old: SlotMap | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, SlotMap]:
    """Records with their shard and their place in it, and the map version that was used.

    Columns: doc_id, key, size, text_crc32, vslot, shard, slot. ``slot`` numbers the records of
    a shard without gaps from 0, by virtual slot and then id; no shard is ordered as a whole.
    """
    spark = docs.sparkSession
    rows = cut(slotted(docs, slots, id_col, text_col))
    loads = {r["vslot"]: (r["b"], r["n"]) for r in
             rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}  # <= slots
    table = rebalanced(old or first_map(slots, shards), {s: b for s, (b, _) in loads.items()}, shards)
    start, offset = [0] * shards, []
    for slot, shard in enumerate(table.shard_of):
        offset.append((slot, shard, start[shard]))
        start[shard] += loads.get(slot, (0, 0))[1]
    place = spark.createDataFrame(offset, "pslot int, shard int, earlier long")               # ``slots`` rows
    inside = Window.partitionBy("vslot").orderBy("doc_id", "key")
    out = (rows.withColumn("rank", F.row_number().over(inside))
           .join(F.broadcast(place), F.col("vslot") == F.col("pslot"))
           .select("doc_id", "key", "size", "text_crc32", "vslot", "shard",
                   (F.col("earlier") + F.col("rank") - 1).cast("long").alias("slot")))
    return out, table
