"""Helpers shared by the corpus operators: lineage cuts, table reads, typed column picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and go on from those files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(df: DataFrame):
    """Digest of a whole row, for telling rows with the same id apart."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def pick(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (of the whole row) and body (the text's UTF-8 bytes, null: empty).

    Nothing else of ``df`` goes on, so its extra columns cannot clash with an operator's own.
    """
    return df.select(F.col(id_col).alias("doc_id"), row_key(df).alias("key"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))


def only(df: DataFrame, stays: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``df`` whose id and key are in ``stays`` (doc_id, key); identical rows once."""
    tagged = df.withColumn("__key", row_key(df)).withColumn("__id", F.col(id_col))
    right = stays.select(F.col("key").alias("__skey"), F.col("doc_id").alias("__sid"))
    return (tagged.join(right, same_row(), "left_semi").dropDuplicates(["__key", "__id"]).select(*df.columns))


def same_row():
    """Equal key, and equal ids as a check beside it: the join and what follows deal rows by the key alone."""
    a, b = F.col("__id"), F.col("__sid")
    return (F.col("__key") == F.col("__skey")) & (((a <= b) & (a >= b)) | (a.isNull() & b.isNull()))


def with_fields(df: DataFrame, *names: str, **new: T.DataType) -> T.StructType:
    """Schema of some of ``df``'s columns followed by new ones."""
    return T.StructType([df.schema[n] for n in names]
                        + [T.StructField(n, t) for n, t in new.items()])


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
