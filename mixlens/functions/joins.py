"""Small derived tables beside large ones: stored, so that the planner knows their real size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stored(df: DataFrame) -> DataFrame:
    """Write a derived table into the checkpoint folder and read it back.

    The files cut the lineage and survive executor loss, and their size is what the planner
    goes by: it broadcasts a table under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    beyond, with adaptive execution splitting hot keys. Nothing is guessed and no hint is given.
    """
    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/mixlens-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """``big JOIN small`` with ``small`` stored first; the planner picks the join by its size."""
    return big.join(stored(small), on=on, how=how)


def scalar_row(df: DataFrame) -> dict:
    """Collect a global (ungrouped) aggregate; it has exactly one row by construction."""
    return df.first().asDict()


def merge_rows(*frames: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side without a join: stack them with the
    missing columns NULL, then take each column's single non-NULL value."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
