"""Connected components of an undirected link table, by alternating star contraction.

Each round is two aggregations over the links; the number of rounds grows with the logarithm
of the component size. Links and labels stay distributed; each round is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: hang a node's neighbours on the least node it sees.

    ``large`` moves neighbours above the node, the other step those below it (and the node itself).
    """
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.filter("u != v").distinct()


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """node, root (least node reachable), for every node that has a link to another node.

    ``links`` need not be unique or ordered; self links are ignored; no links give no rows.
    """
    edges = cut(links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u != v").distinct())
    before = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == before:
            break
        before = (now["n"], now["s"])
        edges = cut(_star(_star(edges, True), False))
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
