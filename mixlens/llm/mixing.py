"""Mixing sources to token targets by entropy balancing.

A document of size x gets the rate 2 / (1 + exp(-l * x / scale)), the exponentially tilted
odds between the bounds 0 and 2 that stay closest (in entropy) to an even rate of 1 while
meeting the source's token constraint. The constraint's convex dual has one multiplier l per
source; all are found by Newton steps that run as aggregations over a (source, size) count
table, with bisection where a step leaves the bracket. Sources at the bound of twice their
size take rate 2.

Rates become whole copies by error diffusion over each source's size classes, the largest
first, so a source misses its target by about half its smallest document at most. Inside a
class the copies differ by at most one; the documents that get one more are the first by
hash, ranked through salted sub-classes, so that no class is ordered in one task.

Defined cases: null text has size 0; null sources form one source, the last; documents of
size 0 are taken once (0 words); a corpus without words has targets 0; identical rows are
ranked side by side, so which of them gets the further copy does not matter; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, row_key, same_row, width

WEIGHTS = (3.0, 1.0, 2.0)        # by source in code-point order, null last, repeating
SHARE = 1.5                      # of all sizes
MOST = 2.0                       # copies of a document, and target over a source's size
SALTS = 64
ROWS_PER_SALT = 1_000_000
STEPS = 60
WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, key, source, size (words of the whole text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), row_key(docs).alias("key"),
                       F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` (from 0, code-point order, null last), through a range partitioning."""
    spread = cut(sources.repartitionByRange(width(sources.sparkSession), F.col("source").asc_nulls_last())
                 .withColumn("part", F.spark_partition_id()))
    sizes = {r["part"]: r["n"] for r in spread.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one a partition
    before, start = 0, {}
    for p in sorted(sizes):
        start[p], before = before, before + sizes[p]
    at = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    first = F.element_at(F.create_map(*[F.lit(x) for kv in start.items() for x in kv]), F.col("part")) if start else F.lit(0)
    return spread.withColumn("rank", (first + at - 1).cast("long")).drop("part")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: the budget dealt by weight, capped, the excess reshared."""
    pos = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    dealt = cut(ranked(sources).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), pos + 1))
                .withColumn("bound", F.lit(most) * F.col("source_size")).drop("rank"))
    budget = share * float(dealt.agg(F.sum("source_size")).first()[0] or 0)
    per, full = 0.0, -1
    while True:                                   # each pass caps at least one more source, or ends
        over = F.col("weight") * F.lit(per) >= F.col("bound")
        r = dealt.agg(F.sum(F.when(over, F.col("bound"))).alias("taken"), F.sum(F.when(~over, F.col("weight"))).alias("w"),
                      F.count(F.when(over, 1)).alias("n")).first()
        if not r["w"] or r["n"] == full:
            break
        full, per = r["n"], (budget - (r["taken"] or 0.0)) / r["w"]
    return dealt.withColumn("target", F.least(F.col("bound"), F.col("weight") * F.lit(per))).drop("weight", "bound")


def multipliers(classes: DataFrame, goal: DataFrame, steps: int = STEPS) -> DataFrame:
    """source, scale, l: the dual's solution for each source; null where the source is at its bound (or has no words)."""
    scale = classes.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"))
    state = (_on_source(goal.select("source", "source_size", "target"), scale, ["scale"])
             .withColumn("l", F.lit(0.0)).withColumn("low", F.lit(-700.0)).withColumn("high", F.lit(700.0))
             .withColumn("done", (F.col("target") >= MOST * F.col("source_size")) | (F.col("source_size") == 0)))
    state = cut(state)
    x = F.col("size") / F.col("scale")
    rate = F.lit(MOST) / (1 + F.exp(-F.col("l") * x))
    for _ in range(steps):
        open_ = state.filter("not done")
        if open_.isEmpty():
            break
        sums = (_on_source(classes, open_, ["l", "scale"], how="inner")
                .groupBy("source").agg(F.sum(F.col("n") * F.col("size") * rate).alias("got"),
                                       F.sum(F.col("n") * F.col("size") * x * rate * (1 - rate / MOST)).alias("slope")))
        new = _on_source(state, sums, ["got", "slope"])
        miss = F.col("got") - F.col("target")
        new = (new.withColumn("high", F.when(miss > 0, F.col("l")).otherwise(F.col("high")))
               .withColumn("low", F.when(miss <= 0, F.col("l")).otherwise(F.col("low"))))
        step = F.col("l") - miss / F.greatest("slope", F.lit(1e-300))
        near = F.abs(miss) <= 1e-9 * F.col("source_size")
        new = new.withColumn("next", F.when((step > F.col("low")) & (step < F.col("high")), step)
                             .otherwise((F.col("low") + F.col("high")) / 2))
        state = cut(new.select("source", "source_size", "target", "scale",
                               F.when(F.col("done") | near, F.col("l")).otherwise(F.col("next")).alias("l"), "low", "high",
                               (F.col("done") | near).alias("done")))
    bound = (F.col("target") >= MOST * F.col("source_size")) | (F.col("source_size") == 0)
    return state.select("source", "target", "scale", F.when(~bound, F.col("l")).alias("l"))


def _on_source(left: DataFrame, right: DataFrame, cols: list[str], how: str = "left") -> DataFrame:
    """Columns of ``right`` added to ``left`` by source, null matching null."""
    r = right.select(F.col("source").alias("__source"), *cols)
    return left.join(r, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def _diffuse(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of each size class of one source: the largest first, each class pays the error so far."""
    pdf = pdf.sort_values("size", ascending=False)
    out, owed = np.zeros(len(pdf), dtype=np.int64), 0.0
    size, n, rate = pdf["size"].to_numpy(), pdf["n"].to_numpy(), pdf["rate"].to_numpy()
    for i in range(len(pdf)):
        if size[i] == 0:
            out[i] = n[i]
            continue
        owed += n[i] * rate[i] * size[i]
        out[i] = min(max(round(owed / size[i]), 0), int(MOST) * n[i])
        owed -= float(out[i]) * size[i]
    return pd.DataFrame({"source": pdf["source"], "size": size, "copies": out})


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """doc_id, key, source, size, source_size, target, rate, copies: one row per document."""
    rows = cut(sized(docs, id_col, text_col, source_col))
    # a class is a source and a size; it has as many rows as there are distinct lengths, at most
    classes = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    goal = cut(targets(classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share))
    dual = cut(multipliers(classes, goal))
    x = F.col("size") / F.greatest("scale", F.lit(1e-300))
    rate = F.when(F.col("l").isNull(), F.lit(MOST)).otherwise(F.lit(MOST) / (1 + F.exp(-F.col("l") * x)))
    rated = cut(_on_source(classes, dual, ["target", "scale", "l"]).withColumn("rate", rate))
    whole = rated.groupBy("source").applyInPandas(_diffuse, "source string, size long, copies long")
    plan = _same(rated.select("source", "size", "n", "rate"), whole, ["copies"], ["source", "size"])
    plan = cut(_on_source(plan, goal, ["source_size", "target"]))

    order = F.xxhash64("doc_id", "key")
    salts = max(SALTS, -(-rows.count() // ROWS_PER_SALT))
    placed = rows.withColumn("order", order).withColumn("salt", F.pmod(F.xxhash64("order"), F.lit(salts)).cast("int"))
    inside = Window.partitionBy("source", "size", "salt").orderBy("order", "doc_id", "key")
    salt_sizes = placed.groupBy("source", "size", "salt").agg(F.count("*").alias("m"))
    earlier = cut(salt_sizes.withColumn("earlier", F.sum("m").over(
        Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))))
    ranks = placed.withColumn("rank", F.row_number().over(inside))
    ranks = _same(ranks, earlier.select("source", "size", "salt", F.coalesce("earlier", F.lit(0)).alias("earlier")),
                  ["earlier"], ["source", "size", "salt"])
    done = _same(ranks, plan, ["n", "rate", "copies", "source_size", "target"], ["source", "size"])
    each = (F.floor(F.col("copies") / F.col("n"))
            + (F.col("rank") + F.col("earlier") <= F.col("copies") % F.col("n")).cast("long"))
    return done.select("doc_id", "key", "source", "size", "source_size", "target", "rate", each.cast("long").alias("copies"))


def _same(left: DataFrame, right: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Columns of ``right`` added to ``left`` on equal keys; the source matches null with null."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *cols)
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) if k == "source" else F.col(k) == F.col(f"__{k}") for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(r, cond).drop(*[f"__{k}" for k in keys])


def mixed(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The documents with all their columns, each row as many times as it is taken."""
    taken = (mix(docs, id_col=id_col, **kw).groupBy("doc_id", "key").agg(F.sum("copies").alias("__copies"))
             .filter(F.col("__copies") > 0)
             .select(F.col("doc_id").alias("__sid"), F.col("key").alias("__skey"), "__copies"))
    tagged = docs.withColumn("__key", row_key(docs)).withColumn("__id", F.col(id_col))
    # identical rows share their key: one of them stands for all their copies
    return (tagged.join(taken, same_row())
            .dropDuplicates(["__key", "__id"])
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*docs.columns))
