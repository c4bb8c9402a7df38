"""Exact quantiles (linear interpolation) of any number of rows, without sorting them.

A mergeable sketch gives a first bracket around each wanted rank, so the values' spread does
not matter. A pass then cuts every open bracket into ``BINS`` bins of equal width and counts
each bin's rows with its least and largest value, as one aggregation combined on the map side
(the first pass counts the rows below the bracket too); the bin that holds the wanted rank
becomes the next bracket, until it holds a single value. Where the sketch's guess misses a rank
the search starts from all values, so results are exact whatever the sketch says. At most
``BINS`` rows a bracket come back from a pass, and the method is the same at every size.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
ACCURACY = 10_000        # of the sketch that the search begins with


LARGEST = sys.float_info.max


def _finite(c):
    v = c.cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), F.greatest(F.least(v, F.lit(LARGEST)), F.lit(-LARGEST)))


def exact_quantiles(df: DataFrame, columns: dict, qs) -> dict:
    """{name: [value for each q]} of the expressions in ``columns`` ({name: Column}).

    NULL and NaN are left out, infinities count as the largest double; a column without
    values has quantiles None. Callers should hand in a frame that is cheap to read again
    (a stored or persisted one).
    """
    names = list(columns)
    if not names:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("key"), _finite(columns[n]).alias("x"))
                                         for i, n in enumerate(names)])).alias("e")).select("e.key", "e.x")
    found = _search(long, qs)
    return {n: found.get(i, [None] * len(qs)) for i, n in enumerate(names)}


def exact_quantiles_by(df: DataFrame, key, column, qs) -> dict:
    """{key value: [value for each q]}; the caller bounds the number of keys (integers)."""
    return _search(df.select(key.cast("int").alias("key"), _finite(column).alias("x")), qs)


def exact_quantile(df: DataFrame, column, q: float):
    return exact_quantiles(df, {"x": column}, [q])["x"][0]


def _search(long: DataFrame, qs) -> dict:
    """Quantiles of ``x`` for each ``key``: a sketch's guesses first, then counting."""
    long = long.filter("x is not null")
    near = F.lit([min(max(q + d * 2 / ACCURACY, 0.0), 1.0) for q in qs for d in (-1, 1)])
    ends = long.groupBy("key").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                                   F.percentile_approx("x", near, ACCURACY).alias("near")).collect()
    wanted = {r["key"]: [q * (r["n"] - 1) for q in qs] for r in ends}
    whole = {r["key"]: (r["lo"], r["hi"], 0) for r in ends}
    # key and rank (from 0) -> bracket: least and largest value, rows below it (None: not counted yet)
    bracket = {}
    for r in ends:
        for i, pos in enumerate(wanted[r["key"]]):
            for rank in {math.floor(pos), math.ceil(pos)}:
                lo, hi = r["near"][2 * i:2 * i + 2]
                bracket[(r["key"], rank)] = whole[r["key"]] if r["n"] <= 2 else (lo, hi, None)
    while True:
        open_ = sorted({(key, *b) for (key, _), b in bracket.items() if b[0] < b[1] or b[2] is None}, key=str)
        if not open_:
            break
        found = _bins(long, open_)
        for (key, rank), (lo, hi, below) in bracket.items():
            if (key, lo, hi, below) not in found:
                continue
            under, bins = found[(key, lo, hi, below)]
            below = under if below is None else below
            place = whole[key]                              # the guess missed the rank: search it all
            if rank >= below:
                for r in bins:
                    if rank < below + r["n"]:
                        place = (r["lo"], r["hi"], below)
                        break
                    below += r["n"]
            bracket[(key, rank)] = place

    def value(key: int, pos: float) -> float:
        a, b = bracket[(key, math.floor(pos))][0], bracket[(key, math.ceil(pos))][0]
        return a if a == b else a + (b - a) * (pos - math.floor(pos))

    return {key: [value(key, pos) for pos in places] for key, places in wanted.items()}


def _bins(long: DataFrame, open_: list) -> dict:
    """For each open bracket: rows below it (where they are to be counted) and, for every bin, its rows,
    least and largest value; at most BINS + 1 rows a bracket."""
    # a table of the brackets, not constants in the expressions: later passes reuse the compiled code
    rows = ", ".join(f"({i}, {key}, {lo!r}D, {hi!r}D, {str(below is None).lower()})" for i, (key, lo, hi, below) in enumerate(open_))
    spans = long.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(b, bkey, lo, hi, fresh)")
    # halves, so that the width of a bracket cannot overflow; rising in x
    part = F.expr("try_divide(x / 2 - lo / 2, hi / 2 - lo / 2)")
    place = F.least(F.floor(F.coalesce(part, F.expr("if(x > lo, 1D, 0D)")) * BINS), F.lit(BINS - 1)).cast("int")
    inside = F.col("x").between(F.col("lo"), F.col("hi")) | (F.col("fresh") & (F.col("x") < F.col("lo")))
    tally = (long.join(F.broadcast(spans), (F.col("key") == F.col("bkey")) & inside)
             .select("b", F.when(F.col("x") < F.col("lo"), -1).otherwise(place).alias("bin"), "x").groupBy("b", "bin")
             .agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    out: dict = {b: (0, []) for b in open_}
    for r in sorted(tally, key=lambda r: (r["b"], r["bin"])):
        under, bins = out[open_[r["b"]]]
        if r["bin"] < 0:
            out[open_[r["b"]]] = (r["n"], bins)
        else:
            bins.append(r)
    return out
