"""Proportional allocation of the repaired weekly KPI to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import scalar_row, stored
from ..spec import DEFAULT_SPEC, MediaSpec
from .measure import true_kpi_expr


def weight_maxima(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> dict:
    """Dataset-wide max of each weight candidate (one global aggregate, one row)."""
    cands = spec.present(clean, spec.weight_priority)
    if not cands:
        return {}
    row = scalar_row(clean.agg(*[F.max(F.greatest(F.col(c).cast("double"), F.lit(0.0))).alias(c)
                                 for c in cands]))
    return {c: row[c] for c in cands}


def activity_weight(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC,
                    maxima: dict | None = None) -> DataFrame:
    """The first candidate, in priority order, with a positive max-normalised value;
    the fallback weight when none is active. Candidates absent or with max <= 0 are
    skipped."""
    maxima = weight_maxima(clean, spec) if maxima is None else maxima
    opts = []
    for c in spec.weight_priority:
        m = maxima.get(c)
        if c not in clean.columns or m is None or m <= 0:
            continue
        norm = F.greatest(F.col(c).cast("double"), F.lit(0.0)) / F.lit(float(m))
        opts.append(F.when(norm > 0, norm))
    return clean.withColumn("activity_weight", F.coalesce(*opts, F.lit(float(spec.fallback_weight))))


def weight_class(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC):
    """Index (in priority order) of the first candidate with a positive value, -1 when
    none is active. Independent of the maxima: a positive value implies a positive max."""
    cands = spec.present(clean, spec.weight_priority)
    cls = F.lit(-1)
    for i in reversed(range(len(cands))):
        cls = F.when(F.col(cands[i]).cast("double") > 0, F.lit(i)).otherwise(cls)
    return cands, cls


def key_statistics(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per KPI key (the week): what the allocation of its rows needs.

    The sum of each weight candidate's values over the rows that candidate weighs (``_s``), its
    largest value (``_m``), the rows without any (``_nfb``) and the true sales. One grouped pass,
    combined on the map side, so a week holding a third of all rows is one row a task.
    """
    cands, cls = weight_class(clean, spec)
    val = {c: F.greatest(F.col(c).cast("double"), F.lit(0.0)) for c in cands}
    return clean.groupBy(*spec.kpi_keys).agg(
        *[F.sum(F.when(cls == i, val[c])).alias(f"_s{i}") for i, c in enumerate(cands)],
        *[F.max(val[c]).alias(f"_m{i}") for i, c in enumerate(cands)],
        F.count_if(cls == -1).alias("_nfb"),
        true_kpi_expr(spec.target_col).alias("_true_sales"))


def allocate_with(clean: DataFrame, stats: DataFrame, spec: MediaSpec = DEFAULT_SPEC,
                  maxima: dict | None = None) -> DataFrame:
    """D4-D6 where the rows are read: ``stats`` (a stored ``key_statistics``) gives each row's week
    its weight total, sum_c S_c / max_c + n_fallback * fallback, and its true sales.

    The global maxima are the largest of the weekly ones. Rows do not move while the planner can
    broadcast the stored statistics; beyond that they shuffle by week, hot weeks split.
    """
    keys = list(spec.kpi_keys)
    cands = spec.present(clean, spec.weight_priority)
    if maxima is None:
        mrow = scalar_row(stats.agg(*[F.max(f"_m{i}").alias(c) for i, c in enumerate(cands)])) if cands else {}
        maxima = {c: mrow[c] for c in cands}
    total = F.col("_nfb").cast("double") * F.lit(float(spec.fallback_weight))
    for i, c in enumerate(cands):
        m = maxima.get(c)
        if m is not None and m > 0:
            total = total + F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) / F.lit(float(m))
    per_key = stats.select(*keys, total.alias("_key_weight"), "_true_sales")
    joined = activity_weight(clean, spec, maxima).join(per_key, on=keys, how="left")
    share = F.try_divide(F.col("activity_weight"), F.col("_key_weight"))
    est = F.coalesce(share * F.col("_true_sales").cast("double"), F.lit(0.0))
    return joined.withColumn("estimated_sales", est).drop("_key_weight", "_true_sales")


def allocate_sales(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC,
                   maxima: dict | None = None) -> DataFrame:
    """estimated_sales = weight / week weight total * true weekly sales (0 when the
    week's sales are unknown). The share is taken within ``spec.kpi_keys`` (the week).

    ``clean`` is read twice, for the statistics and for the allocation, so it should be stored.
    """
    return allocate_with(clean, stored(key_statistics(clean, spec)), spec, maxima)
