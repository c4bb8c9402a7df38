"""Fan-out measure repair (D1-D3) and its evidence.

The KPI was copied onto every granular row of a week, sometimes multiplied; the true
weekly value is the smallest positive copy. Everything here is a grouped aggregate with
map-side partial aggregation, so a week that holds a third of all rows is pre-reduced on
every mapper before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import parse_mixed_date, safe_div
from ..spec import DEFAULT_SPEC, MediaSpec
from .clean import date_parts


def true_kpi_expr(target: str):
    """min(target) over positive copies; NULL when the week has none."""
    return F.min(F.when(F.col(target) > 0, F.col(target)))


def weekly_true_sales(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """D1 (+C1): one row per KPI key (default: week), every key kept, NULL when unknown."""
    keys = list(spec.kpi_keys)
    return (clean.where(F.col(spec.week_col).isNotNull())
                 .groupBy(*keys)
                 .agg(true_kpi_expr(spec.target_col).alias("total_sales")))


def weekly_metrics(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """D2 + C2 fused: additive sums and the repaired KPI in one grouped pass."""
    add = spec.present(clean, spec.additive)
    return (clean.where(F.col(spec.week_col).isNotNull())
                 .groupBy(spec.week_col)
                 .agg(*[F.sum(c).alias(c) for c in add],
                      true_kpi_expr(spec.target_col).alias("total_sales")))


def weekly_ratios(weekly: DataFrame) -> DataFrame:
    """Five ratios at the weekly grain; cost per sale uses the true sales."""
    names = set(weekly.columns)
    out = {}
    if {"clicks", "impressions"} <= names:
        out["ctr"] = safe_div("clicks", "impressions")
    if {"engagements", "impressions"} <= names:
        out["engagement_rate"] = safe_div("engagements", "impressions")
    if {"video_completes", "video_starts"} <= names:
        out["video_completion_rate"] = safe_div("video_completes", "video_starts")
    if {"spend", "engagements"} <= names:
        out["cost_per_engagement"] = safe_div("spend", "engagements")
    if {"spend", "total_sales"} <= names:
        out["cost_per_sale"] = safe_div("spend", "total_sales")
    return weekly.withColumns(out)


def weekly_feature_table(clean: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """D3: weekly sums + true sales + calendar parts + weekly ratios (one shuffle)."""
    return (weekly_metrics(clean, spec)
            .transform(date_parts, spec.week_col)
            .transform(weekly_ratios))


def fanout_evidence(raw: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """Per (unaligned) date each distinct positive KPI value, the date's minimum,
    the multiplier (1 dp) and the number of distinct values.

    Distinct (date, value) pairs first (partial aggregation collapses the copies), then a
    grouped aggregate joined back on the date key.
    """
    date = parse_mixed_date(spec.date_col, raw.schema[spec.date_col].dataType).cast("date").alias("activity_date")
    v = F.expr(f"try_cast(`{spec.target_col}` as double)")
    pairs = (raw.select(date, v.alias("sales_value"))
                .where(F.col("sales_value") > 0)
                .distinct())
    per_date = pairs.groupBy("activity_date").agg(
        F.min("sales_value").alias("min_sales"),
        F.count("*").alias("distinct_values"))
    return (pairs.join(per_date, "activity_date")
                 .withColumn("multiplier", F.bround(F.col("sales_value") / F.col("min_sales"), 1)))


def fanout_histogram(evidence: DataFrame) -> DataFrame:
    """Number of dates per distinct-value count."""
    return (evidence.select("activity_date", "distinct_values").distinct()
                    .groupBy("distinct_values").agg(F.count("*").alias("n_weeks")))


def evidence_classes(evidence: DataFrame) -> DataFrame:
    """Base (multiplier 1) vs inflated (> 1) copies with the marker size."""
    m = F.col("multiplier")
    return evidence.withColumns({
        "evidence_class": F.when(m == 1.0, "base").when(m > 1.0, "inflated"),
        "marker_size": F.when(m > 1.0, F.least(m, F.lit(30.0)) * 3 + 4).otherwise(F.lit(10.0)),
    })


def reconciliation(allocated: DataFrame, spec: MediaSpec = DEFAULT_SPEC,
                   tolerance: float = 0.01) -> DataFrame:
    """Largest |sum(allocated) - true sales| over weeks with known sales.

    Both sides come from one grouped pass over the allocated rows (the true weekly value
    is recomputed in the same aggregate), so no join is needed.
    """
    wk = (allocated.groupBy(spec.week_col)
                   .agg(F.sum("estimated_sales").alias("allocated"),
                        true_kpi_expr(spec.target_col).alias("total_sales"))
                   .where(F.col("total_sales").isNotNull()))
    diff = F.abs(F.col("allocated") - F.col("total_sales").cast("double"))
    return wk.agg(F.count("*").alias("known_weeks"),
                  F.max(diff).alias("max_abs_diff")).withColumn(
        "reconciles", F.coalesce(F.col("max_abs_diff") < tolerance, F.lit(True)))
