"""Registered views: name -> (spark, sf_dir) -> DataFrame, with the DuckDB oracle text.

Each builder composes the operators over the full source tables; ``present`` only fixes
the output types (ISO dates, DOUBLE money) and rounds sums whose last bits depend on
summation order.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import present
from ..operators import measure
from ..operators.allocate import activity_weight
from ..operators.clean import date_parts
from ..operators.quality import FLOW_NODES, WATERFALL_STEPS
from . import oracle as O
from .context import context

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------------
# Step 1: cleaning and the repaired weekly KPI
# ---------------------------------------------------------------------------------
@register("clean_rows", O.q(f"SELECT * EXCLUDE (week, spend, base_amount), {O.d('week')} AS week, "
                            "CAST(spend AS DOUBLE) AS spend, CAST(base_amount AS DOUBLE) AS base_amount "
                            "FROM clean"))
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(context(spark, sf_dir).clean())


@register("date_parts", O.q(f"SELECT DISTINCT {O.d('week')} AS week, year, quarter, month, month_name, "
                            "week_number FROM rows"))
def date_parts_q(spark, sf_dir):
    c = context(spark, sf_dir).clean_fact().drop("year", "quarter", "month", "month_name", "week_number")
    return present(c.select("week").transform(date_parts).distinct())


@register("credit_flags", O.q("SELECT spend_is_credit, COUNT(*) AS n_rows, "
                              "CAST(SUM(spend) AS DOUBLE) AS total_spend FROM clean GROUP BY spend_is_credit"))
def credit_flags(spark, sf_dir):
    c = context(spark, sf_dir).clean_fact()          # the cleaned rows, as written once
    return present(c.groupBy("spend_is_credit").agg(F.count("*").alias("n_rows"),
                                                    F.sum("spend").alias("total_spend")))


@register("dedup_rows", O.q("SELECT (SELECT COUNT(*) FROM media_raw) AS raw_rows, "
                            "(SELECT COUNT(*) FROM clean) AS clean_rows, "
                            "(SELECT COUNT(*) FROM media_raw) - (SELECT COUNT(*) FROM clean) AS dropped_rows",
                            copies=True))
def dedup_rows(spark, sf_dir):
    from ..operators.clean import clean
    ctx = context(spark, sf_dir)
    raw = ctx.raw_with_copies()
    counts = (raw.agg(F.count("*").alias("n")).withColumn("k", F.lit("raw"))
                 .unionByName(clean(raw, ctx.spec, ctx.pieces()).agg(F.count("*").alias("n")).withColumn("k", F.lit("clean"))))
    return counts.agg(F.sum(F.when(F.col("k") == "raw", F.col("n"))).alias("raw_rows"),
                      F.sum(F.when(F.col("k") == "clean", F.col("n"))).alias("clean_rows")) \
                 .withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))


@register("weekly_true_sales", O.q(f"SELECT {O.d('week')} AS week, CAST(total_sales AS DOUBLE) AS total_sales "
                                   "FROM weekly_sales"))
def weekly_true_sales(spark, sf_dir):
    return present(measure.weekly_true_sales(context(spark, sf_dir).clean_fact()))


# ---------------------------------------------------------------------------------
# Step 2: allocation of the KPI to rows
# ---------------------------------------------------------------------------------
@register("activity_weight", O.q(f"SELECT {O.d('week')} AS week, COUNT(*) AS n_rows, "
                                 "CAST(SUM(CASE WHEN spend = 0 AND impressions = 0 AND hh_grps_tv = 0 "
                                 "AND engagements = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_fallback, "
                                 "ROUND(SUM(activity_weight), 6) AS weight_total FROM weighted GROUP BY week"))
def activity_weight_q(spark, sf_dir):
    c = context(spark, sf_dir).clean_fact().drop("activity_weight")
    w = activity_weight(c)
    fallback = (F.col("spend") == 0) & (F.col("impressions") == 0) & (F.col("hh_grps_tv") == 0) & \
               (F.col("engagements") == 0)
    return present(w.groupBy("week").agg(F.count("*").alias("n_rows"),
                                         F.count_if(fallback).alias("n_fallback"),
                                         F.sum("activity_weight").alias("weight_total")),
                   {"weight_total": 6})


@register("allocated_sales", O.q(f"SELECT {O.d('week')} AS week, media_type, "
                                 "ROUND(SUM(estimated_sales), 2) AS estimated_sales FROM rows "
                                 "GROUP BY week, media_type"))
def allocated_sales(spark, sf_dir):
    r = context(spark, sf_dir).rows()
    return present(r.groupBy("week", "media_type").agg(F.sum("estimated_sales").alias("estimated_sales")),
                   {"estimated_sales": 2})


@register("breakdown_media_type", O.q("SELECT media_type, ROUND(SUM(estimated_sales), 2) AS estimated_sales "
                                      "FROM rows GROUP BY media_type"))
def breakdown_media_type(spark, sf_dir):
    from ..operators.eda import breakdown_by
    r = context(spark, sf_dir).rows()
    return present(breakdown_by(r, "media_type"), {"estimated_sales": 2})


@register("reconciliation", O.q("SELECT COUNT(*) AS known_weeks, ROUND(MAX(ABS(a - CAST(ts AS DOUBLE))), 2) "
                                "AS max_abs_diff, COALESCE(MAX(ABS(a - CAST(ts AS DOUBLE))) < 0.01, true) "
                                "AS reconciles FROM (SELECT week, SUM(estimated_sales) AS a, "
                                "MIN(CASE WHEN base_amount > 0 THEN base_amount END) AS ts FROM rows "
                                "GROUP BY week) t WHERE ts IS NOT NULL"))
def reconciliation(spark, sf_dir):
    r = context(spark, sf_dir).rows()
    return present(measure.reconciliation(r), {"max_abs_diff": 2})


# ---------------------------------------------------------------------------------
# Step 3: weekly table, row ratios, filters
# ---------------------------------------------------------------------------------
_WEEKLY_OUT = ("week, CAST(spend AS DOUBLE) AS spend, impressions, clicks, video_starts, video_completes, "
               "hh_grps_tv, engagements, CAST(total_sales AS DOUBLE) AS total_sales")


@register("weekly_features_base", O.q(
    f"SELECT {O.d('week')} AS week, CAST(spend AS DOUBLE) AS spend, impressions, clicks, video_starts, "
    "video_completes, hh_grps_tv, engagements, CAST(total_sales AS DOUBLE) AS total_sales, year, quarter, "
    "month, month_name, week_number, ctr, engagement_rate, video_completion_rate, cost_per_engagement, "
    "cost_per_sale FROM weekly_f"))
def weekly_features_base(spark, sf_dir):
    return present(context(spark, sf_dir).weekly())


@register("row_ratios", O.q(
    f"SELECT {O.d('week')} AS week, channel, media_type, CAST(spend AS DOUBLE) AS spend, "
    f"{O.div('clicks', 'impressions')} AS ctr, {O.div('engagements', 'impressions')} AS engagement_rate, "
    f"{O.div('video_completes', 'video_starts')} AS video_completion_rate, "
    f"{O.div('spend', 'engagements')} AS cost_per_engagement, {O.div('spend', 'clicks')} AS cpc, "
    f"{O.div('spend', 'impressions')} * 1000 AS cpm, "
    f"ROUND({O.div('spend', 'estimated_sales')}, 6) AS cost_per_sale FROM rows"))
def row_ratios_q(spark, sf_dir):
    from ..operators.efficiency import row_ratios
    r = row_ratios(context(spark, sf_dir).rows())
    return present(r.select("week", "channel", "media_type", "spend", "ctr", "engagement_rate",
                            "video_completion_rate", "cost_per_engagement", "cpc", "cpm", "cost_per_sale"),
                   {"cost_per_sale": 6})


FILTER_EXAMPLE = {"media_type": ["ECONOMY", "PROMO", "STANDARD"], "device": ["O", "Not Tracked"]}
_FILTER_SQL = "media_type IN ('ECONOMY', 'PROMO', 'STANDARD') AND device IN ('O', 'Not Tracked')"


@register("filtered_weekly", O.q(
    f"SELECT {O.d('f.week')} AS week, CAST(f.spend AS DOUBLE) AS spend, f.impressions, f.clicks, "
    "f.video_starts, f.video_completes, f.hh_grps_tv, f.engagements, "
    "CAST(ws.total_sales AS DOUBLE) AS total_sales FROM "
    f"(SELECT week, {O._weekly_sums()} FROM rows WHERE {_FILTER_SQL} GROUP BY week) f "
    "LEFT JOIN weekly_sales ws ON f.week = ws.week"))
def filtered_weekly_q(spark, sf_dir):
    from ..operators.eda import filtered_weekly
    ctx = context(spark, sf_dir)
    return present(filtered_weekly(ctx.clean_fact(), ctx.weekly_sales(), FILTER_EXAMPLE, ctx.spec.additive))


@register("rows_in_view", O.q(
    f"SELECT CAST(SUM(CASE WHEN {_FILTER_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS rows_in_view, "
    "COUNT(*) AS rows_total FROM rows"))
def rows_in_view_q(spark, sf_dir):
    from ..operators.eda import rows_in_view
    return rows_in_view(context(spark, sf_dir).clean_fact(), FILTER_EXAMPLE)


# ---------------------------------------------------------------------------------
# Step 4: executive views
# ---------------------------------------------------------------------------------
@register("kpi_summary", O.q(
    "SELECT CAST((SELECT SUM(total_sales) FROM weekly_sales) AS DOUBLE) AS total_sales, "
    "CAST(SUM(spend) AS DOUBLE) AS total_spend, CAST(SUM(impressions) AS BIGINT) AS total_impressions, "
    "CAST(SUM(clicks) AS BIGINT) AS total_clicks, CAST(SUM(engagements) AS BIGINT) AS total_engagements, "
    "CAST((SELECT SUM(total_sales) FROM weekly_sales) AS DOUBLE) / NULLIF(CAST(SUM(spend) AS DOUBLE), 0) "
    "AS romi FROM clean"))
def kpi_summary_q(spark, sf_dir):
    from ..operators.eda import kpi_summary
    return present(kpi_summary(context(spark, sf_dir).clean_fact()))


def _union_dims(dims, body):
    return " UNION ALL ".join(body(d) for d in dims)


SNAP = ["media_type", "channel", "site", "device", "platform_type"]
FILTER_DIMS = ["media_type", "channel", "sub_channel", "site", "device", "platform_type"]


@register("breakdown_all_dims", O.q(_union_dims(SNAP, lambda d: (
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, ROUND(SUM(estimated_sales), 2) "
    f"AS estimated_sales FROM rows GROUP BY {d}"))))
def breakdown_all_dims_q(spark, sf_dir):
    from ..operators.efficiency import breakdown_all_dims
    return present(breakdown_all_dims(context(spark, sf_dir).rows(), SNAP), {"estimated_sales": 2})


@register("top_creatives", O.q(
    "SELECT creative, ROUND(SUM(estimated_sales), 2) AS estimated_sales, CAST(SUM(spend) AS DOUBLE) AS spend, "
    "CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(engagements) AS BIGINT) AS engagements "
    "FROM rows GROUP BY creative ORDER BY SUM(estimated_sales) DESC, creative LIMIT 20"))
def top_creatives_q(spark, sf_dir):
    from ..operators.eda import top_creatives
    return present(top_creatives(context(spark, sf_dir).rows(), 20), {"estimated_sales": 2})


def _eff_sql(d, extra=""):
    return (f"CAST(SUM(spend) AS DOUBLE) AS spend, CAST(SUM(impressions) AS BIGINT) AS impressions, "
            f"CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(engagements) AS BIGINT) AS engagements, "
            f"{O.div('SUM(clicks)', 'SUM(impressions)')} AS ctr, {O.div('SUM(spend)', 'SUM(clicks)')} AS cpc, "
            f"{O.div('SUM(spend)', 'SUM(impressions)')} * 1000 AS cpm, "
            f"{O.div('SUM(spend)', 'SUM(engagements)')} AS cost_per_engagement{extra} FROM rows GROUP BY {d}")


@register("efficiency_by_channel", O.q(f"SELECT channel, {_eff_sql('channel')}"))
def efficiency_by_channel(spark, sf_dir):
    from ..operators.efficiency import efficiency_by
    return present(efficiency_by(context(spark, sf_dir).clean_fact(), "channel"))


@register("efficiency_all_dims", O.q(_union_dims(FILTER_DIMS, lambda d: (
    f"SELECT '{d}' AS dimension, {O.label(f'CAST({d} AS VARCHAR)')} AS value, "
    + _eff_sql(d, ", ROUND(SUM(estimated_sales), 2) AS estimated_sales")))))
def efficiency_all_dims_q(spark, sf_dir):
    from ..operators.efficiency import efficiency_all_dims
    return present(efficiency_all_dims(context(spark, sf_dir).rows(), FILTER_DIMS), {"estimated_sales": 2})


CORR_COLS = ["spend", "impressions", "clicks", "engagements", "total_sales"]
SALES_CORR = ["spend", "impressions", "clicks", "engagements", "reach", "video_starts", "video_completes",
              "hh_grps_tv", "likes", "comments"]
_PRESENT_SALES_CORR = ["spend", "impressions", "clicks", "engagements", "video_starts", "video_completes",
                       "hh_grps_tv"]


@register("correlation_matrix", O.q(" UNION ALL ".join(
    f"SELECT '{a}' AS col_x, '{b}' AS col_y, ROUND({O.corr(a, b)}, 6) AS r FROM weekly"
    for a in CORR_COLS for b in CORR_COLS)))
def correlation_matrix(spark, sf_dir):
    from ..operators.eda import correlation_long
    return present(correlation_long(context(spark, sf_dir).weekly(), CORR_COLS), {"r": 6})


@register("corr_with_sales", O.q(" UNION ALL ".join(
    f"SELECT '{a}' AS feature, ROUND({O.corr(a, 'total_sales')}, 6) AS r FROM weekly"
    for a in _PRESENT_SALES_CORR)))
def corr_with_sales(spark, sf_dir):
    from ..operators.eda import corr_with_target
    return present(corr_with_target(context(spark, sf_dir).weekly(), SALES_CORR), {"r": 6})


@register("spend_sales_trend", O.q(
    f"SELECT ROUND({O.corr('spend', 'total_sales')}, 6) AS r, "
    "regr_count(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) AS n_pairs, "
    "ROUND(CASE WHEN regr_count(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) > 2 THEN "
    "regr_slope(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) END, 9) AS slope, "
    "ROUND(CASE WHEN regr_count(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) > 2 THEN "
    "regr_intercept(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) END, 2) AS intercept, "
    "ROUND(COALESCE(AVG(CAST(spend AS DOUBLE)), 0), 4) AS mean_x, "
    "COALESCE(MAX(CAST(spend AS DOUBLE)), 1000000.0) AS max_x, "
    "ROUND(CASE WHEN regr_count(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) > 2 THEN "
    "regr_slope(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) * COALESCE(AVG(CAST(spend AS DOUBLE)), 0) "
    "+ regr_intercept(CAST(total_sales AS DOUBLE), CAST(spend AS DOUBLE)) END, 2) AS estimate_at_mean "
    "FROM weekly"))
def spend_sales_trend_q(spark, sf_dir):
    from ..operators.eda import spend_sales_trend
    out = spend_sales_trend(context(spark, sf_dir).weekly())
    return present(out.withColumn("n_pairs", F.col("n_pairs").cast("bigint")),
                   {"r": 6, "slope": 9, "intercept": 2, "mean_x": 4, "estimate_at_mean": 2})


DESCRIBE = ["spend", "impressions", "clicks", "engagements", "base_amount"]


@register("describe_metrics", O.q(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, COUNT(x) AS count, ROUND(AVG(x), 6) AS mean, ROUND(STDDEV_SAMP(x), 6) AS std, "
    f"MIN(x) AS min, ROUND(quantile_cont(x, 0.25), 6) AS p25, ROUND(quantile_cont(x, 0.5), 6) AS p50, "
    f"ROUND(quantile_cont(x, 0.75), 6) AS p75, MAX(x) AS max FROM (SELECT CAST({m} AS DOUBLE) AS x FROM clean) t"
    for m in DESCRIBE)))
def describe_metrics(spark, sf_dir):
    from ..operators.eda import describe
    return present(describe(context(spark, sf_dir).clean_fact(), DESCRIBE),
                   {"mean": 6, "std": 6, "p25": 6, "p50": 6, "p75": 6})


@register("series_peak", O.q(
    f"SELECT {O.d('week')} AS peak_week, CAST(total_sales AS DOUBLE) AS peak_value, "
    "CASE WHEN total_sales > 1000000 THEN printf('$%.1fM', CAST(total_sales AS DOUBLE) / 1000000) "
    "WHEN total_sales > 1000 THEN printf('$%.1fk', CAST(total_sales AS DOUBLE) / 1000) "
    "ELSE '$' || format('{:,.0f}', CAST(total_sales AS DOUBLE)) END AS peak_label "
    "FROM weekly_sales WHERE total_sales IS NOT NULL ORDER BY total_sales DESC, week LIMIT 1"))
def series_peak_q(spark, sf_dir):
    from ..operators.eda import series_peak
    return present(series_peak(context(spark, sf_dir).weekly_sales()))


@register("category_share", O.q(
    "SELECT media_type, ROUND(SUM(estimated_sales), 2) AS estimated_sales, "
    "ROUND(SUM(estimated_sales) / (SELECT SUM(estimated_sales) FROM rows), 6) AS share "
    "FROM rows GROUP BY media_type"))
def category_share_q(spark, sf_dir):
    from ..operators.eda import category_share
    return present(category_share(context(spark, sf_dir).rows(), "media_type"),
                   {"estimated_sales": 2, "share": 6})


@register("top1_per_dim", O.q(
    "SELECT dimension, value, ROUND(estimated_sales, 2) AS estimated_sales FROM ("
    "SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY estimated_sales DESC, value ASC NULLS LAST) "
    "AS rk FROM (" + _union_dims(SNAP, lambda d: (
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, SUM(estimated_sales) AS estimated_sales "
        f"FROM rows GROUP BY {d}")) + ") u) t WHERE rk = 1"))
def top1_per_dim_q(spark, sf_dir):
    from ..operators.efficiency import top1_per_dim
    return present(top1_per_dim(context(spark, sf_dir).rows(), SNAP), {"estimated_sales": 2})


# ---------------------------------------------------------------------------------
# Step 5: data quality and fan-out evidence
# ---------------------------------------------------------------------------------
_RAW_COLS = [c.strip() for c in O.RAW_COLS.split(",")]
_ACTIONS_SQL = ("CASE \"column\" " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in {
        "site": "Filled → 'Unknown' (structural)", "device": "Filled → 'Not Tracked' (structural)",
        "platform_type": "Filled → 'Unknown' (structural)",
        "partner_type": "Filled → 'Not Applicable' (structural)",
        "audience": "Filled → 'Not Applicable' (structural)",
        "creative": "Filled → 'Unspecified Creative' (structural)"}.items()).replace("'Unknown'", "''Unknown''")
    .replace("'Not Tracked'", "''Not Tracked''").replace("'Not Applicable'", "''Not Applicable''")
    .replace("'Unspecified Creative'", "''Unspecified Creative''")
    + " ELSE 'Left as NaN (metric — zero-fill)' END")

_MISSING_SQL = ("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing_count, "
    f"round_even(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 100, 2) AS missing_pct FROM media_raw"
    for c in _RAW_COLS) + ") m WHERE missing_count > 0")


@register("missing_report", O.q(_MISSING_SQL))
def missing_report_q(spark, sf_dir):
    from ..operators.quality import missing_report
    return missing_report(context(spark, sf_dir).raw())


@register("missing_detailed", O.q(
    "SELECT *, CASE WHEN missing_pct > 50 THEN 'High' WHEN missing_pct > 10 THEN 'Moderate' ELSE 'Low' END "
    f"AS severity, {_ACTIONS_SQL} AS action_taken, CASE WHEN \"column\" IN ('site', 'device', "
    "'platform_type', 'partner_type', 'audience', 'creative') THEN 'Structural' ELSE 'Metric' END AS category "
    f"FROM ({_MISSING_SQL}) md"))
def missing_detailed_q(spark, sf_dir):
    from ..operators.quality import missing_detailed
    return missing_detailed(context(spark, sf_dir).raw())


_FILL_NULLS = " + ".join(f"COUNT(*) - COUNT({c})" for c in
                         ["site", "device", "platform_type", "partner_type", "audience", "creative"])
_ALL_NULLS = " + ".join(f"COUNT(*) - COUNT({c})" for c in _RAW_COLS)
_SUMMARY_CTE = (
    ", qs AS (SELECT COUNT(*) AS total_rows, 19 AS total_columns, "
    f"CAST({_ALL_NULLS} AS BIGINT) AS total_missing_cells, "
    f"round_even(CAST({_ALL_NULLS} AS DOUBLE) / (COUNT(*) * 19) * 100, 2) AS missing_pct, "
    "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM media_raw) dd) AS duplicates_dropped, "
    "CAST(SUM(CASE WHEN regexp_replace(sub_channel, '^\\s+|\\s+$', '', 'g') = 'VIdeo' THEN 1 ELSE 0 END) AS BIGINT)"
    " AS typos_fixed, "
    f"CAST({_FILL_NULLS} AS BIGINT) AS structural_nas_filled, "
    "CAST(SUM(CASE WHEN spend < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_spend_rows, "
    "COUNT(DISTINCT activity_date) AS distinct_weeks, (SELECT COUNT(*) FROM clean) AS clean_rows, "
    "33 AS clean_columns FROM media_raw) ")


def _quality_frames(spark, sf_dir):
    """The one-row quality summary, computed once per context (waterfall and flow edges
    are projections of it)."""
    from ..operators.clean import clean
    from ..operators.quality import quality_summary
    ctx = context(spark, sf_dir)
    with ctx._lock:
        if getattr(ctx, "_quality", None) is None:
            raw = ctx.raw_with_copies()
            width = len(ctx.row_level().columns)       # the published row-level table
            ctx._quality = quality_summary(raw, clean(raw, ctx.spec, ctx.pieces()), ctx.spec,
                                           clean_columns=width, pieces=ctx.pieces()).checkpoint(eager=True)
        return ctx._quality


@register("quality_summary", O.q(_SUMMARY_CTE + "SELECT * FROM qs", copies=True))
def quality_summary_q(spark, sf_dir):
    return _quality_frames(spark, sf_dir)


_WATERFALL = [
    ("total_missing_cells", "absolute", "true"),
    ("-structural_nas_filled", "relative", "structural_nas_filled > 0"),
    ("-typos_fixed", "relative", "typos_fixed > 0"),
    ("-duplicates_dropped", "relative", "duplicates_dropped > 0"),
    ("-negative_spend_rows", "relative", "negative_spend_rows > 0"),
    ("-(total_missing_cells - structural_nas_filled - typos_fixed - "
     "duplicates_dropped - negative_spend_rows)", "relative",
     "total_missing_cells - structural_nas_filled - typos_fixed - duplicates_dropped - negative_spend_rows > 0"),
    ("0", "total", "true"),
]


@register("cleaning_waterfall", O.q(_SUMMARY_CTE + " UNION ALL ".join(
    f"SELECT {i} AS seq, '{n}' AS step, CAST({v} AS BIGINT) AS value, '{m}' AS measure FROM qs WHERE {k}"
    for i, (n, (v, m, k)) in enumerate(zip(WATERFALL_STEPS, _WATERFALL))), copies=True))
def cleaning_waterfall_q(spark, sf_dir):
    from ..operators.quality import cleaning_waterfall
    return cleaning_waterfall(_quality_frames(spark, sf_dir))


_EDGES = [(0, 1, "total_missing_cells"), (0, 2, "GREATEST(typos_fixed, 1)"),
          (0, 3, "GREATEST(structural_nas_filled, 1)"), (0, 4, "GREATEST(duplicates_dropped, 1)"),
          (0, 5, "GREATEST(negative_spend_rows, 1)"),
          (1, 6, "GREATEST(total_missing_cells - structural_nas_filled, 1)"), (2, 6, "GREATEST(typos_fixed, 1)"),
          (3, 6, "GREATEST(structural_nas_filled, 1)"), (4, 6, "GREATEST(duplicates_dropped, 1)"),
          (5, 6, "GREATEST(negative_spend_rows, 1)")]


@register("cleaning_flow_edges", O.q(_SUMMARY_CTE + " UNION ALL ".join(
    f"SELECT '{FLOW_NODES[a]}' AS source, '{FLOW_NODES[b]}' AS target, CAST({v} AS BIGINT) AS value FROM qs"
    for a, b, v in _EDGES), copies=True))
def cleaning_flow_edges_q(spark, sf_dir):
    from ..operators.quality import cleaning_flow_edges
    return cleaning_flow_edges(_quality_frames(spark, sf_dir))


_EVIDENCE_CTE = (
    ", pairs AS (SELECT DISTINCT activity_date, CAST(base_amount AS DOUBLE) AS sales_value FROM media_raw "
    "WHERE base_amount > 0), per_date AS (SELECT activity_date, MIN(sales_value) AS min_sales, "
    "COUNT(*) AS distinct_values FROM pairs GROUP BY activity_date), ev AS (SELECT p.activity_date, "
    "p.sales_value, d.min_sales, round_even(p.sales_value / d.min_sales, 1) AS multiplier, d.distinct_values "
    "FROM pairs p JOIN per_date d ON p.activity_date = d.activity_date) ")


@register("fanout_evidence", O.q(
    _EVIDENCE_CTE + f"SELECT {O.d('activity_date')} AS activity_date, sales_value, min_sales, multiplier, "
    "distinct_values, CASE WHEN multiplier = 1.0 THEN 'base' WHEN multiplier > 1.0 THEN 'inflated' END "
    "AS evidence_class, CASE WHEN multiplier > 1.0 THEN LEAST(multiplier, 30.0) * 3 + 4 ELSE 10.0 END "
    "AS marker_size FROM ev"))
def fanout_evidence_q(spark, sf_dir):
    from ..operators.measure import evidence_classes, fanout_evidence
    return present(fanout_evidence(context(spark, sf_dir).raw()).transform(evidence_classes))


@register("fanout_histogram", O.q(
    _EVIDENCE_CTE + "SELECT distinct_values, COUNT(*) AS n_weeks FROM (SELECT DISTINCT activity_date, "
    "distinct_values FROM ev) h GROUP BY distinct_values"))
def fanout_histogram_q(spark, sf_dir):
    from ..operators.measure import fanout_evidence, fanout_histogram
    return fanout_histogram(fanout_evidence(context(spark, sf_dir).raw()))


# ---------------------------------------------------------------------------------
# Step 6: time-series features, caps, model dataset, split, lookback, future weeks
# ---------------------------------------------------------------------------------
def _features(spark, sf_dir):
    from ..operators.features import engineer_features
    return engineer_features(context(spark, sf_dir).weekly())


def _fdig(cols):
    return {c: O.feat_digits(c) for c in cols if O.feat_digits(c) is not None}


def _fpresent(df, cols):
    out = df.select("week", *[F.col(c).cast("double").alias(c) for c in cols])
    return present(out, _fdig(cols))


_LAGS = ["total_sales"] + O.SALES_FEATS
_ROLLS = O.ROLL
_EWM = ["sales_ewm_4", "sales_diff_1", "sales_ratio_to_mean_8"]
_MEDIA = ["spend_lag_1", "impressions_lag_1", "clicks_lag_1"]
_SEASON = ["week_number", "week_of_year_sin", "week_of_year_cos"]


def _feat_view(name, cols, src="feat2"):
    sql = O.fq(f"SELECT {O.d('week')} AS week, {O.feat_select(cols)} FROM {src}")

    @register(name, sql)
    def view(spark, sf_dir):
        return _fpresent(_features(spark, sf_dir), cols)
    view.__name__ = name
    return view


_feat_view("sales_lags", _LAGS)
_feat_view("rolling_stats", _ROLLS)
_feat_view("ewm_momentum", _EWM)
_feat_view("media_lags", _MEDIA)
_feat_view("seasonality", _SEASON)


def _model(spark, sf_dir):
    from ..operators.features import model_dataset
    return model_dataset(context(spark, sf_dir).weekly())


@register("ratio_caps", O.fq("SELECT ROUND(cap_ctr, 10) AS ctr_cap, ROUND(cap_er, 10) AS engagement_rate_cap, "
                             "ROUND(cap_vcr, 10) AS video_completion_rate_cap FROM caps"))
def ratio_caps_q(spark, sf_dir):
    from ..operators.features import LAG_FEATURES, ROLLING_FEATURES, RATIO_CAP_COLS, engineer_features
    eng = engineer_features(context(spark, sf_dir).weekly())
    kept = eng.dropna(subset=[c for c in LAG_FEATURES + ROLLING_FEATURES if c in eng.columns])
    out = kept.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.99)).alias(f"{c}_cap")
                     for c in RATIO_CAP_COLS])
    return present(out, {c: 10 for c in out.columns})


@register("model_dataset", O.fq(f"SELECT {O.d('week')} AS week, {O.feat_select(['total_sales'] + O.FEATURES)} "
                                "FROM model"))
def model_dataset_q(spark, sf_dir):
    df, feats, _ = _model(spark, sf_dir)
    return _fpresent(df, ["total_sales"] + feats)


@register("time_split", O.fq(f"SELECT {O.d('week')} AS week, split FROM split"))
def time_split_q(spark, sf_dir):
    from ..operators.features import time_split
    df, _, _ = _model(spark, sf_dir)
    return present(time_split(df).select("week", "split"))


@register("lookback", O.q(f"SELECT {O.d('week')} AS week, CAST(total_sales AS DOUBLE) AS total_sales "
                          "FROM weekly_sales WHERE total_sales IS NOT NULL ORDER BY week DESC LIMIT 52"))
def lookback_q(spark, sf_dir):
    from ..operators.eda import lookback
    return present(lookback(context(spark, sf_dir).weekly_sales(), 52, require="total_sales"))


@register("future_weeks", O.q(
    ", anchor AS (SELECT MAX(CASE WHEN total_sales IS NOT NULL THEN week END) AS a, MAX(week) AS l "
    "FROM weekly_sales), ex AS (SELECT week FROM weekly_sales, anchor WHERE week > a ORDER BY week LIMIT 20), "
    "pad AS (SELECT CAST(l + INTERVAL (7 * i) DAY AS DATE) AS week FROM anchor, "
    "range(1, 1 + 20 - LEAST((SELECT COUNT(*) FROM ex), 20)) t(i)) "
    f"SELECT {O.d('week')} AS week, false AS is_padded FROM ex UNION ALL "
    f"SELECT {O.d('week')} AS week, true AS is_padded FROM pad"))
def future_weeks_q(spark, sf_dir):
    from ..operators.features import future_weeks
    ws = context(spark, sf_dir).weekly_sales()
    return present(future_weeks(ws, 20).select("week", "is_padded"))


# ---------------------------------------------------------------------------------
# Steps 7-9: model tournament, leaderboard, recursive forecast
# ---------------------------------------------------------------------------------
TOURNAMENT = ["ridge", "arx", "forest", "gbt", "huber", "stack"]


class ModelSuite:
    """Trains the six models once per context on the 'train' split of a weekly table and keeps them.

    ``rounds`` replaces the boosted models' own number of rounds where a caller asks for it.
    """

    def __init__(self, ctx, weekly=None, rounds=None):
        from ..operators.features import BASE_FEATURES, model_dataset, time_split
        self.ctx, self.rounds = ctx, rounds
        self.weekly = ctx.weekly() if weekly is None else weekly
        df, self.feats, self.caps = model_dataset(self.weekly)
        self.base = [c for c in BASE_FEATURES if c in self.feats]
        self.data = (time_split(df, ctx.spec.test_weeks).withColumn("label", F.log1p("total_sales"))
                     .checkpoint(eager=True))
        self.train = self.data.where(F.col("split") == "train")
        self.fits = {}
        self._lock = threading.RLock()

    def fit(self, key):
        with self._lock:                  # each model is fitted once, even from threads
            if key not in self.fits:
                self.fits.update(self._fit(key))
            return self.fits[key]

    def _fit(self, key) -> dict:
        """The fit asked for; the stack brings its base models, fitted on all training rows, with it."""
        from ..operators import models as M
        from ..operators.forecast import NaiveFit
        f, tr = self.feats, self.train
        seed = {"seed": self.ctx.spec.seed}
        changes = {**seed, **({"rounds": self.rounds} if self.rounds else {})}
        if key == "stack":
            fit = M.fit_stack(tr, f, **changes)
            return {key: fit, **fit.bases}
        made = {"naive": lambda: NaiveFit(), "ridge": lambda: M.fit_ridge(tr, f), "arx": lambda: M.fit_arx(tr, f, self.base),
                "forest": lambda: M.fit_forest(tr, f, **seed), "gbt": lambda: M.fit_gbt(tr, f, **changes),
                "huber": lambda: M.fit_huber(tr, f, **changes)}
        return {key: made[key]()}

    def predictions(self, key, name=None):
        from ..operators.models import MODEL_NAMES, predictions
        return predictions(self.fit(key), self.data.where(F.col("split") != "forecast"),
                           name or MODEL_NAMES.get(key, key))

    def board(self):
        """Leaderboard of all six models, worked out once."""
        from ..operators.models import leaderboard
        with self._lock:
            if getattr(self, "_board", None) is None:
                self.fit("stack")                             # three of the six in one go
                preds = None
                for key in TOURNAMENT:
                    p = self.predictions(key)
                    preds = p if preds is None else preds.unionByName(p)
                self._board = leaderboard(preds).checkpoint(eager=True)
            return self._board

    def champion(self):
        """(key, row of the leaderboard) of the model with the least holdout RMSE."""
        from ..operators.models import MODEL_NAMES
        best = self.board().orderBy("rmse", "model").first()
        return {v: k for k, v in MODEL_NAMES.items()}[best["model"]], best

    def champion_forecast(self):
        from ..operators.forecast import attach_interval, recursive_forecast
        key, best = self.champion()
        fc = recursive_forecast(self.weekly, self.fit(key), self.feats, self.caps, self.ctx.spec.horizon)
        return attach_interval(fc, best["rmse"]).withColumn("model", F.lit(best["model"]))


def suite(spark, sf_dir, rounds=None) -> ModelSuite:
    ctx = context(spark, sf_dir)
    with ctx._lock:
        if getattr(ctx, "_suite", None) is None:
            ctx._suite = ModelSuite(ctx, rounds=rounds)
        return ctx._suite


def panel_suite(spark, sf_dir) -> ModelSuite:
    """The same models pooled over every channel's weeks (AR-X: one a channel)."""
    ctx = context(spark, sf_dir)
    with ctx._lock:
        if getattr(ctx, "_panel_suite", None) is None:
            ctx._panel_suite = ModelSuite(ctx, _panel(spark, sf_dir))
        return ctx._panel_suite


_NAIVE_PRED = ("SELECT split, total_sales AS y, sales_lag_1 AS yhat FROM split WHERE split <> 'forecast'")
_METRIC_SQL = (
    "SELECT 'Naive (lag 1)' AS model, split, ROUND(sqrt(AVG((y - yhat) * (y - yhat))), 4) AS rmse, "
    "ROUND(AVG(ABS(y - yhat)), 4) AS mae, "
    "ROUND(AVG(ABS(y - yhat) / GREATEST(ABS(y), 2.220446049250313e-16)) * 100, 6) AS mape_pct, "
    "ROUND(1 - SUM((y - yhat) * (y - yhat)) / (VAR_POP(y) * COUNT(*)), 9) AS r2 "
    f"FROM ({_NAIVE_PRED}) p GROUP BY split")


@register("naive_metrics", O.fq(_METRIC_SQL))
def naive_metrics(spark, sf_dir):
    from ..operators.models import metrics
    s = suite(spark, sf_dir)
    m = metrics(s.predictions("naive", "Naive (lag 1)").withColumn("yhat", F.round("yhat", 6)))
    return present(m, {"rmse": 4, "mae": 4, "mape_pct": 6, "r2": 9})


def _holdout_view(name, key):
    @register(name)
    def view(spark, sf_dir):
        p = suite(spark, sf_dir).predictions(key)
        return present(p.where(F.col("split") == "test").drop("split"))
    view.__name__ = name
    return view


_holdout_view("ridge_holdout", "ridge")
_holdout_view("ar_x_holdout", "arx")
_holdout_view("forest_holdout", "forest")
_holdout_view("gbt_holdout", "gbt")
_holdout_view("huber_boost_holdout", "huber")
_holdout_view("stacked_holdout", "stack")


@register("leaderboard")
def leaderboard_q(spark, sf_dir):
    return suite(spark, sf_dir).board().orderBy("rmse", "model")


def _naive_forecast(spark, sf_dir, horizon=12):
    """The lag-1 recursive forecast, computed once per context (checkpointed)."""
    from ..operators.forecast import recursive_forecast
    s = suite(spark, sf_dir)
    with s.ctx._lock:
        if getattr(s, "_naive_fc", None) is None:
            s._naive_fc = recursive_forecast(s.ctx.weekly(), s.fit("naive"), s.feats, s.caps,
                                             horizon).checkpoint(eager=True)
        return s._naive_fc


_FC_SQL = (
    ", anchor AS (SELECT MAX(week) AS a FROM weekly_sales WHERE total_sales IS NOT NULL), "
    "last_val AS (SELECT CAST(total_sales AS DOUBLE) AS v FROM weekly_sales, anchor WHERE week = a), "
    "fc AS (SELECT w.week, (SELECT v FROM last_val) AS forecasted_sales FROM weekly_sales w, anchor "
    "WHERE w.week > a ORDER BY w.week LIMIT 12) ")


@register("recursive_forecast", O.fq(_FC_SQL + f"SELECT 'all' AS series, {O.d('week')} AS week, "
                                     "ROUND(forecasted_sales, 2) AS forecasted_sales FROM fc"))
def recursive_forecast_q(spark, sf_dir):
    return present(_naive_forecast(spark, sf_dir), {"forecasted_sales": 2})


_NAIVE_RMSE = (f"(SELECT sqrt(AVG((y - yhat) * (y - yhat))) FROM ({_NAIVE_PRED}) p WHERE split = 'test')")


@register("forecast_interval", O.fq(
    _FC_SQL + f"SELECT 'all' AS series, {O.d('week')} AS week, ROUND(forecasted_sales, 2) AS forecasted_sales, "
    f"ROUND(GREATEST(forecasted_sales - {_NAIVE_RMSE}, 0), 2) AS lower_bound, "
    f"ROUND(forecasted_sales + {_NAIVE_RMSE}, 2) AS upper_bound FROM fc"))
def forecast_interval_q(spark, sf_dir):
    from ..operators.forecast import attach_interval
    from ..operators.models import metrics
    s = suite(spark, sf_dir)
    rmse = metrics(s.predictions("naive")).where("split = 'test'").first()["rmse"]
    out = attach_interval(_naive_forecast(spark, sf_dir), rmse)
    return present(out, {"forecasted_sales": 2, "lower_bound": 2, "upper_bound": 2})


@register("forecast_summary", O.fq(
    _FC_SQL + "SELECT 'all' AS series, ROUND(AVG(forecasted_sales), 2) AS mean_forecast, "
    "ROUND(SUM(forecasted_sales), 2) AS total_forecast, COUNT(*) AS horizon, "
    "(SELECT v FROM last_val) AS last_actual, "
    "ROUND(CASE WHEN (SELECT v FROM last_val) <> 0 THEN (AVG(forecasted_sales) - (SELECT v FROM last_val)) / "
    "(SELECT v FROM last_val) * 100 ELSE 0 END, 6) + 0.0 AS trend_pct, "
    "CASE WHEN ROUND(CASE WHEN (SELECT v FROM last_val) <> 0 THEN (AVG(forecasted_sales) - (SELECT v FROM last_val))"
    " / (SELECT v FROM last_val) * 100 ELSE 0 END, 6) > 0 THEN 'up' ELSE 'down' END AS direction FROM fc"))
def forecast_summary_q(spark, sf_dir):
    from ..operators.forecast import forecast_summary
    fc = _naive_forecast(spark, sf_dir).withColumn("forecasted_sales", F.round("forecasted_sales", 6))
    out = forecast_summary(fc, context(spark, sf_dir).weekly())
    out = out.withColumn("trend_pct", F.round("trend_pct", 6)).withColumn(
        "direction", F.when(F.col("trend_pct") > 0, "up").otherwise("down"))
    return present(out, {"mean_forecast": 2, "total_forecast": 2})


# every kind of feature that the state or the candidate rows give, so a wrong one shows
LINEAR = {"sales_lag_1": 0.3, "sales_lag_2": 0.05, "sales_lag_3": 0.05, "sales_lag_8": 0.05,
          "sales_rolling_mean_4": 0.1, "sales_rolling_mean_8": 0.1, "sales_rolling_std_8": 0.1,
          "sales_rolling_min_8": 0.05, "sales_rolling_max_8": 0.05, "sales_ewm_4": 0.1, "sales_diff_1": 0.2,
          "sales_ratio_to_mean_8": 10.0, "spend_lag_1": 0.001, "clicks_lag_1": 0.01, "spend": 0.002, "month": 5.0,
          "week_of_year_sin": 50.0}
LINEAR_HORIZON = 24          # past the last logged week, so padded weeks are reached


def _linear_forecast(weekly):
    from ..operators.features import feature_columns
    from ..operators.forecast import LinearFit, recursive_forecast
    present_ = [c for c in feature_columns() if c in LINEAR or c in weekly.columns]
    fc = recursive_forecast(weekly, LinearFit(LINEAR), present_, {}, LINEAR_HORIZON)
    return present(fc, {"forecasted_sales": 2})


@register("linear_forecast", O.linear_forecast(O.fq(""), LINEAR, LINEAR_HORIZON))
def linear_forecast_q(spark, sf_dir):
    """I13 with a model that reads every state feature."""
    return _linear_forecast(context(spark, sf_dir).weekly())


@register("panel_linear_forecast", O.linear_forecast(O.pfq(""), LINEAR, LINEAR_HORIZON))
def panel_linear_forecast_q(spark, sf_dir):
    """The same for every channel at once."""
    return _linear_forecast(_panel(spark, sf_dir))


@register("ar_x_forecast")
def ar_x_forecast_q(spark, sf_dir):
    """AR-X rolled forward on its own predictions."""
    from ..operators.forecast import recursive_forecast
    s = suite(spark, sf_dir)
    return present(recursive_forecast(s.ctx.weekly(), s.fit("arx"), s.feats, s.caps, 12), {"forecasted_sales": 2})


# Per-series AR-X of one lag and two columns: normal equations that SQL can solve
ARX_EXOG, ARX_PENALTY = ("spend", "clicks"), 1.0


def _pair_arx(s):
    from ..operators.models import fit_arx
    return fit_arx(s.train, s.feats, list(ARX_EXOG), penalty=ARX_PENALTY)


@register("panel_ar_x_holdout", O.arx_holdout(O.pfq(""), ARX_EXOG, ARX_PENALTY))
def panel_ar_x_holdout(spark, sf_dir):
    """One regression a channel; each holdout follows its own predictions."""
    from ..operators.models import predictions
    s = panel_suite(spark, sf_dir)
    p = predictions(_pair_arx(s), s.data.where(F.col("split") != "forecast"), "arx").where(F.col("split") == "test")
    return present(p.select("series", "week", "y", "yhat"), {"y": 2, "yhat": 2})


@register("panel_ar_x_forecast", O.arx_forecast(O.pfq(""), ARX_EXOG, ARX_PENALTY, LINEAR_HORIZON))
def panel_ar_x_forecast(spark, sf_dir):
    """Every channel's regression rolled forward, padded weeks included."""
    from ..operators.forecast import recursive_forecast
    s = panel_suite(spark, sf_dir)
    fc = recursive_forecast(s.weekly, _pair_arx(s), s.feats, {}, LINEAR_HORIZON)
    return present(fc, {"forecasted_sales": 2})


# One boosting round of depth 1, whose split and leaf values SQL can work out
STUMP = ("month", "quarter")
_STUMP_SQL = O.stump(O.fq(""), STUMP, 0.9, 0.5, 1.0, 2)


def _stumps(spark, sf_dir):
    from ..operators.boost import fit_boosters
    from ..operators.models import gbt_spec, huber_spec
    s = suite(spark, sf_dir)
    once = {"rounds": 1, "depth": 1, "step": 1.0, "rows": 1.0, "columns": 1.0}
    return s, dict(zip(("squared", "huber"), fit_boosters(s.train, STUMP, [gbt_spec(**once), huber_spec(**once)])))


@register("boosted_stump", _STUMP_SQL + f"SELECT s.model, s.series, {O.d('s.week')} AS week, s.split, ROUND(total_sales, 2) AS y, "
          "ROUND(exp(init + v) - 1, 2) AS yhat FROM side s JOIN leaf l ON s.model = l.model AND s.lo = l.lo JOIN par p ON p.model = s.model")
def boosted_stump(spark, sf_dir):
    """I8 (L1 and L2 on leaf values) and I9 (Huber leaves) with one tree of depth 1."""
    from ..operators.models import predictions
    s, fits = _stumps(spark, sf_dir)
    data = s.data.where(F.col("split") != "forecast")
    p = predictions(fits["squared"], data, "squared").unionByName(predictions(fits["huber"], data, "huber"))
    return present(p, {"y": 2, "yhat": 2})


@register("boosted_stump_shap", _STUMP_SQL + ", ev AS (SELECT model, SUM(n * v) / SUM(n) AS e FROM leaf GROUP BY model) "
          f"SELECT s.model, s.series, {O.d('s.week')} AS week, c.name AS feature, "
          "ROUND(CASE WHEN s.f = c.i THEN v - e ELSE 0.0 END, 8) + 0.0 AS shap_value "
          "FROM side s JOIN leaf l ON s.model = l.model AND s.lo = l.lo JOIN ev ON ev.model = s.model, "
          "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(STUMP)) + ") c(i, name) WHERE s.split = 'train'")
def boosted_stump_shap(spark, sf_dir):
    """J3 on the same trees."""
    from ..operators.explain import shap_values
    s, fits = _stumps(spark, sf_dir)
    out = None
    for name, fit in fits.items():
        one = shap_values(s.train, fit, ["series", "week"]).withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return present(out, {"shap_value": 8})


# Models that SQL can compute, through the same prediction, leaderboard and comparison operators
BASELINES = {"Lag 1": {"sales_lag_1": 1.0}, "Mean of 8 weeks": {"sales_rolling_mean_8": 1.0},
             "Fixed linear": {"sales_lag_1": 0.5, "sales_lag_2": 0.2, "sales_ewm_4": 0.2, "sales_rolling_std_8": 0.1,
                              "spend": 0.001}}
_BASE_PREDS = " UNION ALL ".join(
    f"SELECT '{name}' AS model, series, week, split, total_sales AS y, GREATEST({O.linear(w)}, 0.0) AS yhat "
    "FROM split WHERE split <> 'forecast'" for name, w in BASELINES.items())
_BASE_BOARD = (
    f"p AS ({_BASE_PREDS}), m AS (SELECT model, split, sqrt(AVG((y - yhat) * (y - yhat))) AS rmse, "
    "AVG(ABS(y - yhat)) AS mae, AVG(ABS(y - yhat) / GREATEST(ABS(y), 2.220446049250313e-16)) * 100 AS mape_pct, "
    "1 - SUM((y - yhat) * (y - yhat)) / (VAR_POP(y) * COUNT(*)) AS r2 FROM p GROUP BY model, split), "
    "board AS (SELECT t.model, ROUND(t.rmse, 4) AS rmse, ROUND(t.mae, 4) AS mae, ROUND(t.mape_pct, 6) AS mape_pct, "
    "ROUND(t.r2, 9) AS r2_holdout, ROUND(r.r2, 9) AS r2_train FROM m t JOIN m r ON t.model = r.model "
    "WHERE t.split = 'test' AND r.split = 'train') ")


def _baseline_preds(spark, sf_dir):
    from ..operators.forecast import LinearFit
    from ..operators.models import predictions
    data = suite(spark, sf_dir).data.where(F.col("split") != "forecast")
    out = None
    for name, w in BASELINES.items():
        p = predictions(LinearFit(w), data, name)
        out = p if out is None else out.unionByName(p)
    return out


def _baseline_board(spark, sf_dir):
    from ..operators.models import leaderboard
    return present(leaderboard(_baseline_preds(spark, sf_dir)),
                   {"rmse": 4, "mae": 4, "mape_pct": 6, "r2_holdout": 9, "r2_train": 9})


@register("baseline_holdout", O.fq(
    f", p AS ({_BASE_PREDS}) SELECT model, series, {O.d('week')} AS week, ROUND(y, 2) AS y, ROUND(yhat, 2) AS yhat "
    "FROM p WHERE split = 'test'"))
def baseline_holdout(spark, sf_dir):
    p = _baseline_preds(spark, sf_dir).where(F.col("split") == "test").drop("split")
    return present(p, {"y": 2, "yhat": 2})


@register("baseline_leaderboard", O.fq(", " + _BASE_BOARD + "SELECT * FROM board"))
def baseline_leaderboard(spark, sf_dir):
    return _baseline_board(spark, sf_dir)


@register("baseline_comparison", O.fq(", " + _BASE_BOARD + " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, {m} AS value FROM board"
    for m in ["rmse", "mae", "mape_pct", "r2_train", "r2_holdout"])))
def baseline_comparison(spark, sf_dir):
    from ..operators.models import model_comparison
    return model_comparison(_baseline_board(spark, sf_dir))


# Ridge of two features at one penalty: the normal equations in closed form
PAIR, PENALTY = ("spend", "sales_rolling_mean_8"), 3.0
_PAIR_SQL = (
    ", tr AS (SELECT series, week, CAST({0} AS DOUBLE) AS a, CAST({1} AS DOUBLE) AS b, ln(1 + total_sales) AS y "
    "FROM split WHERE split = 'train'), st AS (SELECT COUNT(*) AS n, AVG(a) AS ma, AVG(b) AS mb, "
    "stddev_pop(a) AS sa, stddev_pop(b) AS sb, corr(a, b) AS r, covar_pop(a, y) AS ca, covar_pop(b, y) AS cb FROM tr), "
    "eq AS (SELECT *, n + {2} AS d, n * r AS e, n * ca / sa AS u, n * cb / sb AS v FROM st), "
    "w AS (SELECT *, (u * d - e * v) / (d * d - e * e) AS wa, (d * v - e * u) / (d * d - e * e) AS wb FROM eq) "
).format(*PAIR, PENALTY)


def _pair_fit(spark, sf_dir):
    from ..operators.models import fit_ridge
    s = suite(spark, sf_dir)
    return s, fit_ridge(s.train, list(PAIR), [PENALTY])


@register("pair_coefficients", O.fq(
    _PAIR_SQL + f"SELECT '{PAIR[0]}' AS feature, ROUND(wa, 9) AS coefficient FROM w UNION ALL "
    f"SELECT '{PAIR[1]}', ROUND(wb, 9) FROM w"))
def pair_coefficients(spark, sf_dir):
    """I6 + J1 on two features, where SQL can solve the equations."""
    from ..operators.explain import std_coefficients
    _, fit = _pair_fit(spark, sf_dir)
    return present(_pairs_frame(spark, std_coefficients(fit), "feature string, coefficient double"), {"coefficient": 9})


_PAIR_SHAP = (f"SELECT series, week, '{PAIR[0]}' AS feature, (a - ma) / sa * wa AS v FROM tr, w UNION ALL "
              f"SELECT series, week, '{PAIR[1]}', (b - mb) / sb * wb FROM tr, w")


@register("pair_shap", O.fq(
    _PAIR_SQL + f"SELECT series, {O.d('week')} AS week, feature, ROUND(v, 8) + 0.0 AS shap_value FROM ({_PAIR_SHAP}) x"))
def pair_shap(spark, sf_dir):
    """J5 for the two-feature ridge."""
    from ..operators.explain import linear_shap
    s, fit = _pair_fit(spark, sf_dir)
    return present(linear_shap(s.train, fit, ["series", "week"]), {"shap_value": 8})


@register("pair_shap_global", O.fq(
    _PAIR_SQL + f"SELECT feature, ROUND(AVG(ABS(v)), 8) AS mean_abs_shap FROM ({_PAIR_SHAP}) x GROUP BY feature"))
def pair_shap_global(spark, sf_dir):
    """J4 over J5's values."""
    from ..operators.explain import linear_shap, shap_global
    s, fit = _pair_fit(spark, sf_dir)
    return present(shap_global(linear_shap(s.train, fit, ["series", "week"])), {"mean_abs_shap": 8})


@register("champion_forecast")
def champion_forecast(spark, sf_dir):
    """Forecast with the leaderboard's best model and its holdout RMSE band."""
    return suite(spark, sf_dir).champion_forecast()


# ---------------------------------------------------------------------------------
# Step 10: explainability and insights
# ---------------------------------------------------------------------------------
def _pairs_frame(spark, pairs, names):
    return spark.createDataFrame([tuple(p) for p in pairs], names)


@register("std_coefficients")
def std_coefficients_q(spark, sf_dir):
    from ..operators.explain import std_coefficients
    return _pairs_frame(spark, std_coefficients(suite(spark, sf_dir).fit("ridge")), "feature string, coefficient double")


@register("tree_importance")
def tree_importance_q(spark, sf_dir):
    from ..operators.explain import tree_importance
    return _pairs_frame(spark, tree_importance(suite(spark, sf_dir).fit("forest")), "feature string, importance double")


def _shap(spark, sf_dir):
    from ..operators.explain import shap_values
    s = suite(spark, sf_dir)
    if getattr(s, "_shap", None) is None:
        s._shap = shap_values(s.train, s.fit("gbt"), ["series", "week"]).checkpoint(eager=True)
    return s._shap


@register("shap_values")
def shap_values_q(spark, sf_dir):
    return present(_shap(spark, sf_dir))


@register("shap_global")
def shap_global_q(spark, sf_dir):
    from ..operators.explain import shap_global
    return shap_global(_shap(spark, sf_dir))


@register("shap_beeswarm")
def shap_beeswarm_q(spark, sf_dir):
    from ..operators.explain import beeswarm
    s = suite(spark, sf_dir)
    return present(beeswarm(_shap(spark, sf_dir), s.train, ["series", "week"]))


@register("linear_shap")
def linear_shap_q(spark, sf_dir):
    from ..operators.explain import linear_shap
    s = suite(spark, sf_dir)
    return present(linear_shap(s.train, s.fit("ridge"), ["series", "week"]))


def _facts(spark, sf_dir):
    from ..operators.insights import facts
    ctx = context(spark, sf_dir)
    return facts(ctx.rows(), ctx.weekly())


_FACT_ROUND = "CASE WHEN rule_id LIKE 'K1%' THEN ROUND(value, 2) ELSE ROUND(value, 6) END"


@register("insight_facts", O.q(
    ", share AS (SELECT channel AS d, SUM(estimated_sales) AS v FROM rows GROUP BY channel), "
    "tot AS (SELECT SUM(v) AS t, COUNT(*) AS n FROM share), "
    "cw AS (" + " UNION ALL ".join(f"SELECT '{a}' AS feature, {O.corr(a, 'total_sales')} AS r FROM weekly"
                                  for a in _PRESENT_SALES_CORR) + "), "
    "eff AS (SELECT channel, SUM(spend) AS spend, SUM(impressions) AS impressions, "
    f"{O.div('SUM(spend)', 'SUM(clicks)')} AS cpc FROM rows GROUP BY channel), "
    "f AS ("
    "(SELECT 'K1_top' AS rule_id, d AS subject, v AS value, v / t AS share FROM share, tot "
    " ORDER BY v DESC, d DESC LIMIT 1) UNION ALL "
    "(SELECT 'K1_bottom', d, v, v / t FROM share, tot ORDER BY v ASC, d ASC LIMIT 1) UNION ALL "
    "SELECT 'K5_categories', 'channel', CAST(n AS DOUBLE), NULL FROM tot UNION ALL "
    "(SELECT 'K2_strongest_corr', feature, r, NULL FROM cw WHERE r IS NOT NULL ORDER BY abs(r) DESC LIMIT 1) "
    "UNION ALL (SELECT 'K4_best_cpc', channel, cpc, NULL FROM eff WHERE cpc IS NOT NULL AND spend > 0 "
    " ORDER BY cpc, channel LIMIT 1) UNION ALL "
    "SELECT 'K6_spend_gap', channel, CAST(impressions AS DOUBLE), NULL FROM eff WHERE spend = 0 AND impressions > 0) "
    f"SELECT rule_id, subject, {_FACT_ROUND} AS value, ROUND(share, 6) AS share FROM f"))
def insight_facts(spark, sf_dir):
    f = _facts(spark, sf_dir)
    v = F.when(F.col("rule_id").startswith("K1"), F.round("value", 2)).otherwise(F.round("value", 6))
    return f.withColumn("value", v).withColumn("share", F.round("share", 6))


@register("insights_core", "SELECT CASE WHEN rule_id IN ('K1_top', 'K1_bottom', 'K2_strongest_corr') THEN 1 "
          "WHEN rule_id LIKE 'K8%' THEN 3 ELSE 2 END AS section_order, rule_id, subject, value FROM ("
          "SELECT CASE rule_id WHEN 'K5_categories' THEN 'K5_incrementality' ELSE rule_id END AS rule_id, subject, value "
          f"FROM ({ORACLE['insight_facts']}) x WHERE rule_id <> 'K5_categories' OR value > 1 "
          "UNION ALL SELECT 'K8_regressors', NULL, NULL UNION ALL SELECT 'K8_rerun_dedup', NULL, NULL) y")
def insights_core(spark, sf_dir):
    """K1, K2, K4-K6, K8 and their sections: the insights that need no model."""
    from ..operators.insights import generate
    out = generate(spark, _facts(spark, sf_dir), None, None)
    v = F.when(F.col("rule_id").startswith("K1"), F.round("value", 2)).otherwise(F.round("value", 6))
    return out.select(F.col("section_order").cast("int").alias("section_order"), "rule_id", "subject", v.alias("value"))


@register("insights")
def insights_q(spark, sf_dir):
    from ..operators.explain import shap_global
    from ..operators.insights import generate
    best = suite(spark, sf_dir).champion()[1].asDict()
    top = shap_global(_shap(spark, sf_dir)).first()["feature"]
    return generate(spark, _facts(spark, sf_dir), best, top)


# ---------------------------------------------------------------------------------
# Step 11: sinks and re-reads, row sample, streaming
# ---------------------------------------------------------------------------------
@register("weekly_roundtrip", ORACLE["weekly_features_base"])
def weekly_roundtrip(spark, sf_dir):
    """A3 + A2: write the weekly table as CSV (header, ISO dates) and read it back with
    its schema; the values must survive the text hop."""
    from ..sources.io import load_table, save_table
    ctx = context(spark, sf_dir)
    wk = ctx.weekly()
    path = ctx._path("weekly_csv")
    save_table(wk, path, fmt="csv")
    return present(load_table(spark, path, fmt="csv", schema=wk.schema))


_SAMPLE_ORDER = ["week", "tab", "media_type", "channel", "sub_channel", "site", "device", "platform_type",
                 "partner_type", "audience", "creative", "spend", "impressions", "clicks", "video_starts",
                 "video_completes", "hh_grps_tv", "engagements", "base_amount", "spend_is_credit"]


@register("sample_rows", O.q(
    f"SELECT * EXCLUDE (week, spend, base_amount), {O.d('week')} AS week, CAST(spend AS DOUBLE) AS spend, "
    "CAST(base_amount AS DOUBLE) AS base_amount FROM clean ORDER BY " + ", ".join(
        f"{c} ASC NULLS FIRST" for c in _SAMPLE_ORDER) + " LIMIT 10"))
def sample_rows_q(spark, sf_dir):
    from ..operators.eda import sample_rows
    c = context(spark, sf_dir).clean_fact().select(*_SAMPLE_ORDER)
    return present(sample_rows(c, 10, _SAMPLE_ORDER))


@register("streaming_weekly_kpi", O.q(
    f"SELECT {O.d('week')} AS week, CAST(spend AS DOUBLE) AS spend, impressions, clicks, video_starts, "
    "video_completes, hh_grps_tv, engagements, CAST(total_sales AS DOUBLE) AS total_sales FROM weekly"))
def streaming_weekly_kpi(spark, sf_dir):
    """The weekly repair as a streaming job over the materialised row files."""
    from ..streaming.weekly_kpi import run_weekly_kpi
    ctx = context(spark, sf_dir)
    rows = ctx.clean_fact()
    src = ctx._path("clean_fact")
    import uuid
    run_id = uuid.uuid4().hex[:8]        # each call drains the stream from the start
    out = run_weekly_kpi(spark, src, ctx._path(f"stream_weekly/{run_id}/out"), rows.schema, ctx.spec,
                         files_per_trigger=16, checkpoint=ctx._path(f"stream_weekly/{run_id}/checkpoint"))
    keep = ["week", *ctx.spec.present(out, ctx.spec.additive), "total_sales"]
    return present(out.select(*keep))


# ---------------------------------------------------------------------------------
# Inventory completions: trend projection, dataset summary, model comparison
# ---------------------------------------------------------------------------------
@register("weekly_trend", O.q(f"SELECT {O.d('week')} AS week, CAST(total_sales AS DOUBLE) AS total_sales "
                              "FROM weekly WHERE total_sales IS NOT NULL"))
def weekly_trend_q(spark, sf_dir):
    from ..operators.eda import weekly_trend
    return present(weekly_trend(context(spark, sf_dir).weekly(), "total_sales"))


@register("dataset_summary", O.q("SELECT (SELECT COUNT(*) FROM rows) AS row_count, "
                                 "(SELECT COUNT(week) FROM weekly) AS weeks, "
                                 "(SELECT COUNT(total_sales) FROM weekly) AS known_weeks, 33 AS column_count"))
def dataset_summary_q(spark, sf_dir):
    from ..operators.eda import dataset_summary
    ctx = context(spark, sf_dir)
    return dataset_summary(ctx.row_level(), ctx.weekly())


@register("model_comparison")
def model_comparison_q(spark, sf_dir):
    from ..operators.models import model_comparison
    return model_comparison(suite(spark, sf_dir).board())


# ---------------------------------------------------------------------------------
# Panel of many series (series = channel): dense weekly panel, features, forecast
# ---------------------------------------------------------------------------------
PANEL_KEYS = ["channel"]


def _panel(spark, sf_dir):
    from ..operators.panel import panel_weekly
    ctx = context(spark, sf_dir)
    if getattr(ctx, "_panel", None) is None:
        ctx._panel = panel_weekly(ctx.rows(), ctx.weekly_sales(), PANEL_KEYS, ctx.spec).checkpoint(eager=True)
    return ctx._panel


@register("panel_weekly", O.pq(
    f"SELECT series, {O.d('week')} AS week, CAST(spend AS DOUBLE) AS spend, impressions, clicks, engagements, "
    "ROUND(total_sales, 2) AS total_sales, ctr, ROUND(cost_per_sale, 9) AS cost_per_sale FROM pdf"))
def panel_weekly_q(spark, sf_dir):
    p = _panel(spark, sf_dir).select("series", "week", "spend", "impressions", "clicks", "engagements",
                                     "total_sales", "ctr", "cost_per_sale")
    return present(p, {"total_sales": 2, "cost_per_sale": 9})


_PANEL_FEATS = O.FEATURES


@register("panel_features", O.pfq(f"SELECT series, {O.d('week')} AS week, {O.feat_select(_PANEL_FEATS)} "
                                  "FROM feat2"))
def panel_features_q(spark, sf_dir):
    from ..operators.features import engineer_features
    f = engineer_features(_panel(spark, sf_dir))
    out = f.select("series", "week", *[F.col(c).cast("double").alias(c) for c in _PANEL_FEATS])
    return present(out, _fdig(_PANEL_FEATS))


@register("panel_time_split", O.pfq(f"SELECT series, {O.d('week')} AS week, split FROM split"))
def panel_time_split_q(spark, sf_dir):
    from ..operators.features import model_dataset, time_split
    df, _, _ = model_dataset(_panel(spark, sf_dir))
    return present(time_split(df).select("series", "week", "split"))


@register("panel_forecast", O.pq(
    ", anchor AS (SELECT series, MAX(CASE WHEN total_sales IS NOT NULL THEN week END) AS a FROM pdf "
    "GROUP BY series), lastv AS (SELECT p.series, p.total_sales AS v FROM pdf p JOIN anchor a "
    "ON p.series = a.series AND p.week = a.a), cand AS (SELECT p.series, p.week, row_number() OVER "
    "(PARTITION BY p.series ORDER BY p.week) AS k FROM pdf p JOIN anchor a ON p.series = a.series "
    "AND p.week > a.a) "
    f"SELECT c.series, {O.d('c.week')} AS week, ROUND(l.v, 2) AS forecasted_sales FROM cand c "
    "JOIN lastv l ON c.series = l.series WHERE c.k <= 12"))
def panel_forecast_q(spark, sf_dir):
    """Naive (lag-1) recursive forecast for every channel at once."""
    from ..operators.features import model_dataset
    from ..operators.forecast import NaiveFit, recursive_forecast
    panel = _panel(spark, sf_dir)
    _, feats, caps = model_dataset(panel)
    fc = recursive_forecast(panel, NaiveFit(), feats, caps, 12)
    return present(fc, {"forecasted_sales": 2})


@register("panel_ridge_holdout")
def panel_ridge_holdout(spark, sf_dir):
    """Pooled ridge over all channels, holdout rows of every series."""
    p = panel_suite(spark, sf_dir).predictions("ridge")
    return present(p.where(F.col("split") == "test").drop("split"))


@register("panel_leaderboard")
def panel_leaderboard(spark, sf_dir):
    """The whole tournament on every channel's weeks."""
    return panel_suite(spark, sf_dir).board().orderBy("rmse", "model")


@register("panel_champion_forecast")
def panel_champion_forecast(spark, sf_dir):
    """The panel's best model rolled forward for all channels at once."""
    return present(panel_suite(spark, sf_dir).champion_forecast())


@register("panel_boosted_blocks")
def panel_boosted_blocks(spark, sf_dir):
    """Both boosters on the panel cut into blocks of 2,000 rows, a job a tree level: 5 rounds, holdout rows."""
    from ..operators.boost import fit_boosters
    from ..operators.models import gbt_spec, huber_spec, predictions
    s = panel_suite(spark, sf_dir)
    fits = fit_boosters(s.train, s.feats, [gbt_spec(rounds=5), huber_spec(rounds=5)], block_rows=2000)
    test = s.data.where(F.col("split") == "test")
    p = predictions(fits[0], test, "squared").unionByName(predictions(fits[1], test, "huber"))
    return present(p.drop("split"))


@register("panel_shap_global")
def panel_shap_global(spark, sf_dir):
    """J3 + J4 of the panel's stack: boosted trees and ridge, weighted by the combiner."""
    from ..operators.explain import shap_global, shap_values
    s = panel_suite(spark, sf_dir)
    return shap_global(shap_values(s.data.where(F.col("split") == "test"), s.fit("stack"), ["series", "week"]))


@register("forecast_roundtrip", ORACLE["forecast_interval"])
def forecast_roundtrip(spark, sf_dir):
    """A5: the forecast with its band written as CSV (header, ISO dates) and read back."""
    from pyspark.sql import types as T

    from ..sources.io import load_table, save_table
    ctx = context(spark, sf_dir)
    fc = forecast_interval_q(spark, sf_dir)
    path = ctx._path("forecast_csv")
    save_table(fc, path, fmt="csv")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fc.schema.fields])
    return load_table(spark, path, fmt="csv", schema=schema)


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Save the ridge and forest fits with features and caps, load them back and
    score the holdout rows with the loaded models."""
    from ..operators.models import predictions
    from ..sources.io import load_fit, save_fit
    s = suite(spark, sf_dir)
    test = s.data.where(F.col("split") == "test")
    out = None
    for key, name in [("ridge", "Linear Regression (RidgeCV)"), ("forest", "Random Forest")]:
        path = s.ctx._path(f"model_{key}")
        save_fit(spark, s.fit(key), path, s.feats, s.caps)
        fit, feats, caps = load_fit(spark, path)
        assert feats == s.feats and set(caps) == set(s.caps)
        p = predictions(fit, test, name)
        out = p if out is None else out.unionByName(p)
    return present(out.drop("split"))


@register("panel_ridge_forecast")
def panel_ridge_forecast(spark, sf_dir):
    """Pooled ridge fitted on every channel's training weeks, rolled forward 12 weeks for
    all channels at once, with each channel's band from the pooled holdout RMSE."""
    from ..operators.forecast import attach_interval, recursive_forecast
    from ..operators.models import metrics
    s = panel_suite(spark, sf_dir)
    rmse = metrics(s.predictions("ridge")).where("split = 'test'").first()["rmse"]
    return present(attach_interval(recursive_forecast(s.weekly, s.fit("ridge"), s.feats, s.caps, 12), rmse))


@register("saved_tables", O.q(
    "SELECT 'row_level' AS table_name, COUNT(*) AS n_rows, ROUND(SUM(estimated_sales), 2) AS total FROM rows UNION ALL "
    "SELECT 'weekly', COUNT(*), ROUND(CAST(SUM(spend) AS DOUBLE), 2) FROM weekly UNION ALL "
    "SELECT 'weekly_sales', COUNT(*), ROUND(CAST(SUM(total_sales) AS DOUBLE), 2) FROM weekly_sales UNION ALL "
    "SELECT 'raw', COUNT(*), ROUND(CAST(SUM(base_amount) AS DOUBLE), 2) FROM media_raw"))
def saved_tables(spark, sf_dir):
    """A3 + A2: the four output tables written (row level partitioned by year) and read
    back; one row per table with its row count and the total of its main metric."""
    from ..sources.io import load_table, save_table_set
    ctx = context(spark, sf_dir)
    tables = {"row_level": ctx.row_level(), "weekly": ctx.weekly(), "weekly_sales": ctx.weekly_sales(),
              "raw": ctx.raw()}
    paths = save_table_set(tables, ctx._path("saved"))
    out = None
    for name, path in paths.items():
        main = {"row_level": "estimated_sales", "weekly": "spend", "weekly_sales": "total_sales", "raw": "base_amount"}[name]
        c = load_table(spark, path).agg(F.count("*").alias("n_rows"), F.round(F.sum(main).cast("double"), 2).alias("total")).select(
            F.lit(name).alias("table_name"), "n_rows", "total")
        out = c if out is None else out.unionByName(c)
    return out


# ---------------------------------------------------------------------------------
# Typed source: an export whose dates and numbers are text, and round trips of outputs
# ---------------------------------------------------------------------------------
def _as_text(raw):
    """The raw fact as a text export: dates in four formats and some no dates, numbers with blanks and some words."""
    d, day = F.col("activity_date"), F.dayofmonth("activity_date")
    date = (F.when(day == 31, "no date").when(day % 4 == 0, F.date_format(d, "yyyy-MM-dd")).when(day % 4 == 1, F.date_format(d, "M/d/yyyy"))
            .when(day % 4 == 2, F.date_format(d, "d-MMM-yyyy")).otherwise(F.concat(F.lit("  "), F.date_format(d, "yyyy/MM/dd"))))
    spend = F.when(F.col("spend").isNotNull(), F.when(F.col("tab") == "ASIA", "n/a").otherwise(
        F.concat(F.lit(" "), F.col("spend").cast("string"), F.lit("\t"))))
    clicks = F.when(day % 7 == 0, "").otherwise(F.col("clicks").cast("string"))
    return raw.select(date.alias("activity_date"), "tab", spend.alias("spend"), clicks.alias("clicks"), "impressions")


_TEXT_SQL = (", tx AS (SELECT CASE WHEN day(activity_date) <> 31 THEN activity_date END AS d, day(activity_date) AS dd, tab, spend, "
             "clicks, impressions FROM media_raw)")


@register("typed_media", O.q(
    _TEXT_SQL + f" SELECT {O.d('d')} AS activity_date, COUNT(*) AS n_rows, CAST(SUM(CASE WHEN tab <> 'ASIA' THEN spend END) AS DOUBLE) AS spend, "
    "CAST(SUM(CASE WHEN dd % 7 <> 0 THEN clicks END) AS DOUBLE) AS clicks, CAST(SUM(impressions) AS BIGINT) AS impressions FROM tx GROUP BY d"))
def typed_media(spark, sf_dir):
    """A1, B2, H-Type: text dates and numbers read into the declared types."""
    from ..sources.media_fact import typed
    t = typed(_as_text(context(spark, sf_dir).raw()))
    return present(t.groupBy("activity_date").agg(F.count("*").alias("n_rows"), F.sum("spend").alias("spend"),
                                                  F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")))


@register("typed_clean", O.q(
    _TEXT_SQL + ", cl AS (SELECT DISTINCT CAST(d + INTERVAL ((7 - dayofweek(d)) % 7) DAY AS DATE) AS week, tab, "
    "CASE WHEN spend IS NULL THEN NULL WHEN tab = 'ASIA' THEN 'n/a' ELSE CAST(spend AS VARCHAR) END AS sk, "
    "CASE WHEN dd % 7 = 0 THEN '' ELSE CAST(clicks AS VARCHAR) END AS ck, impressions FROM tx), "
    "nu AS (SELECT week, TRY_CAST(sk AS DOUBLE) AS spend, TRY_CAST(ck AS DOUBLE) AS clicks FROM cl) "
    f"SELECT {O.d('week')} AS week, COUNT(*) AS n_rows, ROUND(SUM(GREATEST(COALESCE(spend, 0), 0)), 2) AS spend, "
    "SUM(COALESCE(clicks, 0)) AS clicks, "
    "CAST(SUM(CASE WHEN COALESCE(spend, 0) < 0 THEN 1 ELSE 0 END) AS BIGINT) AS credits FROM nu GROUP BY week"))
def typed_clean(spark, sf_dir):
    """B1-B9 on a text export, straight from text (B8 coerces what B2 and the types leave)."""
    from ..operators.clean import clean
    ctx = context(spark, sf_dir)
    c = clean(_as_text(ctx.raw()), pieces=ctx.pieces())
    return present(c.groupBy("week").agg(F.count("*").alias("n_rows"), F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks"),
                                         F.sum(F.col("spend_is_credit").cast("bigint")).alias("credits")), {"spend": 2})


@register("typed_rejects", O.q(
    _TEXT_SQL + " SELECT 'activity_date' AS \"column\", COUNT(*) AS bad_values FROM tx WHERE dd = 31 HAVING COUNT(*) > 0 "
    "UNION ALL SELECT 'spend', COUNT(*) FROM tx WHERE tab = 'ASIA' AND spend IS NOT NULL HAVING COUNT(*) > 0"))
def typed_rejects(spark, sf_dir):
    """A1: how many values of a column do not fit its declared type."""
    from ..sources.media_fact import rejects
    return rejects(_as_text(context(spark, sf_dir).raw()))


def _saved(ctx, df, name, fmt="parquet"):
    from ..sources.io import load_table, save_table
    path = ctx._path(f"saved_outputs/{name}")
    save_table(df, path, fmt=fmt)
    return load_table(ctx.spark, path, fmt=fmt, schema=df.schema)


@register("leaderboard_roundtrip", ORACLE["baseline_leaderboard"])
def leaderboard_roundtrip(spark, sf_dir):
    """A4: a leaderboard written and read back."""
    return _saved(context(spark, sf_dir), _baseline_board(spark, sf_dir), "leaderboard")


@register("shap_ranking_roundtrip", ORACLE["pair_shap_global"])
def shap_ranking_roundtrip(spark, sf_dir):
    """A4: the SHAP ranking written as CSV and read back."""
    return _saved(context(spark, sf_dir), pair_shap_global(spark, sf_dir), "shap_ranking", "csv")


@register("boosted_roundtrip", ORACLE["boosted_stump"])
def boosted_roundtrip(spark, sf_dir):
    """Boosted fits saved, loaded and scored."""
    from ..operators.models import predictions
    from ..sources.io import load_fit, save_fit
    s, fits = _stumps(spark, sf_dir)
    out = None
    for name, fit in fits.items():
        path = s.ctx._path(f"saved_fits/{name}")
        save_fit(spark, fit, path, STUMP, {})
        p = predictions(load_fit(spark, path)[0], s.data.where(F.col("split") != "forecast"), name)
        out = p if out is None else out.unionByName(p)
    return present(out, {"y": 2, "yhat": 2})


@register("panel_ar_x_roundtrip", ORACLE["panel_ar_x_holdout"])
def panel_ar_x_roundtrip(spark, sf_dir):
    """The regressions of all channels saved, loaded and followed through the holdout."""
    from ..operators.models import predictions
    from ..sources.io import load_fit, save_fit
    s = panel_suite(spark, sf_dir)
    path = s.ctx._path("saved_fits/panel_arx")
    save_fit(spark, _pair_arx(s), path, s.feats, s.caps)
    fit, feats, _ = load_fit(spark, path)
    p = predictions(fit, s.data.where(F.col("split") != "forecast"), "arx").where(F.col("split") == "test")
    return present(p.select("series", "week", "y", "yhat"), {"y": 2, "yhat": 2})


@register("fits_roundtrip")
def fits_roundtrip(spark, sf_dir):
    """All six fits of the tournament saved, loaded and scored on the holdout; ``differs`` counts rows whose score changed."""
    from ..operators.models import predictions
    from ..sources.io import load_fit, save_fit
    s = suite(spark, sf_dir)
    s.board()
    data, out = s.data.where(F.col("split") != "forecast"), None
    for key in TOURNAMENT:
        path = s.ctx._path(f"saved_fits/{key}")
        save_fit(spark, s.fit(key), path, s.feats, s.caps)
        fit, feats, caps = load_fit(spark, path)
        again = predictions(fit, data, key).select("series", "week", F.col("yhat").alias("again"))
        both = predictions(s.fit(key), data, key).join(again, ["series", "week"])
        one = both.groupBy("model").agg(F.count("*").alias("n_rows"), F.count_if(
            F.abs(F.col("yhat") - F.col("again")) > 1e-9 * F.abs(F.col("yhat"))).alias("differs"))
        out = one if out is None else out.unionByName(one)
    return out
