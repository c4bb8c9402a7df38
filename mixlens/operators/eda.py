"""Exploratory views over the allocated rows and the weekly table (D7-D18, D27-D31, F*).

Rollups always re-derive ratios from sums (ratio of sums, never mean of ratios).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def breakdown_by(rows: DataFrame, dim: str, metric: str = "estimated_sales",
                 top_n: int | None = None) -> DataFrame:
    """sum(metric) per value of ``dim`` (NULL is its own group), largest first.
    ``top_n`` keeps the n largest (ties broken by the dimension value)."""
    out = rows.groupBy(dim).agg(F.sum(metric).alias(metric))
    out = out.orderBy(F.col(metric).desc(), F.col(dim).asc_nulls_last())
    return out.limit(top_n) if top_n else out


def kpi_summary(clean: DataFrame, week_col: str = "week", target_col: str = "base_amount") -> DataFrame:
    """D7 + D8: total true sales (sum over weeks of the repaired KPI), total spend,
    impressions, clicks, engagements and ROMI, from one grouped pass and no join: the
    per-week partial sums are re-summed globally."""
    from .measure import true_kpi_expr
    metrics = [c for c in ["spend", "impressions", "clicks", "engagements"] if c in clean.columns]
    wk = clean.groupBy(week_col).agg(
        F.when(F.col(week_col).isNotNull(), true_kpi_expr(target_col)).alias("_ts"),
        *[F.sum(c).alias(c) for c in metrics])
    out = wk.agg(F.sum("_ts").alias("total_sales"),
                 *[F.sum(c).alias(f"total_{c}") for c in metrics])
    if "spend" not in metrics:
        return out
    return out.withColumn("romi", F.try_divide(F.col("total_sales").cast("double"),
                                               F.col("total_spend").cast("double")))


def top_creatives(rows: DataFrame, n: int = 20, dim: str = "creative",
                  metric: str = "estimated_sales") -> DataFrame:
    """Top-n creatives by allocated sales with those of spend, impressions, engagements present."""
    beside = [c for c in ("spend", "impressions", "engagements") if c in rows.columns]
    agg = rows.groupBy(dim).agg(F.sum(metric).alias(metric), *[F.sum(c).alias(c) for c in beside])
    return agg.orderBy(F.col(metric).desc(), F.col(dim).asc_nulls_last()).limit(n)


def correlation_long(weekly: DataFrame, cols) -> DataFrame:
    """Pearson matrix of the present columns as a long table (col_x, col_y, r),
    all pairs computed in one aggregate (pairwise-complete, NULL for constants)."""
    from ..functions.exprs import safe_corr
    cols = [c for c in cols if c in weekly.columns]
    pairs = [(a, b) for a in cols for b in cols]
    row = weekly.agg(*[safe_corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    entries = F.array(*[F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"),
                                 F.col(f"{a}__{b}").alias("r")) for a, b in pairs])
    return row.select(F.inline(entries))


def corr_with_target(weekly: DataFrame, cols, target: str = "total_sales") -> DataFrame:
    """Correlation of each present column with the target, largest first."""
    from ..functions.exprs import safe_corr
    cols = [c for c in cols if c in weekly.columns and c != target]
    row = weekly.agg(*[safe_corr(c, target).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in cols])
    return row.select(F.inline(entries)).orderBy(F.col("r").desc_nulls_last(), "feature")


def spend_sales_trend(weekly: DataFrame, x: str = "spend", y: str = "total_sales") -> DataFrame:
    """R, least-squares line y = slope*x + intercept (only with > 2 complete
    pairs), mean/max weekly x and the line's estimate at the mean."""
    from ..functions.exprs import safe_corr
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    out = weekly.agg(
        safe_corr(x, y).alias("r"),
        F.regr_count(yd, xd).alias("n_pairs"),
        F.regr_slope(yd, xd).alias("_slope"),
        F.regr_intercept(yd, xd).alias("_intercept"),
        F.avg(xd).alias("mean_x"),
        F.max(xd).alias("max_x"))
    ok = F.col("n_pairs") > 2
    return out.select(
        "r", "n_pairs",
        F.when(ok, F.col("_slope")).alias("slope"),
        F.when(ok, F.col("_intercept")).alias("intercept"),
        F.coalesce(F.col("mean_x"), F.lit(0.0)).alias("mean_x"),
        F.coalesce(F.col("max_x"), F.lit(1_000_000.0)).alias("max_x"),
        F.when(ok, F.col("_slope") * F.coalesce(F.col("mean_x"), F.lit(0.0)) + F.col("_intercept"))
         .alias("estimate_at_mean"))


def describe(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max per column.

    The quartiles are exact at any size (functions.quantiles).
    """
    from ..functions.quantiles import exact_quantiles
    cols = [c for c in cols if c in df.columns]
    quarts = exact_quantiles(df, {c: F.col(c) for c in cols}, [0.25, 0.5, 0.75])
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        p25, p50, p75 = (F.lit(x).cast("double") for x in quarts[c])
        aggs.append(F.struct(F.lit(c).alias("metric"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                             F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
                             p25.alias("p25"), p50.alias("p50"), p75.alias("p75"),
                             F.max(v).alias("max")).alias(c))
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[F.col(c) for c in cols])))


def series_peak(weekly: DataFrame, value: str = "total_sales", week_col: str = "week") -> DataFrame:
    """Highest value and its (earliest) week, with a $k/$M label."""
    from ..functions.exprs import money_label
    key = F.struct(F.col(value).cast("double").alias("v"),
                   (-F.unix_date(F.col(week_col))).alias("neg_day"))
    best = weekly.where(F.col(value).isNotNull()).agg(F.max(key).alias("b"))
    return best.select(
        F.date_from_unix_date(-F.col("b.neg_day")).alias("peak_week"),
        F.col("b.v").alias("peak_value"),
        money_label(F.col("b.v")).alias("peak_label"))


def category_share(rows: DataFrame, dim: str, metric: str = "estimated_sales") -> DataFrame:
    """Share of the total per category. The total is a scalar subquery over the summed
    categories, so nothing runs while the view is built and rows are not summed a second time."""
    agg = rows.groupBy(dim).agg(F.sum(metric).alias(metric))
    return agg.withColumn("share", F.try_divide(F.col(metric), agg.agg(F.sum(metric)).scalar()))


def filter_rows(rows: DataFrame, selections: dict) -> DataFrame:
    """Keep rows whose dimension values are in the selected sets (conjunction over
    the dimensions given; an empty or missing selection keeps everything)."""
    cond = F.lit(True)
    for d, vals in (selections or {}).items():
        if vals and d in rows.columns:
            cond = cond & F.col(d).isin(list(vals))
    return rows.where(cond)


def rows_in_view(rows: DataFrame, selections: dict) -> DataFrame:
    """Rows passing the filter and all rows, in one pass."""
    cond = F.lit(True)
    for d, vals in (selections or {}).items():
        if vals and d in rows.columns:
            cond = cond & F.col(d).isin(list(vals))
    return rows.agg(F.count_if(cond).alias("rows_in_view"), F.count("*").alias("rows_total"))


def sample_rows(rows: DataFrame, n: int = 10, order=None) -> DataFrame:
    """A deterministic n-row sample (the head of a stable order)."""
    order = order or [c for c in rows.columns]
    return rows.orderBy(*order).limit(n)


def filtered_weekly(rows: DataFrame, weekly_sales: DataFrame, selections: dict, additive,
                    week_col: str = "week") -> DataFrame:
    """C4: weekly sums of the filtered rows, left-joined to the company-wide (unfiltered)
    weekly sales, which are stored so that the planner joins them by their size."""
    from ..functions.joins import join_small
    add = [c for c in additive if c in rows.columns]
    wk = filter_rows(rows, selections).groupBy(week_col).agg(*[F.sum(c).alias(c) for c in add])
    return join_small(wk, weekly_sales, on=week_col, how="left")


def lookback(weekly: DataFrame, n: int, week_col: str = "week", series=None,
             require: str | None = None) -> DataFrame:
    """The last n weeks of each series (optionally only weeks where ``require`` is
    known)."""
    from pyspark.sql import Window
    df = weekly.where(F.col(require).isNotNull()) if require else weekly
    if not series:
        # one series: a distributed top-n (TakeOrderedAndProject), no single-partition window
        return df.orderBy(F.col(week_col).desc()).limit(n)
    w = Window.partitionBy(*series).orderBy(F.col(week_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def weekly_trend(weekly: DataFrame, metric: str, week_col: str = "week") -> DataFrame:
    """(week, metric) without NULLs, in week order."""
    return weekly.select(week_col, metric).dropna().orderBy(week_col)


def dataset_summary(rows: DataFrame, weekly: DataFrame, week_col: str = "week") -> DataFrame:
    """Row and column counts of the row table, weeks and weeks with known sales."""
    from ..functions.joins import merge_rows
    r = rows.agg(F.count("*").alias("row_count"))
    w = weekly.agg(F.count(week_col).alias("weeks"), F.count("total_sales").alias("known_weeks"))
    return merge_rows(r, w).withColumn("column_count", F.lit(len(rows.columns)))
