"""Panel of many series: the weekly table keyed by (series, week).

With the KPI repaired per week (``kpi_keys = [week]``), a series' target is its allocated
sales, ``sum(estimated_sales)`` by (series, week), kept NULL in weeks whose KPI is unknown.
The panel is made dense (every series x every week, media 0) so that a row lag is a week
lag. The dense grid is generated, not joined: each series row explodes the list of
distinct weeks, which is bounded by the calendar (one entry per week), and the observed
sums are then joined on (series, week).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_small
from ..spec import DEFAULT_SPEC, MediaSpec
from .clean import date_parts
from .measure import weekly_ratios


def panel_weekly(rows: DataFrame, weekly_sales: DataFrame, series_keys, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """(series, week, additive sums, total_sales = allocated sales or NULL, calendar, ratios)."""
    keys = list(series_keys)
    sid = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("series")
    add = spec.present(rows, spec.additive)
    obs = (rows.where(F.col(spec.week_col).isNotNull())
               .groupBy(sid, F.col(spec.week_col))
               .agg(*[F.sum(c).alias(c) for c in add], F.sum("estimated_sales").alias("_alloc")))
    weeks = [r[0] for r in weekly_sales.select(spec.week_col).where(F.col(spec.week_col).isNotNull())
             .distinct().orderBy(spec.week_col).collect()]
    series = rows.select(sid).distinct()
    grid = series.select("series", F.explode(F.array(*[F.lit(w) for w in weeks])).alias(spec.week_col))
    known = weekly_sales.select(spec.week_col, F.col("total_sales").isNotNull().alias("_known"))
    dense = join_small(grid.join(obs, ["series", spec.week_col], "left"), known, spec.week_col)
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(obs.schema[c].dataType)) for c in add}
    dense = dense.withColumns(zero).withColumn(
        "total_sales", F.when(F.col("_known"), F.coalesce(F.col("_alloc"), F.lit(0.0))))
    return (dense.drop("_alloc", "_known")
                 .transform(date_parts, spec.week_col)
                 .transform(weekly_ratios))
