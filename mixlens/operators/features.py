"""Leak-free time-series features for one or many series.

Every feature at week T reads only weeks before T. All window columns share one window
spec (partitioned by series, ordered by week), so Spark evaluates them in a single Window
node after one shuffle by series. The input is the weekly table, already reduced to one
row per (series, week), so a partition holds one series' weeks, never raw rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import stored

# The feature set of the analysed workflow.
N_LAGS = 8
BASE_FEATURES = [
    "spend", "impressions", "clicks", "video_starts", "video_completes", "hh_grps_tv", "impact", "reach",
    "likes", "engagements", "comments", "ctr", "engagement_rate", "video_completion_rate", "month",
    "quarter", "week_of_year_sin", "week_of_year_cos",
]
LAG_FEATURES = [f"sales_lag_{i}" for i in range(1, N_LAGS + 1)]
ROLLING_FEATURES = [
    "sales_rolling_mean_4", "sales_rolling_mean_8", "sales_rolling_std_8", "sales_rolling_min_8",
    "sales_rolling_max_8", "sales_ewm_4", "sales_diff_1", "sales_ratio_to_mean_8",
    "spend_lag_1", "impressions_lag_1", "clicks_lag_1",
]
RATIO_CAP_COLS = ["ctr", "engagement_rate", "video_completion_rate"]
MEDIA_LAGS = ["spend", "impressions", "clicks"]
EWM_SPAN = 4
MIN_PERIODS = 2
TARGET = "total_sales"


def with_series(weekly: DataFrame, series_keys=None) -> DataFrame:
    """Add the ``series`` key: the concatenated series keys, or 'all' for one series."""
    if series_keys:
        return weekly.withColumn("series", F.concat_ws("|", *[F.col(k).cast("string") for k in series_keys]))
    return weekly if "series" in weekly.columns else weekly.withColumn("series", F.lit("all"))


def _frame(lo: int, hi: int):
    return Window.partitionBy("series").orderBy("week").rowsBetween(lo, hi)


def _rolling(y, n: int, fn):
    w = _frame(-n, -1)
    return F.when(F.count(y).over(w) >= MIN_PERIODS, fn(y).over(w))


def ewm_start() -> list:
    """num, den, age of an exponentially weighted mean before any value."""
    return [F.lit(0.0).alias("num"), F.lit(0.0).alias("den"), F.lit(1.0).alias("age")]


def ewm_step(num, den, age, y, span: int = EWM_SPAN) -> list:
    """num, den, age after one more week: an unknown one only ages the weights."""
    age = age * F.lit(1.0 - 2.0 / (span + 1))
    known = y.isNotNull()
    return [F.when(known, num * age + y).otherwise(num).alias("num"),
            F.when(known, den * age + 1.0).otherwise(den).alias("den"),
            F.when(known, F.lit(1.0)).otherwise(age).alias("age")]


def previous_ewm(df: DataFrame, span: int = EWM_SPAN) -> DataFrame:
    """series, week, sales_ewm_4: the exponentially weighted mean of all earlier known targets.

    One fold over each series' weeks. An unknown week only ages the weights, so the mean
    stays as it is; the ageing is counted and applied at the next known value, however long
    the gap. A series has as many rows as there are weeks.
    """
    out = F.array().cast("array<struct<week:date,ewm:double>>")
    start = F.struct(*ewm_start(), out.alias("out"))

    def step(acc, e):
        return F.struct(*ewm_step(acc["num"], acc["den"], acc["age"], e["y"], span),
                        F.concat(acc["out"], F.array(F.struct(
                            e["week"].cast("date").alias("week"),
                            F.when(acc["den"] > 0, acc["num"] / acc["den"]).alias("ewm")))).alias("out"))

    weeks = F.sort_array(F.collect_list(F.struct("week", F.col(TARGET).cast("double").alias("y"))))
    return (df.groupBy("series").agg(weeks.alias("h"))
            .select("series", F.inline(F.aggregate("h", start, step, lambda acc: acc["out"])))
            .select("series", F.col("week").cast(df.schema["week"].dataType).alias("week"), F.col("ewm").alias("sales_ewm_4")))


def engineer_features(weekly: DataFrame, series_keys=None) -> DataFrame:
    """E1-E11 on the weekly table (target ``total_sales``; unknown weeks NULL)."""
    df = with_series(weekly, series_keys)
    y = F.col(TARGET).cast("double")
    df = df.withColumn(TARGET, y)
    base = Window.partitionBy("series").orderBy("week")
    cols = {f"sales_lag_{i}": F.lag(TARGET, i).over(base) for i in range(1, N_LAGS + 1)}
    cols.update({
        "sales_rolling_mean_4": _rolling(F.col(TARGET), 4, F.avg),
        "sales_rolling_mean_8": _rolling(F.col(TARGET), 8, F.avg),
        "sales_rolling_std_8": _rolling(F.col(TARGET), 8, F.stddev_samp),
        "sales_rolling_min_8": _rolling(F.col(TARGET), 8, F.min),
        "sales_rolling_max_8": _rolling(F.col(TARGET), 8, F.max),
    })
    for c in MEDIA_LAGS:
        if c in df.columns:
            cols[f"{c}_lag_1"] = F.lag(c, 1).over(base)
    df = df.withColumns(cols)
    df = df.join(previous_ewm(df), ["series", "week"], "left")
    mean8 = F.col("sales_rolling_mean_8")
    df = df.withColumns({
        "sales_diff_1": F.col("sales_lag_1") - F.col("sales_lag_2"),
        "sales_ratio_to_mean_8": F.when(mean8.isNotNull(), F.col("sales_lag_1") / F.greatest(mean8, F.lit(1.0))),
    })
    wn = F.weekofyear("week").cast("double")
    return df.withColumns({
        "week_of_year_sin": F.sin(F.lit(2 * math.pi) * wn / 52.0),
        "week_of_year_cos": F.cos(F.lit(2 * math.pi) * wn / 52.0),
    })


def feature_columns(df: DataFrame | None = None) -> list:
    """18 base + 8 lags + 11 rolling = 37 names, intersected with the columns present."""
    cols = BASE_FEATURES + LAG_FEATURES + ROLLING_FEATURES
    return [c for c in cols if df is None or c in df.columns]


def ratio_caps(model_rows: DataFrame, cols=RATIO_CAP_COLS, q: float = 0.99) -> dict:
    """Per-column p99 (linear interpolation, exact) over the model rows."""
    from ..functions.quantiles import exact_quantiles
    found = exact_quantiles(model_rows, {c: F.col(c) for c in cols if c in model_rows.columns}, [q])
    return {c: v[0] for c, v in found.items()}


def final_values(x: dict, feature_cols, caps: dict) -> dict:
    """I2 on named columns: ratio columns winsorised at the caps (NULL stays NULL), then NULL -> 0."""
    out = dict(x)
    for c, cap in caps.items():
        if c in out and cap is not None:
            out[c] = F.when(out[c].isNotNull(), F.least(out[c].cast("double"), F.lit(float(cap))))
    out.update({c: F.coalesce(out[c].cast("double"), F.lit(0.0)) for c in feature_cols if c in out})
    return out


def finalize_features(df: DataFrame, feature_cols, caps: dict) -> DataFrame:
    """I2 on a frame."""
    done = final_values({c: F.col(c) for c in df.columns}, feature_cols, caps)
    return df.withColumns({c: done[c] for c in df.columns if c in caps or c in feature_cols})


def model_dataset(weekly: DataFrame, series_keys=None, caps: dict | None = None):
    """Features -> drop rows missing a lag/rolling feature -> caps -> finalise.
    Returns (frame, feature columns, caps)."""
    eng = engineer_features(weekly, series_keys)
    feats = feature_columns(eng)
    required = [c for c in LAG_FEATURES + ROLLING_FEATURES if c in eng.columns]
    kept = eng.dropna(subset=required)
    if caps is None:
        # the caps need passes over the engineered rows: they are stored, so the windows run once
        kept = stored(kept)
        caps = ratio_caps(kept)
    return finalize_features(kept, feats, caps), feats, caps


def time_split(model_df: DataFrame, test_weeks: int = 12) -> DataFrame:
    """I4 (E8 + B16): per series, known weeks split chronologically; the last
    ``min(test_weeks, max(1, n_known // 4))`` known weeks are 'test', unknown weeks are
    'forecast'. Both counts are windows over the series partition alone (running and total
    count of known weeks), so the split reuses the features' partitioning: no new shuffle."""
    known = F.col(TARGET).isNotNull().cast("int")
    by_series = Window.partitionBy("series")
    from_end = Window.partitionBy("series").orderBy(F.col("week").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = model_df.withColumns({"_n": F.sum(known).over(by_series), "_rn": F.sum(known).over(from_end)})
    n_test = F.least(F.lit(test_weeks), F.greatest(F.lit(1), F.floor(F.col("_n") / 4)))
    split = (F.when(F.col(TARGET).isNull(), "forecast")
              .when(F.col("_rn") <= n_test, "test").otherwise("train"))
    return df.withColumn("split", split).drop("_rn", "_n")


def future_weeks(weekly: DataFrame, horizon: int, series_keys=None) -> DataFrame:
    """G1 + E9: the ``horizon`` weeks after each series' last known week; weeks missing
    from the table are generated 7 days apart after its last week (``is_padded``)."""
    df = with_series(weekly, series_keys)
    per = df.groupBy("series").agg(
        F.max(F.when(F.col(TARGET).isNotNull(), F.col("week"))).alias("anchor"),
        F.max("week").alias("last_week"))
    after = (df.select("series", "week")
               .join(per, "series")
               .where(F.col("anchor").isNotNull() & (F.col("week") > F.col("anchor")))
               .withColumn("_rn", F.row_number().over(Window.partitionBy("series").orderBy("week"))))
    existing = after.where(F.col("_rn") <= horizon).select("series", "week", F.lit(False).alias("is_padded"))
    n_after = after.groupBy("series").agg(F.count("*").alias("_n_after"))
    pads = (per.where(F.col("anchor").isNotNull())
               .join(n_after, "series", "left")
               .withColumn("_need", (F.lit(horizon) - F.least(F.coalesce("_n_after", F.lit(0)), F.lit(horizon)))
                           .cast("int"))
               .where(F.col("_need") > 0)
               .select("series", F.explode(F.sequence(F.date_add("last_week", 7),
                                                       F.date_add("last_week", F.col("_need") * 7),
                                                       F.expr("INTERVAL 7 DAYS"))).alias("week"))
               .withColumn("is_padded", F.lit(True)))
    return existing.unionByName(pads)
