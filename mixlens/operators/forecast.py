"""Recursive multi-week forecast for every series at once.

State is one row per series carrying an array of its last 8 sales and its candidate rows
(real media where logged, padded weeks otherwise), joined to it once. The whole horizon is one
fold over the candidate array: each step derives the lag and rolling features from the state,
scores them with the fit's own expression and pushes the prediction into the state. The plan
does not grow with the horizon, and all series run in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import MEDIA_LAGS, N_LAGS, TARGET, ewm_start, ewm_step, final_values, future_weeks


@dataclass
class NaiveFit:
    """Lag-1 persistence: next week's sales = last week's sales."""

    def score(self, x: dict):
        return F.log1p(x["sales_lag_1"])

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        return df.withColumn(out, self.score({"sales_lag_1": F.col("sales_lag_1")}))


@dataclass
class LinearFit:
    """Fixed weights over feature columns, in dollars, floored at 0."""

    weights: dict

    def score(self, x: dict):
        total = F.lit(0.0)
        for c, w in self.weights.items():
            total = total + x[c].cast("double") * F.lit(float(w))
        return F.log1p(F.greatest(total, F.lit(0.0)))

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        return df.withColumn(out, self.score({c: F.col(c) for c in self.weights}))


def _nonnull(arr):
    return F.filter(arr, lambda x: x.isNotNull())


def _mean(arr):
    nn = _nonnull(arr)
    return F.when(F.size(nn) > 0, F.aggregate(nn, F.lit(0.0), lambda a, b: a + b) / F.size(nn))


def _std(arr):
    nn = _nonnull(arr)
    m = _mean(arr)
    ss = F.aggregate(nn, F.lit(0.0), lambda a, b: a + (b - m) * (b - m))
    return F.when(F.size(arr) <= 1, F.lit(0.0)).when(F.size(nn) >= 2, F.sqrt(ss / (F.size(nn) - 1)))


def step_features(hist, ewm=None) -> dict:
    """Lag/rolling features of the next row from the previous (up to 8) values, with the
    forecast-time rules: lags before the start are 0, no min_periods, std 0 under two
    rows, EWM set to the 8-row mean unless ``ewm`` gives it."""
    size = F.size(hist)
    lag = {i: F.when(size >= i, F.element_at(hist, -i)).otherwise(F.lit(0.0)) for i in range(1, N_LAGS + 1)}
    last4 = F.slice(hist, F.greatest(size - 3, F.lit(1)), 4)
    mean8 = F.when(size > 0, _mean(hist)).otherwise(F.lit(0.0))
    nn = _nonnull(hist)
    out = {f"sales_lag_{i}": lag[i] for i in lag}
    out.update({
        "sales_rolling_mean_4": F.when(size > 0, _mean(last4)).otherwise(F.lit(0.0)),
        "sales_rolling_mean_8": mean8,
        "sales_rolling_std_8": _std(hist),
        "sales_rolling_min_8": F.when(size > 0, F.array_min(nn)).otherwise(F.lit(0.0)),
        "sales_rolling_max_8": F.when(size > 0, F.array_max(nn)).otherwise(F.lit(0.0)),
        "sales_diff_1": F.when(lag[2] != 0, lag[1] - lag[2]).otherwise(F.lit(0.0)),
        "sales_ratio_to_mean_8": F.when(mean8.isNotNull(), lag[1] / F.greatest(mean8, F.lit(1.0))),
    })
    out["sales_ewm_4"] = mean8 if ewm is None else ewm
    return out


def candidates(weekly: DataFrame, horizon: int, series_keys=None, pad_calendar: bool = False) -> DataFrame:
    """The horizon rows after each series' last known week with their static features:
    own media, ratios and calendar, and the previous row's media as the media lags. The
    sales-based features are rebuilt from the state array in the loop, so no feature window
    runs here. Padded weeks carry NULL media and, unless ``pad_calendar``, NULL calendar
    features (they become 0)."""
    import math

    from .features import BASE_FEATURES, with_series
    base = with_series(weekly, series_keys)
    static_cols = [c for c in BASE_FEATURES if c in base.columns]
    media = [c for c in MEDIA_LAGS if c in base.columns]
    fut = future_weeks(weekly, horizon, series_keys)
    anchor = fut.groupBy("series").agg(F.min("week").alias("_first"))
    prev = (base.join(anchor, "series").where(F.col("week") < F.col("_first"))
                .withColumn("_rn", F.row_number().over(Window.partitionBy("series").orderBy(F.col("week").desc())))
                .where("_rn = 1").select("series", "week", *media))
    static = fut.join(base.select("series", "week", *static_cols), ["series", "week"], "left")
    wn = F.weekofyear("week").cast("double")
    cal = {"week_of_year_sin": F.sin(F.lit(2 * math.pi) * wn / 52.0),
           "week_of_year_cos": F.cos(F.lit(2 * math.pi) * wn / 52.0)}
    # calendar of real rows; padded rows get it only with pad_calendar
    static = static.withColumns({c: F.when(~F.col("is_padded"), e) for c, e in cal.items()})
    seq = static.unionByName(prev.withColumn("is_padded", F.lit(None).cast("boolean")), allowMissingColumns=True)
    w = Window.partitionBy("series").orderBy("week")
    seq = seq.withColumns({f"{c}_lag_1": F.lag(c, 1).over(w) for c in media})
    out = seq.where(F.col("is_padded").isNotNull()).withColumn("step", F.row_number().over(w))
    if pad_calendar:
        wk = F.col("week")
        fill = {"month": F.month(wk), "quarter": F.quarter(wk), **cal}
        out = out.withColumns({c: F.coalesce(F.col(c), e) if c in out.columns else e for c, e in fill.items()})
    return out


def history_state(weekly: DataFrame, first: DataFrame, series_keys=None) -> DataFrame:
    """Last 8 sales (NULLs kept, week order) before each series' first candidate (``first``: series,
    _first), and the weighted mean's numerator, denominator and age over all its sales. Reads the
    target straight from the weekly table (no feature window needed)."""
    from .features import with_series
    base = with_series(weekly, series_keys).select("series", "week", F.col(TARGET).cast("double").alias(TARGET))
    before = base.join(first, "series").where(F.col("week") < F.col("_first"))
    st = before.groupBy("series").agg(F.sort_array(F.collect_list(F.struct("week", F.col(TARGET).alias("v"))))
                                      .alias("_h"))        # as many as there are weeks
    ewm = F.aggregate("_h", F.struct(*ewm_start()), lambda a, e: F.struct(*ewm_step(a["num"], a["den"], a["age"], e["v"])))
    hist = F.transform(F.slice("_h", F.greatest(F.size("_h") - N_LAGS + 1, F.lit(1)), N_LAGS), lambda e: e["v"])
    return st.select("series", hist.alias("hist"), ewm.alias("ewm"))


def recursive_forecast(weekly: DataFrame, fit, feats, caps: dict, horizon: int = 12, series_keys=None,
                       ewm_mode: str = "reference", pad_calendar: bool = False) -> DataFrame:
    """(series, week, forecasted_sales) for the next ``horizon`` weeks of every series.

    ``ewm_mode='exact'`` weights all earlier sales and forecasts; 'reference' takes the 8-row mean.
    A fit gives its prediction as an expression of named features (``score``); one that has
    parameters a series joins them first (``prepare``). Series without known sales have no rows;
    if there are none at all, ValueError."""
    from .models import let
    cand = candidates(weekly, horizon, series_keys, pad_calendar)
    rest = [c for c in cand.columns if c not in ("series", "step")]
    rows = cand.groupBy("series").agg(                           # ``horizon`` rows a series
        F.sort_array(F.collect_list(F.struct("step", *rest))).alias("rows"), F.min("week").alias("_first"))
    rows = rows.checkpoint(eager=True)
    state = history_state(weekly, rows.select("series", "_first"), series_keys).join(rows, "series")
    if hasattr(fit, "prepare"):
        state = fit.prepare(state)
    if rows.isEmpty():
        raise ValueError("No weeks with known sales -- cannot anchor a forecast.")
    out = F.array().cast("array<struct<week:date,forecasted_sales:double>>")

    def step(acc, row):
        ewm = acc["ewm"]
        known = F.when(ewm["den"] > 0, ewm["num"] / ewm["den"])
        own = {**{c: row[c] for c in rest},
               **step_features(acc["hist"], known if ewm_mode == "exact" else None)}
        x = final_values(own, feats, caps)
        return let(F.expm1(fit.score(x)), lambda y: F.struct(
            _pushed(acc["hist"], y).alias("hist"),
            F.struct(*ewm_step(ewm["num"], ewm["den"], ewm["age"], y)).alias("ewm"),
            F.concat(acc["out"], F.array(F.struct(row["week"].alias("week"), y.alias("forecasted_sales")))).alias("out")))

    start = F.struct(F.col("hist"), F.col("ewm"), out.alias("out"))
    return state.select("series", F.inline(F.aggregate("rows", start, step, lambda acc: acc["out"])))


def _pushed(hist, y):
    """The last values with one more at the end, ``N_LAGS`` at most."""
    longer = F.concat(hist, F.array(y))
    return F.slice(longer, F.greatest(F.size(longer) - N_LAGS + 1, F.lit(1)), N_LAGS)


def attach_interval(forecast: DataFrame, rmse: float) -> DataFrame:
    """+/- holdout RMSE band, lower bound floored at 0."""
    f = F.col("forecasted_sales")
    return forecast.withColumns({"lower_bound": F.greatest(f - F.lit(float(rmse)), F.lit(0.0)),
                                 "upper_bound": f + F.lit(float(rmse))})


def forecast_summary(forecast: DataFrame, weekly: DataFrame, series_keys=None) -> DataFrame:
    """Per series mean and total forecast, last actual, % change, direction."""
    from .features import with_series
    last = (with_series(weekly, series_keys).where(F.col(TARGET).isNotNull())
            .groupBy("series").agg(F.max_by(F.col(TARGET).cast("double"), "week").alias("last_actual")))
    fc = forecast.groupBy("series").agg(F.avg("forecasted_sales").alias("mean_forecast"),
                                        F.sum("forecasted_sales").alias("total_forecast"),
                                        F.count("*").alias("horizon"))
    out = fc.join(last, "series", "left")
    pct = F.when(F.coalesce(F.col("last_actual"), F.lit(0.0)) != 0,
                 (F.col("mean_forecast") - F.col("last_actual")) / F.col("last_actual") * 100).otherwise(F.lit(0.0))
    return out.withColumn("trend_pct", pct).withColumn("direction", F.when(pct > 0, "up").otherwise("down"))
