"""Recursive forecast against a direct re-statement of the forecast-time rules."""
import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from mixlens.operators.forecast import recursive_forecast

W = {"sales_lag_1": 0.5, "sales_lag_3": 0.1, "sales_lag_8": 0.05, "sales_rolling_mean_4": 0.1,
     "sales_rolling_mean_8": 0.1, "sales_rolling_std_8": 0.2, "sales_rolling_min_8": 0.05,
     "sales_rolling_max_8": 0.05, "sales_ewm_4": 0.02, "sales_diff_1": 0.3, "sales_ratio_to_mean_8": 1000.0,
     "spend_lag_1": 0.001, "month": 10.0}


class LinearFit:
    def score(self, x):
        e = F.lit(0.0)
        for c, w in W.items():
            e = e + x[c] * w
        return F.log1p(F.greatest(e, F.lit(0.0)))


def _expected(sales, spend, months, horizon):
    work = list(sales)
    last = max(i for i, v in enumerate(work) if v is not None and not math.isnan(v))
    n_after = len(work) - 1 - last
    spend = list(spend) + [None] * max(0, horizon - n_after)
    months = list(months) + [None] * max(0, horizon - n_after)
    work += [None] * max(0, horizon - n_after)
    out = []
    for idx in range(last + 1, last + 1 + horizon):
        arr = np.array([np.nan if v is None else v for v in work], dtype=float)
        f = {}
        for i in range(1, 9):
            f[f"sales_lag_{i}"] = arr[idx - i] if idx - i >= 0 else 0.0
        win = arr[max(0, idx - 8):idx]
        nn = win[~np.isnan(win)]
        mean = nn.mean() if len(nn) else (np.nan if len(win) else 0.0)
        f["sales_rolling_mean_8"] = mean
        f["sales_rolling_std_8"] = (nn.std(ddof=1) if len(nn) > 1 else np.nan) if len(win) > 1 else 0.0
        f["sales_rolling_min_8"] = nn.min() if len(nn) else np.nan
        f["sales_rolling_max_8"] = nn.max() if len(nn) else np.nan
        w4 = arr[max(0, idx - 4):idx]
        f["sales_rolling_mean_4"] = w4[~np.isnan(w4)].mean() if (~np.isnan(w4)).any() else np.nan
        f["sales_ewm_4"] = mean
        lag1, lag2 = f["sales_lag_1"], f["sales_lag_2"]
        f["sales_diff_1"] = lag1 - lag2 if lag2 != 0 else 0.0
        f["sales_ratio_to_mean_8"] = lag1 / max(mean, 1.0) if not np.isnan(mean) else np.nan
        prev = spend[idx - 1] if idx - 1 >= 0 else None
        f["spend_lag_1"] = np.nan if prev is None else prev
        f["month"] = np.nan if months[idx] is None else months[idx]
        f = {k: (0.0 if (isinstance(v, float) and np.isnan(v)) else v) for k, v in f.items()}
        e = sum(f[c] * w for c, w in W.items())
        pred = np.expm1(np.log1p(max(e, 0.0)))
        work[idx] = pred
        out.append(pred)
    return out


def test_recursive_forecast_rules(spark):
    start = dt.date(2024, 1, 7)
    sales = [100.0, 120.0, None, 90.0, 110.0, 130.0, 95.0, 105.0, 115.0, 125.0, None, None]
    spend = [float(10 * i) for i in range(len(sales))]
    weeks = [start + dt.timedelta(days=7 * i) for i in range(len(sales))]
    months = [w.month for w in weeks]
    rows = [(w, s, sp, 1, 1, m) for w, s, sp, m in zip(weeks, sales, spend, months)]
    df = spark.createDataFrame(rows, "week date, total_sales double, spend double, impressions bigint, "
                                     "clicks bigint, month int")
    feats = list(W) + [f"sales_lag_{i}" for i in range(1, 9) if f"sales_lag_{i}" not in W]
    got = recursive_forecast(df, LinearFit(), feats, {}, horizon=4).orderBy("week").collect()
    expect = _expected(sales, spend, months, 4)
    assert [r.week for r in got][:2] == weeks[10:12]
    assert (got[2].week - got[1].week).days == 7
    assert np.allclose([r.forecasted_sales for r in got], expect, rtol=1e-9)


def test_calendar_padding(spark):
    from mixlens.operators.forecast import candidates

    start = dt.date(2024, 1, 7)
    rows = [(start + dt.timedelta(days=7 * i), 1.0 if i < 3 else None, 1.0, 1, 1, (start + dt.timedelta(days=7 * i)).month)
            for i in range(4)]
    df = spark.createDataFrame(rows, "week date, total_sales double, spend double, impressions bigint, "
                                     "clicks bigint, month int")
    plain = {r.week: r.month for r in candidates(df, 3).collect()}
    fixed = {r.week: r.month for r in candidates(df, 3, pad_calendar=True).collect()}
    padded = sorted(plain)[1:]
    assert all(plain[w] is None for w in padded)             # reference: padded weeks lose calendar
    assert all(fixed[w] == w.month for w in padded)          # option: calendar filled in


def test_exact_ewm_weights_all_earlier_sales(spark):
    import pandas as pd

    class EwmFit:
        def score(self, x):
            return F.log1p(x["sales_ewm_4"] * 1.1)

    start = dt.date(2020, 1, 5)
    rng = np.random.default_rng(1)
    sales = [float(v) for v in rng.uniform(50, 150, 140)]
    sales[20:82] = [None] * 62                                   # a gap far longer than the lags
    rows = [(start + dt.timedelta(days=7 * i), v, 1.0, 1, 1, 1) for i, v in enumerate(sales)]
    df = spark.createDataFrame(rows, "week date, total_sales double, spend double, impressions bigint, "
                                     "clicks bigint, month int")
    feats = ["sales_ewm_4", "sales_lag_1"]
    got = [r.forecasted_sales for r in recursive_forecast(df, EwmFit(), feats, {}, horizon=6, ewm_mode="exact")
           .orderBy("week").collect()]
    work = pd.Series([np.nan if v is None else v for v in sales])
    for v in got:
        expect = work.ewm(span=4).mean().iloc[-1] * 1.1
        assert abs(v - expect) < 1e-8
        work = pd.concat([work, pd.Series([v])], ignore_index=True)
