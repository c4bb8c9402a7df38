"""Window features against pandas' own rolling / ewm on random series with gaps."""
import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from mixlens.operators.features import engineer_features

values = st.lists(st.one_of(st.none(), st.floats(min_value=1.0, max_value=1e7, allow_nan=False)),
                  min_size=3, max_size=30)


@settings(max_examples=8, deadline=None)
@given(values)
def test_rolling_and_ewm_match_pandas(spark, vals):
    start = dt.date(2024, 1, 7)
    rows = [(start + dt.timedelta(days=7 * i), v, 1.0, 1, 1) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "week date, total_sales double, spend double, impressions bigint, "
                                     "clicks bigint")
    got = engineer_features(df).orderBy("week").toPandas()
    s = pd.Series([np.nan if v is None else v for v in vals], dtype=float).shift(1)
    expect = {
        "sales_rolling_mean_4": s.rolling(4, min_periods=2).mean(),
        "sales_rolling_mean_8": s.rolling(8, min_periods=2).mean(),
        # pandas' rolling std is an online add/remove update that drifts after a large
        # value leaves the window; the reference value here is computed per window.
        "sales_rolling_std_8": s.rolling(8, min_periods=2).apply(lambda w: np.nanstd(w, ddof=1), raw=True),
        "sales_rolling_min_8": s.rolling(8, min_periods=2).min(),
        "sales_rolling_max_8": s.rolling(8, min_periods=2).max(),
        "sales_ewm_4": s.ewm(span=4).mean(),
        "sales_diff_1": s.diff(1),
    }
    for col, e in expect.items():
        g = got[col].astype(float).to_numpy()
        e = e.to_numpy()
        assert np.array_equal(np.isnan(g), np.isnan(e)), col
        m = ~np.isnan(e)
        assert np.allclose(g[m], e[m], rtol=1e-9, atol=1e-6), col


def test_ewm_keeps_every_earlier_week_across_long_gaps(spark):
    import datetime as dt

    import pandas as pd

    from mixlens.operators.features import engineer_features
    week = [dt.date(2020, 1, 5) + dt.timedelta(weeks=i) for i in range(140)]
    y = [100.0 + (i * 37) % 50 if i < 57 or i >= 119 else None for i in range(140)]
    df = spark.createDataFrame([(w, v, 1.0, 2.0, 3.0) for w, v in zip(week, y)],
                               "week date, total_sales double, spend double, impressions double, clicks double")
    got = [r["sales_ewm_4"] for r in engineer_features(df).orderBy("week").collect()]
    want = pd.Series(y, dtype=float).ewm(span=4, min_periods=1).mean().shift(1)
    assert got[0] is None
    assert all(abs(g - w) < 1e-9 for g, w in zip(got[1:], want[1:]))
