"""Time-series features: min_periods, EWM with gaps, no leakage, padding."""
import datetime as dt

import numpy as np

from mixlens.operators.features import engineer_features, future_weeks


def _weekly(spark, values, start=dt.date(2024, 1, 7)):
    rows = [(start + dt.timedelta(days=7 * i), v, 1.0, 1, 1) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "week date, total_sales double, spend double, impressions bigint, "
                                       "clicks bigint")


def test_rolling_min_periods(spark):
    out = engineer_features(_weekly(spark, [5.0, 7.0, 9.0, 11.0])).orderBy("week").collect()
    assert out[1].sales_rolling_mean_4 is None          # one prior value
    assert out[2].sales_rolling_mean_4 == 6.0           # two prior values
    assert abs(out[3].sales_rolling_std_8 - 2.0) < 1e-12


def test_ewm_with_gaps(spark):
    vals = [None, 3.0, 5.0, None, 8.0, 2.0, 9.0]
    expect = [None, 3, 4.25, 4.25, 6.629442, 4.25, 6.441606]   # EWM of the unshifted series
    out = engineer_features(_weekly(spark, vals + [1.0])).orderBy("week").collect()
    got = [r.sales_ewm_4 for r in out][1:]                    # feature at t = EWM up to t-1
    for g, e in zip(got, expect):
        assert (g is None and e is None) or abs(g - e) < 1e-6


def test_no_leakage(spark):
    base = [float(v) for v in np.arange(1, 21)]
    changed = list(base)
    changed[12] = 1000.0
    a = engineer_features(_weekly(spark, base)).orderBy("week").collect()
    b = engineer_features(_weekly(spark, changed)).orderBy("week").collect()
    cols = [c for c in a[0].asDict() if c.startswith("sales_")]
    for t in range(13):                                       # features up to and including T
        assert all(a[t][c] == b[t][c] for c in cols)


def test_horizon_beyond_table_pads(spark):
    vals = [1.0] * 18 + [None, None]
    fw = future_weeks(_weekly(spark, vals), 4).orderBy("week").collect()
    assert [r.is_padded for r in fw] == [False, False, True, True]
    assert (fw[2].week - fw[1].week).days == 7 and (fw[3].week - fw[2].week).days == 7


def test_no_known_sales_is_a_clear_error(spark):
    import pytest

    from mixlens.operators.forecast import NaiveFit, recursive_forecast
    weekly = _weekly(spark, [None, None, None])
    with pytest.raises(ValueError, match="No weeks with known sales"):
        recursive_forecast(weekly, NaiveFit(), [], {}, 2)
