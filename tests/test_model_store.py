"""Saving and loading every kind of fit; the autoregressive path through the holdout."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlens.operators import models as M
from mixlens.sources.io import load_fit, save_fit


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    sales, out = [100.0], []
    for i in range(60):
        x = float(rng.random())
        y = float(np.expm1(0.6 * np.log1p(sales[-1]) + 2.0 + x + 0.05 * rng.normal()))
        out.append(("all", dt.date(2021, 1, 3) + dt.timedelta(weeks=i), "train" if i < 48 else "test", y, sales[-1], x,
                    float(np.log1p(y))))
        sales.append(y)
    return spark.createDataFrame(out, "series string, week date, split string, total_sales double, sales_lag_1 double, "
                                      "x double, label double")


def test_every_fit_survives_saving(spark, rows, tmp_path):
    train, feats = rows.where("split = 'train'"), ["x", "sales_lag_1"]
    fits = {"ridge": M.fit_ridge(train, feats), "gbt": M.fit_gbt(train, feats, rounds=3),
            "huber": M.fit_huber(train, feats, rounds=3), "arx": M.fit_arx(train, feats, ["x"])}
    fits["stack"] = M.StackFit({"ridge": fits["ridge"], "huber": fits["huber"]},
                               M.RidgeFit(["_b_ridge", "_b_huber"], np.zeros(2), np.ones(2), np.array([0.5, 0.5]), 0.0, 1.0))
    for name, fit in fits.items():
        save_fit(spark, fit, f"{tmp_path}/{name}", feats, {"x": 1.0})
        again, got_feats, caps = load_fit(spark, f"{tmp_path}/{name}")
        assert got_feats == feats and caps == {"x": 1.0}
        want = [r["p"] for r in fit.transform(rows, "p").orderBy("week").collect()]
        got = [r["p"] for r in again.transform(rows, "p").orderBy("week").collect()]
        assert np.allclose(want, got, atol=1e-12)
    with pytest.raises(TypeError):
        save_fit(spark, object(), f"{tmp_path}/none", feats, {})


def test_autoregressive_holdout_follows_its_own_predictions(rows):
    fit = M.fit_arx(rows.where("split = 'train'"), ["x", "sales_lag_1"], ["x"])
    got = M.predictions(fit, rows, "arx").where("split = 'test'").orderBy("week").collect()
    test = rows.where("split = 'test'").orderBy("week").collect()
    own = fit.table.first()
    last = np.log1p(test[0]["sales_lag_1"])
    for g, r in zip(got, test):
        last = np.clip(own["intercept"] + own["coef"][0] * last + own["coef"][1] * r["x"], 0, 20)
        assert abs(g["yhat"] - np.expm1(last)) < 1e-6 * g["yhat"]
    assert M.predictions(fit, rows, "arx").where(F.col("yhat").isNull()).count() == 0


def test_every_series_has_its_own_regression(spark):
    rng = np.random.default_rng(8)
    rows, data = [], {}
    for name, slope in (("a", 0.3), ("b", 0.8), ("c", 0.0)):
        y = 5.0
        for i in range(40):
            x, flat, before = float(rng.normal()), 2.0, y
            y = 2.0 + slope * y + 0.5 * x + 0.1 * float(rng.normal())
            data.setdefault(name, []).append((before, x, y))
            rows.append((name, dt.date(2021, 1, 3) + dt.timedelta(weeks=i), float(np.expm1(before)), x, flat, y))
    df = spark.createDataFrame(rows, "series string, week date, sales_lag_1 double, x double, flat double, label double")
    fit = M.fit_arx(df, ["x", "flat", "sales_lag_1"], ["x", "flat"])
    got = {r["series"]: r for r in fit.table.collect()}
    assert set(got) == {"a", "b", "c"}
    for name, points in data.items():
        m = np.array(points)
        want = np.linalg.lstsq(np.column_stack([np.ones(40), m[:, :2]]), m[:, 2], rcond=None)[0]
        assert np.allclose([got[name]["intercept"], *got[name]["coef"][:2]], want, atol=1e-5)
        assert abs(got[name]["coef"][2]) < 1e-6                     # a constant column has no part
    other = df.limit(1).withColumn("series", F.lit("new"))
    assert fit.transform(other, "p").first()["p"] is None
