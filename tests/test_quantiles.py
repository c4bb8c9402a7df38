"""Exact quantiles against NumPy, at any spread, with ties, gaps and a coarse grid of bins."""
import numpy as np
from pyspark.sql import functions as F

from mixlens.functions import quantiles

QS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def _check(spark, columns):
    n = max(map(len, columns.values()))
    rows = [tuple(float(v[i]) if i < len(v) else None for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = quantiles.exact_quantiles(df, {c: F.col(c) for c in columns}, QS)
    for c, v in columns.items():
        assert np.allclose(got[c], np.quantile(np.array(v), QS), rtol=1e-12, atol=0), c


def test_matches_numpy(spark, monkeypatch):
    rng = np.random.default_rng(0)
    columns = {"normal": rng.normal(size=3000), "tied": rng.integers(0, 4, 3000), "one": [7.5],
               "heavy": np.exp(rng.normal(size=2000) * 20), "wide": [-1.7e308, 0.0, 1.7e308],
               "near": 1.0 + rng.integers(0, 3, 999) * 2.0**-52}
    _check(spark, columns)
    monkeypatch.setattr(quantiles, "BINS", 4)                    # many passes
    _check(spark, {"normal": columns["normal"], "tied": columns["tied"]})


def test_empty_null_and_nan(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 2.0), (None, 4.0)], "a double, b double")
    got = quantiles.exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.5])
    assert got == {"a": [None], "b": [3.0]}
    assert quantiles.exact_quantile(df.limit(0), F.col("b"), 0.5) is None
    far = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "a double")
    assert quantiles.exact_quantiles(far, {"a": F.col("a")}, [0.5])["a"] == [1.0]


def test_few_passes_over_any_spread(spark, monkeypatch):
    rng = np.random.default_rng(9)
    values = [float(v) for v in 10.0 ** rng.uniform(-150, 150, 5000)]
    df = spark.createDataFrame([(v,) for v in values], "a double").checkpoint()
    passes, plain = [], quantiles._bins
    monkeypatch.setattr(quantiles, "_bins", lambda long, open_: passes.append(1) or plain(long, open_))
    got = quantiles.exact_quantiles(df, {"a": F.col("a")}, [0.25, 0.5, 0.75, 0.99])["a"]
    assert np.allclose(got, np.quantile(values, [0.25, 0.5, 0.75, 0.99]), rtol=1e-12)
    assert len(passes) <= 2                                        # with the sketch: three jobs


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = [float(v) for v in rng.normal(size=3000)]
    df = spark.createDataFrame([(v,) for v in values], "a double").checkpoint()
    monkeypatch.setattr(quantiles, "ACCURACY", 5)
    got = quantiles.exact_quantiles(df, {"a": F.col("a")}, [0.1, 0.5, 0.9])["a"]
    assert np.allclose(got, np.quantile(values, [0.1, 0.5, 0.9]), rtol=1e-12)
