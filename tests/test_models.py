"""Model checks: ridge LOO vs brute force, TreeSHAP local accuracy, interval floor."""
import numpy as np
from pyspark.sql import functions as F

from mixlens.operators.forecast import attach_interval
from mixlens.operators.models import fit_gbt, fit_ridge


def _frame(spark, n=60, p=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    y = x @ rng.normal(size=p) + rng.normal(scale=0.5, size=n)
    rows = [tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)]
    cols = [f"x{i}" for i in range(p)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", label double"), x, y, cols


def test_ridge_loo_matches_brute_force(spark):
    df, x, y, cols = _frame(spark)
    alphas = np.logspace(-1, 3, 9)
    fit = fit_ridge(df, cols, alphas)
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / sd
    n = len(y)
    best, best_a = None, None
    for a in alphas:
        err = 0.0
        for i in range(n):
            m = np.ones(n, bool)
            m[i] = False
            zc, yc = z[m] - z[m].mean(0), y[m] - y[m].mean()
            w = np.linalg.solve(zc.T @ zc + a * np.eye(len(cols)), zc.T @ yc)
            pred = y[m].mean() + (z[i] - z[m].mean(0)) @ w
            err += (y[i] - pred) ** 2
        if best is None or err < best - 1e-12:
            best, best_a = err, a
        assert abs(fit.loo_mse[float(a)] - err / n) < 1e-8 * max(1.0, err / n)
    assert fit.alpha == best_a
    zc = z - z.mean(0)
    w = np.linalg.solve(zc.T @ zc + best_a * np.eye(len(cols)), zc.T @ (y - y.mean()))
    assert np.allclose(fit.coef, w, atol=1e-9)


def test_tree_shap_local_accuracy(spark):
    from mixlens.operators.explain import base_value, shap_values
    df, x, y, cols = _frame(spark, n=80)
    df = df.withColumn("rid", F.monotonically_increasing_id())
    from mixlens.operators.models import RidgeFit, StackFit, fit_forest, fit_huber
    fits = {"gbt": fit_gbt(df, cols, rounds=5, depth=3), "huber": fit_huber(df, cols, rounds=4),
            "forest": fit_forest(df, cols, numTrees=4, maxDepth=3), "ridge": fit_ridge(df, cols)}
    fits["stack"] = StackFit({k: fits[k] for k in ("huber", "gbt", "ridge")},
                             RidgeFit(["_b_huber", "_b_gbt", "_b_ridge"], np.array([0.1, -0.2, 0.3]), np.ones(3),
                                      np.array([0.5, 0.2, 0.4]), 0.7, 1.0))
    for fit in fits.values():
        base = base_value(fit)
        phi = shap_values(df, fit, ["rid"]).groupBy("rid").agg(F.sum("shap_value").alias("s"))
        pred = fit.transform(df, "p").withColumn("q", fit.score({c: F.col(c) for c in cols})).select("rid", "p", "q")
        rows = phi.join(pred, "rid").collect()
        assert len(rows) == 80
        assert max(abs(base + r.s - r.p) for r in rows) < 1e-9
        assert max(abs(r.q - r.p) for r in rows) < 1e-9             # the expression gives what the batches give


def test_interval_lower_bound_floor(spark):
    df = spark.createDataFrame([("all", 5.0)], "series string, forecasted_sales double")
    r = attach_interval(df, 9.0).first()
    assert r.lower_bound == 0.0 and r.upper_bound == 14.0


def test_plain_ridge_matches_closed_form(spark):
    df, x, y, cols = _frame(spark, seed=3)
    fit = fit_ridge(df, cols, [2.0], standardize=False)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(len(cols)), xc.T @ yc)
    assert np.allclose(fit.coef, w, atol=1e-9)


def test_tree_shap_matches_shapley_definition():
    """Against the definition: every coalition of features, absent ones averaged by cover."""
    from itertools import combinations
    from math import factorial

    from mixlens.operators.explain import tree_shap
    # depth 3, feature 0 split twice on one path; children of i listed explicitly
    tree = {"feature": np.array([0, 1, 0, -1, -1, 2, -1, -1, -1]), "threshold": np.array([0.0, 0.5, 1.0, 0, 0, -0.2, 0, 0, 0]),
            "left": np.array([1, 3, 5, -1, -1, 7, -1, -1, -1]), "right": np.array([2, 4, 6, -1, -1, 8, -1, -1, -1]),
            "value": np.array([0, 0, 0, 1.0, -2.0, 0, 5.0, 3.0, 0.5]), "cover": np.array([20.0, 9, 11, 4, 5, 7, 4, 3, 4])}

    def mean(x, known, node=0):
        if tree["left"][node] < 0:
            return tree["value"][node]
        a, b, f = tree["left"][node], tree["right"][node], tree["feature"][node]
        if f in known:
            return mean(x, known, a if x[f] <= tree["threshold"][node] else b)
        return (tree["cover"][a] * mean(x, known, a) + tree["cover"][b] * mean(x, known, b)) / tree["cover"][node]

    xs = np.random.default_rng(5).normal(size=(30, 4))
    xs[0] = [0.0, 0.5, -0.2, 0.0]                                # on the thresholds
    got = tree_shap(xs, tree)
    for x, phi in zip(xs, got):
        for i in range(4):
            rest = [j for j in range(4) if j != i]
            want = sum(factorial(k) * factorial(3 - k) / 24 * (mean(x, {*s, i}) - mean(x, set(s)))
                       for k in range(4) for s in combinations(rest, k))
            assert abs(phi[i] - want) < 1e-12


def test_views_fit_all_rounds():
    from mixlens.operators import models as M
    from mixlens.plans.catalog import ModelSuite
    assert M.gbt_spec().rounds == M.huber_spec().rounds == 500
    assert ModelSuite.__init__.__defaults__ == (None, None)         # no other number unless a caller gives one


def test_ridge_folds_equal_single_fits(spark):
    from mixlens.operators.models import fit_ridge_folds
    df, *_, cols = _frame(spark, n=50)
    idx = df.withColumn("_fold", F.pmod(F.xxhash64("label"), F.lit(3)).cast("int")).checkpoint()
    every = fit_ridge_folds(idx, cols, 3)
    for k, fit in enumerate(every):
        one = fit_ridge(idx.where(F.col("_fold") != k) if k < 3 else idx, cols)
        assert fit.alpha == one.alpha and np.allclose(fit.coef, one.coef, atol=1e-9)
        assert np.allclose(list(fit.loo_mse.values()), list(one.loo_mse.values()), rtol=1e-9)
