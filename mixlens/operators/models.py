"""Model tournament on the weekly panel.

All models fit log1p(sales) and report in dollars (expm1). Fitting reads the assembled
training rows; nothing row-level is collected to the driver: the ridge family needs one
pass for the p x p Gram matrix (p = number of features) and one distributed pass for
the leave-one-out errors, the forest is an MLlib estimator, and the boosted models (squared
and Huber loss, and all folds of the stack) grow together by histograms in ``boost``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boost import BoostFit, BoostSpec, fit_boosters, folds

LABEL = "label"
EPS = float(np.finfo(np.float64).eps)

# Hyper-parameters of the analysed workflow's model set.
RIDGE_ALPHAS = np.logspace(-1, 5, 200)
META_ALPHAS = np.logspace(-1, 3, 50)
SEED = 42
FOREST = dict(numTrees=500, maxDepth=8, minInstancesPerNode=2, featureSubsetStrategy="sqrt")
BOOST = dict(rounds=500, depth=4, step=0.08, rows=0.8, columns=0.8, l1=0.5, l2=1.0)
HUBER = dict(rounds=500, depth=4, step=0.08, rows=0.9, min_rows=2, alpha=0.9)
MODEL_NAMES = {
    "ridge": "Linear Regression (RidgeCV)",
    "arx": "AR-X (least squares, one lag)",
    "forest": "Random Forest",
    "gbt": "Boosted trees (squared error)",
    "huber": "Boosted trees (Huber)",
    "stack": "Stacking Ensemble",
}


# ----------------------------------------------------------------------------------
# Ridge with leave-one-out alpha choice (standardised features, free intercept)
# ----------------------------------------------------------------------------------
def gram_stats(df: DataFrame, feats, label: str = LABEL, by: str | None = None) -> dict:
    """n, column sums, X'X, X'y and y'y for each value of ``by`` (an int column; None: one value, 0).

    Each task multiplies its own Arrow batches with BLAS and returns only its p x p partial sums
    (bounded by the feature count, not the rows); the partials are added up by a grouped sum. A
    single SQL aggregate with p^2 sum expressions would exceed whole-stage codegen's field limit
    and run interpreted."""
    p = len(feats)
    cols = list(feats) + [label]

    def partial(batches):
        acc = {}
        for pdf in batches:
            for g, part in pdf.groupby("_by"):
                m = part[cols].to_numpy(dtype=float)
                a = np.hstack([m, np.ones((len(m), 1))])     # [x..., y, 1]
                acc[g] = acc.get(g, 0.0) + a.T @ a
        iu = np.triu_indices(p + 2)
        for g, a in acc.items():
            yield pd.DataFrame({"g": g, "i": iu[0], "j": iu[1], "v": a[iu]})

    parts = (df.select((F.col(by) if by else F.lit(0)).cast("long").alias("_by"), *[F.col(c).cast("double") for c in cols])
               .mapInPandas(partial, "g long, i long, j long, v double")
               .groupBy("g", "i", "j").agg(F.sum("v").alias("v")).toPandas())
    out = {}
    for g, part in parts.groupby("g"):
        full = np.zeros((p + 2, p + 2))
        full[part["i"].to_numpy(), part["j"].to_numpy()] = part["v"].to_numpy()
        full = np.triu(full) + np.triu(full, 1).T
        yi, oi = p, p + 1
        out[int(g)] = {"n": float(full[oi, oi]), "sy": float(full[yi, oi]), "syy": float(full[yi, yi]),
                       "s": full[:p, oi].copy(), "sxy": full[:p, yi].copy(), "g": full[:p, :p].copy()}
    return out


def columns(names) -> dict:
    """Feature name -> column, what a fit's ``score`` takes."""
    return {c: F.col(c) for c in names}


@dataclass
class RidgeFit:
    feats: list
    mean: np.ndarray
    scale: np.ndarray
    coef: np.ndarray          # on standardised features
    intercept: float
    alpha: float
    loo_mse: dict = field(default_factory=dict)

    def score(self, x: dict):
        """Prediction as a built-in Spark expression (stays in whole-stage codegen)."""
        out = F.lit(float(self.intercept))
        for c, m, s, w in zip(self.feats, self.mean, self.scale, self.coef):
            if w != 0.0:
                out = out + (x[c].cast("double") - float(m)) * float(w / s)
        return out

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        return df.withColumn(out, self.score(columns(self.feats)))


def _centered(st: dict, standardize: bool = True):
    n = st["n"]
    mean = st["s"] / n
    cov = st["g"] - n * np.outer(mean, mean)                 # centred X'X
    if standardize:
        var = np.clip(np.diag(cov) / n, 0.0, None)           # ddof=0, like StandardScaler
        scale = np.sqrt(var)
        scale[scale == 0.0] = 1.0
    else:
        scale = np.ones_like(mean)                           # plain ridge: centre only
    zz = cov / np.outer(scale, scale)                        # Z'Z of standardised columns
    ybar = st["sy"] / n
    zy = (st["sxy"] - n * mean * ybar) / scale               # Z'y_c
    return mean, scale, zz, zy, ybar


def fit_ridge(df: DataFrame, feats, alphas=RIDGE_ALPHAS, label: str = LABEL,
              standardize: bool = True) -> RidgeFit:
    """Standardise (or only centre), choose alpha by exact leave-one-out error, fit."""
    st = gram_stats(df, feats, label)[0]
    return _ridges(df.withColumn("_fold", F.lit(-1)), feats, {-2: st}, alphas, label, standardize)[-2]


def fit_ridge_folds(df: DataFrame, feats, k: int, alphas=RIDGE_ALPHAS, label: str = LABEL) -> list[RidgeFit]:
    """The ridge without each ``_fold`` in turn, then on all rows: two passes in all."""
    by = gram_stats(df, feats, label, by="_fold")
    total = {key: sum(st[key] for st in by.values()) for key in next(iter(by.values()))}
    stats = {i: {key: total[key] - by[i][key] if i in by else total[key] for key in total} for i in range(k)}
    fits = _ridges(df, feats, {**stats, -2: total}, alphas, label, True)
    return [fits[i] for i in range(k)] + [fits[-2]]


def _ridges(df: DataFrame, feats, stats: dict, alphas, label: str, standardize: bool) -> dict:
    """One ridge for each entry of ``stats``: Gram sums of the rows whose ``_fold`` is not its key.

    LOO residual of row i: e_i / (1 - h_i), h_i = 1/n + z_i'(Z'Z + a I)^-1 z_i. With
    Z'Z = V diag(s) V' both terms are sums over the p eigen-directions, so one pass over
    the rows (mapInPandas, NumPy per Arrow batch) returns the summed squared LOO error
    for every alpha and model; only those numbers come back from a task.
    """
    feats, alphas = list(feats), np.asarray(alphas, dtype=float)
    parts = {}
    for key, st in stats.items():
        mean, scale, zz, zy, ybar = _centered(st, standardize)
        s, v = np.linalg.eigh(zz)
        parts[key] = (mean, scale, v, np.clip(s, 0.0, None), v.T @ zy, ybar, st["n"])
    bc = df.sparkSession.sparkContext.broadcast((parts, alphas))       # p x p numbers a model

    def loo(batches):
        models, al = bc.value
        acc = {key: np.zeros(len(al)) for key in models}
        for pdf in batches:
            x, y, fold = pdf[feats].to_numpy(dtype=float), pdf[label].to_numpy(dtype=float), pdf["_fold"].to_numpy()
            for key, (mean_, scale_, v_, s_, c_, ybar_, n_) in models.items():
                own = fold != key
                u = ((x[own] - mean_) / scale_) @ v_               # rows x p
                inv = 1.0 / (s_[None, :] + al[:, None])            # alphas x p
                h = 1.0 / n_ + (u * u) @ inv.T                     # rows x alphas
                yhat = ybar_ + u @ (inv * c_[None, :]).T           # rows x alphas
                e = (y[own][:, None] - yhat) / (1.0 - h)
                acc[key] += (e * e).sum(axis=0)
        for key, sse in acc.items():
            yield pd.DataFrame({"m": key, "k": np.arange(len(al)), "sse": sse})

    found = (df.select(*feats, label, "_fold").mapInPandas(loo, "m long, k long, sse double")
               .groupBy("m", "k").agg(F.sum("sse").alias("sse")).toPandas().sort_values(["m", "k"]))
    out = {}
    for key, (mean, scale, v, s, c, ybar, n) in parts.items():
        mse = found.loc[found["m"] == key, "sse"].to_numpy() / n
        alpha = float(alphas[int(np.argmin(mse))])
        out[key] = RidgeFit(feats, mean, scale, v @ (c / (s + alpha)), float(ybar), alpha,
                            dict(zip(alphas.tolist(), mse.tolist())))
    return out


# ----------------------------------------------------------------------------------
# MLlib forest
# ----------------------------------------------------------------------------------
@dataclass
class SparkFit:
    model: object
    feats: list
    _nodes: tuple | None = field(default=None, repr=False)

    def nodes(self) -> tuple[list, list]:
        """Per tree the arrays (feature, threshold, left, right, value, cover) by node, and the weights (read once)."""
        if self._nodes is None:
            from .explain import ensemble_nodes
            self._nodes = ensemble_nodes(self)
        return self._nodes

    def score(self, x: dict):
        """The weighted trees as one expression: each is walked from node to node by its arrays."""
        trees, weights = self.nodes()
        return tree_walk(F.array(*[x[c].cast("double") for c in self.feats]), trees, weights)

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        va = VectorAssembler(inputCols=self.feats, outputCol="_features", handleInvalid="keep")
        res = self.model.transform(va.transform(df))
        return res.withColumnRenamed(self.model.getPredictionCol(), out).drop("_features")


def let(value, use):
    """``use`` of ``value``, which is worked out once: the body of a one-element transform."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tree_walk(x, trees: list, weights: list):
    """Weighted sum over trees given as node arrays, as an expression that does not grow with them."""
    deep = max((depth_of(t) for t in trees), default=0)
    told = [{"f": (t["feature"] + 1).tolist(), "c": [float(c) for c in t["threshold"]], "l": (t["left"] + 1).tolist(),
             "r": (t["right"] + 1).tolist(), "v": [float(v) * float(w) for v in t["value"]]} for t, w in zip(trees, weights)]
    table = F.from_json(F.lit(json.dumps(told)),
                        "array<struct<f:array<int>,c:array<double>,l:array<int>,r:array<int>,v:array<double>>>")

    def one(xs, tree):
        def down(node, _):
            return F.when(F.element_at(tree["l"], node) < 1, node).when(
                F.element_at(xs, F.element_at(tree["f"], node)) <= F.element_at(tree["c"], node),
                F.element_at(tree["l"], node)).otherwise(F.element_at(tree["r"], node))

        return F.element_at(tree["v"], F.aggregate(F.sequence(F.lit(1), F.lit(deep)), F.lit(1), down) if deep else F.lit(1))

    return let(x, lambda xs: F.aggregate(table, F.lit(0.0), lambda acc, tree: acc + one(xs, tree)))


def depth_of(tree: dict) -> int:
    """Levels below the root."""
    depth, at = 0, [0]
    while at := [c for n in at if tree["left"][n] >= 0 for c in (tree["left"][n], tree["right"][n])]:
        depth += 1
    return depth


def _assembled(df: DataFrame, feats) -> DataFrame:
    return VectorAssembler(inputCols=list(feats), outputCol="_features", handleInvalid="keep").transform(df)


def fit_forest(df: DataFrame, feats, label: str = LABEL, **params) -> SparkFit:
    """Random forest (bootstrap rows, sqrt features per split)."""
    p = {**FOREST, **params}
    # execution setting only (same trees): node ids cached with the rows so deep trees are
    # not re-traversed every level. The histogram budget stays at MLlib's default (256 MB):
    # a larger one can exhaust a default-size driver heap on deep, wide forests.
    p = {"cacheNodeIds": True, **p}
    est = RandomForestRegressor(featuresCol="_features", labelCol=label, predictionCol="_pred", **{"seed": SEED, **p})
    return SparkFit(est.fit(_assembled(df, feats)), list(feats))


# ----------------------------------------------------------------------------------
# Boosted trees
# ----------------------------------------------------------------------------------
def gbt_spec(**params) -> BoostSpec:
    """I8: squared loss, L1 and L2 on leaf values, rows and columns drawn for each tree."""
    return BoostSpec("squared", **{**BOOST, "seed": SEED, **params})


def huber_spec(**params) -> BoostSpec:
    """Friedman's Huber boosting. Each round: delta = alpha-quantile of |residual|, a tree on the
    clipped residuals, each leaf the median residual plus the mean clipped deviation from it."""
    return BoostSpec("huber", **{**HUBER, "seed": SEED, **params})


def fit_gbt(df: DataFrame, feats, label: str = LABEL, **params) -> BoostFit:
    return fit_boosters(df, feats, [gbt_spec(**params)], label)[0]


def fit_huber(df: DataFrame, feats, label: str = LABEL, **params) -> BoostFit:
    return fit_boosters(df, feats, [huber_spec(**params)], label)[0]


# ----------------------------------------------------------------------------------
# AR(1) with exogenous regressors, by conditional least squares
# ----------------------------------------------------------------------------------
@dataclass
class ARXFit:
    """One regression a series: ``table`` has series, intercept and coef (array: lag first, then ``base``)."""
    table: DataFrame
    base: list
    lo: float = 0.0
    hi: float = 20.0

    def prepare(self, df: DataFrame) -> DataFrame:
        """``df`` with its series' coefficients; series without a fit score null."""
        own = self.table.select("series", F.struct("intercept", "coef").alias("_arx"))
        return df.join(own, "series", "left")

    def _rest(self, x: dict):
        """Everything but the lag's part."""
        exog = F.array(*[x[c].cast("double") for c in self.base]).cast("array<double>")
        coef = F.slice(F.col("_arx.coef"), 2, max(1, len(self.base)))
        return F.col("_arx.intercept") + F.aggregate(F.zip_with(exog, coef, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    def _clipped(self, p):
        return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(self.lo)), F.lit(self.hi)))

    def score(self, x: dict):
        return self._clipped(self._rest(x) + F.element_at("_arx.coef", 1) * F.log1p(x["sales_lag_1"]))

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        return self.prepare(df).withColumn(out, self.score(columns([*self.base, "sales_lag_1"]))).drop("_arx")

    def transform_path(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        """Like ``transform``, but the rows of the test split follow one another: the first takes
        the last training week's sales as its lag, each later one the prediction before it. One
        fold over a series' test weeks."""
        rest = self.prepare(df.where(F.col("split") == "test")).select(
            "series", "week", self._rest(columns(self.base)).alias("rest"), F.element_at("_arx.coef", 1).alias("slope"),
            F.log1p("sales_lag_1").alias("lag"))
        weeks = F.sort_array(F.collect_list(F.struct("week", "rest", "slope", "lag")))

        def step(acc, e):
            p = self._clipped(e["rest"] + e["slope"] * F.coalesce(acc["last"], e["lag"]))
            return F.struct(p.alias("last"), F.concat(acc["path"], F.array(
                F.struct(e["week"].alias("week"), p.alias("p")))).alias("path"))

        start = F.struct(F.lit(None).cast("double").alias("last"), F.array().cast("array<struct<week:date,p:double>>").alias("path"))
        path = (rest.groupBy("series").agg(weeks.alias("h"))
                .select("series", F.inline(F.aggregate("h", start, step, lambda acc: acc["path"])))
                .withColumnRenamed("p", "_path"))
        return (self.transform(df, out).join(path, ["series", "week"], "left")
                .withColumn(out, F.when(F.col("split") == "test", F.col("_path")).otherwise(F.col(out))).drop("_path"))


def fit_arx(df: DataFrame, feats, base_feats, label: str = LABEL, penalty: float = 1e-6) -> ARXFit:
    """I11 (re-aimed): for every series, log-sales on its own lag and the base features by least
    squares (a tiny ridge keeps constant columns at 0); predictions clipped to [0, 20].

    Each task adds up the p x p products of its rows by series; the sums meet by (series, i, j)
    and every series' equations are solved where its sums are. Nothing is collected.
    """
    base = [c for c in base_feats if c in feats]
    cols = ["_ylag", *base, label]
    p = len(cols)

    def partial(batches):
        acc = {}
        for pdf in batches:
            for g, part in pdf.groupby("series"):
                m = part[cols].to_numpy(dtype=float)
                a = np.hstack([m, np.ones((len(m), 1))])
                acc[g] = acc.get(g, 0.0) + a.T @ a
            if len(acc) > 1000:                                # a task holds the sums of so many series at a time
                yield told(acc)
                acc = {}
        if acc:
            yield told(acc)

    def told(acc):
        iu = np.triu_indices(p + 1)
        return pd.concat([pd.DataFrame({"series": g, "i": iu[0], "j": iu[1], "v": a[iu]}) for g, a in acc.items()])

    def solve(pdf):
        full = np.zeros((p + 1, p + 1))
        full[pdf["i"], pdf["j"]] = pdf["v"]
        full = np.triu(full) + np.triu(full, 1).T
        st = {"n": full[p, p], "sy": full[p - 1, p], "s": full[:p - 1, p], "sxy": full[:p - 1, p - 1], "g": full[:p - 1, :p - 1]}
        mean, scale, zz, zy, ybar = _centered(st)
        coef = np.linalg.lstsq(zz + penalty * np.eye(p - 1), zy, rcond=1e-12)[0] / scale
        return pd.DataFrame({"series": pdf["series"].iloc[:1], "intercept": ybar - float(coef @ mean), "coef": [coef]})

    sums = (df.withColumn("_ylag", F.log1p(F.col("sales_lag_1")))
            .select("series", *[F.col(c).cast("double") for c in cols])
            .mapInPandas(partial, "series string, i long, j long, v double")
            .groupBy("series", "i", "j").agg(F.sum("v").alias("v")))
    table = sums.groupBy("series").applyInPandas(solve, "series string, intercept double, coef array<double>")
    return ARXFit(table.checkpoint(eager=True), base)


# ----------------------------------------------------------------------------------
# Stacking: out-of-fold predictions on contiguous week blocks, ridge meta-learner
# ----------------------------------------------------------------------------------
@dataclass
class StackFit:
    bases: dict
    meta: RidgeFit

    def score(self, x: dict):
        return self.meta.score({f"_b_{n}": fit.score(x) for n, fit in self.bases.items()})

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        cur = df
        for name, fit in self.bases.items():
            cur = fit.transform(cur, f"_b_{name}")
        return self.meta.transform(cur, out).drop(*[f"_b_{n}" for n in self.bases])


def week_folds(df: DataFrame, k: int):
    """Fold of each row: ``k`` contiguous blocks of the distinct weeks, the first ones longer by one."""
    weeks = [r[0] for r in df.select("week").distinct().orderBy("week").collect()]      # bounded by the calendar
    sizes = [len(weeks) // k + (1 if i < len(weeks) % k else 0) for i in range(k)]
    fold = F.lit(0)
    for i, start in enumerate(np.cumsum(sizes)[:-1], 1):
        if start < len(weeks):
            fold = F.when(F.col("week") >= F.lit(weeks[int(start)]), F.lit(i)).otherwise(fold)
    return fold


def fit_stack(df: DataFrame, feats, k: int = 5, label: str = LABEL, rounds: int | None = None,
              **changes) -> StackFit:
    """Base models fitted without each of ``k`` contiguous folds give out-of-fold scores; a
    plain ridge combines them; the bases of the result are fitted on all rows.

    All boosters (both losses, all folds and the full fit) grow in the same jobs, and the ridge
    of every fold comes from one pass of Gram matrices with the fold as a key. ``changes`` go to
    both boosters.
    """
    if rounds:
        changes["rounds"] = rounds
    specs = {"huber": huber_spec(**changes), "gbt": gbt_spec(**changes)}
    idx = df.withColumn("_fold", week_folds(df, k)).checkpoint(eager=True)
    grown = fit_boosters(idx, feats, [s for spec in specs.values() for s in folds(spec, k)], label, "_fold")
    fitted = {name: grown[i * (k + 1):(i + 1) * (k + 1)] for i, name in enumerate(specs)}
    fitted["ridge"] = fit_ridge_folds(idx, feats, k, label=label)
    oof = idx
    for name, each in fitted.items():
        oof = held_out(oof, each[:k], f"_b_{name}")
    # the meta-learner is a plain ridge on the out-of-fold columns (no scaler)
    meta = fit_ridge(oof.select(label, *[f"_b_{n}" for n in fitted]).checkpoint(eager=True),
                     [f"_b_{n}" for n in fitted], META_ALPHAS, label, standardize=False)
    return StackFit({n: each[k] for n, each in fitted.items()}, meta)


def held_out(df: DataFrame, fits: list, out: str) -> DataFrame:
    """Each row's score by the model that was fitted without the row's ``_fold``."""
    cur = df
    for i, fit in enumerate(fits):
        cur = fit.transform(cur, f"_s{i}")
    score = F.coalesce(*[F.when(F.col("_fold") == i, F.col(f"_s{i}")) for i in range(len(fits))])
    return cur.withColumn(out, score).drop(*[f"_s{i}" for i in range(len(fits))])


# ----------------------------------------------------------------------------------
# Evaluation and leaderboard
# ----------------------------------------------------------------------------------
def predictions(fit, df: DataFrame, model: str) -> DataFrame:
    """expm1 of the log-space prediction, long format; autoregressive fits run through the test weeks."""
    res = (fit.transform_path if hasattr(fit, "transform_path") else fit.transform)(df, "log_pred")
    return res.select(F.lit(model).alias("model"), "series", "week", "split",
                      F.col("total_sales").alias("y"), F.expm1("log_pred").alias("yhat"))


def metrics(preds: DataFrame) -> DataFrame:
    """RMSE, MAE, MAPE % and R2 per (model, split)."""
    e = F.col("y") - F.col("yhat")
    g = preds.where(F.col("y").isNotNull()).groupBy("model", "split")
    out = g.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                (F.avg(F.abs(e) / F.greatest(F.abs(F.col("y")), F.lit(EPS))) * 100).alias("mape_pct"),
                F.sum(e * e).alias("_sse"), F.var_pop("y").alias("_vy"), F.count("*").alias("_n"))
    return out.withColumn("r2", F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("_n"))) \
              .drop("_sse", "_vy", "_n")


def leaderboard(preds: DataFrame) -> DataFrame:
    """I12 + F4: holdout metrics, training R2, holdout R2; best (lowest RMSE) first."""
    m = metrics(preds)
    test = m.where(F.col("split") == "test").select("model", "rmse", "mae", "mape_pct",
                                                   F.col("r2").alias("r2_holdout"))
    train = m.where(F.col("split") == "train").select("model", F.col("r2").alias("r2_train"))
    return test.join(train, "model", "left").orderBy("rmse", "model")


def model_comparison(board: DataFrame) -> DataFrame:
    """The leaderboard stacked long, (model, metric, value), for per-metric charts."""
    metrics_ = ["rmse", "mae", "mape_pct", "r2_train", "r2_holdout"]
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics_])
    return board.select("model", F.inline(arr))
