"""What drives the forecast.

TreeSHAP is scored where the rows live: the fitted ensemble's nodes (bounded by the model size,
not the data; a forest's are read from its saved form) are broadcast, and each task explains
its own rows inside ``mapInPandas`` with NumPy. Sums of models, such as the stack, add their
parts' values. Output is long: (row keys, feature, shap_value), in log1p(sales) space like the model.
"""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def std_coefficients(ridge_fit) -> list:
    """(feature, standardised coefficient) sorted by |coefficient| desc."""
    pairs = list(zip(ridge_fit.feats, [float(c) for c in ridge_fit.coef]))
    return sorted(pairs, key=lambda t: (-abs(t[1]), t[0]))


def tree_importance(fit) -> list:
    """(feature, importance) sorted desc, of the forest or a boosted fit."""
    imp = fit.importance() if hasattr(fit, "importance") else fit.model.featureImportances.toArray()
    return sorted(zip(fit.feats, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))


def linear_shap(df: DataFrame, ridge_fit, keys) -> DataFrame:
    """Exact SHAP of the linear model, coef * (x - mean) / scale, long format."""
    cols = [F.struct(F.lit(c).alias("feature"),
                     ((F.col(c).cast("double") - float(m)) * float(w / s)).alias("shap_value"))
            for c, m, s, w in zip(ridge_fit.feats, ridge_fit.mean, ridge_fit.scale, ridge_fit.coef)]
    return df.select(*keys, F.inline(F.array(*cols)))


def ensemble_nodes(spark_fit, spark=None) -> tuple[list, list]:
    """Read a fitted tree ensemble's nodes from its saved form.

    Returns per tree a dict of arrays (feature, threshold, left, right, value, cover)
    indexed by node id, and the tree weights."""
    model = spark_fit.model
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/mixlens-models/{model.uid}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", "nodeData.split.featureIndex",
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold")).toPandas()
    weights = [float(w) for w in model.treeWeights]
    if "RandomForest" in type(model).__name__:                  # a mean of its trees, not a sum
        weights = [w / sum(weights) for w in weights]
    trees = []
    for t in sorted(nodes["treeID"].unique()):
        g = nodes[nodes["treeID"] == t].sort_values("id")
        n = int(g["id"].max()) + 1
        arr = {k: np.zeros(n) for k in ["threshold", "value", "cover"]}
        for k in ["feature", "left", "right"]:
            arr[k] = np.full(n, -1, dtype=np.int64)
        ids = g["id"].to_numpy()
        arr["feature"][ids] = g["featureIndex"].to_numpy()
        arr["threshold"][ids] = g["threshold"].fillna(0.0).to_numpy()
        arr["left"][ids] = g["leftChild"].to_numpy()
        arr["right"][ids] = g["rightChild"].to_numpy()
        arr["value"][ids] = g["prediction"].to_numpy()
        arr["cover"][ids] = g["rawCount"].to_numpy()
        trees.append(arr)
    return trees, weights


def leaf_paths(tree: dict) -> list[tuple[int, dict]]:
    """(leaf, {feature: (low, high, share)}) of every leaf: the splits on a feature joined into
    the interval low < x <= high that leads there, with the part of the rows that took those turns."""
    out, todo = [], [(0, {})]
    while todo:
        node, path = todo.pop()
        if tree["left"][node] < 0:
            out.append((node, path))
            continue
        f, cut = int(tree["feature"][node]), tree["threshold"][node]
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, span in ((tree["left"][node], (low, min(high, cut))), (tree["right"][node], (max(low, cut), high))):
            todo.append((child, {**path, f: (*span, share * tree["cover"][child] / tree["cover"][node])}))
    return out


def tree_shap(x: np.ndarray, tree: dict, paths: list | None = None) -> np.ndarray:
    """Path-dependent SHAP values of one tree for all rows of ``x`` at once (rows x features).

    At a leaf, a coalition of the path's features contributes the product, over its members, of
    whether the row follows the path and, over the others, of the share of rows that do. The
    coefficients of prod(share + follows * t) sum those products by coalition size, so each
    feature's Shapley weights apply to one short polynomial a row.
    """
    phi = np.zeros(x.shape)
    for leaf, path in paths if paths is not None else leaf_paths(tree):
        names = list(path)
        m = len(names)
        follows = {f: ((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, (low, high, _) in path.items()}
        for f in names:
            poly = np.zeros((m, len(x)))
            poly[0] = 1.0
            for k, g in enumerate(n for n in names if n != f):
                share = path[g][2]
                for size in range(k + 1, 0, -1):
                    poly[size] = poly[size] * share + poly[size - 1] * follows[g]
                poly[0] *= share
            weight = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
            phi[:, f] += (weight @ poly) * (follows[f] - path[f][2]) * tree["value"][leaf]
    return phi


def expected_value(trees, weights) -> float:
    """Base value: cover-weighted mean leaf value, summed over the weighted trees."""
    total = 0.0
    for t, w in zip(trees, weights):
        leaves = t["left"] < 0
        total += w * float((t["value"][leaves] * t["cover"][leaves]).sum() / t["cover"][0])
    return total


def parts_of(fit, weight: float = 1.0) -> list[tuple]:
    """A fit as weighted parts that can be explained one by one: ('trees', feats, trees, weights) and
    ('linear', feats, means, slopes). A stack's parts are its bases', times the combiner's slopes."""
    if hasattr(fit, "bases"):
        slope = {f: float(c / s) for f, c, s in zip(fit.meta.feats, fit.meta.coef, fit.meta.scale)}
        return [part for name, base in fit.bases.items() for part in parts_of(base, weight * slope[f"_b_{name}"])]
    if hasattr(fit, "nodes"):
        trees, weights = fit.nodes()
        return [("trees", list(fit.feats), trees, [w * weight for w in weights])]
    if hasattr(fit, "coef"):
        return [("linear", list(fit.feats), np.asarray(fit.mean, float), np.asarray(fit.coef / fit.scale, float) * weight)]
    raise TypeError(f"no SHAP values for a fit of kind {type(fit).__name__}")


def base_value(fit) -> float:
    """What the SHAP values of a row add up from: the fit's output less their sum, the same for all rows."""
    if hasattr(fit, "bases"):
        slope = {f: float(c / s) for f, c, s in zip(fit.meta.feats, fit.meta.coef, fit.meta.scale)}
        centre = sum(slope[f] * float(m) for f, m in zip(fit.meta.feats, fit.meta.mean))
        return float(fit.meta.intercept) - centre + sum(slope[f"_b_{n}"] * base_value(b) for n, b in fit.bases.items())
    if hasattr(fit, "nodes"):
        return float(getattr(fit, "init", 0.0)) + expected_value(*fit.nodes())
    return float(fit.intercept)


def shap_values(df: DataFrame, fit, keys) -> DataFrame:
    """Long (keys..., feature, shap_value) for every row of ``df``: trees, linear fits and stacks of them.

    The paths of every tree are worked out once on the driver and go out with the model, so a
    batch of rows costs a few operations on whole columns for each leaf.
    """
    feats = list(next(iter(fit.bases.values())).feats if hasattr(fit, "bases") else fit.feats)
    parts = []
    for kind, names, a, b in parts_of(fit):
        at = [feats.index(f) for f in names]
        parts.append((kind, at, [(t, leaf_paths(t)) for t in a] if kind == "trees" else a, b))
    bc = df.sparkSession.sparkContext.broadcast((parts, feats))        # the model
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType(key_fields + [T.StructField("feature", T.StringType()),
                                        T.StructField("shap_value", T.DoubleType())])

    def explain(batches):
        parts_, feats_ = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = pdf[feats_].to_numpy(dtype=float)
            out = np.zeros_like(x)
            for kind, at, a, b in parts_:
                if kind == "trees":
                    for (t, paths), w in zip(a, b):
                        out[:, at] += w * tree_shap(x[:, at], t, paths)
                else:
                    out[:, at] += (x[:, at] - a) * b
            rep = pdf[keys].loc[pdf.index.repeat(len(feats_))].reset_index(drop=True)
            rep["feature"] = np.tile(feats_, len(pdf))
            rep["shap_value"] = out.reshape(-1)
            yield rep

    return df.select(*keys, *feats).mapInPandas(explain, schema)


def shap_global(shap_long: DataFrame) -> DataFrame:
    """Mean |SHAP| per feature, largest first."""
    return (shap_long.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))
                     .orderBy(F.col("mean_abs_shap").desc(), "feature"))


def beeswarm(shap_long: DataFrame, rows: DataFrame, keys, top_n: int = 15) -> DataFrame:
    """(feature, shap_value, feature_value) for the top-n features by J4."""
    top = [r["feature"] for r in shap_global(shap_long).limit(top_n).collect()]
    vals = rows.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                          F.col(c).cast("double").alias("feature_value"))
                                                 for c in top])))
    return shap_long.where(F.col("feature").isin(top)).join(vals, [*keys, "feature"])
