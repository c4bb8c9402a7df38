"""Sinks and re-reads (A2-A6): tables as Parquet (partitioned) or CSV, fitted models
and their feature list / caps beside them."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TREE = ("feature", "bin", "cut", "value", "cover", "gain")


# rows that one task sorts and writes into a partitioned table
TASK_ROWS = 500_000


def _dealt(df: DataFrame, keys, task_rows: int) -> DataFrame:
    """Rows of a table to be partitioned by ``keys``, dealt to its tasks: a small table by the keys, a larger one in even
    ranges of the keys and a random number, so a key with many rows is read by many tasks, each with few keys."""
    n = -(-df.count() // task_rows)
    if n <= 1:
        return df.hint("rebalance", *keys)
    return df.withColumn("_deal", F.rand(7)).repartitionByRange(n, *keys, "_deal").drop("_deal")


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite",
               task_rows: int = TASK_ROWS):
    """A3/A4/A5: write a table; Parquet by default (partitioned when asked), CSV with a
    header and ISO dates otherwise. Rows of a partitioned table are first dealt by its
    keys, ``task_rows`` to a task: a folder gets a few files of even size, not one from every task."""
    w = (_dealt(df, partition_by, task_rows) if partition_by else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        w.format(fmt).save(path)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A2: read a saved table back; CSV needs the schema so types survive the text hop."""
    r = spark.read
    if fmt == "csv":
        r = r.option("header", True).option("dateFormat", "yyyy-MM-dd")
        if schema is not None:
            r = r.schema(schema)
        return r.csv(path)
    return r.format(fmt).load(path)


def save_fit(spark: SparkSession, fit, path: str, feats, caps: dict):
    """Persist a fitted model of any of the six kinds, with its feature list and caps."""
    _write_row(spark, f"{path}/fit", {"feats": list(feats), "caps": {k: float(v) for k, v in caps.items()}})
    _save_part(spark, fit, f"{path}/model")


def load_fit(spark: SparkSession, path: str):
    """Load a model saved by :func:`save_fit`; returns (fit, feats, caps)."""
    top = _read_row(spark, f"{path}/fit")
    return _load_part(spark, f"{path}/model"), top["feats"], top["caps"]


def _write_row(spark: SparkSession, path: str, values: dict) -> None:
    spark.createDataFrame([(json.dumps(values),)], "meta string").coalesce(1).write.mode("overwrite").parquet(path)


def _read_row(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["meta"])


def _save_part(spark: SparkSession, fit, path: str) -> None:
    """One model and, below it, the models it is made of. An unknown kind raises."""
    kind = type(fit).__name__
    meta = {"kind": kind}
    if kind == "RidgeFit":
        rows = [(f, float(m), float(s), float(c)) for f, m, s, c in zip(fit.feats, fit.mean, fit.scale, fit.coef)]
        spark.createDataFrame(rows, "feature string, mean double, scale double, coef double") \
             .coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
        meta.update(feats=list(fit.feats), intercept=float(fit.intercept), alpha=float(fit.alpha))
    elif kind == "SparkFit":
        fit.model.write().overwrite().save(f"{path}/spark")
        meta.update(feats=list(fit.feats), model_class=f"{type(fit.model).__module__}.{type(fit.model).__name__}")
    elif kind == "BoostFit":
        rows = [(i, *[getattr(t, k).tolist() for k in _TREE]) for i, t in enumerate(fit.trees)]
        (spark.createDataFrame(rows, "tree int, feature array<int>, bin array<int>, cut array<double>, "
                                     "value array<double>, cover array<double>, gain array<double>")
              .coalesce(1).write.mode("overwrite").parquet(f"{path}/trees"))
        meta.update(feats=list(fit.feats), init=fit.init, spec=asdict(fit.spec))
    elif kind == "ARXFit":
        fit.table.write.mode("overwrite").parquet(f"{path}/series")
        meta.update(base=list(fit.base), lo=fit.lo, hi=fit.hi)
    elif kind == "StackFit":
        for name, base in fit.bases.items():
            _save_part(spark, base, f"{path}/bases/{name}")
        _save_part(spark, fit.meta, f"{path}/combiner")
        meta.update(bases=list(fit.bases))
    else:
        raise TypeError(f"cannot save a fit of kind {kind}")
    _write_row(spark, f"{path}/meta", meta)


def _load_part(spark: SparkSession, path: str):
    import importlib

    import numpy as np

    from ..operators.boost import BoostFit, BoostSpec, Tree
    from ..operators.models import ARXFit, RidgeFit, SparkFit, StackFit
    meta = _read_row(spark, f"{path}/meta")
    kind = meta["kind"]
    if kind == "RidgeFit":
        c = spark.read.parquet(f"{path}/coefficients").toPandas().set_index("feature").loc[meta["feats"]]
        return RidgeFit(meta["feats"], c["mean"].to_numpy(), c["scale"].to_numpy(), c["coef"].to_numpy(),
                        meta["intercept"], meta["alpha"])
    if kind == "SparkFit":
        mod, cls = meta["model_class"].rsplit(".", 1)
        return SparkFit(getattr(importlib.import_module(mod), cls).load(f"{path}/spark"), meta["feats"])
    if kind == "BoostFit":
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()          # the model
        trees = [Tree(*[np.array(r[k]) for k in _TREE]) for r in rows]
        return BoostFit(BoostSpec(**meta["spec"]), meta["init"], trees, meta["feats"])
    if kind == "ARXFit":
        return ARXFit(spark.read.parquet(f"{path}/series"), meta["base"], meta["lo"], meta["hi"])
    if kind == "StackFit":
        return StackFit({n: _load_part(spark, f"{path}/bases/{n}") for n in meta["bases"]},
                        _load_part(spark, f"{path}/combiner"))
    raise TypeError(f"unknown fit kind {kind}")


__all__ = ["save_table", "load_table", "save_fit", "load_fit", "save_table_set"]


def save_table_set(tables: dict, root: str, fmt: str = "parquet") -> dict:
    """A3/A4: write a set of tables under ``root`` (row-level partitioned by year when
    it has the column) and return {name: path}."""
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        part = ["year"] if ("year" in df.columns and name == "row_level") else None
        save_table(df, path, fmt=fmt, partition_by=part)
        paths[name] = path
    return paths
