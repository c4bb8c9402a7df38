"""Histogram boosting against a plain single-machine version, in one block and in many."""
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlens.operators import boost as B
from mixlens.operators import models as M


def _rows(n=300, p=5, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)), 1)
    x[:, 3] = 7.0                                                   # nothing to split
    y = 2 * x[:, 0] + x[:, 1] ** 2 + rng.normal(size=n) + 30 * (rng.random(n) < 0.03)
    return x, y


@pytest.fixture(scope="module")
def frame(spark):
    x, y = _rows()
    cols = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(v), i, i % 5) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", label double, week int, fold int").checkpoint()
    ids = np.array([r[0] for r in df.orderBy("week").select(F.xxhash64("week")).collect()], dtype=np.int64).view(np.uint64)
    return df, x, y, cols, ids


class _Plain:
    """The same boosting with rows in one array and splits tried one by one at midpoints of values."""

    def __init__(self, spec, x, y, ids, own):
        self.spec, self.trees = spec, []
        self.init = np.median(y[own]) if spec.loss == "huber" else y[own].mean()
        f = np.full(len(y), self.init)
        for r in range(spec.rounds):
            cols = B.drawn(spec, r, x.shape[1])
            use = own & B.sampled(ids, spec.rows, spec.seed, r)
            rest = y - f
            delta = np.quantile(np.abs(rest[own]), spec.alpha)
            g = np.clip(rest, -delta, delta) if spec.loss == "huber" else rest
            tree = self._tree(x, g, rest, np.flatnonzero(use), cols, spec.depth, delta)
            self.trees.append(tree)
            f = f + spec.step * np.array([self._value(tree, row) for row in x])
        self.fitted = f

    def _soft(self, g):
        return np.sign(g) * max(abs(g) - self.spec.l1, 0)

    def _worth(self, g):
        return self._soft(g.sum()) ** 2 / (len(g) + self.spec.l2)

    def _tree(self, x, g, rest, at, cols, depth, delta):
        best = (1e-10, None)
        if depth:
            for c in cols:
                values = np.unique(x[:, c])
                for cut in values[:-1] + (values[1:] - values[:-1]) / 2:
                    left = x[at, c] <= cut
                    if min(left.sum(), (~left).sum()) >= max(1, self.spec.min_rows):
                        gain = self._worth(g[at[left]]) + self._worth(g[at[~left]]) - self._worth(g[at])
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, (c, cut))
        if best[1] is None:
            if self.spec.loss == "squared":
                return self._soft(g[at].sum()) / (len(at) + self.spec.l2)
            med = np.median(rest[at])
            off = rest[at] - med
            return med + (np.sign(off) * np.minimum(np.abs(off), delta)).mean()
        c, cut = best[1]
        left = x[at, c] <= cut
        return (c, cut, self._tree(x, g, rest, at[left], cols, depth - 1, delta), self._tree(x, g, rest, at[~left], cols, depth - 1, delta))

    def _value(self, tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree


SPECS = [B.BoostSpec("huber", 12, 3, 0.3, rows=0.9, min_rows=2), B.BoostSpec("squared", 12, 3, 0.3, rows=0.8, columns=0.8, l1=0.5, l2=1.0),
         B.BoostSpec("squared", 1, 1, 1.0), B.BoostSpec("huber", 5, 4, 0.5, alpha=0.8)]


@pytest.mark.parametrize("block_rows", [50_000, 70])
def test_equals_plain_boosting(frame, block_rows):
    df, x, y, cols, ids = frame
    fits = B.fit_boosters(df, cols, SPECS, fold_col="fold", block_rows=block_rows)
    for spec, fit in zip(SPECS, fits):
        plain = _Plain(spec, x, y, ids, np.ones(len(y), bool))
        got = [r["p"] for r in fit.transform(df, "p").orderBy("week").collect()]
        assert abs(fit.init - plain.init) < 1e-12
        assert np.allclose(got, plain.fitted, atol=1e-9)


def test_folds_equal_fits_without_their_rows(frame):
    df, x, y, cols, ids = frame
    spec = replace(SPECS[0], rounds=4)
    fits = B.fit_boosters(df, cols, B.folds(spec, 5), fold_col="fold")
    for k, fit in enumerate(fits):
        plain = _Plain(spec, x, y, ids, np.arange(len(y)) % 5 != k)
        got = [r["p"] for r in fit.transform(df, "p").orderBy("week").collect()]
        assert np.allclose(got, plain.fitted, atol=1e-9)


def test_many_blocks_with_refreshes_and_checkpoints(frame, monkeypatch):
    df, *_, cols, _ = frame
    specs = [replace(SPECS[0], rounds=7, depth=2), replace(SPECS[1], rounds=5, depth=2)]
    one = B.fit_boosters(df, cols, specs)
    monkeypatch.setattr(B._Spread, "refresh", 2)
    monkeypatch.setattr(B, "CHECKPOINT", 2)
    monkeypatch.setattr(B, "WIDE", 2)                               # answers meet in tasks
    many = B.fit_boosters(df, cols, specs, block_rows=60)
    for a, b in zip(one, many):
        assert len(a.trees) == len(b.trees)
        for s, t in zip(a.trees, b.trees):
            assert (s.feature == t.feature).all() and (s.bin == t.bin).all()
            assert np.allclose(s.value, t.value, atol=1e-12) and np.allclose(s.cover, t.cover)


def test_out_of_fold_scores_and_stack(frame, spark):
    df, x, y, cols, ids = frame
    fit = M.fit_stack(df, cols, k=5, rounds=3)
    weeks = np.arange(len(y))
    fold = np.repeat(np.arange(5), 60)
    oof = {}
    for name, spec in (("huber", M.huber_spec(rounds=3)), ("gbt", M.gbt_spec(rounds=3))):
        oof[name] = np.zeros(len(y))
        for k in range(5):
            oof[name][fold == k] = _Plain(spec, x, y, ids, fold != k).fitted[fold == k]
    oof["ridge"] = np.zeros(len(y))
    for k in range(5):
        r = M.fit_ridge(df.where(~F.col("week").between(60 * k, 60 * k + 59)), cols)
        oof["ridge"][fold == k] = [v["p"] for v in r.transform(df, "p").orderBy("week").collect()[60 * k:60 * k + 60]]
    z = np.column_stack([oof[n] for n in ("huber", "gbt", "ridge")])
    centred = z - z.mean(0)
    coef = np.linalg.solve(centred.T @ centred + fit.meta.alpha * np.eye(3), centred.T @ (y - y.mean()))
    assert np.allclose(fit.meta.coef, coef, atol=1e-8)
    assert weeks.size == 300


def test_thinned_points_keep_ranks():
    rng = np.random.default_rng(1)
    values = rng.lognormal(size=100_000)
    points, weights = B.thin(values, 1000)
    assert len(points) == 1000 and weights.sum() == len(values)
    for q in (0.01, 0.5, 0.9, 0.999):
        assert abs((values <= B.weighted_quantile(points, weights, q)).mean() - q) < 0.0015
    few = rng.normal(size=17)
    for q in (0.0, 0.3, 0.5, 1.0):
        assert abs(B.weighted_quantile(*B.thin(few), q) - np.quantile(few, q)) < 1e-12


def test_no_rows_and_nulls(spark):
    empty = spark.createDataFrame([], "a double, label double, week int")
    with pytest.raises(ValueError):
        B.fit_boosters(empty, ["a"], [B.BoostSpec(rounds=1)])
    flat = spark.createDataFrame([(1.0, 2.0, i) for i in range(6)], "a double, label double, week int")
    fit = B.fit_boosters(flat, ["a"], [B.BoostSpec(rounds=2)])[0]
    assert {r["p"] for r in fit.transform(flat, "p").collect()} == {2.0}
    assert all((t.cut == B.FAR).all() for t in fit.trees)
