"""Histogram gradient boosting for any number of models in the same jobs.

Features are cut into at most 256 bins once; each partition becomes one block holding its
rows' bins as bytes. A tree level is one job: every block adds up (node, feature, bin) sums
of its rows' gradients, and only the cells that hold rows come back, so what the driver
merges is bounded by nodes x features x bins a model and not by the rows. All models of a
call grow in step: folds of a stack, squared and Huber losses share each job, with the fold
as part of the model and not of the data.

Scores are not stored with every round. Blocks keep the scores of the last refresh and the
trees grown since travel with the job, so a round writes nothing; every ``REFRESH`` rounds
the scores are brought up to date, and every few refreshes the blocks go to the checkpoint
folder, which ends their lineage. A lost executor's blocks are made again from there. Rows that
fit one block (``BLOCK_ROWS``) are boosted by the same steps inside a task a model.

Row samples are a hash of the row's key, the round and the seed, hence the same however
rows are partitioned. Huber's leaf values and clipping bound come from sorted residuals of
each leaf, which a block thins to ``POINTS`` equally weighted ones: exact as long as a leaf
of a block holds no more rows, within 1 / POINTS of a rank beyond.
"""

from __future__ import annotations

import json
import pickle
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 256
BLOCK_ROWS = 50_000
REFRESH = 10                   # rounds between two refreshes of the scores
CHECKPOINT = 5                 # refreshes between two checkpoints of the blocks
POINTS = 2048
CHUNK = 16_384                 # rows whose cells are counted at a time
WIDE = 32                      # blocks whose answers the driver merges itself; more go through a tree of tasks
FAR = float(np.finfo(np.float64).max)


@dataclass(frozen=True)
class BoostSpec:
    """One model: loss ('squared' or 'huber'), rounds and the limits of its trees.

    ``l1`` and ``l2`` penalise leaf values (soft threshold of the gradient sum, addend to the
    row count). ``rows`` and ``columns`` are the shares drawn for each tree. Rows of fold
    ``skip`` are left out of the fit.
    """
    loss: str = "squared"
    rounds: int = 500
    depth: int = 4
    step: float = 0.08
    rows: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    min_rows: int = 1
    alpha: float = 0.9
    seed: int = 42
    skip: int | None = None


@dataclass
class Tree:
    """A complete binary tree: nodes 1 to 2**depth - 1 (children of i: 2i, 2i + 1), then the leaves.

    ``feature`` counts from 0; rows with x <= cut go left. A node that was not split sends all
    rows left (cut ``FAR``). ``cover`` has the fitted rows at every node and leaf.
    """
    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray


@dataclass
class BoostFit:
    spec: BoostSpec
    init: float
    trees: list
    feats: list

    @property
    def step(self) -> float:
        return self.spec.step

    def arrays(self):
        """feature, cut and value of all trees, stacked."""
        if not self.trees:
            return np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1))
        return tuple(np.stack([getattr(t, k) for t in self.trees]) for k in ("feature", "cut", "value"))

    def transform(self, df: DataFrame, out: str = "log_pred") -> DataFrame:
        """Scores by Arrow batches: each tree level is one comparison of whole columns."""
        shared = df.sparkSession.sparkContext.broadcast((self.init, self.step, *self.arrays()))   # the model

        @F.pandas_udf("double")
        def score(x: pd.DataFrame) -> pd.Series:
            init, step, f, c, v = shared.value
            return pd.Series(init + step * ensemble(x.to_numpy(dtype=float), f, c, v))

        return df.withColumn(out, score(F.struct(*[F.col(c).cast("double").alias(c) for c in self.feats])))

    def score(self, x: dict):
        """The score as one Spark expression whose size does not grow with the trees: a fold over them,
        each walked by halving (node i's children: 2i, 2i + 1)."""
        trees = F.from_json(F.lit(json.dumps([{"f": (t.feature + 1).tolist(), "c": t.cut.tolist(), "v": t.value.tolist()}
                                              for t in self.trees])),
                            "array<struct<f:array<int>,c:array<double>,v:array<double>>>")
        deep = self.spec.depth

        def one(xs, tree):
            node = F.aggregate(F.sequence(F.lit(1), F.lit(deep)), F.lit(1), lambda n, _: 2 * n + F.when(
                F.element_at(xs, F.element_at(tree["f"], n)) <= F.element_at(tree["c"], n), 0).otherwise(1))
            return F.element_at(tree["v"], node - (2**deep - 1))

        def fold(xs):
            return F.aggregate(trees, F.lit(float(self.init)), lambda acc, tree: acc + F.lit(float(self.step)) * one(xs, tree))

        # a one-element transform, so the features are worked out once
        return F.get(F.transform(F.array(F.array(*[x[c].cast("double") for c in self.feats])), fold), F.lit(0))

    def nodes(self) -> tuple[list, list]:
        """Per tree the arrays (feature, threshold, left, right, value, cover) by node, and the weights."""
        out = []
        for t in self.trees:
            inner, leaves = len(t.feature), len(t.value)
            i = np.arange(inner)
            split = t.cut < FAR
            # a node without a split shows as a leaf with the value that all rows below it get
            value = np.concatenate([np.zeros(inner), t.value])
            for n in range(inner - 1, -1, -1):
                if not split[n]:
                    value[n] = value[2 * n + 1]
            reached = np.arange(inner + leaves) == 0                # what is below such a node has no rows of its own
            for n in np.flatnonzero(split):
                reached[2 * n + 1] = reached[2 * n + 2] = reached[n]
            none = np.full(leaves, -1)
            out.append({"feature": np.concatenate([np.where(split, t.feature, -1), none]),
                        "threshold": np.concatenate([np.where(split, t.cut, 0.0), np.zeros(leaves)]),
                        "left": np.concatenate([np.where(split, 2 * i + 1, -1), none]),
                        "right": np.concatenate([np.where(split, 2 * i + 2, -1), none]),
                        "value": value, "cover": np.where(reached, t.cover, 0.0)})
        return out, [self.step] * len(self.trees)

    def importance(self) -> np.ndarray:
        """Share of the trees' total gain that each feature's splits gave."""
        total = np.zeros(len(self.feats))
        for t in self.trees:
            np.add.at(total, t.feature, t.gain)
        return total / total.sum() if total.sum() else total


def ensemble(x: np.ndarray, f: np.ndarray, c: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Sum of the trees' values for each row of ``x``."""
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for ft, ct, vt in zip(f, c, v):
        node = np.zeros(len(x), dtype=np.int64)
        while node.size and node[0] < len(ft):                  # all rows are at the same level
            node = 2 * node + 1 + ~(x[rows, ft[node]] <= ct[node])
        total += vt[node - len(ft)]
    return total


# ----------------------------------------------------------------------------------
# Blocks
# ----------------------------------------------------------------------------------
def cut_points(df: DataFrame, feats, bins: int = BINS, finer: int = 4) -> list[np.ndarray]:
    """At most bins - 1 cuts a feature: midpoints between neighbouring values where there are few, and
    between quantile values otherwise. Values held by less than 1 / (bins * finer) of the rows may share a bin."""
    # one literal for all features: an array of thousands of literals each would be slow to plan
    at = F.from_json(F.lit(json.dumps([(k + 0.5) / (bins * finer) for k in range(bins * finer)])), "array<double>")
    found = df.agg(*[F.array_distinct(F.concat(F.array(F.min(x)), F.percentile_approx(x, at, 4 * bins * finer), F.array(F.max(x))))
                     for x in (F.col(c).cast("double") for c in feats)]).first()
    out = []
    for some in found:
        values = np.unique(np.array([v for v in some or [] if v is not None and np.isfinite(v)], dtype=float))
        if len(values) > bins:
            values = values[np.linspace(0, len(values) - 1, bins).astype(int)]
        out.append(values[:-1] + (values[1:] - values[:-1]) / 2)
    return out


def _mix(ids: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row keys and a salt (splitmix64)."""
    with np.errstate(over="ignore"):
        z = ids + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(2**53)


def sampled(ids: np.ndarray, share: float, seed: int, round_: int) -> np.ndarray:
    """Which rows a round's tree is fitted on."""
    return np.ones(len(ids), bool) if share >= 1 else _mix(ids, seed * 100_003 + round_) < share


def drawn(spec: BoostSpec, round_: int, p: int) -> np.ndarray:
    """Which features a round's tree may split."""
    if spec.columns >= 1:
        return np.arange(p)
    rng = np.random.default_rng([spec.seed, round_])
    return np.sort(rng.choice(p, max(1, int(spec.columns * p)), replace=False))


def blocks_of(df: DataFrame, feats, label: str, cuts, fold_col: str | None, key_cols, block_rows: int):
    """RDD of (bins, y, fold, ids): one block a partition, of about ``block_rows`` rows at most."""
    spark = df.sparkSession
    rows = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(feats)],
                     F.col(label).cast("double").alias("y"),
                     (F.col(fold_col) if fold_col else F.lit(-1)).cast("int").alias("fold"),
                     F.xxhash64(*key_cols).alias("id")).checkpoint(eager=True)
    parts = max(1, -(-rows.count() // block_rows))
    shared = spark.sparkContext.broadcast(cuts)                 # 255 numbers a feature

    def pack(batches):
        bins, rest = [], []
        for pdf in batches:
            if len(pdf):
                x = pdf.iloc[:, :len(shared.value)].to_numpy(dtype=float)
                bins.append(np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(shared.value)])
                            .astype(np.uint8) if shared.value else np.zeros((0, len(pdf)), np.uint8))
                rest.append(pdf[["y", "fold", "id"]])
        if rest:
            rest = pd.concat(rest)
            block = (np.concatenate(bins, axis=1), rest["y"].to_numpy(float), rest["fold"].to_numpy(np.int32),
                     rest["id"].to_numpy(np.int64).view(np.uint64))
            yield pd.DataFrame({"block": [pickle.dumps(block, 5)]})

    return (rows.repartition(parts, "id").mapInPandas(pack, "block binary").rdd
            .map(lambda r: pickle.loads(bytes(r[0]))))


def _route(bins: np.ndarray, feature: np.ndarray, cut_bin: np.ndarray, levels: int) -> np.ndarray:
    """Place of each row among the nodes ``levels`` below the root (bins compare like the values do)."""
    node = np.zeros(bins.shape[1], dtype=np.int64)
    rows = np.arange(bins.shape[1])
    for _ in range(levels):
        node = 2 * node + 1 + (bins[feature[node], rows] > cut_bin[node])
    return node - (2**levels - 1)


def _scores(block, grown: list, steps: list) -> np.ndarray:
    """Scores after the trees grown since the last refresh: for each model its list of (feature, bin, value)."""
    out = block[4].copy()
    for m, trees in enumerate(grown):
        for feature, cut_bin, value in trees:
            depth = len(value).bit_length() - 1
            out[m] += steps[m] * value[_route(block[0], feature, cut_bin, depth)]
    return out


def _gather(rdd, fn, merge, parts: int):
    """fn of every block, merged; by the driver for few blocks, by a tree of tasks for many."""
    made = rdd.map(fn)
    if parts <= WIDE:
        out = None
        for x in made.collect():
            out = x if out is None else merge(out, x)
        return out
    return made.treeReduce(merge, depth=max(2, int(np.ceil(np.log(parts) / np.log(WIDE)))))


# ----------------------------------------------------------------------------------
# What a block sends
# ----------------------------------------------------------------------------------
def _cells(bins, node, g, columns, nodes: int):
    """Non-empty (node, feature, bin) cells: place, gradient sum, rows."""
    size = nodes * len(columns) * BINS
    s, n = np.zeros(size), np.zeros(size)
    base = (np.arange(len(columns)) * BINS)[:, None]
    for a in range(0, len(node), CHUNK):
        b = slice(a, a + CHUNK)
        at = (node[b] * (len(columns) * BINS) + base + bins[columns][:, b]).ravel()
        s += np.bincount(at, weights=np.tile(g[b], len(columns)), minlength=size)
        n += np.bincount(at, minlength=size)
    held = np.flatnonzero(n)
    return held, s[held], n[held]


def _merge_cells(a: list, b: list) -> list:
    out = []
    for (ia, sa, na), (ib, sb, nb) in zip(a, b):
        held, where = np.unique(np.concatenate([ia, ib]), return_inverse=True)
        out.append((held, np.bincount(where, np.concatenate([sa, sb]), len(held)),
                    np.bincount(where, np.concatenate([na, nb]), len(held))))
    return out


def thin(values: np.ndarray, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and their weights, at most ``points`` of them."""
    values = np.sort(values)
    if len(values) <= points:
        return values, np.ones(len(values))
    ends = np.linspace(0, len(values), points + 1).astype(np.int64)
    return values[(ends[:-1] + ends[1:] - 1) // 2], np.diff(ends).astype(float)


def weighted_quantile(values: np.ndarray, weights: np.ndarray, q: float) -> float:
    """Linear interpolation between ranks, each value standing for ``weight`` equal ones."""
    if not len(values):
        return 0.0
    order = np.argsort(values, kind="stable")
    values, upto = values[order], np.cumsum(weights[order])
    place = q * (upto[-1] - 1)
    low = np.floor(place)
    a = values[min(np.searchsorted(upto, low, side="right"), len(values) - 1)]
    b = values[min(np.searchsorted(upto, low + 1, side="right"), len(values) - 1)]
    return float(a + (b - a) * (place - low))


def _merge_points(a: list, b: list) -> list:
    return [{k: tuple(tuple(np.concatenate(z) for z in zip(x, y)) for x, y in zip(pa.get(k, _NONE), pb.get(k, _NONE)))
             for k in {*pa, *pb}} for pa, pb in zip(a, b)]


_NONE = ((np.zeros(0), np.zeros(0)), (np.zeros(0), np.zeros(0)))


# ----------------------------------------------------------------------------------
# Growing
# ----------------------------------------------------------------------------------
def soft(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def best_splits(held: np.ndarray, s: np.ndarray, n: np.ndarray, columns: int, spec: BoostSpec) -> dict:
    """node -> (feature place, bin, gain, gradient sum and rows on the left) of its best split, where one gains.

    ``held`` are the places of non-empty (node, feature, bin) cells in order; everything is done on those.
    """
    if not len(held):
        return {}
    group = held // BINS                                        # (node, feature)
    last = np.append(np.flatnonzero(np.diff(group)), len(held) - 1)
    size = np.diff(np.append(-1, last))
    cs, cn = np.cumsum(s), np.cumsum(n)
    end_s, end_n = cs[last], cn[last]
    begin_s, begin_n = np.append(0.0, end_s[:-1]), np.append(0.0, end_n[:-1])
    left, rows = cs - np.repeat(begin_s, size), cn - np.repeat(begin_n, size)
    all_s, all_n = end_s - begin_s, end_n - begin_n
    right, rest = np.repeat(all_s, size) - left, np.repeat(all_n, size) - rows

    def worth(g, k):
        return soft(g, spec.l1) ** 2 / np.maximum(k + spec.l2, 1e-300)

    least = max(1, spec.min_rows)
    gain = np.where((rows >= least) & (rest >= least),
                    worth(left, rows) + worth(right, rest) - np.repeat(worth(all_s, all_n), size), 0.0)
    node = held // (BINS * columns)
    first = np.append(0, np.flatnonzero(np.diff(node)) + 1)
    top = np.maximum.reduceat(gain, first)
    out = {}
    for a, b, g in zip(first, np.append(first[1:], len(held)), top):
        if g > 1e-10:
            i = a + int(np.argmax(gain[a:b] >= g * (1 - 1e-9)))          # the first of equal ones, whatever the sums' last bits
            out[int(node[i])] = (int(group[i] % columns), int(held[i] % BINS), float(g), float(left[i]), float(rows[i]))
    return out


class _Growing:
    """A model while it grows: its state on the driver."""

    def __init__(self, spec: BoostSpec, init: float, delta: float):
        self.spec, self.init, self.delta, self.trees = spec, init, delta, []
        self.drawing = (spec.rows, spec.seed, spec.skip)

    def begin(self, p: int, round_: int):
        inner = 2**self.spec.depth - 1
        self.columns = drawn(self.spec, round_, p)
        self.feature, self.bin = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        self.gain, self.cover = np.zeros(inner), np.zeros(2 * inner + 1)
        self.sums = np.zeros(2 * inner + 1)                     # of gradients, at every node
        self.live = np.ones(1, bool)

    def split(self, level: int, held, s, n):
        nodes, k = 2**level, len(self.columns)
        first = nodes - 1
        if level == 0:
            one = held // BINS == (held[0] // BINS if len(held) else 0)           # any feature has all rows
            self.sums[0], self.cover[0] = s[one].sum(), n[one].sum()
        best = best_splits(held, s, n, k, self.spec)
        live = np.zeros(2 * nodes, bool)
        for j in range(nodes):
            i = first + j
            self.sums[2 * i + 1], self.cover[2 * i + 1] = self.sums[i], self.cover[i]      # unsplit: all rows left
            if self.live[j] and j in best:
                place, cut_bin, self.gain[i], gl, nl = best[j]
                self.feature[i], self.bin[i] = self.columns[place], cut_bin
                self.sums[2 * i + 1], self.cover[2 * i + 1] = gl, nl
                self.sums[2 * i + 2], self.cover[2 * i + 2] = self.sums[i] - gl, self.cover[i] - nl
                live[2 * j] = live[2 * j + 1] = True
        self.live = live

    def finish(self, cuts, points: dict | None):
        leaves = 2**self.spec.depth
        value = np.zeros(leaves)
        if self.spec.loss == "squared":
            g, n = self.sums[leaves - 1:], self.cover[leaves - 1:]
            value = np.where(n > 0, soft(g, self.spec.l1) / np.maximum(n + self.spec.l2, 1e-300), 0.0)
        else:
            left, weight = [], []
            for leaf, (own, other) in (points or {}).items():
                if len(own[0]):
                    med = weighted_quantile(*own, 0.5)
                    off = own[0] - med
                    value[leaf] = med + np.average(np.sign(off) * np.minimum(np.abs(off), self.delta), weights=own[1])
                for v, w in (own, other):
                    left.append(np.abs(v - self.spec.step * value[leaf]))
                    weight.append(w)
            if left:
                self.delta = weighted_quantile(np.concatenate(left), np.concatenate(weight), self.spec.alpha)
        cut = np.array([cuts[f][b] if b < BINS else FAR for f, b in zip(self.feature, self.bin)])
        self.trees.append(Tree(self.feature, self.bin, cut, value, self.cover, self.gain))


class _Here:
    """One block in the task that holds it."""

    refresh = 1

    def __init__(self, block):
        self.block = block

    def ask(self, fn, merge):
        return fn(self.block)

    def change(self, fn):
        self.block = fn(self.block)

    def close(self):
        pass


class _Spread:
    """Blocks of an RDD; every question is a job, every change a new generation of cached blocks."""

    refresh = REFRESH

    def __init__(self, blocks):
        self.parts, self.changes = blocks.getNumPartitions(), 0
        self.now = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.before = []

    def ask(self, fn, merge):
        return _gather(self.now, fn, merge, self.parts)

    def change(self, fn):
        self.before.append(self.now)
        self.now = self.now.map(fn).persist(StorageLevel.MEMORY_AND_DISK)
        self.changes += 1
        if self.changes % CHECKPOINT == 0:
            self.now.checkpoint()                               # reliable storage: ends the lineage
            self.now.count()
        if len(self.before) > 2:                                # its successor has been read by now
            self.before.pop(0).unpersist()

    def close(self):
        for x in (*self.before, self.now):
            x.unpersist()


def grow(rows, specs: list, cuts: list) -> list[tuple]:
    """(init, trees) of every model. ``rows`` answers questions about all blocks, wherever they are."""
    p = len(cuts)
    skips, huber, steps = [s.skip for s in specs], [s.loss == "huber" for s in specs], [s.step for s in specs]

    def first(block):
        own = [np.ones(len(block[1]), bool) if k is None else block[2] != k for k in skips]
        return [(block[1][w].sum(), float(w.sum()), {0: (thin(block[1][w]), _NONE[0])}) for w in own]

    models = []
    found = rows.ask(first, lambda a, b: [(x[0] + y[0], x[1] + y[1], _merge_points([x[2]], [y[2]])[0]) for x, y in zip(a, b)])
    for spec, (total, n, points) in zip(specs, found):
        values, weights = points[0][0]
        init = weighted_quantile(values, weights, 0.5) if spec.loss == "huber" else float(total / max(n, 1.0))
        models.append(_Growing(spec, init, weighted_quantile(np.abs(values - init), weights, spec.alpha)))
    inits = np.array([m.init for m in models])
    rows.change(lambda b: (*b[:4], np.repeat(inits[:, None], len(b[1]), axis=1)))
    grown = [[] for _ in models]
    for r in range(max((s.rounds for s in specs), default=0)):
        active = [m for m, s in enumerate(specs) if r < s.rounds]
        for m in active:
            models[m].begin(p, r)
        for level in range(max(specs[m].depth for m in active)):
            at = [m for m in active if level < specs[m].depth]
            asked = [(m, models[m].drawing, models[m].columns, models[m].feature, models[m].bin, models[m].live,
                      models[m].delta if huber[m] else None) for m in at]

            def level_cells(block, asked=asked, level=level, r=r):
                scores, out = _scores(block, grown, steps), []
                for m, (share, seed, skip), columns, feature, cut_bin, live, delta in asked:
                    use = sampled(block[3], share, seed, r)
                    if skip is not None:
                        use &= block[2] != skip
                    node = _route(block[0], feature, cut_bin, level)
                    use = np.flatnonzero(use & live[node])
                    g = (block[1] - scores[m])[use]
                    if delta is not None:
                        g = np.clip(g, -delta, delta)
                    out.append(_cells(block[0][:, use], node[use], g, columns, 2**level))
                return out

            for m, cells in zip(at, rows.ask(level_cells, _merge_cells)):
                models[m].split(level, *cells)
        points = dict.fromkeys(active)
        if at := [m for m in active if huber[m]]:
            asked = [(m, models[m].drawing, models[m].feature, models[m].bin, specs[m].depth) for m in at]

            def leaf_points(block, asked=asked, r=r):
                scores, out = _scores(block, grown, steps), []
                for m, (share, seed, skip), feature, cut_bin, depth in asked:
                    fitted = block[2] != skip if skip is not None else np.ones(len(block[1]), bool)
                    own = sampled(block[3], share, seed, r)
                    leaf = _route(block[0], feature, cut_bin, depth)
                    rest = block[1] - scores[m]
                    out.append({int(k): (thin(rest[fitted & own & (leaf == k)]), thin(rest[fitted & ~own & (leaf == k)]))
                                for k in np.unique(leaf[fitted])})
                return out

            points.update(zip(at, rows.ask(leaf_points, _merge_points)))
        for m in active:
            models[m].finish(cuts, points[m])
            t = models[m].trees[-1]
            grown[m].append((t.feature, t.bin, t.value))
        if (r + 1) % rows.refresh == 0:
            done, grown = grown, [[] for _ in models]
            rows.change(lambda b, done=done: (*b[:4], _scores(b, done, steps)))
    rows.close()
    return [(float(m.init), m.trees) for m in models]


def fit_boosters(df: DataFrame, feats, specs: list, label: str = "label", fold_col: str | None = None,
                 key_cols=("series", "week"), bins: int = BINS, block_rows: int = BLOCK_ROWS) -> list[BoostFit]:
    """Fit all ``specs`` in step; one job a tree level, and one a round for Huber leaves.

    Rows of a single block need no jobs: the same steps run in one task a model, each with the
    block, which saves the latency of thousands of jobs and gives the same trees. ``key_cols``
    identify a row; absent ones are left out, and without any the features and the label are the key.
    """
    feats = list(feats)
    cuts = cut_points(df, feats, bins)
    keys = [c for c in key_cols if c in df.columns] or [*feats, label]
    blocks = blocks_of(df, feats, label, cuts, fold_col, keys, block_rows)
    if blocks.getNumPartitions() == 1:                          # a task a model, each with the block
        dealt = blocks.flatMap(lambda b: [(m, b) for m in range(len(specs))]).partitionBy(len(specs), lambda m: m)
        made = dict(dealt.map(lambda x: (x[0], grow(_Here(x[1]), [specs[x[0]]], cuts)[0])).collect())     # the models
        made = [made[m] for m in sorted(made)]
    else:
        made = grow(_Spread(blocks), specs, cuts)
    if not made:
        raise ValueError("no rows to fit")
    return [BoostFit(s, init, trees, feats) for s, (init, trees) in zip(specs, made)]


def folds(spec: BoostSpec, k: int) -> list[BoostSpec]:
    """The model without each fold in turn, then on all rows."""
    return [replace(spec, skip=i) for i in range(k)] + [spec]


__all__ = ["BoostSpec", "BoostFit", "Tree", "fit_boosters", "folds", "cut_points"]
