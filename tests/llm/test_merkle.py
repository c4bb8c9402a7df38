"""Merkle manifest against a tree built by hand."""
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlens.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, low=False):
    out = []
    for c in merkle.FIELDS:
        v = row[c]
        if c == "text" and low and v is not None:
            v = v.encode().lower().decode()
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return _h(*out)


def _tree(leaves):
    """Root, and for each leaf its siblings level by level with its place among them."""
    path = [[] for _ in leaves]
    level, under = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        nxt, nxt_under = [], []
        for a in range(0, len(level), 8):
            run = level[a:a + 8]
            for k, own in enumerate(under[a:a + 8]):
                for i in own:
                    path[i].append((k, run[:k] + run[k + 1:]))
            nxt.append(_h(*run))
            nxt_under.append([i for own in under[a:a + 8] for i in own])
        level, under = nxt, nxt_under
    return level[0], path


def _fold(leaf, path):
    for k, others in path:
        leaf = _h(*others[:k], leaf, *others[k:])
    return leaf


def _slow(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    made = {}
    for lang in order:
        own = sorted(trees[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        root, path = _tree([_leaf(r) for r in own])
        made[lang] = (own, root, path)
    if not made:
        return []
    top, top_path = _tree([made[k][1] for k in order])
    out = []
    for lang, up in zip(order, top_path):
        own, sub, path = made[lang]
        for r, p in zip(own, path):
            steps = p + up
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            folded = _fold(_leaf(r, low=bad), steps)
            out.append((r["doc_id"], _leaf(r), sub, top, _h(*[d for _, others in steps for d in others]), folded, folded == top))
    return out


def _got(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    proofs = merkle.checked(merkle.manifest(merkle.leaves(df, tampered=tampered)).prove())
    return [(r["doc_id"], *(bytes(r[c]).hex() for c in ("digest", "subroot", "root", "proof", "folded")), r["verified"])
            for r in proofs.collect()]


def _frame(spark, sizes):
    rng = np.random.default_rng(5)
    rows = []
    for lang, n in sizes.items():
        for d in rng.choice(10_000, n, replace=False):
            rows.append((int(d), f"s{d % 5}" if d % 7 else None, lang, int(d) % 100 if d % 11 else None, f"Text of {d} É"))
    rng.shuffle(rows)
    return spark.createDataFrame([(int(r[0]), r[1], r[2], None if r[3] is None else int(r[3]), r[4]) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("sizes", [
    {"en": 1200, "de": 65, None: 9, "": 1, "fr": 8, "es": 513}, {"en": 1}, {"en": 8}, {"en": 9},
    {f"l{i}": 1 for i in range(70)}])
def test_proofs_equal_a_tree_built_by_hand(spark, sizes):
    df = _frame(spark, sizes)
    assert sorted(_got(df)) == sorted(_slow(df.collect()))


def test_odd_rows_and_empty(odd, none):
    docs, empty = (x.selectExpr("*", "length(text) AS n_chars") for x in (odd, none))
    assert Counter(map(str, _got(docs))) == Counter(map(str, _slow(docs.collect())))
    assert _got(empty) == []
    assert merkle.manifest(merkle.leaves(empty)).root() is None


def test_requests_records_and_root(spark):
    df = _frame(spark, {"en": 700, "de": 3})
    made = merkle.manifest(merkle.leaves(df))
    store = {bytes(r["digest"]): [bytes(c) for c in r["children"]] for r in made.records().collect()}
    assert all(merkle.combine(kids) == d for d, kids in store.items())

    def leaves(d):
        return [x for k in store[d] for x in leaves(k)] if d in store else [d]

    assert len(leaves(made.root())) == df.count()                    # all leaves are reached from the root
    some = made.prove(made.forest.leaves.filter("doc_id % 50 = 0")).collect()
    assert len(some) == df.filter("doc_id % 50 = 0").count()
    for r in some:
        assert merkle.fold(bytes(r["digest"]), [bytes(s) for s in r["steps"]]) == made.root()


def test_repeated_rows_spread_and_count(spark):
    df = spark.range(600).selectExpr("1L AS doc_id", "'s' AS source", "'en' AS lang", "4L AS n_chars", "'same' AS text")
    assert Counter(_got(df)) == Counter(_slow(df.collect()))
