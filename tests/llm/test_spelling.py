"""Spelling variants against brute force."""
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mixlens.llm import spelling


def _lower(t):
    return t.encode().lower().decode()


def _slow_counts(rows, every=31, shortest=7):
    n = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = _lower(w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= shortest:
                n[w] += 1
    return n


def _one_error(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _slow(n, least=2, ratio=10):
    words = {w: c for w, c in n.items() if c >= least}
    near = {w: [x for x in words if _one_error(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def _got(df):
    rows = df.collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.fixture(scope="module")
def texts(spark):
    """Words of few letters, so that many are near, with counts over several powers of ten."""
    rng = np.random.default_rng(11)
    stems = ["".join(rng.choice(list("abé"), rng.integers(7, 10))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    words = []
    for s in stems:
        words += [s] * int(10 ** rng.uniform(0, 2.3))
        for _ in range(4):
            i, kind = int(rng.integers(len(s))), rng.integers(3)
            letter = rng.choice(list("abéz"))
            words += [s[:i] + (letter if kind else "") + s[i + (kind < 2):]] * int(rng.integers(1, 6))
    rng.shuffle(words)
    rows = [(int(i), " ".join(words[i::40]).upper() if i % 3 else ", ".join(words[i::40])) for i in range(40)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block", [20_000, 7])
def test_variants_equal_brute_force(texts, block):
    rows, df = texts
    assert _got(spelling.variants(df, block=block)) == _slow(_slow_counts(rows))


def test_no_hash_and_other_limits(texts):
    rows, df = texts
    got = _got(spelling.variants(df, every=None, least=1, ratio=2))
    assert got == _slow(_slow_counts(rows, every=None), least=1, ratio=2)
    assert any(f is not None and f != r for _, f, r, *_ in got)            # a chain of two forms


def test_index_tracks_one_error():
    rng = np.random.default_rng(2)
    for short in (1, 3, 6):
        words = sorted({"".join(rng.choice(list("ab"), int(n))) for n in rng.integers(short, short + 2, 200)})
        index = spelling.Index(words, short)
        for w in words:
            bits = index.near(w)
            found = {x for i, x in enumerate(words) if bits >> i & 1}
            assert found == {x for x in words if _one_error(w, x) and len(w) + len(x) <= 2 * short + 1}


def test_odd_rows_and_empty(odd, none, spark):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert _got(spelling.variants(odd)) == _slow(_slow_counts(rows))
    assert spelling.variants(none).count() == 0
    assert spelling.variants(none).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    long = "x" * 30_000
    one = spark.createDataFrame([(1, long), (2, long + "y"), (3, long), (4, long + "y")], "doc_id long, text string")
    assert _got(spelling.variants(one, every=None)) == {(long, None, long, 2, 1, None), (long + "y", None, long + "y", 2, 1, None)}


def test_counts_in_small_batches(texts, monkeypatch):
    rows, df = texts
    monkeypatch.setattr(spelling, "HELD", 5)
    got = {r["word"]: r["n"] for r in spelling.counted(df).collect()}
    assert got == dict(_slow_counts(rows))
