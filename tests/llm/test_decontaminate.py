"""Decontamination against a search for every window."""
import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from mixlens.llm import decontaminate as D
from mixlens.llm.queries import QUERIES


def _words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def _slow(docs, items, window=10):
    windows = {}
    for item, t in items:
        w = _words(t)
        for i in range(max(1, len(w) - window + 1)):
            if w:
                windows.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = _words(t), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (ids := windows.get(tuple(w[i:i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= ids
        out.append((d, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return out


def _case(seed=1, n=120, letters=3):
    """Few different words, so that windows overlap, repeat and contain each other."""
    rng = np.random.default_rng(seed)
    words = ["Aa", "b1", "ß", "don't", "x"][:letters + 2]

    def text(k):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n"]) for _ in range(k))

    items = [(i, text(int(rng.choice([0, 1, 3, 6, 9, 10, 11, 14, 30])))) for i in range(40)] + [(3, text(12)), (None, text(12)), (90, None)]
    docs = [(i, text(int(rng.integers(0, 60)))) for i in range(n)] + [(n, None), (None, items[7][1]), (5, "aa " * 30)]
    for i in range(0, n, 4):
        docs[i] = (i, docs[i][1] + " " + (items[int(rng.integers(40))][1] or "").upper() + " zz " + docs[i][1])
    return docs, items


def _got(df):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect())


@pytest.mark.parametrize("window,block_words", [(10, 200_000), (10, 25), (4, 40)])
def test_scan_equals_brute_force(spark, window, block_words):
    docs, items = _case()
    got = D.scan(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                 window=window, block_words=block_words)
    assert _got(got) == Counter(_slow(docs, items, window))


def test_long_texts_and_long_items_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(7)
    text = " ".join(f"w{x}" for x in rng.integers(0, 400, 3000))
    docs = [(1, text), (2, "W5 " + text[200:900] + " end"), (3, "x" * 5000)]
    items = [(1, text[500:4000]), (2, text[4100:4200])]
    monkeypatch.setattr(D, "SLICE", 64)
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert [len(list(D.slices(t.encode()))) > 1 for _, t in docs[:2]] == [True, True]
    whole = D.pieces(b).count()
    assert _got(D.scan(a, b)) == Counter(_slow(docs, items))
    monkeypatch.setattr(D.pieces, "__defaults__", (10, "item_id", "text", 50))
    assert D.pieces(b).count() > whole
    assert _got(D.scan(a, b)) == Counter(_slow(docs, items))


def test_odd_rows_and_empty_tables(odd, none, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven word number one"), (2, "hello world again my friends")],
                                  "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert _got(D.scan(odd, items)) == Counter(_slow(docs, [tuple(r) for r in items.collect()]))
    assert D.scan(none, items).count() == 0
    assert {r["n_hit"] for r in D.scan(odd, items.limit(0)).collect()} == {0}


def test_removal_takes_the_hit_words_out(spark, odd):
    docs, items = _case(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, key string")
    kept = D.decontaminate(frame, benchmark, coverage=0.5)
    assert kept.columns == frame.columns
    want = [r for r in _slow(docs, items) if r[2] <= 0.5 * r[1]]
    got = kept.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in want)
    clean = {(d, t) for (d, t), r in zip(docs, _slow(docs, items)) if r[2] == 0}
    assert clean <= {(r["doc_id"], r["text"]) for r in got}
    left = {r[0]: r[1] - r[2] for r in want if r[2]}
    for r in got:
        if r["doc_id"] in left and r["doc_id"] not in (5, None):
            assert len(_words(r["text"])) == left[r["doc_id"]]
    assert D.decontaminate(odd, benchmark).count() == odd.count()


def test_registered_query(spark, tmp_path):
    docs, items = _case(5)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = Counter(tuple(r) for r in QUERIES["op13_decontamination"](spark, str(tmp_path)).collect())
    assert got == Counter((d, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0)
                          for d, n, h, ids in _slow(docs, items))
