"""The pipeline's stages on awkward rows; what each keeps."""
import os

import pytest

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_stages(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert C.STAGES[-1][1](spark, docs, SF).count() == docs.count()


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_run_keeps_one_of_each_text(spark):
    out = C.run(spark, SF)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = [r["doc_id"] for r in out.collect()]
    assert max(ids.count(i) for i in set(ids)) <= 2
    assert len({docs[i].encode().lower() for i in set(ids)}) == len(set(ids))


def test_run_equals_brute_force(spark, tmp_path):
    """Every stage once more with dictionaries, on uneven lengths; copies by ``mixing.mix``, which has its own brute force."""
    from collections import Counter

    import numpy as np
    from tokenizers import Tokenizer

    from mixlens.llm import mixing
    from test_operators import _slow_fingerprint, _slow_quality, path
    rng = np.random.default_rng(13)
    good, rare, bad = ([f"{c}{i}" for i in range(40)] for c in ("stone", "fluss", "zz"))
    rows, labels = [], {}
    for i in range(200):
        kind = i % 4                                       # clean, clean of two languages, junk, very short
        size = (60, 3000 if i % 40 == 1 else 80, 30, 1 + i % 3)[kind]
        words = (good, good + rare, bad, good if i % 8 == 3 else bad)[kind]
        rows.append((i, " ".join(rng.choice(words, size)), "en", ["a", "b", None][i % 3]))
        if kind != 1 and i % 3 == 0 or i % 40 == 5 or i in (1, 41):
            labels[i] = int(words is not bad)
    for i in range(0, 40):                                  # exact copies in capitals, near copies with a word more
        rows.append((200 + i, rows[i][1].upper() if i % 2 else rows[i][1] + " stone1", "en", rows[i][3]))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels.items()), "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    text = {r[0]: r[1] for r in rows}

    stat, cut = _slow_quality(docs, labels)
    clean = {d for d, s in stat.items() if s > cut}
    assert all(d in clean for d in range(1, 200, 40))       # the very long ones
    last = {}
    for d in sorted(clean):
        last[text[d].lower()] = d
    prints = {d: _slow_fingerprint(text[d]) for d in last.values()}
    group = {d: d for d in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4 and group[a] != group[b]:
                one, other = sorted((group[a], group[b]))
                group = {d: one if g == other else g for d, g in group.items()}
    left = sorted(set(group.values()))
    assert len(clean) > len(last) > len(left) > 0
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.filter(docs["doc_id"].isin(left))).collect()}
    tok = Tokenizer.from_file(path)
    want = Counter()
    for d in left:
        ids = tok.encode(text[d], add_special_tokens=False).ids
        want[d, len(ids), np.array(ids, "<u4").tobytes()] += copies[d]
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in C.run(spark, str(tmp_path)).collect()) == +want
