"""Each operator against brute force, on awkward rows and on empty tables."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from mixlens.llm import bpe, components, exact_dedup, fuse, html_text, mixing, ngrams, pii, quality, search, secrets, sharding, simhash

path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def by_text(pairs):
    groups = defaultdict(list)
    for d, t in pairs:
        groups[t.encode().lower()].append(d)
    return groups


def test_fuse_filter_holds_every_key_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 10, 1000, 30_000):
        keys = rng.integers(0, 2**63, n, dtype=np.uint64)
        data = fuse.build(keys)
        assert fuse.contains(data, keys).all()
        assert fuse.contains(data, rng.integers(0, 2**63, 20_000, dtype=np.uint64)).mean() < 0.01


def _check_dedup(df, digest):
    got = exact_dedup.exact_dedup(df, digest=digest).collect()
    pairs = texts(df)
    groups = by_text(pairs)
    assert len(got) == len(pairs) and sum(r["kept"] for r in got) == len(groups)
    want = sorted(str((d, max((x for x in groups[t.encode().lower()] if x is not None), default=None),
                       len(groups[t.encode().lower()]))) for d, t in pairs)
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"])) for r in got) == want


def test_exact_dedup(odd):
    _check_dedup(odd, exact_dedup.sha256)


def test_exact_dedup_survives_digest_collisions(odd):
    _check_dedup(odd, lambda body: bytes([len(body) % 2]))


def test_keep_one_keeps_all_columns(odd, none):
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(by_text(texts(odd)))
    assert exact_dedup.keep_one(none).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for p in links for x in p if p[0] != p[1]}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def _slow_fingerprint(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", text.encode().lower().decode())
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(odd, none):
    got = simhash.near_duplicates(odd).collect()
    pairs = texts(odd)
    assert Counter((r["doc_id"], r["fp"] % 2**64) for r in got) == Counter((d, _slow_fingerprint(t)) for d, t in pairs)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(odd).columns == odd.columns
    assert simhash.keep_one(odd).count() == len({r["root"] for r in got})


@pytest.mark.parametrize("groups", [5, 6, 7])
def test_near_links_finds_every_pair(spark, groups):
    rng = np.random.default_rng(3)
    seeds = rng.integers(-2**63, 2**63, 30, dtype=np.int64)
    prints = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(6):
            flip = 0
            for b in rng.choice(64, rng.integers(1, 8), replace=False):
                flip |= 1 << int(b)
            x = (int(s) ^ flip) & (2**64 - 1)
            prints.add(x - 2**64 if x >> 63 else x)
    got = [(r["a"], r["b"]) for r in simhash.near_links(
        spark.createDataFrame([(p,) for p in prints], "fp long"), groups=groups).collect()]
    want = {(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert len(got) == len(set(got)) and set(got) == want


def test_bpe_equals_the_library(odd, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    want = []
    for d, t in texts(odd):
        ids = tok.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)))
    coded = bpe.encode(odd, path, decoded=True)
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in coded.collect()) == Counter(want)
    again = bpe.decode(coded.select("doc_id", "ids"), path)
    assert Counter((r["doc_id"], r["decoded"]) for r in again.collect()) == Counter((w[0], w[3]) for w in want)
    assert bpe.encode(none, path).count() == 0


def test_words_join_to_the_text():
    rng = np.random.default_rng(4)
    parts = ["a", "é", "²", "5", " ", "\n", "\xa0", "　", "'s", "don't", "<|endoftext|>", "日本", "\x1c", "\x85", "ª", "!"]
    from tokenizers import Tokenizer
    tok, special = Tokenizer.from_file(path), ("<|endoftext|>",)
    for _ in range(2000):
        t = "".join(rng.choice(parts, rng.integers(0, 12)))
        cut = bpe.words(t, special)
        assert "".join(cut) == t
        assert sum((tok.encode(w, add_special_tokens=False).ids for w in cut), []) == tok.encode(t, add_special_tokens=False).ids


def test_word_hashes_tell_words_apart():
    h, doc = ngrams.word_hashes([b"The cat, the CAT", b"", b"cat"])
    assert doc.tolist() == [0, 0, 0, 0, 0, 2] and h[0] == h[3] and h[1] == h[4] == h[5] and len(set(h.tolist())) == 3


def test_quality_drops_junk_and_keeps_clean(spark):
    rng = np.random.default_rng(5)
    good = ["river stone walk light green morning table open window road".split()[i] for i in range(10)]
    bad = "xx!! zz$$ click## win%% qq&&".split()
    rows, labels = [], []
    for i in range(400):
        clean = i % 5 != 0
        rows.append((i, " ".join(rng.choice(good if clean else bad, 40)), "en"))
        if i % 2:
            labels.append((i, int(clean), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.keep_sampled(docs, lab).collect()}
    assert kept == {i for i in range(400) if i % 5}
    assert quality.resample(docs, lab, k=17).filter("kept").count() == 17
    assert quality.resample(docs, lab.limit(0)).filter("kept").count() == 400
    assert quality.resample(docs.limit(0), lab).count() == 0


def _slow_quality(docs, labels):
    """(row, per n-gram perturbed weight) of each document and the cut, with one dictionary per count."""
    rows = docs.selectExpr("doc_id", "text", f"xxhash64({quality.SEED}, doc_id, xxhash64({','.join(docs.columns)})) AS noise").collect()
    raw, good, bags = Counter(), Counter(), []
    for r in rows:
        bags.append(ngrams.hashed([(r["text"] or "").encode()], quality.BUCKETS)[0].tolist())
        raw.update(bags[-1])
        good.update(bags[-1] if labels.get(r["doc_id"]) == 1 else [])
    n_raw, n_good = sum(raw.values()) + quality.BUCKETS, sum(good.values()) + quality.BUCKETS
    stat = {}
    for r, bag in zip(rows, bags):
        weight = sum(np.log((good[b] + 1) / n_good) - np.log((raw[b] + 1) / n_raw) for b in bag)
        u = (((r["noise"] % 2**64) >> 11) + 0.5) / 2**53
        stat[r["doc_id"]] = (weight - np.log(-np.log(u))) / max(len(bag), 1)
    values = sorted({stat[d] for d in labels})
    cuts = [values[0] - 1] + [(a + b) / 2 for a, b in zip(values, values[1:])]
    n = Counter(labels.values())
    return stat, min(cuts, key=lambda c: sum(stat[d] <= c for d in labels if labels[d]) / n[1]
                     + sum(stat[d] > c for d in labels if not labels[d]) / n[0])


def test_quality_keeps_long_clean_documents(spark):
    rng = np.random.default_rng(12)
    good, rare = ([f"{c}{i}" for i in range(40)] for c in ("stone", "fluss"))
    bad = [f"zz{i}" for i in range(40)]
    rows, labels = [], {}
    for i in range(300):
        kind = i % 4                                       # clean, clean of a second language, junk, short
        size = (60, 3000 if i % 40 == 1 else 80, 30, 1 + i % 3)[kind]
        words = (good, good + rare, bad, good if i % 8 == 3 else bad)[kind]
        rows.append((i, " ".join(rng.choice(words, size))))
        if kind != 1 and i % 3 == 0 or i % 40 == 5 or i in (1, 41):
            labels[i] = int(words is not bad)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stat, cut = _slow_quality(docs, labels)
    lab = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    got = {r["doc_id"] for r in quality.resample(docs, lab).filter("kept").collect()}
    assert got == {d for d, s in stat.items() if s > cut}
    assert cut < 0 and all(i in got for i in range(1, 300, 40))


def test_quality_on_odd_rows(odd, spark):
    lab = spark.createDataFrame([(1, 1), (10, 0)], "doc_id long, quality int")
    assert quality.resample(odd, lab).count() == odd.count()
    assert quality.keep_sampled(odd, lab).columns == odd.columns


def test_kth_largest(spark):
    values = [5, -3, 2**62, -2**63, 0, 5, 7, -1]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    for k, want in enumerate(sorted(values, reverse=True), 1):
        assert quality.kth_largest(df, "x", k) == want
    assert quality.kth_largest(df, "x", 0) is None and quality.kth_largest(df, "x", 99) is None


def test_mixing_meets_targets(spark, odd, none):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 60)), s) for i in range(900) for s in [["a", "b", "c", "d", None][i % 5 if i % 2 else 0]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    size = Counter()
    for r in got:
        size[r["source"]] += r["size"]
        assert 0 <= r["copies"] <= 2 and r["size"] == len(dict((a, b) for a, b, _ in rows)[r["doc_id"]].split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, free = 1.5 * sum(size.values()), {}, set(order)
    while True:
        per = left / sum(weight[s] for s in free)
        over = {s for s in free if per * weight[s] > 2 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
        free -= over
    target.update({s: per * weight[s] for s in free})
    for s in order:
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == size[s] for r in mine)
        assert abs(sum(r["copies"] * r["size"] for r in mine) - target[s]) <= 5
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs).collect()))
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in got)
    assert mixing.mix(odd).count() == odd.count() and mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0


def test_sharding_is_even_and_gapless(odd, none, spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i * 37 % 900)) for i in range(3000)], "doc_id long, text string")
    rows, table = sharding.assign(docs)
    got = rows.collect()
    load, slots = Counter(), defaultdict(list)
    for r in got:
        assert r["size"] == r["doc_id"] * 37 % 900 + 1 and r["text_crc32"] == zlib.crc32(b"x" * (r["size"] - 1))
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(load) == 16 and max(load.values()) - min(load.values()) <= 900
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    stored = f"{tmp_path}/map"
    for t in (sharding.first_map(), table):
        sharding.save_map(spark, t, stored)
    assert sharding.load_map(spark, stored) == table and sharding.load_map(spark, stored, 0) == sharding.first_map()
    assert sharding.assign(odd)[0].count() == odd.count() and sharding.assign(none)[0].count() == 0


def test_search_equals_brute_force(odd, none, spark):
    rng = np.random.default_rng(7)
    vocab = [f"w{i}" for i in range(200)]
    p = 1 / np.arange(1, 201)
    rows = [(i, " ".join(rng.choice(vocab, rng.integers(0, 60), p=p / p.sum()))) for i in range(600)] + [(None, "w1 w2"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = defaultdict(list)
    for r in search.search(docs, docs.filter("doc_id % 50 = 0"), k=7).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["doc_id"], r["score"]))
    bags = [(d, Counter((t or "").split())) for d, t in rows]
    average = sum(sum(b.values()) for _, b in bags) / len(bags)
    df = Counter(w for _, b in bags for w in b)
    for q, bag in bags:
        if q is None or q % 50 or not bag:
            continue
        scores = []
        for d, b in bags:
            norm = 1.2 * (0.25 + 0.75 * sum(b.values()) / average)
            s = sum(f * np.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + norm)
                    for w, f in bag.items() if w in b)
            if s:
                scores.append((-round(s, 9), d is None, d or 0))
        assert [(None if n else d, s) for s, n, d in sorted(scores)[:7]] == [(d, -round(s, 9)) for d, s in got[q]]
    assert search.search(odd, odd).count() > 0
    assert search.search(none, odd).count() == 0 and search.search(odd, none).count() == 0


def _slow_private(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(8)
    parts = ["1", "2", "0", "255", "256", ".", "-", " ", "+", "(", "@", "a", "b.c", "a@b", ".de", "4111111111111111", "x", "%"]
    for _ in range(5000):
        t = "".join(rng.choice(parts, rng.integers(0, 16)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == _slow_private(t)


def test_pii_adds_and_keeps(odd, none, spark):
    more = [(i, f"call tel 555-{i % 900 + 100}-1234 or mail ann{i}@example.org; order 555-{i % 900 + 100}-4321, +1 (555) 010-{1000 + i}")
            for i in range(200)]
    docs = spark.createDataFrame(more, "doc_id long, text string")
    for r in pii.find(docs).collect():
        spans = list(zip(r["kind"], r["start"], r["end"], r["base"]))
        base = [(pii.KINDS[k], a, b) for k, a, b, own in spans if own]
        assert base == _slow_private(dict(more)[r["doc_id"]])
        assert spans == sorted(spans)
    assert pii.find(odd).count() == odd.count() and pii.find(none).count() == 0


def test_estimation_tells_reliable_labelers():
    rng = np.random.default_rng(9)
    truth = rng.random(4000) < 0.4
    sure = [0.95, 0.9, 0.7, 0.6, 0.8, 0.85]
    vote = np.column_stack([np.where(rng.random(4000) < s, truth, ~truth) * 2 - 1 for s in sure])
    p, good = pii.estimate(np.zeros(4000, int), vote, np.ones(4000))
    assert np.abs(good - sure).max() < 0.05 and ((p > 0.5) == truth).mean() > 0.95


def _slow_secrets(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_secrets_equal_the_patterns(odd, none, spark):
    rng = np.random.default_rng(10)
    parts = ["token", "Secret", "api_key", "apikey", "PASSWD", "=", " : ", '"', " ", "abcdef", "0123456789ab", "AKIA", "ABCDEFGH12345678",
             "é", "😀", "x", "\n"]
    rows = [(i, "".join(rng.choice(parts, rng.integers(0, 14)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in secrets.scan(docs).collect():
        assert [tuple(s) for s in r["found"] if s["kind"] < 3] == _slow_secrets(dict(rows)[r["doc_id"]])
    assert secrets.scan(odd).count() == odd.count() and secrets.scan(none).count() == 0
    plan = secrets.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_trigram_queries():
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query("[0-9a-f]{24,}") == [] and secrets.trigram_query("ab|abcd") == []
    assert {t for s in secrets.trigram_query("(?:hello|world)[0-9]+")[0] for t in s} == {"hel", "ell", "llo", "wor", "orl", "rld"}


PAGE = """<html><head><title>T</title><script>var t = "</p>";</script></head><body><div class="cookie-notice">We use cookies here.</div>
<header><a href=/>Site</a></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<div class="content"><h1>Title here</h1><p>First paragraph of the story with <a href=x>a link</a> and &lt;b&gt; &#233;t&eacute;.</p>
<p>Short.</p><div class="advert">Buy now!</div><p>Second  paragraph is longer
and goes on for some time.</p></div>
<aside><p>Other story that is interesting.</p></aside><section id="comments"><p>Reader: I liked this story very much!</p></section>
<form><label>Your email</label></form><footer>c 2020</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == ("Title here\n\nFirst paragraph of the story with a link and <b> été.\n\nShort.\n\n"
                                         "Second paragraph is longer and goes on for some time.")
    for page in (None, "", "<div", "<script>x", "<!-- x", '<a href="x', "<nav>x</nav>"):
        assert html_text.main_text(page) == ""


def test_marked_teasers_do_not_replace_the_body():
    body = [f"Paragraph {i} of the body tells a part of the story at some length." for i in range(6)]
    cards = "".join(f"<article><h3>Card {i}</h3><p>A teaser of another story.</p></article>" for i in range(4))
    got = html_text.main_text("<div>" + "".join(f"<p>{b}</p>" for b in body) + f"</div>{cards}").split("\n\n")
    assert got[:6] == body
    got = html_text.main_text("<p>Stray line.</p><article>" + "".join(f"<p>{b}</p>" for b in body) + "</article><p>Another.</p>")
    assert got.split("\n\n") == body


def test_class_words_do_not_take_the_article():
    text = "The article tells its story in a paragraph of some length, and goes on."
    for name in ("content-sidebar-wrap", "page-with-sidebar", "layout-no-sidebar", "elementor-widget-container", "social-history",
                 "related-work", "sidebar", "comments"):
        for body in (f"<article><p>{text}</p></article>", f"<p>{text}</p>"):
            page = f'<p>Stray line.</p><div class="{name}">{body}<div class="site-sidebar">Other</div></div>'
            assert text in html_text.main_text(page) and "Other" not in html_text.main_text(page), name
    assert html_text.main_text(f'<div class="ad">{text}</div><article><p>Short.</p></article>') == "Short."
    many = [f"{text} {i}" for i in range(8)]
    page = "<article><h1>Title</h1>" + "".join(f'<div class="widget">{m}</div>' for m in many) + "</article>"
    assert html_text.main_text(page).split("\n\n") == ["Title", *many]
    page = "<p>Stray line.</p>" + "".join(f'<div class="widget">{m}</div>' for m in many)
    assert html_text.main_text(page).split("\n\n") == ["Stray line.", *many]
    page = "".join(f"<p>{m}</p>" for m in many)
    for name in ("sidebar", "ad-slot", "share-buttons", "cookie-container", "related_posts", "my-widget", "comments-area"):
        assert html_text.main_text(f'{page}<div id="{name}">Furniture.</div><p class="{name}">More.</p>').split("\n\n") == many, name


def test_runs_are_judged_by_themselves():
    body = ["A linked headline", "x" * 4000 + " long paragraph.", "Short rest.", "The end."]
    links = "<ul>" + "".join(f"<li><a href={i}>Link number {i}</a></li>" for i in range(6)) + "</ul>"
    adverts = '<div class="ad">Buy now!</div>' * 4
    for between in (links, adverts):
        for open_, close in (("<div>", "</div>"), ("<article>", "</article>")):
            page = (f"{open_}<h1><a href=x>{body[0]}</a></h1>{between}<p>{body[1]}</p>{between}"
                    f"<p>{body[2]}</p>{between}<p>{body[3]}</p>{close}")
            got = html_text.main_text(page).split("\n\n")
            assert [g for g in got if g in body] == body and "Buy now!" not in got
    got = html_text.main_text(f"<p>{body[1]}</p>{links}<div>Related</div>{links}")
    assert got == body[1]
    assert html_text.main_text(f"{links}<div>Tiny.</div>{links}") == "Tiny."


def test_extract(spark):
    rows = [(1, "u", PAGE), (None, None, None), (1, "u", PAGE), (4, "v", "<p>é" + "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url AS text")
    got = html_text.extract(pages).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(pages.limit(0)).count() == 0
