"""Registered queries of the corpus operators: thin views over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, exact_dedup, html_text, merkle, mixing, pii, quality, search, secrets, sharding, simhash, spelling
from .common import table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary the contract names."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _hex(col):
    return F.lower(F.hex(col))


@register("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents; those that the classifier rejects are absent."""
    return (quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .filter("kept").select("doc_id", "n_ngrams", "log_weight", "kept"))


_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


@register("op5_exact_dedup", f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
     g AS (SELECT t, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", _hex("digest").alias("text_sha256")))


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


@register("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                    "source", "rate", "copies"))


@register("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sharding.assign(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))


@register("op10_html")
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    spans = F.arrays_zip("kind", "start", "end", "base")      # by kind, then start

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1),
                                                                       s["start"], s["end"])), ",")

    base = F.filter(spans, lambda s: s["base"] == 1)

    def count(i):
        return F.size(F.filter(base, lambda s: s["kind"] == i)).cast("long").alias(f"n_{pii.KINDS[i]}")

    return found.select("doc_id", *[count(i) for i in range(4)], F.sha2(told(base), 256).alias("base_sha256"),
                        told(spans).alias("spans"))


@register("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(r.kind) for r in secrets.RULES])
    base = F.filter("found", lambda s: s["kind"] < secrets.BASE)

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1),
                                                                       s["start"], s["end"])), ",")

    def count(i):
        return F.size(F.filter("found", lambda s: s["kind"] == i)).cast("long").alias(f"n_{secrets.RULES[i].kind}")

    return found.select("doc_id", *[count(i) for i in range(secrets.BASE)], F.sha2(told(base), 256).alias("base_sha256"),
                        told(F.col("found")).alias("spans"))


@register("op8_search")
def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for the whole text of every document whose id is divisible by 100."""
    docs = table(spark, sf_dir, "documents")
    return search.search(docs, docs.filter(F.col("doc_id") % 100 == 0))


_WORDS = r"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@register("op13_decontamination", rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format(low=_LOWER)} AS w FROM documents),
     b AS (SELECT item_id, {_WORDS.format(low=_LOWER)} AS w FROM benchmark),
     win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k,
                    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
             FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
     every AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
            FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
     found AS (SELECT r, k, i, item_id FROM every JOIN win USING (k, g)),
     hit AS (SELECT r, COUNT(DISTINCT p) AS n_hit
             FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, k, i FROM found)) GROUP BY r),
     item AS (SELECT r, COUNT(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)""")
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def _crc(text: str) -> str:
    """DuckDB expression: the unsigned CRC-32 of a VARCHAR's UTF-8 bytes, bit by bit."""
    byte = f"hex(encode({text}))"
    steps = (f"flatten(list_transform(range(0, strlen({text})), lambda i: [CAST(('0x' || {byte}[2 * i + 1:2 * i + 2]) AS BIGINT),"
             " -1, -1, -1, -1, -1, -1, -1, -1]))")
    return (f"xor(list_reduce(list_concat([4294967295], {steps}), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
            "ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)")


def _merkle_sql(levels: int = 8, top: int = 4) -> str:
    """Trees of up to 8**levels leaves in up to 8**top languages, level by level."""
    def told(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text):
        return "sha256(" + " || ".join(f"({told(c)})" for c in ["doc_id", "source", "lang", "n_chars", text]) + ")"

    def tree(p, k):
        """Levels p0..pk of nodes, runs pr0.., from p0 (tree, idx, n, dig)."""
        out = []
        for i in range(k):
            out.append(f"{p}r{i} AS MATERIALIZED (SELECT tree, idx // 8 AS up, n, list(dig ORDER BY idx) AS kids "
                       f"FROM {p}{i} GROUP BY tree, up, n)")
            out.append(f"{p}{i + 1} AS MATERIALIZED (SELECT tree, up AS idx, CASE WHEN n = 1 THEN n ELSE (n + 7) // 8 END AS n, "
                       f"CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS dig FROM {p}r{i})")
        return out

    def fold(q, p, k, keep):
        """Carry idx, sibs and cur of q0 up the levels of tree p."""
        out = []
        for i in range(k):
            at = "q.idx % 8"
            out.append(f"{q}{i + 1} AS MATERIALIZED (SELECT {keep}, q.tree, q.idx // 8 AS idx, "
                       f"CASE WHEN r.n = 1 THEN sibs ELSE sibs || array_to_string(list_concat(kids[:{at}], kids[{at} + 2:]), '') END AS sibs, "
                       f"CASE WHEN r.n = 1 THEN cur ELSE sha256(array_to_string(list_concat(list_concat(kids[:{at}], [cur]), "
                       f"kids[{at} + 2:]), '')) END AS cur FROM {q}{i} q JOIN {p}r{i} r ON q.tree = r.tree AND q.idx // 8 = r.up)")
        return out

    low = _LOWER.replace("coalesce(text, '')", "text")
    parts = [
        f"d AS MATERIALIZED (SELECT doc_id, coalesce('v' || lang, 'n') AS tree, {leaf('text')} AS dig, "
        f"CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS bad FROM documents)",
        "a0 AS MATERIALIZED (SELECT doc_id, tree, dig, bad, count(*) OVER (PARTITION BY tree) AS n, "
        "row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, dig) - 1 AS idx FROM d)",
        *tree("a", levels),
        f"b0 AS MATERIALIZED (SELECT 'top' AS tree, tree AS name, dig, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS idx FROM a{levels})",
        *tree("b", top),
        "q0 AS (SELECT doc_id, dig AS leaf, tree, idx, '' AS sibs, bad AS cur FROM a0)",
        *fold("q", "a", levels, "doc_id, leaf"),
        f"s0 AS (SELECT doc_id, leaf, b0.dig AS subroot, b0.tree, b0.idx, sibs, cur FROM q{levels} q JOIN b0 ON q.tree = b0.name)",
        *fold("s", "b", top, "doc_id, leaf, subroot"),
    ]
    return ("WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, b{top}.dig AS root, sha256(sibs) AS proof_sha256, "
            f"cur AS folded_root, cur = b{top}.dig AS verified FROM s{top}, b{top}")


@register("op12_merkle", _merkle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.leaves(table(spark, sf_dir, "documents"), tampered=tampered)
    proofs = merkle.checked(merkle.manifest(rows).prove())
    return proofs.select("doc_id", _hex("digest").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"),
                         _hex("proof").alias("proof_sha256"), _hex("folded").alias("folded_root"), "verified")


@register("op11_spelling", rf"""
WITH RECURSIVE
runs AS (SELECT doc_id, w, count(*) AS c
         FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
         WHERE length(w) >= 7 GROUP BY doc_id, w),
hashed AS (SELECT w, c, {_crc("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)")} AS h FROM runs),
typed AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cuts AS MATERIALIZED (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS s
         FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
pairs AS (SELECT x.word, y.word AS o, y.n AS m FROM cuts x JOIN cuts y ON x.s = y.s AND x.i = y.i AND x.word <> y.word
          UNION SELECT x.word, y.word, y.n FROM cuts x JOIN v y ON x.s = y.word
          UNION SELECT y.word, x.word, x.n FROM cuts x JOIN v y ON x.s = y.word),
near AS (SELECT word, count(*) AS n_near, arg_min(o, (-m, o)) AS best, max(m) AS best_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
                 CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM v LEFT JOIN near USING (word)),
way AS (SELECT word, word AS node, 0 AS k FROM forms
        UNION ALL SELECT way.word, f.form, k + 1 FROM way JOIN forms f ON f.word = way.node WHERE f.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(node, k) FROM way WHERE way.word = forms.word) AS root, n, n_near, form_n FROM forms""")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
