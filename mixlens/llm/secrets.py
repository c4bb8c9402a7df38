"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's regex is parsed and turned into a Boolean trigram query: an AND of clauses, each
an OR of trigram sets, one set for each literal text the regex must contain (lower case on
both sides, so letter case does not matter). The index holds, for every trigram of the
queries, a posting for each document that contains it. Postings of a set are intersected by
counting, clauses and rules are combined by further counts, all co-located by the document's
key, and only the candidates of a rule are verified with its regex. Rules without mandatory
trigrams scan every text.

Defined cases: null text counts as empty; rows identical in every column share their postings
and are verified each; spans are counted in code points, end exclusive; an empty table gives
an empty result. Keys are hashes of id and text: two texts that share one only cause needless
verification.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    least: int = 0          # code points of ``group``, fewer drop the match
    group: int = 0


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+))""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)
BASE = 3                    # the first rules are the base kinds
_EXACT = 32                 # literal alternatives followed at once


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def trigram_query(regex: str) -> list[list[frozenset[str]]]:
    """The regex's mandatory trigrams: all clauses must hold, a clause by any one of its sets."""
    clauses: list[list[frozenset[str]]] = []

    def close(texts: list[str]) -> None:
        sets = [trigrams(t) for t in texts]
        if all(sets):                                          # a text without trigrams makes the clause idle
            clauses.append(sorted({t for t in sets if not any(o < t for o in sets)}, key=sorted))

    def walk(items, texts: list[str], bind: bool) -> list[str] | None:
        """Possible literal texts so far, followed through ``items``; None: not literal (only if not ``bind``)."""
        for op, arg in items:
            step = literal(op, arg)
            if step is not None and len(step) * len(texts) <= _EXACT:
                texts = [a + b for a in texts for b in step]
                continue
            if not bind:
                return None
            close(texts)
            texts = [""]
            if op is C.SUBPATTERN:
                texts = walk(arg[3], [""], True)
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
                close(walk(arg[2], [""], True))
                texts = [""]
        return texts

    def literal(op, arg) -> list[str] | None:
        """All texts that one element can match, if few."""
        if op is C.LITERAL:
            return [chr(arg).lower()]
        if op is C.IN:
            if all(o is C.LITERAL for o, _ in arg) and len(arg) <= 8:
                return sorted({chr(a).lower() for _, a in arg})
            return None
        if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            return [""]
        if op is C.SUBPATTERN:
            return walk(arg[3], [""], False)
        if op is C.BRANCH:
            ways = [walk(b, [""], False) for b in arg[1]]
            return None if any(w is None for w in ways) else sorted({t for w in ways for t in w})
        if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[1] != C.MAXREPEAT and arg[1] <= 8:
            one = walk(arg[2], [""], False)
            if one is None or len(one) ** arg[1] > _EXACT:
                return None
            ways, now = set(), [""]
            for i in range(arg[1] + 1):
                if i >= arg[0]:
                    ways.update(now)
                now = [a + b for a in now for b in one]
            return sorted(ways)
        return None

    close(walk(parser.parse(regex), [""], True))
    return clauses


def _terms(rules) -> list[tuple[int, int, int, str, int]]:
    """(rule, clause, set, trigram, trigrams in the set) of all queries."""
    return [(r, c, s, t, len(one)) for r, rule in enumerate(rules) for c, clause in enumerate(trigram_query(rule.regex))
            for s, one in enumerate(clause) for t in sorted(one)]


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """gram, key: one posting for each document (``key``, ``text``) that contains the trigram."""
    low = docs.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """key, rules (numbers of the indexed rules that the document may match)."""
    spark = docs.sparkSession
    terms = _terms(rules)
    if not terms:
        return docs.select("key", F.array().cast("array<int>").alias("rules")).limit(0)
    need = {r: len({c for q, c, *_ in terms if q == r}) for r in {t[0] for t in terms}}
    query = spark.createDataFrame(terms, "rule int, clause int, one int, qgram string, size int")      # the rule book
    wanted = spark.createDataFrame(sorted(need.items()), "wrule int, clauses int")
    index = postings(docs, sorted({t[3] for t in terms})).repartition("key")
    return (index.join(F.broadcast(query), F.col("gram") == F.col("qgram"))
            .groupBy("key", "rule", "clause", "one", "size").agg(F.countDistinct("gram").alias("n"))
            .filter("n = size")
            .groupBy("key", "rule").agg(F.countDistinct("clause").alias("n"))
            .join(F.broadcast(wanted), (F.col("rule") == F.col("wrule")) & (F.col("n") == F.col("clauses")))
            .groupBy("key").agg(F.collect_set("rule").alias("rules")))             # at most one entry a rule


def _spans(text, number: int, rule: Rule):
    """Array of (start, number, end) of a rule's matches: the texts between them give the places."""
    between = F.split(text, rule.regex, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else hits
    parts = F.zip_with(between, hits, lambda b, h: F.struct(F.char_length(b).alias("gap"), F.char_length(h).alias("size")))
    parts = F.zip_with(parts, counted, lambda p, g: F.struct(p["gap"].alias("gap"), p["size"].alias("size"),
                                                              (F.char_length(g) >= rule.least).alias("ok")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,ok:boolean>>")
    placed = F.aggregate(
        F.filter(parts, lambda p: p["size"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + p["gap"]).alias("start"), F.lit(number).alias("kind"),
                (acc["at"] + p["gap"] + p["size"]).alias("end"), p["ok"].alias("ok")))).alias("out")),
        lambda acc: acc["out"])
    return F.transform(F.filter(placed, lambda s: s["ok"]),
                       lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, found (array of start, kind number, end; by start, then kind): one row per document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    maybe = candidates(rows, rules)
    joined = rows.join(maybe.withColumnRenamed("key", "mkey"), F.col("key") == F.col("mkey"), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = []
    for number, rule in enumerate(rules):
        indexed = bool(trigram_query(rule.regex))
        hit = F.col("text").rlike(rule.regex)
        if indexed:
            hit = F.coalesce(F.array_contains("rules", number), F.lit(False)) & hit
        parts.append(F.when(hit, _spans(F.col("text"), number, rule)).otherwise(none))
    return joined.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))
