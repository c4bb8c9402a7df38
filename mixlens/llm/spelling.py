"""Spelling variants by a bit-sliced position index over the vocabulary.

Words are counted over all texts, with partial counts in every task. Two words are near if one
inserted, deleted or replaced letter turns one into the other. Such words agree in their first
``a // 2`` letters or in their last ``a - a // 2`` ones, where ``a`` is the smaller length, so
each word enters the buckets of these two parts, for ``a`` equal to its length and to one less.

A bucket's task keeps one bitset per (position, letter) over the bucket's words, and finds the
near words of each word by walking its letters once: bitset ``same`` holds the words that agree
so far, and three more hold those that agree but for one error, read at the same position
(replaced), one position ahead (the other word has a letter more) or one behind (a letter
less). Every step is a few AND and OR of whole bitsets. Bits are in order of falling count, so
the lowest bit of a result is the near word that wins, and counting bits counts near words.

A bucket of more than ``block`` words is cut into blocks of words and all pairs of (asking
block, indexed block) become buckets of their own, so a hot bucket is spread and no task holds
more than two blocks of it. Buckets of one word are dropped before they are sent.

Defined cases: a null text has no words; a null id is the empty string in the hash; repeated
rows count once each; words of equal count are taken in code-point order; an empty table or
one without repeated words gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, width

SHORTEST = 7
LEAST = 2
RATIO = 10
EVERY = 31
BLOCK = 20_000
HELD = 300_000                               # distinct words that a counting task holds at a time


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = EVERY,
            shortest: int = SHORTEST) -> DataFrame:
    """word, n over all texts. With ``every``, some runs lose a letter that a hash of id and run picks."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    run_of = re.compile("[a-zÀ-ÿ]{%d,}" % shortest)      # longer runs whole: a match starts where a run does

    def run(batches):
        held: dict[str, int] = {}

        def told():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for doc, body in zip(b.column("id").to_pylist(), b.column("body").to_pylist()):
                start = zlib.crc32(f"{doc}:".encode())
                found: dict[str, int] = {}
                for w in run_of.findall(body.lower().decode("utf-8", "replace")):      # bytes: A-Z only
                    found[w] = found.get(w, 0) + 1
                for w, n in found.items():
                    if every and (h := zlib.crc32(w.encode(), start)) % every == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < shortest:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield told()
        yield told()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def entries(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """bucket (xxhash64 of its part), part, a, word, n: the buckets a word is in."""
    size = F.length("word")
    least = F.explode(F.filter(F.array(size, size - 1), lambda a: a >= shortest))
    cut_at = F.floor(F.col("a") / 2).cast("int")
    parts = F.explode(F.array(
        F.concat(F.lit("<"), F.col("a"), F.lit(":"), F.substring("word", F.lit(1), cut_at)),
        F.concat(F.lit(">"), F.col("a"), F.lit(":"), F.substring("word", F.length("word") - F.col("a") + cut_at + 1, F.col("a") - cut_at))))
    return (words.select("word", "n", least.alias("a")).select("word", "n", "a", parts.alias("part")))


def spread(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` of buckets with two words or more, with pair (of blocks), asks and indexed."""
    sizes = rows.groupBy("part").agg(F.count("*").alias("held")).filter("held > 1")
    blocks = F.ceil(F.col("held") / block).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (rows.join(sizes, "part").withColumn("blocks", blocks).withColumn("own", own)
             .select("part", "a", "word", "n", "blocks", "own", other.alias("other")))
    pair = F.explode(F.when(F.col("own") == F.col("other"), F.array(
        F.struct(F.col("own").alias("p"), F.col("own").alias("q"), F.lit(True).alias("asks"), F.lit(True).alias("indexed"))))
        .otherwise(F.array(
            F.struct(F.col("own").alias("p"), F.col("other").alias("q"), F.lit(True).alias("asks"), F.lit(False).alias("indexed")),
            F.struct(F.col("other").alias("p"), F.col("own").alias("q"), F.lit(False).alias("asks"), F.lit(True).alias("indexed")))))
    return (dealt.select("part", "a", "word", "n", pair.alias("pair"))
            .select("part", "a", "word", "n", "pair.p", "pair.q", "pair.asks", "pair.indexed"))


class Index:
    """Bit-sliced index of some strings: bit i stands for the i-th."""

    def __init__(self, strings: list[str], short: int):
        self.short = short                                     # strings have this length or one more
        self.all = (1 << len(strings)) - 1
        at: list[dict[str, list[int]]] = [{} for _ in range(short + 1)]
        longer = []
        for i, s in enumerate(strings):
            for place, letter in zip(at, s):
                place.setdefault(letter, []).append(i)
            if len(s) > short:
                longer.append(i)
        self.at = [{c: self._bits(some) for c, some in place.items()} for place in at]
        self.longer = self._bits(longer)
        self.shorter = self.all & ~self.longer

    def _bits(self, members: list[int]) -> int:
        if len(members) < 64:
            out = 0
            for i in members:
                out |= 1 << i
            return out
        out = bytearray(members[-1] // 8 + 1)
        for i in members:
            out[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(out, "little")

    def near(self, word: str, apart: int | None = None) -> int:
        """Bits of the strings that are exactly one error away.

        A longer word asks for shorter ones only, a shorter word for its own length and longer ones. With
        ``apart``, strings that agree with the word in their first ``apart`` letters are left out.
        """
        at, same, agree = self.at, self.all, 0
        if len(word) > self.short:                              # the others lack a letter
            less = 0
            for i, c in enumerate(word):
                less = (less & at[i - 1].get(c, 0) if i else 0) | same
                same = same & at[i].get(c, 0)
                if i + 1 == apart:
                    agree = same
            return less & self.shorter & ~agree
        swapped, more = 0, same                                 # more: the other has a letter ahead already
        for i, c in enumerate(word):
            here = at[i].get(c, 0)
            swapped = (swapped & here) | (same & ~here)
            same &= here
            more = (more & at[i + 1].get(c, 0)) | same
            if i + 1 == apart:
                agree = same
        return ((swapped & self.shorter) | (more & self.longer)) & ~agree


def _answers(part: str, a: int, group: list[tuple]):
    """word, n_near, best_n, best of the words that ask, within one bucket."""
    k = a // 2
    head = part[0] == "<"
    indexed = sorted((-n, w) for w, n, _, x in group if x)       # falling count, then code points
    # what is not known to agree: after the first k letters, or before the last a - k ones
    rest = (lambda w: w[k:]) if head else (lambda w: w[:len(w) - a + k])
    index = Index([rest(w) for _, w in indexed], a - k if head else k)
    for w, n, asks, _ in group:
        if asks and (bits := index.near(rest(w), None if head else k)):
            best = indexed[(bits & -bits).bit_length() - 1]
            yield w, bits.bit_count(), -best[0], best[1]


def near_words(words: DataFrame, shortest: int = SHORTEST, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n, best (the most frequent near word): words with a near word only."""
    rows = spread(entries(words, shortest), block)

    def run(batches):
        key, group = None, []
        for b in batches:
            out = []
            for part, a, w, n, p, q, asks, indexed in zip(*(c.to_pylist() for c in b.columns)):
                if (part, p, q) != key:
                    if group:
                        out += _answers(key[0], size, group)
                    key, size, group = (part, p, q), a, []
                group.append((w, n, asks, indexed))
            yield _batch(out)
        if group:
            yield _batch(list(_answers(key[0], size, group)))

    def _batch(out):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds)],
                                          names=["word", "n_near", "best_n", "best"])

    found = (rows.repartition(width(words.sparkSession), "part", "p", "q").sortWithinPartitions("part", "p", "q")
             .mapInArrow(run, "word string, n_near long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = EVERY,
             shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row a word of at least ``least`` occurrences.

    A form's count is at least ``ratio`` times the word's, so chains of forms are no longer than
    the logarithm of the largest count and each round of following halves what is left of them.
    """
    words = cut(counted(docs, id_col, text_col, every, shortest).filter(F.col("n") >= least))
    near = near_words(words, shortest, block)
    wins = F.col("best_n") >= ratio * F.col("n")
    table = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(wins, F.col("best")).alias("form"), F.when(wins, F.col("best_n")).alias("form_n")))
    paths = table.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(paths.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved")))
        paths = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return (table.join(paths, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
