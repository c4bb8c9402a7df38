"""Benchmark decontamination with a generalised suffix automaton over words.

Test items are normalised to words (A-Z lower-cased; digits, letters and everything beyond
ASCII form words) and cut into overlapping pieces of bounded length, so that no window of
``window`` words is lost. Pieces are dealt to blocks of bounded size and each block's task
builds one suffix automaton of all its pieces. Documents then stream through the automata
word by word: the state stands for the longest ending of the text so far that occurs in an
item. Where that length reaches ``window``, the last ``window`` words are an item's window;
an item with fewer words counts where it occurs whole. Rows never leave their task, so there
is no shuffle of documents and no key that could be hot.

An automaton is bounded by ``block_words`` and blocks are broadcast in rounds of at most
``ROUND`` of them; with more blocks the documents are read once a round and the rounds' hits
are merged by row. Long texts are read slice by slice.

Defined cases: a null text has no words; a document row is judged by itself, so null or
repeated ids and identical rows stay apart; items without words have no windows; rows of the
same item id are one item; windows of an item without an id hit words, but it is not counted;
an empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, pick, row_key, with_fields

WINDOW = 10
BLOCK_WORDS = 200_000          # words of an automaton, on average
ROUND = 8                      # automata that are broadcast at a time
PIECE = 4096                   # words of a piece of an item
SLICE = 1 << 20                # bytes of a text that are cut into words at once
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def slices(body: bytes):
    """The lower-cased text in slices that end between words, each with its first byte's place."""
    body, at = body.lower(), 0                                  # bytes: A-Z only
    while at < len(body):
        gap = _GAP.search(body, at + SLICE) if len(body) - at > SLICE else None
        end = gap.end() if gap else len(body)
        yield at, body[at:end]
        at = end


class Automaton:
    """Suffix automaton of several word sequences; state 0 is the empty one."""

    def __init__(self, window: int):
        self.window = window
        self.token: dict[bytes, int] = {}
        self.to: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, self.token.setdefault(w, len(self.token)))

    def _split(self, p: int, t: int, q: int) -> int:
        """State q seen from p by t, without the longer sequences it may hold too."""
        if self.len[q] == self.len[p] + 1:
            return q
        new = len(self.to)
        self.to.append(dict(self.to[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = new
        while p >= 0 and self.to[p].get(t) == q:
            self.to[p][t] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, t: int) -> int:
        if t in self.to[last]:
            return self._split(last, t, self.to[last][t])
        new = len(self.to)
        self.to.append({})
        self.link.append(0)
        self.len.append(self.len[last] + 1)
        p = last
        while p >= 0 and t not in self.to[p]:
            self.to[p][t] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, t, self.to[p][t])
        return new

    def packed(self, pieces: list[tuple[str | None, list[bytes]]]) -> bytes:
        """Everything ``Matcher`` needs, with the items of each window and of each short item."""
        window = np.full(len(self.to), -1, dtype=np.int64)      # the state that stands for the last ``window`` words
        order = sorted(range(len(self.to)), key=self.len.__getitem__)
        for s in order:
            if self.len[s] >= self.window:
                up = self.link[s]
                window[s] = s if self.len[up] < self.window else window[up]
        items: dict[int, set] = {}
        short = set()
        for item, words in pieces:
            s = 0
            for i, w in enumerate(words):
                s = self.to[s][self.token[w]]
                if i + 1 >= self.window:
                    items.setdefault(int(window[s]), set()).add(item)
            if len(words) < self.window:
                short.add(s)
                items.setdefault(s, set()).add(item)
        below = np.full(len(self.to), -1, dtype=np.int64)       # the nearest short item's state, itself included
        for s in order:
            below[s] = s if s in short else below[self.link[s]] if s else -1
        steps = np.array([(s, t, to) for s, out in enumerate(self.to) for t, to in out.items()],
                         dtype=np.int64).reshape(-1, 3)
        told = (self.window, list(self.token), steps, np.array(self.link), np.array(self.len), window, below,
                {s: sorted(i for i in found if i is not None) for s, found in items.items()})
        return zlib.compress(pickle.dumps(told, 5), 1)


class Matcher:
    """A packed automaton, ready to read texts."""

    def __init__(self, data: bytes):
        self.window, tokens, steps, link, length, window, below, self.items = pickle.loads(zlib.decompress(data))
        self.token = {w: i for i, w in enumerate(tokens)}
        self.width = max(1, len(tokens))
        self.go = dict(zip((steps[:, 0] * self.width + steps[:, 1]).tolist(), steps[:, 2].tolist()))
        self.link, self.len, self.at, self.below = link.tolist(), length.tolist(), window.tolist(), below.tolist()
        self.short = bool((below >= 0).any())

    def read(self, body: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, merged spans of hit words (end exclusive), states of the windows that occur."""
        go, width, link, length, at, below, window = self.go.get, self.width, self.link, self.len, self.at, self.below, self.window
        known, n, spans, seen, s, have = self.token.get, 0, [], set(), 0, 0

        def hit(start, end):                                    # ends never fall
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        for _, part in slices(body):
            for t in map(known, _WORD.findall(part)):
                n += 1
                if t is None:
                    s = have = 0
                    continue
                while (to := go(s * width + t)) is None and s:
                    s = link[s]
                    have = length[s]
                if to is None:
                    have = 0
                    continue
                s = to
                have += 1
                if have >= window:
                    seen.add(at[s])
                    hit(n - window, n)
                if self.short:
                    e = below[s]
                    if e == s and have < length[s]:
                        e = below[link[s]]
                    if e > 0:
                        hit(n - length[e], n)
                        while e > 0 and e not in seen:
                            seen.add(e)
                            e = below[link[e]]
        return n, spans, seen


def pieces(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
           piece: int = PIECE) -> DataFrame:
    """item, words (joined by spaces), n (of them): overlapping pieces that hold every window of every item."""
    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for item, body in zip(b.column("item").to_pylist(), b.column("body").to_pylist()):
                words = [w for _, part in slices(body) for w in _WORD.findall(part)]
                for at in range(0, max(1, len(words) - window + 1), piece):
                    if words:
                        out.append((item, b" ".join(words[at:at + piece + window - 1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in out], pa.string()), pa.array([w for _, w in out], pa.binary()),
                 pa.array([w.count(b" ") + 1 for _, w in out], pa.int64())], names=["item", "words", "n"])

    rows = pick(benchmark, id_col, text_col).select(F.col("doc_id").cast("string").alias("item"), "body")
    return rows.mapInArrow(run, "item string, words binary, n long")


def automata(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """block, automaton: one row a block of bounded size, built by the block's own task."""
    table = cut(pieces(benchmark, window, id_col, text_col))
    total = table.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [(i if isinstance(i, str) else None, bytes(w).split(b" ")) for i, w in zip(pdf["item"], pdf["words"])]
        made = Automaton(window)
        for _, words in each:
            made.add(words)
        return pd.DataFrame({"block": pdf["block"].iloc[:1].astype("int32"), "automaton": [made.packed(each)]})

    return (table.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int"))
            .groupBy("block").applyInPandas(build, "block int, automaton binary"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, key, row, n_words, n_hit, spans (of hit words), items (ids as sorted strings): one row a document."""
    spark = docs.sparkSession
    rows = pick(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    schema = with_fields(rows, "doc_id", "key", "row", n_words=T.LongType(), n_hit=T.LongType(), spans=_SPANS,
                         items=T.ArrayType(T.StringType()))
    built = cut(automata(benchmark, window, item_col, item_text_col, block_words))
    blocks = sorted(r[0] for r in built.select("block").collect())          # block numbers only

    def scanned(part):
        shared = [spark.sparkContext.broadcast(bytes(r[0])) for r in
                  built.filter(F.col("block").isin(part)).select("automaton").collect()]   # ROUND bounded automata

        def run(batches):
            only = Matcher(shared[0].value) if len(shared) == 1 else None
            for b in batches:
                bodies = b.column("body").to_pylist()
                n, spans, items = [0] * len(bodies), [[] for _ in bodies], [set() for _ in bodies]
                for data in shared:                                         # one automaton in memory at a time
                    m = only or Matcher(data.value)
                    for i, body in enumerate(bodies):
                        n[i], some, seen = m.read(body)
                        spans[i] += some
                        items[i].update(x for s in seen for x in m.items[s])
                if not shared:
                    n = [sum(len(_WORD.findall(p)) for _, p in slices(x)) for x in bodies]
                spans = [merged(x) for x in spans]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("key"), b.column("row"), pa.array(n, pa.int64()),
                     pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()),
                     pa.array([[{"start": s, "end": e} for s, e in x] for x in spans],
                              pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names=schema.names)

        return rows.mapInArrow(run, schema)

    rounds = [blocks[i:i + ROUND] for i in range(0, len(blocks), ROUND)] or [[]]
    parts = [scanned(part) for part in rounds]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    joined = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("key").alias("key"), F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def sewn(batches):
        for b in batches:
            spans = [merged((x["start"], x["end"]) for x in xs) for xs in b.column("spans").to_pylist()]
            cols = {c: b.column(c) for c in ("doc_id", "key", "row", "n_words", "items")}
            cols["n_hit"] = pa.array([sum(e - s for s, e in x) for x in spans], pa.int64())
            cols["spans"] = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans],
                                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([cols[c] for c in schema.names], names=schema.names)

    return joined.mapInArrow(sewn, schema)


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def without(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given spans of words; what stands between a span's words goes too."""
    if not spans:
        return body
    out, at, n, todo = [], 0, 0, iter([*spans, (None, None)])
    start, end = next(todo)
    for first, part in slices(body):
        for m in _WORD.finditer(part):
            if n == start:
                out.append(body[at:first + m.start()])
            n += 1
            if n == end:
                at = first + m.end()
                start, end = next(todo)
    return b"".join([*out, body[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """``docs`` with the hit spans taken out of the texts, without documents hit beyond ``coverage`` of their words.

    All columns stay; rows identical in every column stay as often as they come.
    """
    names = docs.columns
    hits = (scan(docs, benchmark, window, id_col, text_col, **more).filter("n_hit > 0")
            .dropDuplicates(["doc_id", "key"])                  # identical rows have the same hits
            .select(F.col("key").alias("hit_key"), F.col("doc_id").alias("hit_id"), "n_words", "n_hit", "spans"))
    tagged = docs.select(F.struct(*names).alias("own"), row_key(docs).alias("key"), F.col(id_col).alias("id"))
    found = tagged.join(hits, (F.col("key") == F.col("hit_key")) & F.col("id").eqNullSafe(F.col("hit_id")), "left").filter(
        F.coalesce(F.col("n_hit") <= F.lit(coverage) * F.col("n_words"), F.lit(True)))

    @F.pandas_udf("string")
    def taken(body: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without(bytes(x), [(s["start"], s["end"]) for s in y]).decode("utf-8", "replace")
                          for x, y in zip(body, spans)], dtype=object)

    body = F.coalesce(F.col("own")[text_col].cast("string"), F.lit("")).cast("binary")
    cleaned = F.when(F.col("spans").isNull(), F.col("own")[text_col].cast("string")).otherwise(
        taken(F.when(F.col("spans").isNotNull(), body).otherwise(F.lit(b"")), F.coalesce("spans", F.array().cast(_SPANS))))
    return found.select(*[cleaned.alias(c) if c == text_col else F.col("own")[c].alias(c) for c in names])
