"""Merkle manifest of a dataset: content-addressed records, proofs by descent from the root.

A leaf is the digest of a row's fields. Leaves are ordered within a tree (one tree a language);
every ``FAN`` consecutive nodes become one node of the next level until one is left, and the
trees' roots, in order, form a last tree in the same way. All digests are SHA-256 of their
children's lowercase hex digits.

Ranks without a hot tree: rows are dealt by ranges of (tree, order, digest), so a tree that
holds most rows spans many partitions; one summary row a partition gives every partition its
first rank. Building takes ``STEP`` levels at a time: a segment of FAN**STEP neighbours makes
its part of the tree in one task and stores a record (digest -> children) for each node, and
only the segments' tops go on. Proofs descend the same way. Requests for leaves of one segment
share the way from the root to it, so that way is walked once a segment; within the segment
each request follows its rank's digits from record to record, collecting the children it does
not select, and the collected steps are reversed at the end.

Defined cases: a null field counts as ``-``, so null and empty differ; the null language is a
tree of its own before all others; rows with the same id stand in order of their digests, and
identical rows are leaves each; a lone leaf is its tree's root and has no siblings; columns
outside ``FIELDS`` do not matter; an empty table has no leaves and no root.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, row_key, width

FAN = 8
STEP = 3                                   # levels of a segment: at most FAN**STEP leaves in a task's group
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BITS = FAN.bit_length() - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def combine(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def told(col):
    """A field as its UTF-8 byte count and value, or ``-`` for null."""
    s = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns) -> object:
    return F.unhex(F.sha2(F.concat(*[told(c) for c in columns]), 256))


def leaves(docs: DataFrame, fields=FIELDS, tree_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
           tampered=None) -> DataFrame:
    """tree, doc_id, key, digest, changed: one row a row; ``changed`` is the digest after tampering.

    ``tampered`` is a condition; where it holds, the text's letters A-Z are lower-cased.
    """
    low = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    change = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    return docs.select(F.coalesce(F.concat(F.lit("v"), F.col(tree_col).cast("string")), F.lit("n")).alias("tree"),
                       F.col(id_col).alias("doc_id"), row_key(docs).alias("key"),
                       leaf_digest([F.col(c) for c in fields]).alias("digest"),
                       F.when(change, leaf_digest([low if c == text_col else F.col(c) for c in fields])).alias("changed"))


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with idx (rank within their tree, from 0) and n (nodes of the tree).

    Nodes that agree in ``order`` and digest are interchangeable; a salt spreads them.
    """
    spark = nodes.sparkSession
    keys = ["tree", *order, "digest", "salt"]
    # dealing by ranges samples its input first: from the digests written here, not from the texts again
    dealt = cut(cut(nodes.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())))
                .repartitionByRange(width(spark), *keys).sortWithinPartitions(*keys).drop("salt"))
    dealt = dealt.withColumn("part", F.spark_partition_id())

    def summary(batches):
        part, seen = None, []                                   # [tree, rows] of the first and the last tree
        for b in batches:
            if b.num_rows:
                part = b.column("part")[0].as_py()
                runs = b.column("tree").value_counts()
                for x in runs.to_pylist():                      # in order of appearance
                    if seen and seen[-1][0] == x["values"]:
                        seen[-1][1] += x["counts"]
                    else:
                        seen = [*seen[:1], [x["values"], x["counts"]]]
        if seen:
            row = ((part, pa.int32()), (seen[0][0], pa.string()), (seen[0][1], pa.int64()),
                   (seen[-1][0], pa.string()), (seen[-1][1], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in row],
                                             names=["part", "first", "n_first", "last", "n_last"])

    parts = sorted(map(tuple, dealt.select("tree", "part").mapInArrow(
        summary, "part int, first string, n_first long, last string, n_last long").collect()))   # a row a partition
    before, after = {}, {}
    tree, held = None, 0
    for part, first, n_first, last, n_last in parts:
        before[part] = held if first == tree else 0
        held = before[part] + n_first if first == last else n_last
        tree = last
    tree, held = None, 0
    for part, first, n_first, last, n_last in reversed(parts):
        after[part] = held if last == tree else 0
        held = after[part] + n_last if first == last else n_first
        tree = first
    shared = spark.sparkContext.broadcast((before, after))      # two numbers a partition

    def number(batches):
        held = [b for b in batches if b.num_rows]               # a partition's digests
        if not held:
            return
        part = held[0].column("part")[0].as_py()
        told_before, told_after = shared.value
        trees = pa.chunked_array([b.column("tree") for b in held])
        runs = trees.value_counts().to_pylist()
        idx, total = [], []
        for i, x in enumerate(runs):
            first = told_before[part] if i == 0 else 0
            n = first + x["counts"] + (told_after[part] if i == len(runs) - 1 else 0)
            idx.extend(range(first, first + x["counts"]))
            total.extend([n] * x["counts"])
        at = 0
        for b in held:
            end = at + b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(idx[at:end], pa.int64()),
                                              pa.array(total[at:end], pa.int64())], names=[*b.schema.names, "idx", "n"])
            at = end

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInArrow(number, f"{fields}, idx long, n long").drop("part")


@dataclass
class Forest:
    """Ranked leaves, the records of all inner nodes and the roots of some trees."""
    leaves: DataFrame       # tree, idx, n, digest and what the leaves carry
    records: DataFrame      # stage, tree, seg, level, idx, digest, children
    roots: DataFrame        # tree, level, digest
    stages: int


_NODE = "stage int, tree string, seg long, level int, idx long, n long, digest binary, children array<binary>, top boolean"


def grow(nodes: DataFrame) -> Forest:
    """Build the trees over ranked leaves, ``STEP`` levels a stage; records of every stage are written once."""
    def segment(stage):
        def run(table: pa.Table) -> pa.Table:
            rows = sorted(zip(*(table.column(c).to_pylist() for c in ("idx", "n", "digest", "tree", "seg"))))
            tree, seg, n = rows[0][3], rows[0][4], rows[0][1]
            here = [(i, d) for i, _, d, _, _ in rows]
            out, level = [], stage * STEP
            while n > 1 and level < (stage + 1) * STEP:
                runs: dict[int, list[bytes]] = {}
                for i, d in here:
                    runs.setdefault(i // FAN, []).append(d)
                here, n, level = [(i, combine(ds)) for i, ds in runs.items()], -(-n // FAN), level + 1
                out += [(stage, tree, seg, level, i, n, d, runs[i], False) for i, d in here]
            if out:
                out[-1] = (*out[-1][:-1], True)
            else:                                               # a lone leaf
                out.append((stage, tree, seg, level, here[0][0], n, here[0][1], [], True))
            names = ("stage", "tree", "seg", "level", "idx", "n", "digest", "children", "top")
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(),
                     pa.list_(pa.binary()), pa.bool_())
            return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=list(names))
        return run

    made, stage, at = None, 0, nodes.select("tree", "idx", "n", "digest")
    while True:
        step = cut(at.withColumn("seg", F.shiftright("idx", _BITS * STEP)).groupBy("tree", "seg")
                   .applyInArrow(segment(stage), _NODE))
        made = step if made is None else made.unionByName(step)
        stage += 1
        at = step.filter("top AND n > 1").select("tree", "idx", "n", "digest")
        if at.isEmpty():
            break
    return Forest(nodes, made.filter(F.size("children") > 0).drop("n", "top"),
                  made.filter("top AND n = 1").select("tree", "level", "digest"), stage)


_FRONT = "tree string, seg long, level int, digest binary, steps array<binary>, subroot binary, root binary"
_FRONT_TYPES = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.binary())


def _down(children_of: dict, digest: bytes, digits: int, levels: int) -> tuple[bytes, list[bytes]]:
    """From a node down by the digits of a rank: the node reached and a step (digit, siblings) a level."""
    steps = []
    for level in range(levels - 1, -1, -1):
        kids = children_of[digest]
        d = (digits >> (_BITS * level)) & (FAN - 1)
        steps.append(bytes([d]) + b"".join(kids[:d] + kids[d + 1:]))
        digest = kids[d]
    return digest, steps


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, idx, digest and more columns) with steps (leaf first), subroot and root.

    ``starts`` (tree, level, digest, steps, subroot, root) says where each tree's descent begins.
    A step is the leaf's place among its run (one byte) and the digests of the others.
    """
    def inner(stage):
        def run(front: pa.Table, records: pa.Table) -> pa.Table:
            kids = dict(zip(records.column("digest").to_pylist(), records.column("children").to_pylist()))
            out = []
            for tree, seg, level, digest, steps, subroot, root in zip(*(c.to_pylist() for c in front.columns)):
                todo = [(digest, seg, steps)]
                for _ in range(level - stage * STEP):
                    todo = [(k, i * FAN + d, [*path, bytes([d]) + b"".join(kids[x][:d] + kids[x][d + 1:])])
                            for x, i, path in todo for d, k in enumerate(kids[x])]
                out += [(tree, i, stage * STEP, x, path, subroot, root) for x, i, path in todo]
            cols = zip(*out) if out else [[]] * len(_FRONT_TYPES)
            return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, _FRONT_TYPES)], names=front.column_names)
        return run

    names = [x.split()[0] for x in _FRONT.split(", ")]
    first = F.greatest(F.ceil(F.col("level") / STEP) - 1, F.lit(0))
    begin = cut(starts.withColumn("seg", F.lit(0).cast("long")).withColumn("stage", first))
    front = begin.limit(0).select(*names)
    for stage in range(forest.stages - 1, 0, -1):
        front = cut(front.unionByName(begin.filter(F.col("stage") == stage).select(*names)).groupBy("tree", "seg")
                    .cogroup(forest.records.filter(F.col("stage") == stage).select("tree", "seg", "digest", "children")
                             .groupBy("tree", "seg")).applyInArrow(inner(stage), _FRONT))
    front = front.unionByName(begin.filter("stage = 0").select(*names))

    # the last stage: a segment's records, its way from the root, and the requests for its leaves
    store = (forest.records.filter("stage = 0").select("tree", "seg", "digest", "children")
             .withColumn("level", F.lit(None).cast("int")).withColumn("steps", F.lit(None).cast("array<binary>"))
             .withColumn("subroot", F.lit(None).cast("binary")).withColumn("root", F.lit(None).cast("binary"))
             .unionByName(front.withColumn("children", F.lit(None).cast("array<binary>"))))
    own = requests.withColumn("seg", F.shiftright("idx", _BITS * STEP))

    def last(asked: pa.Table, found: pa.Table) -> pa.Table:
        rows = found.to_pylist()
        kids = {r["digest"]: r["children"] for r in rows if r["children"] is not None}
        way = next((r for r in rows if r["steps"] is not None), None)
        steps, subroot, root = [], [], []
        for idx, digest in zip(asked.column("idx").to_pylist(), asked.column("digest").to_pylist()):
            end, down = _down(kids, way["digest"], idx, way["level"])
            if end != digest:
                raise ValueError("the records do not lead to this leaf")
            steps.append([*way["steps"], *down][::-1])
            subroot.append(way["subroot"])
            root.append(way["root"])
        return (asked.drop_columns(["seg"]).append_column("steps", pa.array(steps, pa.list_(pa.binary())))
                .append_column("subroot", pa.array(subroot, pa.binary())).append_column("root", pa.array(root, pa.binary())))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    return (own.groupBy("tree", "seg").cogroup(store.groupBy("tree", "seg"))
            .applyInArrow(last, f"{fields}, steps array<binary>, subroot binary, root binary"))


@dataclass
class Manifest:
    forest: Forest          # the trees over the leaves
    top: Forest             # the tree over their roots; its one root is the dataset's

    def records(self) -> DataFrame:
        """The content-addressed store: digest -> children, each digest once."""
        return self.forest.records.select("digest", "children").unionByName(
            self.top.records.select("digest", "children")).dropDuplicates(["digest"])

    def root(self) -> bytes | None:
        found = self.top.roots.select("digest").first()
        return bytes(found[0]) if found else None

    def prove(self, requests: DataFrame | None = None) -> DataFrame:
        """Proofs for ``requests`` (some of the ranked leaves; all by default): their columns, steps, subroot, root."""
        start = self.top.roots.select("tree", "level", "digest", F.array().cast("array<binary>").alias("steps"),
                                      F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
        tops = (descend(self.top, start, self.top.leaves)
                .select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.reverse("steps").alias("steps"), "root"))
        starts = self.forest.roots.join(tops, "tree").select("tree", "level", "digest", "steps", "subroot", "root")
        return descend(self.forest, starts, self.forest.leaves if requests is None else requests)


def manifest(leaf_rows: DataFrame) -> Manifest:
    """Trees over ``leaves()``'s rows and the tree over their roots."""
    forest = grow(cut(ranked(leaf_rows, "doc_id")))
    roots = forest.roots.select(F.lit("top").alias("tree"), F.col("tree").alias("name"), "digest")
    return Manifest(forest, grow(cut(ranked(roots, "name"))))


def fold(leaf: bytes, steps: list[bytes]) -> bytes:
    """The root that a leaf and its siblings, leaf first, lead to."""
    for step in steps:
        others = [step[i:i + 32] for i in range(1, len(step), 32)]
        leaf = combine([*others[:step[0]], leaf, *others[step[0]:]])
    return leaf


def checked(proofs: DataFrame) -> DataFrame:
    """``proofs`` without their steps, with proof (digest of all siblings), folded and verified.

    ``folded`` starts from ``changed`` where that is given, from the leaf's own digest elsewhere.
    """
    kept = [f for f in proofs.schema.fields if f.name != "steps"]

    def run(batches):
        for b in batches:
            proof, folded = [], []
            for leaf, changed, steps in zip(*(b.column(c).to_pylist() for c in ("digest", "changed", "steps"))):
                proof.append(combine([s[i:i + 32] for s in steps for i in range(1, len(s), 32)]))
                folded.append(fold(leaf if changed is None else changed, steps))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(proof, pa.binary()),
                                              pa.array(folded, pa.binary())],
                                             names=[*[f.name for f in kept], "proof", "folded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return (proofs.mapInArrow(run, f"{fields}, proof binary, folded binary")
            .withColumn("verified", F.col("folded") == F.col("root")))
