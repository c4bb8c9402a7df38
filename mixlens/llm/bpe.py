"""BPE encoding through a distinct-word table, decoding through an id-to-piece table.

Encoding. Documents travel once, as compressed packs of about a megabyte, to blocks of a
bounded size. Each block's texts are split into words at places where the tokenizer's own
pre-tokenizer always splits, so words can be encoded one by one. The blocks' distinct words
are gathered by word, every distinct word is encoded once, and the answers go back to the
blocks that asked, where they are joined to the words by position. A word is sent once per
block, however often it occurs, so frequent words do not make hot tasks; the words a block
sends to one bucket of words travel sorted and compressed together.

Decoding. The vocabulary file bounds the id-to-piece table, which is broadcast; ids look
their pieces up by position and the pieces' bytes are put together.

The tokenizer is a file of the tokenizers library (byte-level BPE without normaliser, prefix
space, truncation or padding); its path is a parameter and it is read on the driver only.

Defined cases: null text counts as empty and has no ids; a special token's string in a text
is encoded as that token, as the library does; rows identical in every column are encoded
each; ids outside the vocabulary decode to nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, width, with_fields

PACK_BYTES = 1 << 20
BLOCK_BYTES = 32 << 20
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"      # Unicode White_Space
# a run of plain letters with its space, if an ASCII non-letter or the end follows; else a run without
# white space, with its space; else white space: all but the last character before such a run
_WORD = re.compile("| ?".join([" ?[A-Za-zÀ-ÖØ-öø-ɏ]++(?=[\\x00-@\\[-`{-\\x7f]|\\Z)",
                               f"[^{_SPACE}]+"]) + f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")


def words(text: str, specials: tuple[str, ...] = ()) -> list[str]:
    """The text cut into words: joined they give the text, and they can be encoded apart."""
    held = [s for s in specials if s in text]
    if not held:
        return _WORD.findall(text)
    out = []
    for part in re.split("(" + "|".join(map(re.escape, sorted(held, key=len, reverse=True))) + ")", text):
        out += [part] if part in held else _WORD.findall(part)
    return out


def load(path: str) -> str:
    """The tokenizer file's text, after a check that this module's word rule fits it."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    pre = spec["pre_tokenizer"] or {}
    if (spec["model"]["type"], pre.get("type"), pre.get("add_prefix_space"), spec["normalizer"]) != (
            "BPE", "ByteLevel", False, None) or pre.get("use_regex") is False:
        raise ValueError("only byte-level BPE files without normaliser and prefix space are supported")
    return text


def specials(tokenizer: str) -> tuple[str, ...]:
    return tuple(t["content"] for t in json.loads(tokenizer)["added_tokens"])


def pieces(tokenizer: str) -> list[bytes]:
    """The bytes of each id; ids without a token have none.

    Byte-level vocabularies write bytes as printable characters: the printable Latin-1 ones
    as themselves, the others in order from U+0100 on.
    """
    spec = json.loads(tokenizer)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ids = {i: s for s, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    table = [b""] * (max(ids, default=-1) + 1)
    for i, s in ids.items():
        table[i] = bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()
    return table


def _packs(rows: DataFrame, blocks: int) -> DataFrame:
    def run(batches):
        for b in batches:
            sizes = np.diff(np.frombuffer(b.column("body").buffers()[1], dtype=np.int32,
                                          count=b.num_rows + 1 + b.column("body").offset)[b.column("body").offset:])
            at = 0
            while at < b.num_rows:
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), PACK_BYTES, side="right")))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(b.slice(at, end - at))
                data = sink.getvalue().to_pybytes()
                yield pa.RecordBatch.from_arrays([pa.array([zlib.crc32(data) % blocks], pa.int32()),
                                                  pa.array([data], pa.binary())], names=["block", "pack"])
                at = end

    return rows.mapInArrow(run, "block int, pack binary")


def _unpack(data: bytes):
    with pa.ipc.open_stream(data) as r:
        for b in r:
            yield b, [x.decode("utf-8", "replace") for x in b.column("body").to_pylist()]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """doc_id, key, n_tokens, ids (packed little-endian unsigned 32-bit integers), one row a row.

    With ``decoded`` the ids are also decoded in the same tasks, as ``decode`` does.
    """
    spark = docs.sparkSession
    tokenizer = load(path)
    special = specials(tokenizer)
    shared = spark.sparkContext.broadcast(tokenizer)           # bounded by the vocabulary file
    rows = pick(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = width(spark)
    packs = _packs(rows, max(parts, -(-total // block_bytes))).repartition(parts, "block")

    def told(bucket, block, what):
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([block], pa.int32()),
             pa.array([zlib.compress(pickle.dumps(what, 5), 1)], pa.binary())], names=["bucket", "block", "words"])

    def ask(batches):                                          # distinct words of each block, by bucket of words
        def sent(block, known):
            lists: dict[int, list] = {}
            for w in sorted(known):
                lists.setdefault(zlib.crc32(w.encode()) % parts, []).append(w)
            for bucket, some in lists.items():
                yield told(bucket, block, some)

        last, known = None, set()
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("pack").to_pylist()):
                if block != last:
                    yield from sent(last, known)
                    last, known = block, set()
                for _, texts in _unpack(data):
                    for text in texts:
                        known.update(words(text, special))
        yield from sent(last, known)

    def answer(batches):                                       # a bucket's words come together: each is encoded once
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(shared.value)
        tok.no_truncation()
        tok.no_padding()
        coded: dict[str, bytes] = {}
        last = None
        for b in batches:
            for bucket, block, data in zip(*(c.to_pylist() for c in b.columns)):
                if bucket != last:
                    last, coded = bucket, {}
                some = pickle.loads(zlib.decompress(data))
                new = [w for w in some if w not in coded]
                for i in range(0, len(new), 5000):
                    part = new[i:i + 5000]
                    coded.update(zip(part, [np.array(e.ids, dtype="<u4").tobytes()
                                            for e in tok.encode_batch_fast(part, add_special_tokens=False)]))
                yield told(bucket, block, (some, [coded[w] for w in some]))

    kind = "bucket int, block int, words binary"
    table = (packs.sortWithinPartitions("block").mapInArrow(ask, kind)
             .repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(answer, kind))
    more = {"decoded": T.StringType()} if decoded else {}
    schema = with_fields(rows, "doc_id", "key", n_tokens=T.LongType(), ids=T.BinaryType(), **more)
    known_pieces = spark.sparkContext.broadcast(pieces(tokenizer)) if decoded else None

    def join(left: pa.Table, right: pa.Table) -> pa.Table:     # back by position, within one block
        coded = {}
        for data in right.column("words"):
            coded.update(zip(*pickle.loads(zlib.decompress(data.as_py()))))
        ids_of, out = coded.__getitem__, []
        for data in left.column("pack"):
            for b, texts in _unpack(data.as_py()):
                ids = [b"".join(map(ids_of, words(t, special))) for t in texts]
                cols = [b.column("doc_id"), b.column("key"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array(_texts(ids, known_pieces.value), pa.string()))
                out.append(pa.RecordBatch.from_arrays(cols, names=schema.names))
        return pa.Table.from_batches(out)

    return packs.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(join, schema)


def _texts(packed: list[bytes], piece_of: list[bytes]) -> list[str]:
    """The id-to-piece join of some packed id lists; ids without a piece give nothing."""
    table = np.array([*piece_of, b""], dtype=object)
    out = []
    for x in packed:
        ids = np.minimum(np.frombuffer(x or b"", dtype="<u4"), len(piece_of))
        out.append(b"".join(table[ids].tolist()).decode("utf-8", "replace"))
    return out


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with its ``ids`` (packed) decoded as the column ``decoded``."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces(load(path)))      # bounded by the vocabulary file
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(_texts(b.column("ids").to_pylist(), shared.value), pa.string())],
                names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
