"""Personal data by weak supervision.

Candidates are the exact base spans of four kinds and looser ones (obfuscated addresses,
national phone numbers, 13 to 15 digit cards, IPv6, names). Labelers of three sorts vote on
each candidate for, against or not at all: regular expressions (strict form, check digits,
clean edges), gazetteers (mail suffixes, titles and given names) and the context (words
before it). The votes are counted by pattern over the whole corpus, expectation-maximisation
estimates each labeler's reliability from the pattern counts, and a logistic span classifier
is trained on the estimated labels with votes and shape as features. Spans it accepts are
added; base spans always stay.

The texts are scanned once. Pattern counts are bounded by the number of feature cells (under
``CELLS``), so training does not grow with the corpus.

Defined cases: null text counts as empty; a document without candidates has no spans; an
added span never overlaps a base span of its kind; spans are counted in code points, end
exclusive; rows repeat as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, pick, with_fields

KINDS = ("email", "ip", "card", "phone", "name")       # the first four have base spans
LABELERS = 6
CELLS = len(KINDS) * 3**LABELERS * 4
ACCEPT = 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]{1,63}+"
                         r"|\.[A-Za-z0-9-]{1,63}+){1,4}+| at [A-Za-z0-9-]{1,63}+(?: dot [A-Za-z0-9-]{1,63}+){1,4}+)", re.I)),
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9A-Za-z:])", re.I)),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,14}+(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")),
    ("name", re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-Z][a-z]{1,20}+(?: [A-Z][a-z]{1,20}+)?")),
)
_HINT = {
    "email": re.compile(r"\b(?:e-?mails?|mailto|contact|write to|reach|address)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|login|client)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|sms)\b", re.I),
    "name": re.compile(r"\b(?:dear|name|signed|regards|sincerely|patient|contact)\b", re.I),
}
_AGAINST = re.compile(r"\b(?:order|invoice|isbn|issn|version|serial|sku|ref|item|page|volume|lot|doi|part)\b\W*\w*\W*\Z", re.I)
# fixed values: common mail suffixes, given names
_SUFFIXES = frozenset("com org net edu gov mil info biz io co de fr es it nl uk us ca eu ch at be".split())
_GIVEN = frozenset("""james john robert michael william david mary patricia jennifer linda elizabeth barbara susan
    maria anna thomas peter paul hans pierre jean marie jose juan carlos ana laura sofia""".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base spans, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap no base span of their kind."""
    out = []
    for name, pattern in _LOOSE:
        kind = KINDS.index(name)
        taken = [(a, b) for k, a, b in base if k == kind]
        at = 0
        for m in pattern.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at == len(taken) or taken[at][0] >= m.end():
                out.append((kind, *m.span()))
    return out


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> list[int]:
    """One vote a labeler: 1 for, -1 against, 0 none."""
    span, before = text[start:end], text[max(0, start - 40):start]
    digits = "".join(c for c in span if c in "0123456789")
    edge = (text[start - 1:start] or " ") + (text[end:end + 1] or " ")
    form = 1 if strict else 0
    if kind == 2:
        check = 1 if luhn(digits) else -1
    elif kind == 3:
        check = -1 if len(set(digits)) < 3 else 1
    elif kind == 1:
        check = -1 if span.startswith(("0.", "255.")) else 1
    else:
        check = 0
    clean = -1 if edge[0].isalnum() or edge[1].isalnum() or edge[0] in "=/#" else 1
    words = re.findall(r"[A-Za-z]+", span.lower())
    if kind == 0:
        known = 1 if words and words[-1] in _SUFFIXES else -1
    elif kind == 4:
        known = 1 if any(w in _GIVEN for w in words) else 0
    elif kind == 2:
        known = 1 if digits[:1] in "3456" and len(digits) in (13, 14, 15, 16, 19) else -1
    else:
        known = 0
    hint = 1 if _HINT[KINDS[kind]].search(before) else 0
    against = -1 if _AGAINST.search(before) else 0
    return [form, check, clean, known, hint, against]


def _cell(kind: int, vote: list[int], span: str) -> int:
    code = kind
    for v in vote:
        code = code * 3 + v + 1
    shape = (1 if any(c in "()[] " for c in span) else 0) + (2 if len(span) > 16 else 0)
    return code * 4 + shape


def unpack(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes (one column a labeler) and shapes of feature cells."""
    shape, code = cells % 4, cells // 4
    vote = np.zeros((len(cells), LABELERS), dtype=int)
    for j in reversed(range(LABELERS)):
        vote[:, j] = code % 3 - 1
        code = code // 3
    return code, vote, shape


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, kind, start, end, base, cell (parallel lists): one row per document."""
    rows = pick(docs, id_col, text_col)
    ints = T.ArrayType(T.IntegerType())
    schema = with_fields(rows, "doc_id", "key", kind=ints, start=ints, end=ints, base=ints, cell=ints)

    def run(batches):
        for b in batches:
            lists = [[] for _ in range(5)]
            for body in b.column("body"):
                text = body.as_py().decode("utf-8", "replace")
                base = base_spans(text)
                both = [(*s, 1) for s in base] + [(*s, 0) for s in loose_spans(text, base)]
                cells = [_cell(k, votes(text, k, i, j, bool(own)), text[i:j]) for k, i, j, own in both]
                for col, at in zip(lists, range(4)):
                    col.append([x[at] for x in both])
                lists[4].append(cells)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), *[pa.array(x, pa.list_(pa.int32())) for x in lists]],
                names=schema.names)

    return rows.mapInArrow(run, schema)


def estimate(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: P(true) of each row, and each labeler's reliability.

    A vote is right with its labeler's reliability, whichever the truth; a labeler's silence
    says nothing. Each kind has its own share of true candidates.
    """
    good, share = np.full(LABELERS, 0.8), np.full(len(KINDS), 0.5)
    spoke = vote != 0
    for _ in range(rounds):
        odds = np.log(good / (1 - good))
        p = 1 / (1 + np.exp(-(np.log(share / (1 - share))[kind] + vote @ odds)))
        right = np.where(vote > 0, p[:, None], 1 - p[:, None]) * spoke
        new = ((right * n[:, None]).sum(0) + 8) / ((spoke * n[:, None]).sum(0) + 10)
        part = np.bincount(kind, weights=p * n, minlength=len(KINDS)) + 1
        share = part / (np.bincount(kind, weights=n, minlength=len(KINDS)) + 2)
        done = np.abs(new - good).max() < 1e-9
        good = np.clip(new, 0.55, 0.999)
        if done:
            break
    return p, good


def features(kind: np.ndarray, vote: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return np.column_stack([np.eye(len(KINDS))[kind], vote > 0, vote < 0, shape & 1, shape >> 1]).astype(float)


def train(x: np.ndarray, p: np.ndarray, n: np.ndarray, steps: int = 50, penalty: float = 1.0) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + penalty * np.eye(len(w)),
                               x.T @ (n * (p - q)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """doc_id, key, kind, start, end, base (parallel lists): base spans and the accepted others."""
    rows = cut(candidates(docs, id_col, text_col))
    tally = rows.select(F.explode("cell").alias("cell")).groupBy("cell").count().collect()      # under CELLS rows
    taken: set[int] = set()
    if tally:
        cells, n = np.array([r[0] for r in tally]), np.array([r[1] for r in tally], dtype=float)
        kind, vote, shape = unpack(cells)
        p, _ = estimate(kind, vote, n)
        x = features(kind, vote, shape)
        w = train(x, p, n)
        taken = set(cells[1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) >= accept].tolist())
    schema = T.StructType([f for f in rows.schema.fields if f.name != "cell"])

    def run(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("kind", "start", "end", "base", "cell")]
            lists = [[] for _ in range(4)]
            for spans in zip(*cols):
                kept = sorted(x[:4] for x in zip(*spans) if x[3] or x[4] in taken)
                for col, at in zip(lists, range(4)):
                    col.append([x[at] for x in kept])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), *[pa.array(x, pa.list_(pa.int32())) for x in lists]],
                names=schema.names)

    return rows.mapInArrow(run, schema)
