"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. A line weighs the characters of its
text outside links; lines of page furniture (by element, role or class) weigh nothing. The
weights are summed over windows of ``WINDOW`` lines: the text begins where the sum surges above
zero and ends where it dives to zero again. Headings weigh their whole text, linked or not. Each
such run is judged by itself: it stays, without furniture lines, if it has a paragraph, a quotation
or the page's title (``_PROSE``), a line of a trusted article mark (below), or at least the weight of the links
and furniture in it and in the ``WINDOW - 1`` lines on either side (bare labels between link lists
go); the heaviest run always stays. Sums run over all lines of
every page. An article mark is a weight and a check: its lines weigh their links too, and kept lines
outside all marks go, but only where the heaviest mark outweighs all text outside marks (teaser
cards marked as articles do not drive out a body that is not).

Defined cases: null or empty html gives an empty text; unclosed or stray tags, comments and
quotes end at the next possible place; a furniture class does not count on an element that holds
an article mark or most of the text, nor any where they would take most of it; a page whose text is all furniture by its forms is
read again with forms allowed; a page without weight keeps nothing.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = frozenset("script style noscript template textarea svg iframe object canvas math title".split())
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in _RAW}
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    section select summary table tbody td tfoot th thead tr ul""".split())
_HOLDS = frozenset("""article aside blockquote button center dialog details div dl fieldset figure footer form head header
    li main menu nav ol p section select span table td tr ul""".split()) - {"p", "li", "td", "tr"}
_FURNITURE = frozenset("head nav footer aside form menu button select dialog".split())
_PROSE = frozenset("p blockquote pre h1".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_WORDS = ("ad|ads|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|consent|cookie"
          "|cookies|disclaimer|disqus|dropdown|footer|gdpr|login|masthead|menu|modal|nav|navbar|navigation|newsletter"
          "|notice|notification|overlay|pager|pagination|popup|promo|promotion|recommended|related|replies|share"
          "|sharing|sidebar|signup|social|sponsor|sponsored|subscribe|toolbar|widget")
_PLACE = ("area|bar|block|body|bottom|box|button|buttons|form|icon|icons|item|items|left|link|links|list|message|posts|primary|right"
          "|secondary|section|slot|stories|text|top|unit|[0-9]+")
# A furniture word ends the token or is followed by places only; wrapping words count right after it at the token's start.
_CLASS = re.compile(rf"(?!(?:.*[-_])?(?:has|with|no|without|is|not)[-_])"
                    rf"(?:(?:\w+?[-_])*?(?:{_WORDS})(?:[-_](?:{_WORDS}|{_PLACE}))*|(?:{_WORDS})[-_](?:container|inner|wrap|wrapper))\Z", re.I)
_HEADER = re.compile(r"(?:site|page|top|main)?[-_]?header\Z", re.I)


def _furniture(tag: str, attrs: str, in_article: bool, forms: bool) -> bool:
    """Whether an element is furniture by its tag or role."""
    if tag == "form":
        return not forms
    if tag in _FURNITURE:
        return True
    if tag == "header":
        return not in_article
    if tag in ("article", "main", "body", "html") and "comment" not in attrs:
        return False
    return any(token.lower() in _ROLES for name, *value in (_NAMED.findall(attrs) if "=" in attrs else ())
               if name.lower() == "role" for token in "".join(value).split())


def _classed(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element's class or id names furniture."""
    if "=" not in attrs or tag in ("article", "main", "body", "html") and "comment" not in attrs:
        return False
    return any(_CLASS.match(token) or (not in_article and _HEADER.match(token)) for name, *value in _NAMED.findall(attrs)
               if name.lower() != "role" for token in "".join(value).split())


def lines(page: str, forms: bool = False) -> list[tuple[str, int, bool, int, bool]]:
    """(text, weight, furniture, number of the outermost article mark or 0, prose) of each non-empty line.

    Furniture by class is decided at the end: an element that holds an article mark or most of the
    weight of the page is none, and where classes would take most of the weight, none counts. Beside
    a marked article these two need ``WINDOW`` lines: an advert may outweigh a short article.
    """
    out, buf, linked = [], [], 0
    stack: list[tuple[str, bool, bool, int]] = []              # containers: tag, furniture, article mark, number if classed
    bad = art = marks = 0
    over: list[int] = []                                       # open elements with a furniture class, by number
    holds: set[int] = set()                                    # those of them with an article mark inside
    classes, leaf_end = 0, 0                                   # the end of an open paragraph, item, cell or row of them
    in_link, block = False, ""                                 # the block element that the text is in
    at, end = 0, len(page)

    def put(raw: str):
        nonlocal linked
        text = entities.unescape(raw)
        buf.append(text)
        if in_link:
            linked += len("".join(text.split()))

    def flush():
        nonlocal linked
        text = " ".join("".join(buf).split())
        if text:
            full = len(text.replace(" ", ""))
            out.append((text, full if block in _HEADINGS else max(0, full - linked), bad > 0, marks if art else 0,
                        block in _PROSE and (block == "h1" or 2 * linked <= full), tuple(over)))
        buf.clear()
        linked = 0

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            put(page[at:])
            break
        if m.start() > at:
            put(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW:
            if not closing and not m[0].endswith("/>"):
                stop = _RAW_END[tag].search(page, at)
                at = stop.end() if stop else end
            continue
        if tag == "br":
            buf.append(" ")
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag in _BLOCK:
            flush()
            in_link, block = False, "" if closing else tag
        if leaf_end and at >= leaf_end:
            over.remove(leaf)
            leaf_end = 0
        if tag not in _HOLDS or m[0].endswith("/>"):
            if not closing and tag in ("p", "li", "td", "tr") and "=" in (m[3] or "") and not leaf_end:
                hard = _furniture(tag, m[3], art > 0, forms)
                if hard or _classed(tag, m[3], art > 0):
                    stop = re.compile(rf"</{tag}\s*>|<{tag}\b", re.I).search(page, at)
                    if stop and stop[0][1] == "/" and hard:
                        at = stop.end()
                    elif stop and stop[0][1] == "/":
                        classes += 1
                        leaf, leaf_end = classes, stop.end()
                        over.append(leaf)
            continue
        if not closing:
            is_bad, by_class = _furniture(tag, m[3] or "", art > 0, forms), _classed(tag, m[3] or "", art > 0)
            mark = tag in ("article", "main") and not by_class
            if (is_bad or by_class) and tag not in _BLOCK:
                flush()
            if mark and not bad:
                holds.update(over)
            if by_class:
                classes += 1
                over.append(classes)
            stack.append((tag, is_bad, mark, classes if by_class else 0))
            marks += mark and not art
            bad, art = bad + is_bad, art + mark
        elif any(s[0] == tag for s in stack):
            if (bad or over) and tag not in _BLOCK:
                flush()
            while stack:
                name, is_bad, mark, number = stack.pop()
                bad, art = bad - is_bad, art - mark
                if number:
                    over.remove(number)
                if name == tag:
                    break
    flush()
    total, inside, size = 0, Counter(), Counter()
    for _, w, f, _, _, numbers in out:
        if not f:
            total += w
            inside.update(dict.fromkeys(numbers, w))
            size.update(dict.fromkeys(numbers, w > 0))
    marked = any(w and a and not f and holds.issuperset(numbers) for _, w, f, a, _, numbers in out)
    large = {c for c in inside if size[c] >= WINDOW or not marked}
    free = holds | {c for c in large if 2 * inside[c] > total}
    lost = sum(w for _, w, f, a, _, numbers in out if not f and not free.issuperset(numbers) and (a or not large.isdisjoint(numbers)))
    return [(t, w, f or 2 * lost <= total and not free.issuperset(numbers), a, prose) for t, w, f, a, prose, numbers in out]


def _trusted(found: list[tuple[str, int, bool, int, bool]]) -> bool:
    """Whether the heaviest article mark has at least the weight of all text outside marks."""
    total = Counter()
    for _, w, f, a, _ in found:
        total[a] += 0 if f else w
    outside = total.pop(0, 0)
    return max(total.values(), default=0) >= max(outside, 1)


def main_text(page: str | None) -> str:
    """The kept lines, joined by an empty line."""
    for forms in (False, True):
        found = lines(page or "", forms)
        marked = _trusted(found)
        weight = [0 if f or not (marked and a or 2 * w >= len(t)) else len(t) if marked and a else w for t, w, f, a, _ in found]
        if any(weight):
            break
    else:
        return ""
    w = np.array([*weight, *[0] * (WINDOW - 1)])
    sums = np.convolve(w, np.ones(WINDOW, dtype=int), "valid")             # of each line and those after it
    runs = []
    i = 0
    while i < len(weight):
        if not weight[i]:                                      # surge: the first line with weight
            i += 1
            continue
        j = i
        while j < len(weight) and sums[j]:                     # dive: a window without weight
            j += 1
        runs.append((i, j))
        i = j

    def stays(i: int, j: int) -> bool:
        around = range(max(0, i - WINDOW + 1), min(len(weight), j + WINDOW - 1))
        return (any(weight[k] and (found[k][4] or marked and found[k][3]) for k in range(i, j))
                or sum(weight[i:j]) >= min(most, sum(len(found[k][0]) for k in around if not weight[k])))

    most = max(sum(weight[i:j]) for i, j in runs)              # the heaviest run stays
    kept = [k for i, j in runs if stays(i, j) for k in range(i, j)
            if not found[k][2] and (weight[k] or found[k][1]) and (found[k][3] or not marked)]
    return "\n\n".join(found[k][0] for k in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points): one row per page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(run, schema)
