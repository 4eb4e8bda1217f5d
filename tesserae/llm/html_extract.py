"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tesserae.llm.common import map_rows, table

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>"'<=]*)((?:"[^"]*"|'[^']*'|[^>"'])*+|[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z0-9]+")
#: Sentence marks of many scripts.
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？؟،]")

# Fixed values from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Start tags that end an open <p>.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: Start tags that end an open element of these names, within the containers named last.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)), "body": (("head",), ("html",))}

#: Elements that by the standard hold no article text wherever they stand.
OUTSIDE = frozenset("head nav footer aside form button select option textarea script style noscript template iframe svg canvas dialog menu object audio video datalist fieldset title".split())
#: The same, unless inside the article.
HEADER = frozenset("header hgroup".split())
#: Elements that by the standard hold the main content; texts in them weigh so much more.
BODY, BODY_WEIGHT = frozenset("article main".split()), 50
#: Share of the content's weight that the chosen node holds.
HOLD = 0.6
#: Words in class, id or role of reader comments, which read like an article and so can't be told by ratios.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())


class Block:
    __slots__ = ("path", "text", "links", "outside")

    def __init__(self, path: tuple[str, ...], text: str, links: int, outside: bool):
        self.path, self.text, self.links, self.outside = path, text, links, outside


def _attributes(source: str) -> tuple[tuple[str, ...], bool]:
    """(class words, whether the element is something else than the article)"""
    if not source or source.isspace():
        return (), False
    words: list[str] = []
    outside = False
    classes: tuple[str, ...] = ()
    for name, a, b, c in _ATTR.findall(source):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            found = _NAME.findall(html.unescape(value).lower())
            words += found
            if name == "class":
                classes = tuple(found)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.lower().replace(" ", ""):
            outside = True
    return classes, outside or any(w in COMMENTS for w in words)


def blocks(page: str) -> list[Block]:
    """Stretches of text between block tags, in order, each with its path of block elements from the root."""
    out: list[Block] = []
    stack: list[tuple[str, str, bool]] = []  # name, label in paths, outside
    held: list[str] = []
    links = depth_a = 0

    def flush():
        nonlocal links
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Block(tuple(s[1] for s in stack if s[0] not in INLINE), text, links, any(s[2] for s in stack)))
            held.clear()
        links = 0

    def close(k: int):
        nonlocal depth_a
        gone = stack[k:]
        if any(s[0] not in INLINE for s in gone):
            flush()
        depth_a -= sum(s[0] == "a" for s in gone)
        del stack[k:]

    def last(names: Sequence[str], stops: Sequence[str] = ()) -> int:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stops:
                return -1
        return -1

    def say(text: str):
        nonlocal links
        if text:
            held.append(text)
            if depth_a > 0:
                links += len(text)

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            k = last((name,), ("article", "main", "body") if name in INLINE else ())
            if k >= 0:
                close(k)
            elif name not in INLINE:
                flush()
            continue
        if name in ENDS_P and (k := last(("p",), ("table", "td", "th", "button", "article", "div", "section"))) >= 0:
            close(k)
        if name in ENDS:
            names, stops = ENDS[name]
            while (k := last(names, stops)) >= 0:
                close(k)
        if name in ("br", "hr") or name not in INLINE and name not in VOID:
            if name == "br":
                say(" ")
            else:
                flush()
        if name in VOID or m[3].endswith("/") and name in ("svg", "path", "g"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*/?>|\Z", re.I).search(page, at)
            at = max(end.end(), at)
            continue
        classes, outside = _attributes(m[3])
        inside = any(s[0] in BODY for s in stack)
        outside = outside or name in OUTSIDE or name in HEADER and not inside
        if name in INLINE and outside:
            flush()  # an inline advert is a block of its own
            name = "div"
        stack.append((name, ".".join((name, *classes)), outside))
        depth_a += name == "a"
    flush()
    return out


def path_scores(found: list[Block], spread: float = 1.0) -> dict[tuple[str, ...], float]:
    """Score of each path: text and punctuation per node, smoothed over the page, fused and weighed.

    All blocks of a path share their path's ratios. The page is then a series of ratios, one a block,
    which a Gaussian of deviation ``spread`` smooths; the two are fused by product, and a path's score is the mean
    over its blocks, times BODY_WEIGHT if it leads through one of BODY. Text in links doesn't count.
    """
    total: dict[tuple[str, ...], list[float]] = {}
    for b in found:
        own = total.setdefault(b.path, [0, 0, 0])
        own[0] += max(0, len(b.text) - b.links)
        own[1] += len(_PUNCTUATION.findall(b.text)) if b.links < len(b.text) else 0
        own[2] += 1
    ratio = [(total[b.path][0] / total[b.path][2], total[b.path][1] / total[b.path][2]) for b in found]
    reach = max(1, math.ceil(2 * spread))
    kernel = [math.exp(-((k / spread) ** 2) / 2) for k in range(-reach, reach + 1)]
    sums: dict[tuple[str, ...], list[float]] = {}
    for i, b in enumerate(found):
        near = [(kernel[j - i + reach], *ratio[j]) for j in range(max(0, i - reach), min(len(found), i + reach + 1))]
        weight = sum(w for w, _, _ in near)
        chars, marks = sum(w * c for w, c, _ in near) / weight, sum(w * p for w, _, p in near) / weight
        own = sums.setdefault(b.path, [0, 0])
        own[0] += chars * (1 + marks)
        own[1] += 1
    return {p: s / k * (BODY_WEIGHT if _body(p) else 1) for p, (s, k) in sums.items()}


def _body(path: tuple[str, ...]) -> tuple[str, ...] | None:
    """The path of the innermost element of BODY on ``path``."""
    return next((path[: k + 1] for k in range(len(path) - 1, -1, -1) if path[k].split(".")[0] in BODY), None)


def content_paths(scores: dict[tuple[str, ...], float]) -> list[tuple[str, ...]]:
    """Paths that score at least the deviation of all scores, the best first (of equal ones the first in the page)."""
    mean = sum(scores.values()) / len(scores)
    threshold = math.sqrt(sum((s - mean) ** 2 for s in scores.values()) / len(scores))
    best = max(scores, key=scores.get)
    return [best, *(p for p in scores if scores[p] >= threshold and p != best)]


def container(found: list[Block], scores: dict[tuple[str, ...], float]) -> tuple[str, ...]:
    """The content node: the deepest element around the best path that holds HOLD of the weight of all content paths.

    A path weighs its score for each of its blocks. An element of BODY is taken whole if that node lies in it.
    """
    content = content_paths(scores)
    weight = dict.fromkeys(content, 0.0)
    for b in found:
        if b.path in weight:
            weight[b.path] += scores[b.path]
    best, least = content[0], HOLD * sum(weight.values())
    node = next((best[:k] for k in range(len(best) - 1, 0, -1) if sum(w for p, w in weight.items() if len(p) > k and p[:k] == best[:k]) >= least), ())
    whole = _body(best)
    return whole if whole and len(node) >= len(whole) else node


def extract(page: str | None) -> str:
    """The article of ``page``: its blocks, joined by line ends.

    Elements that by the HTML standard hold no article text, and reader comments, are set aside. Of the other
    tag paths the scores tell which are content, and these tell the node that holds the article; all its blocks
    are taken in order, so that headings and short items stay.
    """
    found = [b for b in blocks(page or "") if not b.outside]
    if not found:
        return ""
    node = container(found, path_scores(found))
    return "\n".join(b.text for b in found if b.path[: len(node)] == node)


def main_text(pages: DataFrame, carry: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """text (the main text of the html) and n_chars (its code points) beside the columns in ``carry`` (with _carry_
    before a name of these).

    A null or empty page, or one without article text, gives an empty text; broken markup is read on as a
    browser would; equal rows get equal results; an empty table gives no rows.
    """

    def one(page):
        text = extract(page)
        return text, len(text)

    schema = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])
    return map_rows(pages, one, ["html"], schema, "text string, n_chars long", carry, step=128)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
