"""Main text of web pages by tag-path ratios.

Every run of text has a path of tags from the root.  For each path of a page the
text length, the punctuation and the text inside links are added up over all its
runs; length and punctuation per run are smoothed over paths that follow each other
on the page, fused into one score, and paths above a threshold of the page are
content.  The smallest element that holds the content paths, or all article elements
with some, is the article; everything in it is kept in page order, however short,
except elements that by name are not article text, and blocks of links beside the
elements with content paths.

Defined cases: a null or empty page, or one without content, gives an empty text;
broken markup is read as browsers do in the usual cases (unclosed tags, missing
ends, stray `<`); repeated rows give repeated results; nested depth and length are
not limited; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by role.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr br img".split()
)
NOT_TEXT = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript template nav footer aside form"
    " select button option menu dialog svg math object audio video canvas map".split()
)
#: Class and id words that name page parts other than the article.
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices"
    " pagination pager popup promo promos promotion recommended related reply replies respond share sharing"
    " sidebar skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split()
)
ARTICLE = frozenset("article main".split())
PUNCTUATION = re.compile(r"[,.;:!?…、。，！？]")

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Parts of a class that say what stands beside, what heads an article, and what a page builder calls its text.
_LAYOUT = re.compile(r"(?<!\S)(?:has|no|with|without)[-_]\S+")
_OF_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content)[-_]+header(?![a-z])")
_TEXT_WIDGET = re.compile(r"[a-z]-widget-(?:text|heading|title|post|theme)")


@dataclass(eq=False)
class Element:
    label: str
    parent: "Element | None"
    #: Named elements from the root down to this one; inline elements have those of their parent.
    depth: int = 0
    dropped: bool = False
    article: "Element | None" = None
    #: The nearest element, this one or one around it, that a class or id word alone names as another page part.
    named: "Element | None" = None

    @cached_property
    def path(self) -> tuple[str, ...]:
        """Labels from the root; made for elements that hold text only, so depth alone costs nothing."""
        labels, e = [], self
        while e is not None and e.depth:
            if e.parent is None or e.depth > e.parent.depth:
                labels.append(e.label)
            e = e.parent
        return tuple(reversed(labels))


@dataclass
class Block:
    """Text between two block boundaries, with the element that holds it."""

    element: Element
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""


def _named_by_word(value: str, in_article: bool) -> bool:
    """Whether a class or id names another page part; what says how the page is laid out does not."""
    words = set(_WORD.findall(_LAYOUT.sub(" ", value)))
    found = NOT_TEXT_WORDS & words
    if in_article or _OF_ARTICLE.search(value):
        found = found - {"header"}
    if _TEXT_WIDGET.search(value):
        found = found - {"widget", "widgets"}
    return bool(found)


def _named_boilerplate(tag: str, attrs: str, in_article: bool, by_word: bool = True) -> bool:
    if tag in NOT_TEXT:
        return True
    if tag == "header":
        return not in_article
    if not attrs or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if by_word and name in ("class", "id") and _named_by_word(value, in_article):
            return True
        if name == "role" and value in NOT_TEXT_ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    """All blocks outside dropped elements, in page order, texts decoded and cleaned."""
    root = Element("", None)
    stack: list[tuple[str, Element]] = [("", root)]
    links = at = 0
    found: list[Block] = []
    block: Block | None = None

    def close(tag: str) -> None:
        nonlocal block, links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                if any(t not in INLINE for t, _ in stack[i:]):
                    block = None
                links -= sum(t == "a" for t, _ in stack[i:])
                del stack[i:]
                return
            if tag in INLINE and stack[i][0] not in INLINE:
                return
        if tag == "p":
            block = None

    while at < len(page):
        match = _TOKEN.match(page, at)
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        if not tag:
            piece = match[0]
            if piece[0] == "<" and len(piece) > 1 and not piece.startswith("<![CDATA["):
                continue
            if piece.startswith("<![CDATA["):
                piece = piece[9:].removesuffix("]]>")
            element = stack[-1][1]
            if element.dropped:
                continue
            if block is None:
                if piece.isspace():
                    continue
                block = Block(element)
                found.append(block)
            block.parts.append(piece)
            if links > 0:
                block.link_chars += len(piece)
            continue
        attrs = match["attrs"] or match["attrs2"] or ""
        if match["end"] or match["end2"]:
            close(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag not in INLINE and tag not in NOT_TEXT:
                block = None
            continue
        parent = stack[-1][1]
        if tag in INLINE:
            if tag == "br":
                if block is not None:
                    block.parts.append(" ")
                continue
            if tag in VOID:
                continue
            if tag == "a":
                links += 1
            inner = parent
            if not parent.dropped and attrs and _named_boilerplate(tag, attrs, True):
                inner = Element(tag, parent, parent.depth, True, parent.article, parent.named)
            stack.append((tag, inner))
            continue
        block = None
        if tag in VOID:
            continue
        for closed_by in (("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)):
            if tag in closed_by:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in ("ul", "ol", "dl", "table", "select"):
                        break
                    if stack[i][0] in closed_by:
                        close(stack[i][0])
                        break
        if any(t == "p" for t, _ in stack):  # a block starts: an open paragraph ends
            close("p")
        parent = stack[-1][1]
        kind = _ATTR.search(attrs) if "class" in attrs.lower() else None
        label = f"{tag}.{(kind[2] or kind[3] or kind[4] or '').lower()}" if kind and kind[1].lower() == "class" else tag
        element = Element(label, parent, parent.depth + 1)
        element.article = element if tag in ARTICLE else parent.article
        in_article = parent.article is not None
        element.dropped = parent.dropped or _named_boilerplate(tag, attrs, in_article, by_word=False)
        by_word = not element.dropped and _named_boilerplate(tag, attrs, in_article)
        element.named = element if by_word else parent.named
        if not attrs.endswith("/"):
            stack.append((tag, element))
    for block in found:
        block.text = _SPACE.sub(" ", html.unescape("".join(block.parts))).strip()
    return _without_named([b for b in found if b.text])


def _without_named(blocks: list[Block]) -> list[Block]:
    """The blocks outside elements that a class or id word names as other parts.

    A word is no proof: what stands around the article that holds most of the text stays,
    and, on a page without article text elsewhere, an element that holds most of the text
    outside links.  Articles outside all such elements come before those inside, which may
    be comments or cards.
    """
    held: dict[Element, int] = {}
    articles: dict[Element, int] = {}
    total = 0
    for b in blocks:
        plain = max(0, len(b.text) - b.link_chars)
        total += plain
        article = b.element.article
        if article is not None:
            articles[article] = articles.get(article, 0) + plain
        e = b.element.named
        while e is not None:
            held[e] = held.get(e, 0) + plain
            e = e.parent.named
    around: set[Element] = set()
    if articles:
        main = max(articles, key=lambda a: (a.named is None, articles[a]))
        e = main.named
        while e is not None:
            around.add(e)
            e = e.parent.named
    free_article = any(b.element.article is not None and (b.element.named is None or b.element.named in around) for b in blocks)
    dropped = {e for e, n in held.items() if e not in around and (free_article or 2 * n <= total)}

    def stays(e: Element | None) -> bool:
        while e is not None:
            if e in dropped:
                return False
            e = e.parent.named
        return True

    return [b for b in blocks if stays(b.element.named)]


def path_scores(blocks: list[Block], width: float = 1.0) -> dict[tuple[str, ...], float]:
    """Fused tag-path ratio of every path of a page.

    Text and punctuation per run of a path are smoothed with a Gaussian over the
    paths in the order in which they first occur, weighted by how much of the path
    two neighbours share; their product, less what lies in links, is the score.
    """
    text: dict[tuple[str, ...], list[float]] = {}
    for b in blocks:
        sums = text.setdefault(b.element.path, [0.0, 0.0, 0.0, 0.0])
        for i, x in enumerate((len(b.text), len(PUNCTUATION.findall(b.text)), b.link_chars, 1)):
            sums[i] += x
    paths = list(text)
    ratios = [(text[p][0] / text[p][3], text[p][1] / text[p][3]) for p in paths]
    reach, scores = int(3 * width), {}
    for i, p in enumerate(paths):
        total = smooth_text = smooth_marks = 0.0
        for j in range(max(0, i - reach), min(len(paths), i + reach + 1)):
            q = paths[j]
            shared = sum(1 for a, b in zip(p, q, strict=False) if a == b)
            near = (1 + shared) / (1 + max(len(p), len(q)))
            weight = math.exp(-((i - j) ** 2) / (2 * width**2)) * near**2
            total += weight
            smooth_text += weight * ratios[j][0]
            smooth_marks += weight * ratios[j][1]
        chars, _, linked, _ = text[p]
        plain = max(0.0, 1 - linked / max(1.0, chars))
        scores[p] = (smooth_text / total) * (1 + smooth_marks / total) * plain
    return scores


def _common(elements: set[Element]) -> Element:
    """The lowest element that holds all of them."""
    rest = iter(elements)
    common = next(rest)
    for e in rest:
        while common is not e:
            if common.depth < e.depth:
                e = e.parent
            elif common.depth > e.depth:
                common = common.parent
            else:
                common, e = common.parent, e.parent
    return common


def main_text(page: str | None, share: float = 0.1) -> str:
    """The article of one page; paths from `share` of the best score up are content."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    scores = path_scores(blocks)
    best = max(scores.values())
    content = {p for p, s in scores.items() if s > 0 and s >= share * best}
    found = [b.element for b in blocks if b.element.path in content]
    if not found:
        return ""
    # an article element is a stronger sign than any length
    articles = {e.article for e in found if e.article}
    holders = articles or {e.parent or e for e in found}
    chosen = articles or {_common(holders)}
    parts = {h for h in holders if h.label.partition(".")[0] not in ("", "html", "body")}

    def inside(e: Element | None, some: set[Element]) -> bool:
        while e is not None:
            if e in some:
                return True
            e = e.parent
        return False

    kept = [
        b.text for b in blocks
        if inside(b.element, chosen)
        and (b.element.path in content or b.link_chars * 2 <= len(b.text) or inside(b.element, parts))
    ]
    return "\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
