"""Main text of a web page by composite text density.

A lenient parser builds the tree of a page. Elements that are boilerplate by their very kind (menus,
scripts, hidden parts and so on) are taken out of it; forms and elements with the name of boilerplate are too, unless
they hold most of the page's text. For every node the composite text density is
its characters per tag, adjusted for how many of both belong to links; a node's density sum adds up
the densities of its children (inline markup counts as tags, but is no structure to sum over). The subtree with the largest sum is the core of the article. The
smallest density on the path from it to the body is the threshold from which other subtrees
belong to the article too.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import text_blocks

# Element names of the markup language by their role.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
    "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]),
    "tfoot": frozenset(["thead", "tbody", "tr", "td", "th"]),
}
#: An open element of the first kind is not looked for beyond one of the second.
SCOPES = frozenset("article aside blockquote body div dl fieldset footer form header html main nav ol section table ul".split())
# What is boilerplate by its element or role, or by a class or id of such words.
DROPPED = frozenset(
    "aside button canvas datalist dialog footer head iframe input math menu nav noscript object script select "
    "style svg template textarea audio video".split()
)
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs captcha comment commentlist comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr login menu modal nav navbar navigation newsletter "
    "notice notices notification pagination pager popup promo promotion recommended related respond share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
# The words of DROPPED_WORDS that name reader comments, notices and adverts; these go at any size.
EXCLUDED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense captcha comment commentlist comments consent cookie cookies "
    "disqus gdpr modal newsletter notice notices notification popup promo promotion respond signup sponsor sponsored "
    "subscribe subscription".split()
)
#: Words that a class or id of boilerplate may have besides.
NEUTRAL_WORDS = frozenset(
    "area bar bottom box block button buttons container global inner item items left link links list main outer page primary "
    "right secondary section site slot top unit wrap wrapper".split()
)
#: An article or main element with this share of a page's text beside a larger form or named element is the article.
ARTICLE_SHARE = 0.2
KEPT = frozenset("html body main article p h1 h2 h3 h4 h5 h6 pre blockquote".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def is_boilerplate(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether the element is boilerplate for certain, whether by a layout name or as a form, and whether by a
    name of reader comments, notices or adverts (such a name decides inside an article too)."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True, False, False
    named, excluded = tag == "form", False
    if not attributes:
        return False, named, False
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False, False
        if name == "style" and _HIDING.search(value):
            return True, False, False
        if tag in KEPT:
            continue
        if name == "role" and value in DROPPED_ROLES:
            return True, False, False
        if name in ("class", "id"):
            for token in value.split():
                words = _names_boilerplate(token, in_article)
                excluded = excluded or bool(words & EXCLUDED_WORDS)
                named = named or bool(words)
    return False, named and not excluded, excluded


def _names_boilerplate(token: str, in_article: bool) -> frozenset[str]:
    """The boilerplate words of a whole class or id token, if all its other words are neutral; else none."""
    rest = set(_WORD.findall(token)) - NEUTRAL_WORDS
    known = DROPPED_WORDS if in_article else DROPPED_WORDS | {"header"}
    return frozenset(rest) if rest <= known else frozenset()


class Page:
    """The tree of a page as columns: nodes are numbered in page order, so a subtree is a range.

    ``parents``, ``tags`` and ``ends`` (one past the subtree) describe the nodes; ``runs`` holds the
    texts as ``(node, block, text)``, where a block is what lies between two block boundaries. ``named`` are the
    nodes that are boilerplate by a layout name or as forms; once all is read, they are ``dropped`` if they are minor.
    ``excluded`` are the nodes named as reader comments, notices or adverts: they go at any size, unless nothing
    would be left of the page."""

    def __init__(self, source: str):
        self.tags, self.parents, self.ends, self.dropped = ["body"], [-1], [0], [False]
        self.runs: list[tuple[int, int, str]] = []
        self.named: list[int] = []
        self.excluded: list[int] = []
        self._block = 0
        self._stack = [0]
        self._articles = 0
        self._read(source)
        while self._stack:
            self._close()
        self.linked = [False] * len(self.tags)
        for node in range(1, len(self.tags)):
            self.linked[node] = self.tags[node] == "a" or self.linked[self.parents[node]]
        if self.named or self.excluded:
            self._drop_named()

    def _drop_named(self) -> None:
        """Drop the subtrees of comments, notices and adverts, and the layout-named subtrees, but keep the latter
        if they hold most of the page's text outside links, unless the article is plain to see beside them;
        if no text were left, keep all."""
        n = len(self.tags)
        plain = [0] * n
        for node, _, text in self.runs:
            if not self.dropped[node] and not self.linked[node]:
                plain[node] += sum(map(len, text.split()))
        texts = plain[:]
        for node in range(n - 1, 0, -1):
            plain[self.parents[node]] += plain[node]
        major = {node for node in self.named if 2 * plain[node] > plain[0]}
        minor = set(self.named) - major | set(self.excluded)
        inside = [False] * n  # a minor subtree
        for node in range(1, n):
            inside[node] = node in minor or inside[self.parents[node]]
        articles = [
            i for i in range(1, n)
            if self.tags[i] in ("article", "main") and not inside[i] and plain[i] >= ARTICLE_SHARE * plain[0]
        ]
        dropped = self.dropped[:]
        for node in range(1, n):
            beside = node in major and any(i >= self.ends[node] or self.ends[i] <= node for i in articles)
            dropped[node] = dropped[node] or node in minor or beside or dropped[self.parents[node]]
        if any(size for size, gone in zip(texts, dropped, strict=True) if not gone):
            self.dropped = dropped

    def _open(self, tag: str, attributes: str) -> None:
        parent = self._stack[-1]
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.ends.append(node + 1)
        certain, named, excluded = is_boilerplate(tag, attributes, self._articles > 0)
        self.dropped.append(self.dropped[parent] or certain)
        if named:
            self.named.append(node)
        if excluded:
            self.excluded.append(node)
        self._stack.append(node)
        self._articles += tag == "article"

    def _close(self) -> None:
        node = self._stack.pop()
        self.ends[node] = len(self.tags)
        if self.tags[node] in BLOCKS:
            self._block += 1
        self._articles -= self.tags[node] == "article"

    def _close_through(self, names: frozenset[str] | tuple[str, ...], scopes: frozenset[str]) -> None:
        """Close the innermost open element of one of the names, unless a scope lies before it."""
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in names:
                while len(self._stack) > depth:
                    self._close()
                return
            if tag in scopes:
                return

    def _text(self, text: str) -> None:
        if text:
            self.runs.append((self._stack[-1], self._block, html.unescape(text) if "&" in text else text))

    def _read(self, source: str) -> None:
        at, scan = 0, _MARKUP.search
        while found := scan(source, at):
            self._text(source[at : found.start()])
            at = found.end()
            closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if name is None:
                continue  # a comment or declaration
            tag = name.lower()
            if closing:
                if tag in ("body", "html"):
                    continue  # what follows still belongs to the page
                self._close_through((tag,), SCOPES - {tag} if tag not in SCOPES else frozenset())
                continue
            if tag in ("html", "body"):
                continue
            if tag in BLOCKS:
                self._close_through(("p",), SCOPES)
                self._block += 1
            if tag in CLOSED_BY:
                while self.tags[self._stack[-1]] in CLOSED_BY[tag]:
                    self._close()
                self._close_through(CLOSED_BY[tag], SCOPES)
            self._open(tag, attributes)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else len(source)
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
                self._close()
                if tag == "br":
                    self._text(" ")
        self._text(source[at:])


def main_text(source: str | None) -> str:
    """The blocks of the main text, each with single blanks, joined by line breaks."""
    if not source:
        return ""
    page = Page(source)
    n = len(page.tags)
    linked = page.linked
    chars, link_chars, tag_count, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    all_chars = all_links = 0
    for node, _, text in page.runs:
        size = sum(map(len, text.split()))
        if page.dropped[node] and page.tags[node] in RAW:
            continue
        all_chars += size
        all_links += size * linked[node]
        if not page.dropped[node]:
            chars[node] += size
            link_chars[node] += size * linked[node]
    for node in range(n - 1, 0, -1):
        if page.dropped[node]:
            continue
        parent = page.parents[node]
        chars[parent] += chars[node]
        link_chars[parent] += link_chars[node]
        tag_count[parent] += tag_count[node] + 1
        link_tags[parent] += link_tags[node] + (page.tags[node] == "a")
    if not chars[0]:
        return ""
    share = all_links / max(all_chars, 1)
    density, sums = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        if page.dropped[node]:
            continue
        density[node] = _density(chars[node], tag_count[node], link_chars[node], link_tags[node], share)
        if node and page.tags[node] in BLOCKS:
            sums[page.parents[node]] += density[node]
    alive = [i for i in range(n) if not page.dropped[i] and chars[i]]
    core = max(alive, key=lambda i: (sums[i], -i))
    threshold, node = density[core], core
    while node > 0:
        node = page.parents[node]
        threshold = min(threshold, density[node])
    chosen = [False] * n
    _choose(page, 0, core, threshold, density, sums, chars, chosen)
    blocks: dict[int, list[str]] = {}
    for node, block, text in page.runs:
        if not page.dropped[node] and chosen[node]:
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(texts).split()) for texts in blocks.values())
    return "\n".join(b for b in joined if b)


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, lowered for links; zero denominators count as one. On a page without any link
    it is the plain ratio."""
    if not chars:
        return 0.0
    ratio = chars / max(tags, 1)
    if not share:
        return ratio
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    return ratio * max(0.0, math.log(chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1))) / math.log(base)


def _choose(page, top, core, threshold, density, sums, chars, chosen) -> None:
    """Mark the core, then, going down from the body, the subtree with the largest density sum in every
    node that is dense enough and not marked yet."""
    chosen[core : page.ends[core]] = [True] * (page.ends[core] - core)
    node = top
    while node < len(page.tags):
        if page.dropped[node] or not chars[node] or density[node] < threshold:
            node = page.ends[node]
            continue
        if chosen[node]:
            node = page.ends[node]
            continue
        inside = range(node, page.ends[node])
        if not any(chosen[node : page.ends[node]]):
            best = max((i for i in inside if not page.dropped[i] and chars[i]), key=lambda i: (sums[i], -i))
            chosen[best : page.ends[best]] = [True] * (page.ends[best] - best)
            if best == node:
                node = page.ends[node]
                continue
        node += 1


def extract(pages: DataFrame) -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars`` (code points of the text).

    Null and empty pages and pages without main text give an empty text; plain text without markup is
    taken whole. Nothing is cut for length. ``pages`` needs ``page_id, url`` and ``html``; other columns are
    not read. Repeated rows are extracted each; an empty table gives an empty result.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in text_blocks(batches, "html"):
            texts = [main_text(s) for s in sources]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(read, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
