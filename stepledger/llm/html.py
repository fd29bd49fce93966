"""Main text of web pages by composite text density.

A page is parsed into nodes with their characters, link characters, tags and
link tags. The composite density of a node is its characters for each tag,
weighted by how few of both are links against the share of links in the body.
The node whose children have the largest sum of densities holds the content.
What a block has directly, its text with bold or broken lines in it, is one
child of it, so a paragraph never outweighs the blocks around it by its inline
mark-up. The smallest density on the path from the body to this node is the
threshold that other parts beside the path have to reach, blocks and what the
nodes of the path have directly.

Parts that mark-up declares as no content (menus, footers, adverts, comments
and so on) count neither as characters nor as tags. A class or id declares it
by a whole name (``cookie-notice``), not by a word in one (``has-sidebar``).
Such a part stays out however much text it has: an article may be empty beside
an advert. No element's name is taken for content.

Parsing takes time in proportion to the page, whatever is left unclosed.

Defined results: null and empty html give an empty text, as does a page
without text; columns other than page_id, url and html are not read; each row
gives one row, repeated or not.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import slices

# Fixed values of HTML: element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body br_ caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SCOPE = frozenset("button caption html object table td template th".split())
SIBLINGS = {"li": "li", "dd": "dd dt", "dt": "dd dt", "option": "option", "tr": "tr td th", "td": "td th", "th": "td th", "tbody": "tbody thead tfoot tr td th", "tfoot": "tbody thead tfoot tr td th"}
LISTS = {"li": "ul ol menu", "dd": "dl", "dt": "dl", "option": "select datalist", "tr": "table", "td": "table", "th": "table", "tbody": "table", "tfoot": "table"}
DROPPED = frozenset("aside audio button canvas datalist dialog embed footer form head iframe input menu nav noembed noframes noscript object script search select style svg template textarea title video xmp".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright dialog disqus footer form masthead menu modal nav navbar navigation newsletter notice notification pagination pager popup popover promo promoted promotion related respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that a name of no content may have besides.
NEUTRAL = frozenset("area bar block bottom box container inner item items links list panel posts section site top unit wrapper".split())
ARTICLE_NAMES = frozenset("article content entry post story".split())
HEADER = frozenset(["header"])

MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+))")
#: What a tag has up to its end or a quotation mark without a second one.
INSIDE = re.compile(r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[a-z]+")
#: The least logarithm of the density's base; a body without links would give 0.
LEAST_LOG = 0.1


def named(value: str, names: frozenset[str]) -> bool:
    """Whether one of the names in a class or id consists of these words, at least one, and neutral ones."""
    for name in value.split():
        parts = NAME_PARTS.findall(name)
        if not names.isdisjoint(parts) and all(p in names or p in NEUTRAL for p in parts):
            return True
    return False


def declared_boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element's name, role, class or id says that it is no content."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes or len(attributes) < 4 or tag in ("body", "html", "article", "main") and "hidden" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return True
        if name == "role" and not DROPPED_ROLES.isdisjoint(value.split()):
            return True
        if name in ("class", "id"):
            if named(value, DROPPED_NAMES) or (not in_article and named(value, HEADER) and ARTICLE_NAMES.isdisjoint(NAME_PARTS.findall(value))):
                return True
    return False


class Page:
    """The nodes of a page in document order, and its text between them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.last = ["#"], [-1], [0]
        self.chars, self.link_chars, self.tags, self.link_tags = [0], [0], [0], [0]
        #: The same for what a block has directly, inline elements included; the block of each node.
        self.own: list[list[int]] = [[0, 0, 1, 0]]
        self._block = [0]
        #: (node, text), or None where a block begins or ends
        self.events: list[tuple[int, str] | None] = []
        #: Open elements, and by tag their places among these.
        self._stack, self._open = [0], {"#": [0]}
        self._drop, self._link, self._article = [False], [False], [False]
        self._read(html)
        while self._stack:
            self._pop()
        for i in range(len(self.tag) - 1, 0, -1):
            up = self.parent[i]
            for total in (self.chars, self.link_chars, self.tags, self.link_tags):
                total[up] += total[i]

    def _read(self, html: str) -> None:
        at, size, last = 0, len(html), html.rfind(">")
        patience = 4 * size  # characters that may be read in vain for the ends of quotations
        while at < size:
            found = MARKUP.search(html, at)
            if not found or (found.end() > last and not found[1]):
                self._text(html[at:])
                return
            if found.start() > at:
                self._text(html[at : found.start()])
            comment, other, slash, name = found.groups()
            if comment:
                end = html.find("-->", found.end())
                at = size if end < 0 else end + 3
                continue
            end = found.end()
            if html[end] != ">":
                if not other and patience > 0:
                    end = INSIDE.match(html, end).end()
                if html[end : end + 1] != ">":
                    patience -= 0 if other else size - found.end()
                    end = html.find(">", found.end())
            at = end + 1
            if other:
                continue
            tag = name.lower()
            if slash:
                self._end(tag)
                continue
            self._start(tag, html[found.end() : end])
            if tag in RAW:
                closing = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
                at = closing.end() if closing else size
                self._end(tag)

    def _pop(self) -> None:
        node = self._stack.pop()
        self.last[node] = len(self.tag) - 1
        self._open[self.tag[node]].pop()
        if self.tag[node] in BLOCK:
            self.events.append(None)

    def _close(self, tags, barrier) -> None:
        """Close the innermost of these elements unless one of the barrier is further in."""
        k = max((self._open[t][-1] for t in tags if self._open.get(t)), default=0)
        if k > max((self._open[t][-1] for t in barrier if self._open.get(t)), default=0):
            while len(self._stack) > k:
                self._pop()

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._close(("p",), SCOPE)
        if tag in SIBLINGS:
            for _ in range(3 if tag in ("tr", "tbody", "tfoot") else 1):
                self._close(SIBLINGS[tag].split(), LISTS[tag].split())
        up = self._stack[-1]
        drop = self._drop[up] or declared_boilerplate(tag, attributes, self._article[up])
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        self.last.append(node)
        link = self._link[up] or tag == "a"
        self.chars.append(0)
        self.link_chars.append(0)
        self.tags.append(0 if drop else 1)
        self.link_tags.append(int(tag == "a" and not drop))
        self.own.append([0, 0, 1, 0])
        self._block.append(node if tag in BLOCK else self._block[up])
        if tag not in BLOCK and not drop:
            own = self.own[self._block[up]]
            own[2] += 1
            own[3] += tag == "a"
        self._drop.append(drop)
        self._link.append(link)
        self._article.append(self._article[up] or tag in ("article", "main"))
        if tag in BLOCK:
            self.events.append(None)
        elif tag == "br":
            self.events.append((up, " "))
        if tag not in VOID:
            self._open.setdefault(tag, []).append(len(self._stack))
            self._stack.append(node)

    def _end(self, tag: str) -> None:
        if self._open.get(tag):
            while self.tag[self._stack[-1]] != tag:
                self._pop()
            self._pop()

    def _text(self, raw: str) -> None:
        node = self._stack[-1]
        if self._drop[node]:
            return
        text = unescape(raw) if "&" in raw else raw
        self.events.append((node, text))
        n = len(text.strip())
        own = self.own[self._block[node]]
        self.chars[node] += n
        own[0] += n
        if self._link[node]:
            self.link_chars[node] += n
            own[1] += n

    def density(self, counts: tuple[int, int, int, int], body: int) -> float:
        """The composite text density of something with these characters, link characters, tags and link tags."""
        c, links, t, link_t = counts
        if not c:
            return 0.0
        base = log(log(c / max(1, c - links) * links + self.link_chars[body] / max(1, self.chars[body]) * c + e))
        return c / max(1, t) * log(max(e, c / max(1, links) * max(1, t) / max(1, link_t))) / max(LEAST_LOG, base)

    def content(self) -> tuple[list[int], list[int]]:
        """The nodes whose subtrees are the main text, and those of which only what they have directly is."""
        if not self.chars[0]:
            return [], []
        body = self.tag.index("body") if "body" in self.tag else 0
        if not self.chars[body]:
            body = 0
        inside = range(body, self.last[body] + 1)
        density = {i: self.density((self.chars[i], self.link_chars[i], self.tags[i], self.link_tags[i]), body) for i in inside}
        own = {i: self.density(tuple(self.own[i]), body) if self._block[i] == i else 0.0 for i in inside}
        sums = dict(own)
        for i in inside[1:]:
            if self._block[i] == i:
                sums[self.parent[i]] += density[i]
        best = max(inside, key=lambda i: (sums[i], -i))
        path = [best]
        while path[-1] != body:
            path.append(self.parent[path[-1]])
        threshold, on_path = min(density[i] for i in path), set(path)
        beside = [i for i in inside[1:] if i not in on_path and self._block[i] == i and self.parent[i] in on_path and self.parent[i] != best and density[i] >= threshold]
        return [best, *beside], [i for i in path if i != best and own[i] >= threshold]

    def text(self) -> str:
        """The blocks of the content, one on each line."""
        kept, (whole, direct) = bytearray(len(self.tag)), self.content()
        for i in whole:
            kept[i : self.last[i] + 1] = b"\1" * (self.last[i] + 1 - i)
        direct = set(direct)
        blocks, parts = [], []
        for event in [*self.events, None]:
            if event is None:
                if parts and (block := " ".join("".join(parts).split())):
                    blocks.append(block)
                parts = []
            elif kept[event[0]] or self._block[event[0]] in direct:
                parts.append(event[1])
        return "\n".join(blocks)


def main_text(html: str | None) -> str:
    """The main text of one page."""
    return Page(html).text() if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        for batch in slices(batches):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
