"""The main text of web pages by composite text density.

A page becomes a tree of nodes. Parts that are no content by their element are
left out. Forms, roles, words in a class and articles after the text of another
article are votes against a node; they do not count against one that holds the
page's article or nearly all of its text. For every node left the density is its characters
per tag, adjusted for links: text in links counts against a node, all the more
so on pages with few links. A node's sum is the densities of its children. The
node of largest sum is content; the least density on its path from the body is
the threshold, and every node that reaches it marks the node of largest sum
below itself as content too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayscope.llm.batches import bound_batches

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody tfoot thead tr ul".split()
)
#: Starting one of these ends an open paragraph.
ENDS_PARAGRAPH = BLOCKS - frozenset("body caption html legend tbody tfoot thead tr dd dt li".split())
#: Starting the first ends any of the second, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_HEADINGS = BLOCKS - HEADINGS
PARAGRAPH, LINK = frozenset(["p"]), frozenset(["a"])
AROUND_PARAGRAPH = frozenset("button td th table article section div li blockquote".split())

# What is no content: elements. What speaks against it: roles, and words in a class or id.
LEFT_OUT = frozenset(
    "aside button canvas dialog embed footer head iframe input label link menu meta nav noscript object script "
    "search select style svg template textarea title".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
WORDS = frozenset(
    "ad ads adslot adsense advert adverts advertisement advertising advertisment aside banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies disclaimer disqus discussion footer gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification outbrain pager pagination popup promo promotion "
    "promotions related replies reply respond share sharing sidebar sidenav signup skip social sponsor sponsored "
    "sponsors subscribe subscription taboola toolbar topbar widget widgets".split()
)
#: A class that begins so tells what a node has about it, not what it is.
TELLING = frozenset("has no with without".split())
#: A vote unless inside an article, where they hold its title.
PAGE_HEADERS = frozenset("header hero".split())
#: Never judged by class: they hold the content itself.
WHOLE = frozenset("html body main article".split())

#: Plain characters left beside a node of nearly all text: labels, no article.
FEW_CHARS = 100
#: How many times these a node must hold to be kept against a vote.
NEARLY_ALL = 10

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Tree(HTMLParser):
    """Nodes in page order, with their parents; texts with the node they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.out, self.votes = ["body"], [-1], [False], [False]
        self.open = [0]
        self.depths: dict[str, list[int]] = {}  # of each open element, by name
        self.block_depths: list[int] = []
        self.events: list[tuple[int, str]] = []  # a text, or a node's start ("\0") or end ("\1")
        self.articles: list[bool] = []  # of each open one: has it text yet, headings apart?
        self.in_heading = 0

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata[i:i + 3] == "<![":
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.open.pop()
            tag = self.tags[node]
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.block_depths.pop()
            self.events.append((node, "\1"))
            self.in_heading -= tag in HEADINGS
            if tag == "article":
                self.articles.pop()

    def _last(self, tags: frozenset | set) -> int:
        """Depth of the innermost open element of these names; 0 if none is open."""
        if tags is BLOCKS:
            return self.block_depths[-1] if self.block_depths else 0
        found = 0
        for tag in tags:
            if (depths := self.depths.get(tag)) and depths[-1] > found:
                found = depths[-1]
        return found

    def _close_one(self, ended: frozenset | set, until: frozenset | set) -> None:
        depth = self._last(ended)
        if depth and depth > self._last(until):
            self._close(depth)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body") and len(self.open) == 1:
            self.out[0] = self.out[0] and tag == "html"
            return
        if tag in ENDS_PARAGRAPH:
            self._close_one(PARAGRAPH, AROUND_PARAGRAPH)
        if tag in ENDS:
            self._close_one(*ENDS[tag])
        if tag in HEADINGS:
            self._close_one(HEADINGS, NO_HEADINGS)
        if tag == "a":
            self._close_one(LINK, BLOCKS)
        parent = self.open[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.out.append(self.out[parent] or self._left_out(tag, attrs))
        self.votes.append(self._voted_out(tag, attrs))
        node = len(self.tags) - 1
        self.events.append((node, "\0"))
        if tag in VOID:
            self.events.append((node, "\1"))
        else:
            self.depths.setdefault(tag, []).append(len(self.open))
            if tag in BLOCKS:
                self.block_depths.append(len(self.open))
            self.open.append(node)
            self.in_heading += tag in HEADINGS
            if tag == "article":
                self.articles.append(False)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        depth = self.depths[tag][-1] if self.depths.get(tag) else 0
        inline = tag not in BLOCKS and tag not in ("td", "th")
        if depth and not (inline and self._last(BLOCKS) > depth):
            self._close(depth)

    def handle_data(self, data: str) -> None:
        if not self.out[self.open[-1]]:
            self.events.append((self.open[-1], data))
            if self.articles and not self.in_heading and not data.isspace():
                self.articles[-1] = True

    def _left_out(self, tag: str, attrs: list) -> bool:
        if tag in LEFT_OUT or tag == "header" and not self.articles:
            return True
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
                return True
        return False

    def _voted_out(self, tag: str, attrs: list) -> bool:
        if tag == "form":
            return True
        if tag in WHOLE:
            return tag == "article" and bool(self.articles) and self.articles[-1]
        for name, value in attrs:
            value = value or ""
            if name == "role" and value.lower() in ROLES:
                return True
            if name in ("class", "id"):
                named = ([w.lower() for w in _WORD.findall(one)] for one in value.split())
                words = {w for one in named if one and one[0] not in TELLING for w in one}
                if words & WORDS or words & PAGE_HEADERS and not self.articles and tag not in HEADINGS:
                    return True
        return False


def main_text(html: str | None) -> str:
    """The page's article: its blocks in page order, with an empty line between."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tree._close(1)
    _settle(tree)
    marked = _content(tree)
    return "\n\n".join(_blocks(tree, marked))


def _size(text: str) -> int:
    """Characters that are no white space."""
    return sum(map(len, text.split()))


def _settle(tree: _Tree) -> None:
    """Leave out the nodes with a vote against them, outermost first, but those that hold the content.

    A node is kept against the vote if an article or main element inside it, the page's
    largest, has at least as much plain text as all that no vote is against; or if it
    has most of the page's plain text and no more than a few labels are left beside it.
    """
    tags, parents, out, votes = tree.tags, tree.parents, tree.out, tree.votes
    n = len(tags)
    link, plain, free = [tag == "a" for tag in tags], [0] * n, [0] * n
    for i in range(1, n):
        link[i] = link[i] or link[parents[i]]
    for node, text in tree.events:
        if not link[node] and text not in ("\0", "\1"):
            plain[node] += _size(text)
    free[:] = plain
    for i in range(n - 1, 0, -1):
        plain[parents[i]] += plain[i]
        if not votes[i]:
            free[parents[i]] += free[i]
    rest = free[0]
    wholes = [i for i in range(1, n) if tags[i] in ("article", "main") and not votes[i] and not out[i]]
    largest = max(wholes, key=lambda i: (plain[i], -i), default=0)
    around, i = set(), parents[largest]
    while i > 0:
        around.add(i)
        i = parents[i]
    for i in range(1, n):
        if out[parents[i]]:
            out[i] = True
        elif votes[i] and not out[i]:
            kept = i in around and plain[largest] >= max(rest, 1) or (
                2 * plain[i] > plain[0] and plain[i] >= NEARLY_ALL * rest and rest < FEW_CHARS
            )
            out[i] = not kept
            if kept:
                rest += free[i]


def _content(tree: _Tree) -> list[bool]:
    """For each node: is it, or does it stand inside, content?"""
    tags, parents, out = tree.tags, tree.parents, tree.out
    n = len(tags)
    chars, count, link_chars, link_count = [0] * n, [0] * n, [0] * n, [0] * n
    link = [tag == "a" for tag in tags]
    for i in range(1, n):
        link[i] = link[i] or link[parents[i]]
    sums = [0.0] * n
    for node, text in tree.events:
        if text not in ("\0", "\1") and not out[node]:
            size = _size(text)
            chars[node] += size
            if link[node]:
                link_chars[node] += size
            elif tags[node] in BLOCKS or node == 0:
                sums[node] += size  # a text of its own is like a child with one tag
    for i in range(n - 1, 0, -1):
        if not out[i]:
            up = parents[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            count[up] += count[i] + 1
            link_count[up] += link_count[i] + (tags[i] == "a")
    page_links = link_chars[0] / max(1, chars[0])
    density = [0.0] * n
    for i in range(n):
        if chars[i] and not out[i]:
            plain = chars[i] - link_chars[i]
            base = math.log(chars[i] / max(1, plain) * link_chars[i] + page_links * chars[i] + math.e)
            ratio = chars[i] / max(1, link_chars[i]) * max(1, count[i]) / max(1, link_count[i])
            own = chars[i] / max(1, count[i])
            density[i] = own * math.log(max(ratio, 1.0)) / max(base, 1.0)
    for i in range(1, n):
        if not out[i]:
            sums[parents[i]] += density[i]
    # The node of largest sum at or below each node; of equal ones the outermost, then the first.
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        if not out[i]:
            up = parents[i]
            if sums[best[i]] > sums[best[up]] or sums[best[i]] == sums[best[up]] and best[up] != up and best[i] < best[up]:
                best[up] = best[i]
    top, threshold = best[0], math.inf
    i = top
    while i >= 0:
        threshold = min(threshold, density[i])
        i = parents[i]
    # The outermost article around each node, else the node itself.
    whole = list(range(n))
    for i in range(1, n):
        if tags[whole[parents[i]]] == "article":
            whole[i] = whole[parents[i]]
    marked, last = [False] * n, [0] * n
    for i in range(n):
        if not out[i] and chars[i] and density[i] >= threshold:
            content = whole[best[i]]
            marked[content] = True
            last[parents[content]] = max(last[parents[content]], content)
    for i in range(1, n):  # the titles above content
        marked[i] = marked[i] or tags[i] in HEADINGS and i < last[parents[i]]
    # Marks were also set on earlier nodes: carry all of them down.
    for i in range(1, n):
        marked[i] = (marked[i] or marked[parents[i]]) and not out[i]
    return marked


def _blocks(tree: _Tree, marked: list[bool]) -> Iterator[str]:
    held: list[str] = []
    for node, text in tree.events:
        if text in ("\0", "\1"):
            tag = tree.tags[node]
            if tag in BLOCKS:
                if block := " ".join("".join(held).split()):
                    yield block
                held = []
            elif tag in ("br", "td", "th"):
                held.append(" ")
        elif not tree.out[node]:
            held.append(text if marked[node] else " ")
    if block := " ".join("".join(held).split()):
        yield block


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty page has an empty text. Repeated rows are each read, null
    ids and addresses stay null, other columns are left behind.
    """
    bound_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(
        pages[id_col].cast("bigint").alias("page_id"), pages[url_col].cast("string").alias("url"),
        pages[html_col].cast("string").alias("html"),
    )
    return narrow.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
