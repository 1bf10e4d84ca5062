"""The main text of web pages, by composite text density.

A page becomes a tree of nodes. A node's density is its characters per tag, lowered where many of its characters or tags
belong to links, against the share of links in the whole body. The node whose children's densities sum to the most is
the selected subtree; the least density on its path up to the body is the threshold. From the body downwards, every
subtree that reaches the threshold gives its own node of the largest sum, with a heading right before it. If the selected node lies inside an article or
main element, that whole element is the text.

What is no running text by its tag, role or name (menus, sidebars, forms, scripts, reader comments) is no part of the tree.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Fixed values of HTML: elements without an end, whose contents are no markup, within a line, of the head, that end a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: An open element that a new one ends, and the elements beyond which that doesn't reach.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements around which the text goes on without a break.
UNBROKEN = INLINE | {"script", "style", "template", "noscript", "button"}
# What is not running text by its tag, its role, or one of its names.
NO_TEXT = frozenset("head nav footer aside form script style noscript template iframe object embed svg math canvas audio video map button select datalist input textarea dialog menu search title xmp noembed noframes".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NO_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead comment comments commentlist disqus "
    "respond cookie cookies consent gdpr notice alert banner popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations widget pagination pager skip".split()
)
#: Names that begin so tell what a whole page has, not what the element is.
ABOUT_PAGE = frozenset("has with no without is".split())
_NAME, _ATTRIBUTE = re.compile(r"[^\s/>]+"), re.compile(r"""([^\s/>="']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
HEADING = re.compile("h[1-6]$")
_WHOLE = frozenset(("html", "body", "main"))


class Tag(NamedTuple):
    name: str
    closing: bool
    attributes: str


def tokens(page: str) -> Iterator[Tag | str]:
    """The tags and the texts (references decoded) of a page, in order; comments and declarations are left out.

    Linear in the page: a quotation mark without its partner ends the reading of quotes, not the tag.
    """
    at, quotes = 0, True
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            start = len(page)
        if start > at:
            yield html.unescape(page[at:start])
        if start == len(page):
            return
        after = page[start + 1 : start + 3]
        if after.startswith(("!", "?")):
            comment = page.startswith("<!--", start)
            end = page.find("-->", start + 4) if comment else page.find(">", start)
            at = len(page) if end < 0 else end + (3 if comment else 1)
            continue
        closing = after.startswith("/")
        if not after[closing : closing + 1].isascii() or not after[closing : closing + 1].isalpha():
            yield "<"
            at = start + 1
            continue
        name = _NAME.match(page, start + 1 + closing)
        rest = _REST.match(page, name.end()) if quotes else None
        if rest is None:
            quotes, end = False, page.find(">", name.end()) + 1
            if not end:
                return
        else:
            end = rest.end()
        tag = Tag(name[0].lower(), closing, page[name.end() : end - 1])
        yield tag
        at = end
        if not closing and tag.name in RAW:
            close = re.compile(rf"</{tag.name}(?=[\s/>])", re.I).search(page, at)
            body_end = close.start() if close else len(page)
            if tag.name in ("textarea", "title"):
                yield html.unescape(page[at:body_end])
            at = body_end


def _no_text(tag: Tag) -> bool:
    if tag.name in NO_TEXT:
        return True
    if tag.name in _WHOLE or "=" not in tag.attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(tag.attributes):
        value = html.unescape("".join(values)).lower()
        if name.lower() == "role" and NO_TEXT_ROLES.intersection(value.split()):
            return True
        if name.lower() in ("class", "id"):
            for own in value.split():
                parts = re.split(r"[-_]+", own)
                if parts[0] not in ABOUT_PAGE and not NO_TEXT_NAMES.isdisjoint((own, parts[0], parts[-1])):
                    return True
    return False


class Tree:
    """The nodes of a page in order, each with its parent, and the texts with the node that holds each."""

    def __init__(self, page: str) -> None:
        self.tags, self.parents, self.dropped, self.pieces = ["body"], [-1], [""], []
        self.stack, self.open = [0], Counter()
        for token in tokens(page):
            if isinstance(token, str):
                if self.open["head"] and not self.open["title"] and token.strip():
                    self._close("head")
                self.pieces.append((self.stack[-1], token))
            elif token.name == "body" and not token.closing:
                self._close("head")
            elif token.name not in ("html", "body"):
                if token.closing:
                    self._close(token.name)
                else:
                    self._open(token)

    def _cut(self, k: int) -> None:
        """Ends all open elements from the k-th on."""
        for n in self.stack[k:]:
            self.open[self.tags[n]] -= 1
            if self.tags[n] not in UNBROKEN:
                self.pieces.append((self.parents[n], " "))
        del self.stack[k:]

    def _end(self, names: set[str], beyond: Callable[[str], bool]) -> None:
        """Ends the innermost open element of one of the names, unless one that is `beyond` reach holds it."""
        if any(self.open[name] for name in names):
            for k in range(len(self.stack) - 1, 0, -1):
                if (name := self.tags[self.stack[k]]) in names:
                    return self._cut(k)
                if beyond(name):
                    return None
        return None

    def _close(self, name: str) -> None:
        self._end({name}, (lambda other: other not in INLINE) if name in INLINE else (lambda other: False))

    def _open(self, tag: Tag) -> None:
        if self.open["head"] and tag.name not in IN_HEAD:
            self._close("head")
        if tag.name in CLOSES_P:
            self._end({"p"}, lambda other: other not in INLINE)
        if tag.name in SIBLINGS:
            ends, within = SIBLINGS[tag.name]
            self._end(ends, within.__contains__)
        if tag.name not in UNBROKEN:
            self.pieces.append((self.stack[-1], " "))
        self.tags.append(tag.name)
        self.parents.append(self.stack[-1])
        self.dropped.append("always" if tag.name in NO_TEXT else "named" if tag.name == "header" or _no_text(tag) else "")
        if tag.name not in VOID:
            self.stack.append(len(self.tags) - 1)
            self.open[tag.name] += 1

    def kept(self) -> list[bool]:
        """Whether a node and all above it are running text. Names and headers tell nothing where the title or an article lies inside, nor does a header of an article."""
        titled = [tag in ("h1", "article", "main") for tag in self.tags]
        for n in range(len(titled) - 1, 0, -1):
            titled[self.parents[n]] |= titled[n]
        out, inside = [True], [False]
        for n in range(1, len(titled)):
            above, tag = self.parents[n], self.tags[n]
            inside.append(inside[above] or tag in ("article", "main"))
            spared = titled[n] and tag not in ("h1", "article") or tag == "header" and inside[n]
            out.append(out[above] and (not self.dropped[n] or self.dropped[n] == "named" and spared))
        return out


def main_text(page: str) -> str:
    """The text of the page's main subtree, white space as single spaces; empty if there is none."""
    tree = Tree(page)
    kept, n = tree.kept(), len(tree.tags)
    chars, links, tag_count, link_tags, in_link = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for k in range(1, n):
        in_link[k] = in_link[tree.parents[k]] or tree.tags[k] == "a"
    for node, text in tree.pieces:
        if kept[node] and (size := len(" ".join(text.split()))):
            chars[node] += size
            links[node] += size * in_link[node]
    for k in range(n - 1, 0, -1):
        if kept[k]:
            above = tree.parents[k]
            chars[above] += chars[k]
            links[above] += links[k]
            tag_count[above] += tag_count[k] + 1
            link_tags[above] += link_tags[k] + (tree.tags[k] == "a")
    if not chars[0]:
        return ""
    density = [_density(chars[k], links[k], tag_count[k], link_tags[k], chars[0], links[0]) if kept[k] else 0.0 for k in range(n)]
    total = [0.0] * n
    for k in range(1, n):
        total[tree.parents[k]] += density[k]
    # a subtree's node of the largest sum; of equal ones the uppermost, first
    best = list(range(n))
    for k in range(n - 1, 0, -1):
        above = tree.parents[k]
        if kept[k] and (total[best[k]], -best[k]) > (total[best[above]], -best[above]):
            best[above] = best[k]
    chosen = best[0]
    above = [chosen]
    while above[-1]:
        above.append(tree.parents[above[-1]])
    whole = next((k for k in above if tree.tags[k] in ("article", "main")), None)
    threshold = min(density[k] for k in above)
    tops = [whole] if whole is not None else [best[k] for k in range(n) if kept[k] and density[k] >= threshold]
    marked, before = [False] * n, {}
    for k in tops:
        marked[k] = True
    for k in range(1, n):  # a heading right before a subtree is its own
        if kept[k]:
            heading = before.get(tree.parents[k])
            if marked[k] and heading is not None and HEADING.match(tree.tags[heading]):
                marked[heading] = True
            before[tree.parents[k]] = k
    for k in range(1, n):
        marked[k] |= marked[tree.parents[k]]
    return " ".join("".join(text if marked[node] else " " for node, text in tree.pieces if kept[node]).split())


def _density(chars: int, links: int, tags: int, link_tags: int, body_chars: int, body_links: int) -> float:
    """Composite text density: characters per tag times a logarithm that falls with the links in and around a node.

    Its base is e at least, so that pages without links have finite densities.
    """
    if not chars:
        return 0.0
    base = max(math.e, math.log(chars / max(1, chars - links) * links + body_links / body_chars * chars + math.e))
    share = chars / max(1, links) * max(1, tags) / max(1, link_tags)
    return chars / max(1, tags) * max(0.0, math.log(share) / math.log(base))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages: the main text of the whole html, and its code points.

    pages needs page_id, url and html; other columns are not read. A null or empty page, and one without running text,
    has an empty text. Rows that repeat stay; equal pages have equal texts; null ids and urls stay. A page of any length
    is read whole, in time that is linear in it. An empty table gives no rows.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
