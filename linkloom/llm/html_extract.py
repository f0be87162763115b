"""HTML extraction with removal of site templates.

Each page becomes a tree of elements, and each element subtree is hashed from its tag, its text and its
children's hashes; attributes are left out, and nothing is cut from the tree before it is hashed. Spark counts
the hashes per host, over pages with different main texts. Subtrees that recur across many pages of a host are
templates: in the second pass each page's tree is walked from the top, and a subtree whose hash is a template's
is deleted whole, with all templates inside it.

What is a template: a subtree with text that recurs on at least MIN_PAGES pages of the host whose main texts
differ, however many pages the host has; copies of one article count once. Subtrees are counted wherever they
are on the page. On pages with an `article` or `main` element those deleted are subtrees of CONTAINERS, and
others if most of their text is links; a bare paragraph, heading or list item that a site repeats inside its
articles is still the articles' text. Without such an element any block may go.

What recurrence cannot see, as it may differ from page to page, goes by its tag, role or class (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments of readers). A class or id
counts by its whole name, not by a word in it: `social-history` and `comments-on-keynes` are content. Names that
content may bear too (WEAK) count only if all names of the element are of that kind.

Only hashes are shuffled: (host, hash) counts, combined before the shuffle, so one host may hold any share of
the pages. A host has at most (its pages' subtrees) / MIN_PAGES templates. The list of pages that hold a
template in their main text is broadcast if its counted rows are few, and joined by shuffle otherwise.

Text: character references are decoded; white space in a block becomes one space; blocks are trimmed and
joined in page order by one line end. A `br` is white space within its block. If the page has `article`
elements, the text is theirs; else that of `main`; else that of the body.

Defined cases: null or empty html, and html without main text, give an empty text. Markup that ends early
is read as far as it goes; a tag that is never closed takes the rest of the page. Very long pages, deeply
nested ones and unclosed tags take time in proportion to their length. Repeated rows each get their row; rows
without page_id are extracted without the template step. A url without host counts as the host ''. Other columns
are never read. An empty table gives no rows.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import small_side, stage

MIN_PAGES = 10
#: A subtree of links inside an article is one whose link text is at least this share of its text.
LINK_SHARE = 0.5

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
SKIPPED = frozenset("script style noscript template head title iframe noembed noframes object svg math canvas audio video select option datalist button input textarea form nav footer aside menu dialog label fieldset".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Blocks that recur as a whole also inside articles; others hold the text itself.
CONTAINERS = frozenset("address aside center details dialog div dl fieldset figure footer form header hgroup menu nav ol search section table ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: An open element of the key's kind ends where one of the value's kinds begins.
ENDS_BEFORE = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"])}
# Words of class names and ids. A name of STRONG words (LAYOUT words may join them) marks boilerplate.
STRONG = frozenset("ad ads advert adverts advertisement advertising adbox sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login comments disqus pagination pager".split())
WEAK = frozenset("banner notice notices alert related recommended share sharing social comment reply replies respond widget widgets skip toolbar promotion aside".split())
LAYOUT = frozenset("a b bar block body bottom box button buttons col column container content form group header inner item items label left link links list main message outer page panel right row section site small text title top wrap wrapper".split())
_NAME = re.compile(r"[a-z]+")
_OPEN = re.compile(r"[a-zA-Z][^\s/>]*")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'<>]+))?")
_SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "skip", "children", "digest", "chars", "links")

    def __init__(self, tag: str, skip: bool):
        self.tag, self.skip, self.children = tag, skip, []
        self.digest, self.chars, self.links = b"", 0, 0


def _named(names: list[str]) -> bool:
    """Whether class names or an id mark boilerplate."""
    if not names:
        return False
    kinds = []
    for name in names:
        words = set(_NAME.findall(name))
        if not words:
            kinds.append("layout")
        elif words <= STRONG | WEAK | LAYOUT and words & STRONG:
            return True
        else:
            kinds.append("weak" if words <= WEAK | LAYOUT and words & WEAK else "layout" if words <= LAYOUT else "other")
    return "weak" in kinds and "other" not in kinds


def _boilerplate(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name in ("class", "id") and _named(value.split()):
            return True
    return False


class _Scanner:
    """Finds tags one after the other, each character being looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.at, self.quoted = page, 0, True

    def _end(self, at: int) -> int:
        """The place of the > that closes a tag, outside quotes if the page's quotes allow that; -1 without one."""
        page, k = self.page, at
        while self.quoted:
            k = _UNQUOTED.match(page, k).end()
            if k == len(page):
                # From here on no tag is closed outside quotes, so quotes are not looked at again.
                self.quoted = False
            elif page[k] == ">":
                return k
            else:
                close = page.find(page[k], k + 1)
                if close < 0:
                    self.quoted = False
                k = close + 1
        return page.find(">", at)

    def next(self) -> tuple[str, str, str, bool] | None:
        """Text before the next tag, the tag's name ('' for none), its attributes, and whether it is an end tag; None at the end."""
        page, begin = self.page, self.at
        if begin >= len(page):
            return None
        at = begin
        while True:
            at = page.find("<", at)
            if at < 0:
                self.at = len(page)
                return page[begin:], "", "", False
            first = page[at + 1 : at + 2]
            if first and first in "!?":
                mark = "-->" if page.startswith("<!--", at) else ">"
                close = page.find(mark, at + 1 + len(mark))
                self.at = close + len(mark) if close >= 0 else len(page)
                return page[begin:at], "", "", False
            ends = first == "/"
            m = _OPEN.match(page, at + 1 + ends)
            if m:
                close = page.find(">", m.end()) if ends else self._end(m.end())
                self.at = close + 1 if close >= 0 else len(page)
                if close < 0:
                    return page[begin:at], "", "", False
                return page[begin:at], m[0].lower(), page[m.end() : close], ends
            at += 1


def parse(page: str) -> Node:
    """The page's tree. Text is kept as strings among the children."""
    root = Node("html", False)
    # Places on the stack: of each tag, and of blocks.
    stack, places, blocks, scanner = [root], {}, [], _Scanner(page)

    def cut(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().tag].pop()
        while blocks and blocks[-1] >= k:
            blocks.pop()

    while (found := scanner.next()) is not None:
        text, tag, attributes, ends = found
        if text:
            stack[-1].children.append(_html.unescape(text) if "&" in text else text)
        if not tag:
            continue
        if ends:
            # An inline end tag does not close the block around it.
            if places.get(tag) and (tag in BLOCKS or not blocks or places[tag][-1] > blocks[-1]):
                cut(places[tag][-1])
            continue
        # Inline elements that are still open do not keep a paragraph open before the next block.
        if blocks and tag in ENDS_BEFORE.get(stack[blocks[-1]].tag, ()):
            cut(blocks[-1])
        closed = attributes.endswith("/")
        node = Node(tag, _boilerplate(tag, attributes))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, scanner.at)
            if tag == "textarea":
                node.children.append(_html.unescape(page[scanner.at : end.start() if end else len(page)]))
            scanner.at = end.end() if end else len(page)
        elif tag not in VOID and not (closed and tag not in BLOCKS and tag not in ("a", "b", "i", "span")):
            if tag in BLOCKS:
                blocks.append(len(stack))
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    return root


def _measure(root: Node) -> None:
    """Sets each subtree's digest, characters of text and characters within links, children first."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(x for x in node.children if isinstance(x, Node))
    for node in reversed(order):
        h, chars, links = blake2b(node.tag.encode("utf-8", "surrogatepass"), digest_size=8), 0, 0
        for child in node.children:
            if isinstance(child, str):
                text = _SPACES.sub(" ", child).strip(" ")
                if text:
                    h.update(b"\x00" + text.encode("utf-8", "surrogatepass"))
                    chars += len(text)
            elif child.chars:
                h.update(b"\x01" + child.digest)
                chars, links = chars + child.chars, links + child.links
        node.digest, node.chars, node.links = h.digest(), chars, chars if node.tag == "a" else links


def _mains(root: Node) -> tuple[list[Node], bool]:
    """The elements that hold the main text, and whether the page names them."""
    for wanted in ("article", "main"):
        found, open_nodes = [], [root]
        while open_nodes:
            node = open_nodes.pop()
            if node.tag == wanted:
                found.append(node)
            else:
                open_nodes.extend(x for x in reversed(node.children) if isinstance(x, Node) and not x.skip)
        if found:
            return found, True
    return [root], False


class Extraction:
    """A page's main text without templates, and the hashes of subtrees inside the main text and outside it."""

    def __init__(self, page: str, templates: frozenset[bytes] = frozenset()):
        self.templates = templates
        self.root = parse(page)
        _measure(self.root)
        self.mains, self.named = _mains(self.root)

    def _may_go(self, node: Node, named: bool) -> bool:
        """Whether a subtree is one that is deleted if it recurs."""
        if not node.chars or node.tag not in BLOCKS or node.tag in ("html", "body", "article", "main"):
            return False
        return not named or node.tag in CONTAINERS or node.links >= LINK_SHARE * node.chars

    @property
    def hashes(self) -> set[bytes]:
        """Of subtrees inside the main text."""
        out, waiting = set(), list(self.mains)
        while waiting:
            node = waiting.pop()
            if self._may_go(node, self.named):
                out.add(node.digest)
            waiting.extend(x for x in node.children if isinstance(x, Node) and not x.skip)
        return out

    @property
    def outer(self) -> set[bytes]:
        """Of subtrees outside the main text, those that go by name included."""
        apart, out = {id(x) for x in self.mains if x is not self.root}, set()
        waiting = [(self.root, bool(apart))]
        while waiting:
            node, outside = waiting.pop()
            if id(node) in apart:
                outside = False
            outside = outside or node.skip
            if outside and self._may_go(node, True):
                out.add(node.digest)
            waiting.extend((x, outside) for x in node.children if isinstance(x, Node))
        return out

    def text(self) -> str:
        blocks: list[list[str]] = [[]]
        for main in self.mains:
            blocks.append([])
            # Nodes still to be entered, texts, and None where a block ends.
            waiting: list[Node | str | None] = list(reversed(main.children))
            while waiting:
                x = waiting.pop()
                if x is None:
                    blocks.append([])
                elif isinstance(x, str):
                    blocks[-1].append(x)
                elif x.tag == "br":
                    blocks[-1].append(" ")
                elif x.tag in BLOCKS:
                    blocks.append([])
                    if not (x.skip or x.tag == "hr" or (x.digest in self.templates and self._may_go(x, self.named))):
                        waiting.append(None)
                        waiting.extend(reversed(x.children))
                elif not x.skip:
                    waiting.extend(reversed(x.children))
        return "\n".join(x for x in map(_clean, blocks) if x)


def _clean(block: list[str]) -> str:
    return _SPACES.sub(" ", "".join(block)).strip(" ") if block else ""


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inner, outer, texts = [], [], []
        for page in batch.column("html").to_pylist():
            found = Extraction(page or "")
            hashes = found.hashes
            inner.append(sorted(hashes))
            outer.append(sorted(found.outer - hashes))
            texts.append(found.text())
        lists = [pa.array(x, pa.list_(pa.binary())) for x in (inner, outer)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), pa.array(texts, pa.string()), *lists], names=["page_id", "url", "host", "text", "hashes", "outer"])


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Extraction(x or "", frozenset(t)).text() for x, t in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of each row of pages (page_id, url, html).

    The first pass keeps each page's text; only pages that hold a template in it are read again.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^/]*//(?:[^/@]*@)?([^/:?#]*)", 1))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    kind = dict(pages.dtypes)["page_id"]
    found = stage(pages.mapInArrow(_first_pass, f"page_id {kind}, url string, host string, text string, hashes array<binary>, outer array<binary>"), "html-subtrees")
    known = found.filter(F.col("page_id").isNotNull())
    # Pages of a host with one main text count once for each hash that any of them has.
    main = F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("main")
    counted = known.select("host", main, F.explode(F.concat("hashes", "outer")).alias("hash")).distinct()
    often = counted.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    templates = stage(often.select("host", "hash"), "html-templates")
    one_each = known.select("page_id", "host", F.explode("hashes").alias("hash"))
    # A page's list holds subtrees of that page only.
    per_page = one_each.join(small_side(templates), ["host", "hash"], "left_semi").groupBy("page_id").agg(F.collect_set("hash").alias("templates"))
    per_page = small_side(stage(per_page, "html-deleted"))
    again = pages.join(per_page, "page_id").select("page_id", "url", "html", "templates").mapInArrow(_second_pass, f"page_id {kind}, url string, text string")
    plain = found.join(per_page, "page_id", "left_anti").select("page_id", "url", "text")
    return plain.unionByName(again).withColumn("n_chars", F.length("text").cast("long"))
