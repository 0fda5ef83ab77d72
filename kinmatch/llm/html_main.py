"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged by style: a node of the tree is a path of tags with their
classes. Each node knows how its elements are laid out (the tags of their children) and what they
say, once a page. Its importance joins two entropies, as in the site style tree of the literature:
layouts that vary and contents that differ from page to page are important; what is laid out alike
and says the same on every page is not. Branches of low importance are left out of each page, inside
its article as well as outside.

What HTML or its authors mark is evidence beside the tree. Elements that are by their tag menus,
footers, forms, scripts and the like go. So do those whose class, id or role has a word for such parts
(``site-footer``, but not ``has-sidebar``), unless they are the body or an article, or hold all the
articles of a page. If a page has an article (or main element), what stands outside isn't the article.
The header of an article belongs to it.

Pages of a host with the same text after the evidence count once, so copies of a page don't make it
boilerplate. Style nodes on fewer than ``min_pages`` different pages of a host aren't judged, nor are
inline elements. A page that the tree alone would empty keeps its text, and one that class words alone
would empty is read without them.

Defined results: null and empty pages give an empty text; pages without a host form a host of
their own; repeated pages each get a row; broken markup is read leniently to its end, at any depth;
nothing is shortened; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import slices, spread_join, write_table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "object"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var label".split())
_NOISE_TAGS = {"nav", "footer", "aside", "form", "button", "head", "dialog", "menu", "fieldset"} | _RAW
_NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice alert popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs"
    " footer header masthead comment comments commentlist reply replies disqus share sharing social related recommended newsletter subscribe signup login search widget toolbar pagination".split()
)
#: Beside one of these a word tells of a page's state, not what an element is.
_STATE_WORDS = set("has have with without no not is open closed on off enabled disabled hidden show free wide".split())
_MAIN_TAGS = {"article", "main"}
_NEVER_NOISE = _MAIN_TAGS | {"html", "body"}
_CLOSES = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_SCOPE = {"ul", "ol", "table", "div", "article", "section", "main", "body", "blockquote", "figure", "dl"}
_ENDS_P = _SCOPE | {"h1", "h2", "h3", "h4", "h5", "h6", "pre", "form", "nav", "footer", "header", "aside"}
#: The share that layout has in a node's importance, and the importance below which a branch goes.
LAYOUT_SHARE, THRESHOLD = 0.1, 0.3

_digest = xxhash.xxh64_intdigest


class _Node:
    __slots__ = ("children", "main", "marked", "name", "parent", "path", "scope", "tag", "worded")

    def __init__(self, tag: str, name: str, path: int, parent: int, scope: Counter):
        self.tag, self.name, self.path, self.parent, self.scope = tag, name, path, parent, scope
        self.children: list[str] = []
        #: Noise by its tag; noise by a word of its class; in an article. Each also from a parent.
        self.marked = self.worded = self.main = False


_styles: dict[tuple[str, str], tuple[str, bool, bool]] = {}


def _style(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """A node's name in the style tree, whether a word of its class, id or role tells of noise, and
    whether one does that isn't "header"."""
    known = _styles.get((tag, attrs))
    if known is not None:
        return known
    values = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _ATTR.finditer(attrs)] if attrs else []
    classes = sorted(" ".join(v for k, v in values if k == "class").split())
    told = set()
    for token in " ".join(v for _, v in values).split():
        words = set(re.split(r"[_\-]+", token))
        if not words & _STATE_WORDS:
            told |= words & _NOISE_WORDS
    found = tag + "".join(f".{c}" for c in classes), bool(told), bool(told - {"header"})
    if len(_styles) > 10_000:
        _styles.clear()
    _styles[tag, attrs] = found
    return found


class Page:
    """A page's elements, and what happens from its start to its end: an element opens (its number) or
    closes (the complement), text is said, or a block ends (None)."""

    def __init__(self, html: str | None):
        self.nodes = [_Node("", "", 0, 0, Counter())]
        self.events: list[int | str | None] = []
        if html:
            self._read(html)
        self._judge()

    def _read(self, html: str) -> None:
        nodes, events, stack, opened = self.nodes, self.events, [0], Counter()

        def close() -> None:
            i = stack.pop()
            node = nodes[i]
            opened[node.tag] -= 1
            node.scope[node.tag] -= 1
            events.append(~i)

        def inside() -> Counter:
            """The open elements inside the innermost element that keeps paragraphs apart."""
            return scopes[-1]

        scopes = [nodes[0].scope]
        at, find = 0, _TOKEN.search
        while (m := find(html, at)) is not None:
            if m.start() > at:
                events.append(html[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag, attrs = tag.lower(), m[3] or m[6] or ""
            if m[1] or m[4]:
                if opened[tag] and (tag not in _INLINE or inside()[tag]):
                    while nodes[stack[-1]].tag != tag:
                        if nodes[stack[-1]].tag in _SCOPE:
                            scopes.pop()
                        close()
                    if tag in _SCOPE:
                        scopes.pop()
                    close()
                elif tag not in _INLINE:
                    events.append(None)
                continue
            if tag in _VOID:
                if tag == "br":
                    events.append(" ")
                elif tag == "hr":
                    events.append(None)
                nodes[stack[-1]].children.append(tag)
                continue
            if tag not in _INLINE:
                shut = _CLOSES.get(tag) or ({"p"} if tag in _ENDS_P else ())
                here = inside()
                while shut and any(here[s] for s in shut):
                    while nodes[stack[-1]].tag not in shut:
                        close()
                    close()
            top = stack[-1]
            name = _style(tag, attrs)[0]
            node = _Node(tag, name, _digest(name, nodes[top].path), top, inside())
            nodes[top].children.append(name)
            node.marked, (_, node.worded, other) = tag in _NOISE_TAGS, _style(tag, attrs)
            if tag == "header" or (node.worded and not other):
                node.worded, node.main = False, True  # a header, until it is known whether it is an article's
            nodes.append(node)
            stack.append(len(nodes) - 1)
            events.append(len(nodes) - 1)
            opened[tag] += 1
            node.scope[tag] += 1
            if tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                stop = end.start() if end else len(html)
                close()
                gt = html.find(">", stop) if end else -1
                at = gt + 1 if gt >= 0 else len(html)
            elif tag in _SCOPE:
                scopes.append(Counter())
        if at < len(html):
            events.append(html[at:])
        while len(stack) > 1:
            close()

    def _judge(self) -> None:
        """Marks and articles from parents to children."""
        nodes = self.nodes
        free, mains = False, []
        worded = [False] * len(nodes)
        for i, n in enumerate(nodes[1:], 1):
            if n.tag in _NEVER_NOISE:
                n.worded = False
            n.marked = n.marked or nodes[n.parent].marked
            worded[i] = n.worded or worded[n.parent]
            if n.tag in _MAIN_TAGS and not n.marked:
                mains.append(i)
                free = free or not worded[i]
        if mains and not free:  # all articles are in elements that class words tell against
            for i in mains:
                i = nodes[i].parent
                while i and nodes[i].worded is not None:
                    nodes[i].worded = None
                    i = nodes[i].parent
        for i, n in enumerate(nodes[1:], 1):
            parent, header = nodes[n.parent], n.main
            n.main = parent.main or (n.tag in _MAIN_TAGS and not n.marked and not parent.worded)
            if header and not n.main:
                n.marked, n.worded = n.marked or n.tag == "header", n.tag not in _NEVER_NOISE
            n.marked = n.marked or parent.marked
            n.worded = bool(n.worded or parent.worded)
        self.mains = any(n.main for n in nodes)

    def styles(self) -> dict[int, tuple[int, int]]:
        """``path: (layout, content)`` of the block elements that nothing is marked against, of all
        elements of a path together."""
        nodes, found, said = self.nodes, {}, [[] for _ in self.nodes]
        up = [0]
        for e in self.events:
            if isinstance(e, str):
                if words := e.split():
                    said[up[-1]].append(_digest(" ".join(words)))
            elif e is None:
                continue
            elif e >= 0:
                up.append(e)
            else:
                i, n = up.pop(), nodes[~e]
                content = _digest(repr(said[i]))
                said[up[-1]].append(content)
                said[i] = []
                if n.tag not in _INLINE and not n.marked and not n.worded:
                    layout, before = found.get(n.path, (0, 0))
                    found[n.path] = _digest(" ".join(n.children), layout), _digest(content.to_bytes(8, "big"), before)
        return found

    def text(self, low: frozenset[int] | set[int] = frozenset(), *, words: bool = True, main: bool = False) -> str:
        """The blocks that are left without marked elements, those that class words tell against and
        those of low paths; with ``main`` of articles alone."""
        nodes, out, block, gone = self.nodes, [], [], 0

        def flush() -> None:
            if block:
                if text := " ".join("".join(block).split()):
                    out.append(text)
                block.clear()

        inside = not main
        for e in self.events:
            if isinstance(e, str):
                if not gone and inside:
                    block.append(unescape(e) if "&" in e else e)
                continue
            if e is None:
                flush()
                continue
            n = nodes[e if e >= 0 else ~e]
            if n.tag not in _INLINE:
                flush()
            if n.marked or (words and n.worded) or (n.path in low and n.tag not in _INLINE):
                gone += 1 if e >= 0 else -1
            if main:
                inside = n.main if e >= 0 else nodes[n.parent].main
        flush()
        return " ".join(out)

    def main_text(self, low: frozenset[int] | set[int] = frozenset()) -> str:
        """The main text; what the tree, then what class words alone would empty is read without them."""
        if self.mains:
            found = self.text(low, main=True) or (low and self.text(main=True))
            if found:
                return found
        return self.text(low) or (low and self.text()) or self.text(words=False)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def style_tree(pages: DataFrame, *, min_pages: int = 4) -> DataFrame:
    """``host, path, pages, importance`` of the merged DOMs; ``pages`` has ``host, html``.

    A page gives a row for each of its paths, equal main texts of a host one; these are only ever
    counted, with partial counts before each shuffle, so a host may be of any size.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*seen, strict=True), kinds, strict=True)], names=["host", "page", "path", "layout", "content"])

        for batch in slices(batches):
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(html)
                text = _signed(_digest(page.main_text()))
                seen.update((host, text, _signed(path), _signed(layout), _signed(content)) for path, (layout, content) in page.styles().items())
                if len(seen) > 100_000:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    rows = pages.select("host", "html").mapInArrow(read, "host string, page long, path long, layout long, content long")
    once = rows.groupBy("host", "page", "path").agg(F.min(F.struct("layout", "content")).alias("is"))
    once = write_table(once.groupBy("host", "path", "is.layout", "is.content").agg(F.count(F.lit(1)).alias("n")), "style-tree")

    def evenness(column: str) -> DataFrame:
        each = once.groupBy("host", "path", column).agg(F.sum("n").alias("n"))
        return each.groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias(f"same_{column}"))

    m = F.col("m").cast("double")
    judged = evenness("content").filter(F.col("m") >= max(min_pages, 2)).join(evenness("layout").drop("m"), ["host", "path"])
    content, layout = (1 - F.col(f"same_{c}") / m / F.log(m) for c in ("content", "layout"))
    return judged.select("host", "path", F.col("m").alias("pages"), (LAYOUT_SHARE * layout + (1 - LAYOUT_SHARE) * content).alias("importance"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = [(key, host, _signed(p)) for key, host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in Page(html).styles()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)], names=["key", "host", "path"])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD, min_pages: int = 4, broadcast_rows: int = 20_000) -> DataFrame:
    """``page_id, url, text``. If the low paths, which are written and counted first, are few, they go
    to the pages by host as a broadcast; else each page's own paths are joined to them."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit("")))
    low = write_table(style_tree(rows, min_pages=min_pages).filter(F.col("importance") < threshold).select("host", "path"), "low-paths")
    if low.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(low.groupBy("host").agg(F.collect_list("path").alias("low"))), "host", "left")
    else:
        keyed = rows.withColumn("key", F.md5(F.concat("host", F.lit(" "), "html")))
        held = keyed.filter("key is not null").select("key", "host", "html").mapInArrow(_paths, "key string, host string, path long").distinct()
        met = spread_join(held.select("key", F.struct("host", "path").alias("at")), low.select(F.struct("host", "path").alias("at")), "at", "inner")
        joined = spread_join(keyed, met.groupBy("key").agg(F.collect_list("at.path").alias("low")), "key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [Page(html).main_text({p & (1 << 64) - 1 for p in paths or ()}) for html, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return joined.select("page_id", "url", "html", "low").mapInArrow(cut, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string")


def html_query(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
