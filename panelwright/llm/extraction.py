"""Main text of web pages by consensus host paths.

1. Every container of a page is scored by the text it holds outside boilerplate.  The best one is the lowest that
   holds all of it: of the page, or of its `main` or `article` elements where these hold half of the text or more.
   The page votes for that container's generalised path (tags and classes, digits dropped).
2. Votes are summed per host and path in Spark; a path that two pages vote for is a template of the host, and
   the path with most votes (then most text, then the least name) wins the host.
3. A page whose path is a template of its host gives the text on it; any other page is extracted again from the elements
   on the host's winning path, and a page without such an element, or with none that holds text, falls back on its own.

Boilerplate is decided by votes.  Tags that hold no article text go at once, as does a block all of whose words in one
class, id or role name boilerplate ("cookie-notice", "site-header").  A name that says so only in part
("social-policy") needs a second vote: mostly links, or controls inside.  A header with a heading stays where it opens an
article, and a block round most of the page's text with its heading or article in it is a wrapper, whatever its name.
A headline (`h1`) before a container without one belongs to its text.

Text: character references decoded, white space collapsed, blocks in page order joined by one space.
Null and empty pages, and pages without text, give an empty text; pages without a host share one.  Work is linear in a
page's length, however its tags are nested or left open; markup that never ends is text, and from a tag on whose quotes
swallow the rest of the page, tags end at the next `>`.
"""

from __future__ import annotations

import html as entities
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelwright.llm.common import cut

#: A tag without quotes, and the start and the attributes of any other.
SIMPLE = re.compile(r"<(/?)([A-Za-z][^\s/><\"']*+)([^<>\"']*+)>")
NAME = re.compile(r"</?([A-Za-z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"[\s/]*+(?:([^\s/>][^\s/>=]*+)(\s*+=\s*+)?)?")
UNQUOTED = re.compile(r"[^\s>]*+")
PLAIN_ATTRIBUTE = re.compile(r"([^\s=/]++)(?:\s*+=\s*+([^\s]++))?")
#: Elements whose content is no text of the page.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
RAW_END = {tag: re.compile(f"</{tag}(?![A-Za-z0-9])", re.I | re.A) for tag in RAW}
SKIPPED = {
    "head", "nav", "footer", "aside", "menu", "noscript", "template", "iframe", "object", "svg", "canvas", "button",
    "select", "dialog", "audio", "video", "map",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "center", "blockquote"}
#: Elements that end where the next of their kind starts; a paragraph ends at any block.
SIBLINGS = {"li", "td", "th", "tr", "dt", "dd", "option"}
#: Words in a class, id or role that mark boilerplate.
MARKS = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "brand", "branding", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "logo", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "pagination", "pager", "popup", "promo", "related", "replies", "respond", "search",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Words that say nothing of a block's content.
NEUTRAL = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "center", "col", "column", "container", "content", "desktop",
    "fixed", "form", "global", "group", "inline", "inner", "item", "items", "js", "left", "link", "links", "list", "main", "mobile", "module",
    "news", "outer", "overlay", "page", "panel", "post", "posts", "primary", "right", "row", "secondary", "section", "site", "slot",
    "sticky", "stories", "text", "thread", "top", "unit", "user", "wrap", "wrapper", "zone",
}
#: Readers' words, which are none of the article however much of the page they take.
READERS = {"comment", "comments", "disqus", "replies", "respond"}
HEADERS = {"header", "masthead", "banner"}
#: A word before a mark that takes it back, as in "no-sidebar".
UNMARK = {"no", "has", "with", "without", "not"}
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_LONG_NUMBER = re.compile(r"&#[0-9]{8,};?")


def tags(page: str):
    """(text, tag, closing, attributes) for every tag: the text before it; a last one without a tag ends the page."""
    at, end, last_gt = 0, len(page), page.rfind(">")
    last = {q: page.rfind(q) for q in "\"'"}
    quoted, text_from = True, 0
    while (lt := page.find("<", at)) >= 0:
        if lt > last_gt and not page.startswith("<!--", lt):
            break
        m = SIMPLE.match(page, lt)
        if m is not None:
            closing, tag, stop = m[1] == "/", m[2].lower(), m.end()
            attrs = {k.lower(): v for k, v in PLAIN_ATTRIBUTE.findall(m[3])} if m[3] else {}
        elif page.startswith("<!--", lt):
            stop = page.find("-->", lt + 2)
            stop = end if stop < 0 else stop + 3
            yield page[text_from:lt], None, False, {}
            at = text_from = stop
            continue
        elif page.startswith("<![CDATA[", lt):
            yield page[text_from:lt], None, False, {}
            at = text_from = lt + 9
            continue
        elif page.startswith(("<!", "<?"), lt):
            yield page[text_from:lt], None, False, {}
            at = text_from = page.find(">", lt) + 1
            continue
        elif (m := NAME.match(page, lt)) is not None:
            closing, tag, attrs = page[lt + 1] == "/", m[1].lower(), {}
            stop = m.end()
            while quoted:
                m = ATTRIBUTE.match(page, stop)
                stop = m.end()
                if m[1] is None:
                    break
                value = ""
                if m[2]:
                    q = page[stop : stop + 1]
                    if q in last and stop < last[q]:
                        close = page.find(q, stop + 1)
                        value, stop = page[stop + 1 : close], close + 1
                    else:
                        m2 = UNQUOTED.match(page, stop)
                        value, stop = m2[0].strip("\"'"), m2.end()
                attrs.setdefault(m[1].lower(), value)
            if not quoted or stop >= end:
                quoted = False
                stop = page.find(">", lt)
                attrs = {k.lower(): v.strip("\"'") for k, v in PLAIN_ATTRIBUTE.findall(page[lt + 1 : stop].partition(" ")[2])}
            stop += 1
        else:  # a < that opens no tag
            at = lt + 1
            continue
        yield page[text_from:lt], tag, closing, attrs
        at = text_from = stop
        if tag in RAW and not closing:
            close = RAW_END[tag].search(page, stop)
            gt = page.find(">", close.end()) if close else -1
            at = text_from = end if gt < 0 else gt + 1
    yield page[text_from:], None, False, {}


def marks(attrs: dict[str, str]) -> tuple[bool, set[str]]:
    """Whether one of the names is all boilerplate, and the marks in all names."""
    strong, found = False, set()
    for name in ("class", "id", "role"):
        for token in attrs.get(name, "").split():
            words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
            hits = {w for k, w in enumerate(words) if w in MARKS and (k == 0 or words[k - 1] not in UNMARK)}
            if hits:
                found |= hits
                strong = strong or all(w in MARKS or w in NEUTRAL for w in words)
    return strong, found


def is_hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style", "")))


def step(tag: str, attrs: dict[str, str]) -> str:
    """One step of a generalised path."""
    classes = sorted({re.sub(r"[0-9]+", "", c.lower()) for c in attrs.get("class", "").split()} - {""})
    return ".".join([tag, *classes])


class Node:
    """A block (or a marked inline element) with the span of text pieces it holds."""

    __slots__ = ("tag", "parent", "step", "start", "end", "gone", "strong", "marks", "before", "after", "nested", "dropped", "within", "page_level")

    def __init__(self, tag: str, parent: Node | None, attrs: dict[str, str], start: int, before: tuple):
        self.tag, self.parent, self.start, self.end, self.before, self.after = tag, parent, start, start, before, before
        self.gone = tag in SKIPPED or is_hidden(attrs) if tag != "body" else False
        self.strong, self.marks = marks(attrs) if attrs and tag not in ("", "html", "body", "main", "article") else (False, set())
        if tag in ("header", "form"):
            self.strong, self.marks = True, self.marks | {tag}
        self.step = step(tag, attrs) if tag in CONTAINERS else None
        self.nested, self.dropped, self.page_level = 0, False, False
        #: which of `main` and `article` it lies in
        self.within = frozenset() if parent is None else parent.within | {parent.tag} if parent.tag in ("main", "article") else parent.within

    def holds(self, k: int) -> int:
        return self.after[k] - self.before[k]


CHARS, LINKED, LINKS, CONTROLS, HEADINGS, WHOLES = range(6)


class Page:
    """The blocks of a page in order of their start, its text pieces, and which of them are boilerplate."""

    def __init__(self, page: str):
        self.pieces: list[str] = []
        self.linked: list[bool] = []
        self.h1: list[Node] = []
        self.nodes: list[Node] = []
        self._read(page)
        self._judge()

    def _read(self, page: str) -> None:
        seen = [0] * 6
        root = Node("", None, {}, 0, tuple(seen))
        self.nodes.append(root)
        stack, count = [root], {}
        link = 0  # depth of the stack at which a link is open

        def close(depth: int) -> None:
            nonlocal link
            for node in stack[depth:]:
                node.end, node.after = len(self.pieces), tuple(seen)
                count[node.tag] -= 1
            del stack[depth:]
            link = 0 if link > depth else link

        count[""] = 1
        for text, tag, closing, attrs in tags(page):
            if text:
                n = len(text.strip())
                self.pieces.append(text)
                self.linked.append(link > 0)
                seen[CHARS] += n
                seen[LINKED] += n if link else 0
            if tag is None:
                continue
            if tag not in INLINE:
                self.pieces.append(" ")
                self.linked.append(False)
            if closing:
                link = 0 if tag == "a" else link
                if tag in INLINE and stack[-1].tag == tag and stack[-1].nested:
                    stack[-1].nested -= 1
                elif count.get(tag) and (tag not in INLINE or stack[-1].tag == tag):
                    close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
                continue
            if tag == "a" and "href" in attrs:
                link = len(stack)
                seen[LINKS] += 1
            elif tag in ("input", "button", "select", "textarea"):
                seen[CONTROLS] += 1
            elif tag in ("h1", "h2"):
                seen[HEADINGS] += 1
            elif tag in ("main", "article"):
                seen[WHOLES] += 1
            if tag in VOID or tag in RAW:
                continue
            if tag in INLINE:
                if stack[-1].tag == tag:
                    stack[-1].nested += 1
                    continue
                if not attrs or not (is_hidden(attrs) or marks(attrs)[0]):
                    continue
            elif tag == "body":
                close(next(k for k in range(1, len(stack)) if stack[k].tag == "head") if count.get("head") else len(stack))
            else:
                if stack[-1].tag == "p" or (stack[-1].tag == tag and tag in SIBLINGS):
                    close(len(stack) - 1)
                if not attrs and (tag in SIBLINGS and tag != "td" or tag == "p"):
                    continue
            before = list(seen)
            for k, names in ((CONTROLS, ("button", "select")), (HEADINGS, ("h1", "h2")), (WHOLES, ("main", "article"))):
                before[k] -= tag in names
            node = Node(tag, stack[-1], attrs, len(self.pieces), tuple(before))
            if tag in ("nav", "aside", "main", "article"):
                stack[-1].page_level = True
            self.nodes.append(node)
            stack.append(node)
            count[tag] = count.get(tag, 0) + 1
            if tag == "h1":
                self.h1.append(node)
        close(0)

    def _judge(self) -> None:
        plain = self.nodes[0].holds(CHARS) - self.nodes[0].holds(LINKED)
        for node in self.nodes[1:]:
            own = node.holds(CHARS) - node.holds(LINKED)
            links = 2 * node.holds(LINKED) > node.holds(CHARS)
            boilerplate = node.gone
            if not boilerplate and node.marks:
                boilerplate = node.strong or links or node.holds(CONTROLS) > 0
                wrapper = 2 * own > plain and (node.holds(HEADINGS) or node.holds(WHOLES))
                title = node.marks & HEADERS and node.holds(HEADINGS) and not links
                if boilerplate and not node.marks & READERS:
                    level = node.parent.tag not in ("", "html", "body") and not node.parent.page_level
                    boilerplate = not (wrapper or title and (node.within or level))
            node.dropped = node.parent.dropped or boilerplate
        kept = bytearray(b"\1" * len(self.pieces))
        for node in self.nodes:
            if node.dropped and not node.parent.dropped:
                kept[node.start : node.end] = bytes(node.end - node.start)
        self.kept = kept
        sizes = [len(t.strip()) if k else 0 for t, k in zip(self.pieces, kept, strict=True)]
        self.chars = [0, *accumulate(sizes)]
        self.plain = [0, *accumulate(0 if x else n for n, x in zip(sizes, self.linked, strict=True))]

    def size(self, node: Node, plain: bool) -> int:
        sums = self.plain if plain else self.chars
        return sums[node.end] - sums[node.start]

    def best(self) -> Node:
        """The lowest container with all text of the page, or of its `main` or `article` elements, outside boilerplate."""
        root = self.nodes[0]
        containers = [n for n in self.nodes if not n.dropped and (n.step is not None or n is root)]
        plain = self.size(root, True) > 0  # of a page of links: all text
        region = root
        for tag in ("main", "article"):
            whole = [n for n in containers if n.tag == tag and tag not in n.within and self.size(n, plain)]
            if whole and 2 * sum(self.size(n, plain) for n in whole) >= self.size(root, plain):
                start, end = whole[0].start, max(n.end for n in whole)
                region = [n for n in containers if n.start <= start and n.end >= end and tag not in n.within][-1]
                plain = False
                break
        most = self.size(region, plain)
        inner = [n for n in containers if region.start <= n.start and n.end <= region.end and self.size(n, plain) == most]
        return inner[-1] if inner and most else region

    def text(self, node: Node, headline: bool = True) -> str:
        """The node's text, the headline before it included; the whole body goes without blocks that are lists of links."""
        kept = self.kept
        if node.tag in ("", "body") and 2 * self.size(node, True) > self.size(node, False):
            kept = bytearray(kept)
            for n in self.nodes:
                linked = n.holds(LINKS) >= 3 and 5 * n.holds(LINKED) >= 4 * n.holds(CHARS)
                if linked and not n.within and n.tag not in ("", "body", "main", "article"):
                    kept[n.start : n.end] = bytes(n.end - n.start)
        head = ""
        if headline and not any(node.start <= h.start and h.end <= node.end for h in self.h1):
            head = " ".join(self._joined(h, kept) for h in self.h1 if h.end <= node.start and not h.dropped) + " "
        return " ".join((head + self._joined(node, kept)).split())

    def _joined(self, node: Node, kept: bytearray) -> str:
        return "".join(decoded(self.pieces[k]) for k in range(node.start, node.end) if kept[k])

    def path(self, node: Node) -> str:
        steps = []
        while node is not None:
            if node.step is not None:
                steps.append(node.step)
            node = node.parent
        return "".join(f"/{s}" for s in reversed(steps))

    def on_path(self, path: str) -> list[Node]:
        """The containers on a path: each is matched from where its parent ended, so long paths stay cheap."""
        upto, found = {}, []
        for node in self.nodes:
            m = upto[id(node.parent)] if node.parent is not None else 0
            if node.step is not None and m >= 0:
                m = m + 1 + len(node.step) if path.startswith(node.step, m + 1) and path[m : m + 1] == "/" else -1
                m = m if m < 0 or m == len(path) or path[m] == "/" else -1
                if m == len(path) and not node.dropped:
                    found.append(node)
            upto[id(node)] = m
        return found


def decoded(text: str) -> str:
    """Character references decoded; a number beyond all code points, however long, is the replacement character."""
    return entities.unescape(_LONG_NUMBER.sub("\N{REPLACEMENT CHARACTER}", text)) if "&" in text else text


def own_text(page: str) -> tuple[str | None, str]:
    """The path of the page's best container and its text; no path for a page without text."""
    read = Page(page)
    top = read.best()
    text = read.text(top)
    return (read.path(top) if text else None), text


def vote(page: str) -> tuple[str | None, int]:
    """The path of the page's best container and its text's length; no path for a page without text."""
    path, text = own_text(page)
    return path, len(text)


def extract(page: str, path: str | None) -> str:
    """The text of the elements on the path, or of the page's best container."""
    read = Page(page)
    if path is not None:
        texts = [read.text(n, k == 0) for k, n in enumerate(n for n in read.on_path(path) if read.size(n, False))]
        if text := " ".join(x for x in texts if x):
            return text
    return read.text(read.best())


def host(url: Column) -> Column:
    """The host of an address in lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def host_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(_host, _path, votes, chars): the paths that pages vote for."""

    def votes(parts):
        for batch in parts:
            rows = [vote(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())],
                names=["_host", "_path", "_chars"],
            )

    cast = pages.select(host(F.col(url)).alias("_host"), F.col(html)).mapInArrow(votes, "_host string, _path string, _chars long")
    return cast.where("_path IS NOT NULL").groupBy("_host", "_path").agg(F.count("*").alias("votes"), F.sum("_chars").alias("chars"))


def host_paths(sums: DataFrame) -> DataFrame:
    """(_host, _path): the winning path of every host with a vote."""
    top = sums.groupBy("_host").agg(F.max(F.struct("votes", "chars")).alias("_top"))
    winners = sums.join(top, "_host").where("votes = _top.votes AND chars = _top.chars")
    return winners.groupBy("_host").agg(F.min("_path").alias("_path"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", into: str = "text") -> DataFrame:
    """All columns of `pages` and the main text (instead of a column of that name).

    The winners are a row a host and the templates a row a host and path, read from written tables, so that their
    measured size decides how they are joined; a hot host is split by adaptive execution where they are too many to
    broadcast.
    """
    sums = cut(host_votes(pages, url, html))
    winners = cut(host_paths(sums))
    templates = cut(sums.where("votes > 1").select("_host", F.col("_path").alias("_own"), F.lit(True).alias("_template")))
    kept = [c for c in pages.columns if c != into]
    row = pages.select(F.struct(*kept).alias("_row"), F.col(html).alias("_html"), host(F.col(url)).alias("_host"))

    fields = [StructField("_own", StringType()), StructField("_own_text", StringType())]

    def own_texts(parts):
        for batch in parts:
            own = [own_text(x or "") for x in batch.column("_html").to_pylist()]
            made = [pa.array([x[k] for x in own], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "_own", "_own_text"])

    voted = row.mapInArrow(own_texts, StructType([*row.schema.fields, *fields]))
    # a page on a template of its host has its text; the others are read again on their host's path
    again = F.col("_template").isNull() & F.col("_path").isNotNull()
    joined = voted.join(winners, "_host", "left").join(templates, ["_host", "_own"], "left")
    joined = joined.select("_row", F.when(again, F.col("_html")).alias("_html"), F.when(again, F.col("_path")).alias("_path"), "_own_text")
    schema = StructType([joined.schema["_row"], StructField("_into", StringType())])

    def texts(parts):
        for batch in parts:
            rows = zip(*(batch.column(c).to_pylist() for c in ("_html", "_path", "_own_text")), strict=True)
            made = pa.array([own if p is None else extract(x or "", p) for x, p, own in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), made], names=["_row", "_into"])

    return joined.mapInArrow(texts, schema).select("_row.*", F.col("_into").alias(into))
