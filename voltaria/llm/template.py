"""Main text of web pages by removing each site's template.

Every element subtree of a page is hashed (host, name and text), whatever it is and wherever it stands: paragraphs, lists and
tables of an article as well as menus and footers. Spark counts per host the distinct pages (by the hash of their
articles or, lacking one, their whole text) in which a subtree occurs. Deleted is what is found in ``SHARE`` or more of a host's
at least ``LEAST_PAGES`` pages, or in ``MANY_PAGES`` pages or more that are ``LOW_SHARE`` or more of the host's. Copies
of one page count once. Elements inside a line of text (``b``, ``a``, ``span``) are subtrees from ``INLINE_WORDS`` words on;
shorter ones are words of their sentence.

Besides, markup that never holds main text goes without counts: scripts, styles, forms, menus, page headers and footers,
sidebars, and elements whose class, id or role names an advert, notice, menu or reader comment; inside an article only
whole class names and roles tell, not words of them or ids.

If a page has ``article`` elements (or ``main``), its text is theirs; else it is the body's. Character references are decoded,
white space inside a block becomes one space, blocks are trimmed and joined in page order by one line feed.

Defined cases: null and empty html give empty text; broken markup is read as browsers do in outline (unclosed
paragraphs, missing end tags, an unfinished tag at the end is dropped); pages without a host form one host; repeated
rows are extracted each; null keys and urls are kept; other columns are ignored; what near copies of one page share recurs like a template.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.llm import stream
from voltaria.session import stage

SHARE, LEAST_PAGES = 0.5, 5
LOW_SHARE, MANY_PAGES = 0.1, 10
INLINE_WORDS = 4
#: Bits of a host's hash that a counted row carries.
_HOST_BITS = 46
_MOD, _BASE = (1 << 61) - 1, 1_000_003

# Element names of the HTML standard and naming habits of web pages.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"head", "nav", "footer", "aside", "form", "fieldset", "menu", "dialog"}
DROPPED_INLINE = {"button", "select", "datalist", "option", "label", "svg", "canvas", "object", "audio", "video", "map", "math"}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
MARKS = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal",
    "overlay", "newsletter", "subscribe", "signup", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "footer", "comment", "comments", "respond", "replies",
    "disqus", "share", "sharing", "social", "related", "widget", "masthead", "toolbar", "pagination", "pager", "login"
}
#: Words beside which a mark tells of the layout around the content.
LAYOUT = {"has", "with", "without", "no", "layout", "wrapper", "container"}
#: Elements that a new one of such a kind closes, up to the elements on the right.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}

_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARKUP = re.compile(r"[>\"']")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WHITE = re.compile(r"\s+")
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Node:
    """An element: its name, its place among the open ones, and the range of segments that its content fills."""

    __slots__ = ("name", "parent", "dropped", "article", "first", "last", "words")

    def __init__(self, name: str, parent: Node | None, dropped: bool, article: bool):
        self.name, self.parent, self.dropped, self.article = name, parent, dropped, article
        self.first, self.last, self.words = -1, -1, 0

    def holds(self, first: int, last: int, words: int) -> None:
        if self.first < 0:
            self.first = first
        self.first, self.last, self.words = min(self.first, first), max(self.last, last), self.words + words


class Segment(NamedTuple):
    """Text of one element within a block; a block's end has no text but a line feed and belongs to no element."""

    text: str
    article: bool
    dropped: bool
    end: bool


class Subtree(NamedTuple):
    """An element's hash (host, name and text) and the segments ``first`` to ``last`` that it fills."""

    hash: int
    first: int
    last: int


class Tags:
    """The tags of a page, in one pass: what a tag without an end was compared with is not read again for the next one."""

    def __init__(self, page: str):
        self.page = page
        self.seen: dict[str, tuple[int, int]] = {}
        self.open_quotes: set[int] = set()

    def _find(self, mark: str, at: int) -> int:
        """The next ``mark`` from ``at`` on, remembered while it is the next."""
        since, found = self.seen.get(mark, (0, -2))
        if found == -2 or at < since or 0 <= found < at:
            since, found = at, self.page.find(mark, at)
            self.seen[mark] = since, found
        return found

    def _end(self, at: int) -> int:
        """The ``>`` outside quotes that ends a tag, or -1."""
        quotes = []
        while (mark := _MARKUP.search(self.page, at)) is not None:
            place = mark.start()
            if self.page[place] == ">":
                return place
            if place in self.open_quotes:
                break
            quotes.append(place)
            closing = self.page.find(self.page[place], place + 1)
            if closing < 0:
                break
            at = closing + 1
        self.open_quotes.update(quotes)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name and attributes of the next tag; comments, declarations and an unfinished tag at the end have no name."""
        page = self.page
        while (start := self._find("<", at)) >= 0:
            mark = page[start + 1 : start + 2]
            if mark in ("!", "?") and mark:
                comment = page.startswith("<!--", start)
                end = page.find("-->", start + 4) if comment else self._find(">", start + 2)
                return start, len(page) if end < 0 else end + (3 if comment else 1), "", "", ""
            letter = page[start + 2 : start + 3] if mark == "/" else mark
            if letter.isascii() and letter.isalpha():
                first = self._find(">", start)
                if first >= 0:
                    name = _TAG_NAME.match(page, start)
                    end = self._end(name.end())
                    end = first if end < 0 else end
                    return start, end + 1, name.group(1), name.group(2).lower(), page[name.end() : end]
                if self._find("<", start + 1) < 0:
                    return start, len(page), "", "", ""
            at = start + 1
        return None


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    if name in DROPPED or name in DROPPED_INLINE or name == "header" and not inside:
        return True
    for key, value in _NAMES.findall(attributes):
        key, value = key.lower(), entities.unescape(value.strip("\"'"))
        if key == "hidden" or key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body", "article", "main"):
            if inside:  # in an article only a whole class name tells
                words = set(value.lower().split()) if key == "class" else set()
            else:
                words = {w.lower() for w in _SPLIT.split(value) if w}
            if words & MARKS and not words & LAYOUT:
                return True
    return False


def read_page(page: str, host: str = "") -> tuple[list[Segment], list[Subtree]]:
    """The text of a page in order, and the subtrees that hold text. Time and memory follow the page's length, however deep
    its elements lie."""
    root = Node("", None, False, False)
    open_, piece, nodes = root, [], []
    opened: Counter[str] = Counter()
    segments: list[tuple[str, Node | None]] = []

    def flush() -> None:
        any_ = False
        for _, run in groupby(piece, key=lambda p: id(p[1])):
            parts = list(run)
            text, node = _WHITE.sub(" ", entities.unescape("".join(p[0] for p in parts))), parts[0][1]
            if bare := text.strip():
                any_ = True
                node.holds(len(segments), len(segments), bare.count(" ") + 1)
            segments.append((text, node))
        piece.clear()
        if any_:
            segments.append(("\n", None))

    def closed(node: Node, upto: Node) -> Node:
        while node is not upto:
            opened[node.name] -= 1
            node = node.parent
        return node

    at, n, tags = 0, len(page), Tags(page)
    while at < n:
        tag = tags.next(at)
        if tag is None:
            piece.append((page[at:], open_))
            break
        start, end, closing, name, attributes = tag
        piece.append((page[at:start], open_))
        at = end
        block = name in BLOCKS or name in DROPPED
        if not name:
            continue
        if closing:
            if block:
                flush()
            if opened[name]:
                node = open_
                while node.name != name:
                    node = node.parent
                open_ = closed(open_, node.parent)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name != "wbr":
                piece.append((" ", open_))
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if block:
            flush()
            while name != "head" and (open_.name == "head" or open_.parent is not None and open_.parent.name == "head"):
                open_ = closed(open_, open_.parent)
            above = open_
            while opened["p"] and above is not root and above.name not in BLOCKS and above.name not in DROPPED:
                above = above.parent
            if above.name == "p":  # an open paragraph ends where a block begins
                open_ = closed(open_, above.parent)
            if name in CLOSES and any(opened[c] for c in CLOSES[name][0]):
                node, (same, stop) = open_, CLOSES[name]
                while node is not root and node.name not in same and node.name not in stop:
                    node = node.parent
                if node.name in same:
                    open_ = closed(open_, node.parent)
        if attributes.endswith("/") and name in DROPPED_INLINE:
            continue
        dropped = open_.dropped or _unwanted(name, attributes, open_.article)
        open_ = Node(name, open_, dropped, open_.article or name in ("article", "main"))
        opened[name] += 1
        nodes.append(open_)
    flush()
    made = [Segment(text, node.article, node.dropped, False) if node else Segment(text, False, False, True) for text, node in segments]
    return made, _subtrees(nodes, made, host)


def _subtrees(nodes: list[Node], segments: list[Segment], host: str) -> list[Subtree]:
    """Elements lie in runs of segments, so a running sum of the segments' hashes gives each element's."""
    prefix, count, powers = [0], [0], [1]
    for segment in segments:
        bare = "" if segment.end else segment.text.strip()
        prefix.append((prefix[-1] * _BASE + (_hash(bare) & _MOD) + 1) % _MOD if bare else prefix[-1])
        count.append(count[-1] + bool(bare))
        if bare:
            powers.append(powers[-1] * _BASE % _MOD)
    found = []
    for node in reversed(nodes):  # what lies inside an element was opened after it
        if node.first < 0:
            continue
        if node.parent is not None:
            node.parent.holds(node.first, node.last, node.words)
        if node.name not in ("html", "body") and (node.name in BLOCKS or node.name in DROPPED or node.words >= INLINE_WORDS):
            held = count[node.last + 1] - count[node.first]
            text = (prefix[node.last + 1] - prefix[node.first] * powers[held]) % _MOD
            found.append(Subtree(_hash(f"{host} {node.name} {held} {text}"), node.first, node.last))
    return found


def kept_segments(segments: list[Segment]) -> list[int]:
    """Numbers of the article's segments, or of all where there is no article, without what is dropped; and of the ends of blocks."""
    article = any(s.article and not s.dropped and s.text.strip() for s in segments)
    return [i for i, s in enumerate(segments) if s.end or not s.dropped and (s.article or not article)]


def parsed(page: str, host: str = "") -> list[Segment]:
    """The text of a page in order."""
    return read_page(page, host)[0]


def main_segments(segments: list[Segment]) -> list[Segment]:
    return [segments[i] for i in kept_segments(segments)]


def tidy(text: F.Column) -> F.Column:
    """Blocks trimmed, emptied ones left out."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, " *\n[ \n]*", "\n"), " {2,}", " "), F.lit(" \n"))


def _host(url: str) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _read(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """``key, url, site`` (hash of the host), ``texts``, ``cuts, low, high`` (subtrees that hold some of the texts, and which), ``content, trees`` (all subtrees of the page), ``live`` (whether it holds text that is not dropped)."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), _host(F.col(url)).alias("host"), F.col(page).alias("page"))
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("key", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, value in zip(batch.column(2), batch.column(3)):
                name = host.as_py()
                segments, subtrees = read_page(value.as_py() or "", name)
                kept = kept_segments(segments)
                texts = [segments[i].text for i in kept]
                content = _hash(name + "\n" + " ".join("".join(texts).split()))
                # Where each subtree lies among the kept segments, and whether any of them is text.
                first, last = np.array([[t.first, t.last + 1] for t in subtrees], np.int64).reshape(-1, 2).T
                places = np.array(kept, np.int64)
                own = np.cumsum([0, *(not segments[i].end for i in kept)])
                low, high = np.searchsorted(places, first), np.searchsorted(places, last)
                live = own[high] > own[low]
                trees: dict[int, bool] = {}
                for tree, alive in zip(subtrees, live.tolist()):
                    trees[tree.hash] = trees.get(tree.hash, False) or alive
                cuts = [[t.hash for t, alive in zip(subtrees, live.tolist()) if alive], low[live].tolist(), high[live].tolist()]
                out.append((_hash(name) & ((1 << _HOST_BITS) - 1), texts, *cuts, content, list(trees), list(trees.values())))
            longs = pa.list_(pa.int64())
            types = (pa.int64(), pa.list_(pa.string()), longs, longs, longs, pa.int64(), longs, pa.list_(pa.bool_()))
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["key", "url", "site", "texts", "cuts", "low", "high", "content", "trees", "live"])

    longs = "cuts array<long>, low array<long>, high array<long>"
    return rows.mapInArrow(run, f"{kinds}, site long, texts array<string>, {longs}, content long, trees array<long>, live array<boolean>")


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every page and subtree: subtree, content, host and whether live."""
    none = np.zeros(0, np.int64)
    for batch in batches:
        content, site = (batch.column(i).to_numpy() for i in (0, 1))
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        trees, live = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
        yield stream.batch(trees.astype(np.int64), np.repeat(content, sizes), (np.repeat(site, sizes) << 1) + live.astype(np.int64), (none, none, none))


def recurring(read: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """``content, gone``: the subtrees to delete from pages of a content, by the counts of their hosts."""
    rows = read.select("content", "site", "trees", "live").mapInArrow(_tree_rows, stream.KIND)
    met = stream.shared(rows).groupBy(F.col("sign").alias("tree"), F.col("item").alias("content")).agg(F.max("meta").alias("meta"))
    met = stage(met.select("tree", "content", F.shiftright("meta", 1).alias("site"), (F.col("meta") % 2 == 1).alias("live")), "trees")
    pages = read.select("content", "site").distinct().groupBy("site").agg(F.count("*").alias("pages"))
    counts = met.groupBy("tree", "site").agg(F.count("*").alias("n"), F.max("live").alias("live")).where(F.col("live") & (F.col("n") >= F.greatest(F.lit(2), F.least(F.lit(least) * share, F.lit(MANY_PAGES)))))
    often = (F.col("pages") >= least) & (F.col("n") >= F.col("pages") * share)
    low = (F.col("n") >= MANY_PAGES) & (F.col("n") >= F.col("pages") * LOW_SHARE)
    template = stage(counts.join(pages, "site").where(often | low).select("tree"), "template")
    hits = met.where("live").join(template, "tree")
    return stage(hits.groupBy("content").agg(F.collect_set("tree").alias("gone")), "gone")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each page that lie in none of the subtrees gone."""
    for batch in batches:
        out = []
        for texts, cuts, low, high, gone in zip(*(batch.column(i) for i in range(2, 7))):
            texts = texts.as_py()
            if gone.is_valid:
                hit = np.isin(cuts.values.to_numpy(), gone.values.to_numpy())
                deep = np.zeros(len(texts) + 1, np.int64)
                np.add.at(deep, low.values.to_numpy()[hit], 1)
                np.add.at(deep, high.values.to_numpy()[hit], -1)
                texts = [t for t, d in zip(texts, np.cumsum(deep).tolist()) if not d]
            out.append("".join(texts))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string())], ["key", "url", "text"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """``key, url, text, n_chars`` of every page."""
    read = stage(_read(pages, key, url, page), "blocks")
    judged = read.join(recurring(read, share, least), "content", "left").select("key", "url", "texts", "cuts", "low", "high", "gone")
    kinds = ", ".join(f"{n} {judged.schema[n].dataType.simpleString()}" for n in ("key", "url"))
    judged = judged.mapInArrow(_without, f"{kinds}, text string")
    found = judged.select(F.col("key").alias(key), F.col("url").alias(url), tidy(F.col("text")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
