"""Main text of web pages by site style trees.

The element trees of all pages of a host are merged: elements whose path of tags
and classes is equal are one style node. A node's presentation importance is the
entropy of its child sequences over the pages, its content importance falls with
the share of pages that repeat its text; both run from 0 (the same on all pages)
to 1. The composite importance of a node weighs its own presentation with the
content below it. Branches without important content are removed from each page,
as are those whose tag, role or class says that they are no part of the article.
Within ``article`` and ``main`` elements repetition alone removes nothing.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.frames import append_columns, unused, written
from shelfmark.llm.urls import host_of

#: Importance up to which a node is noise. Each is taken as if one more page had shown full importance, so that
#: a few pages alone don't make noise of what they share.
NOISE = 0.2
#: Weight of a node's own presentation: 1 - GAMMA ** (number of child sequences).
GAMMA = 0.9
#: Elements nested deeper belong to the style node of their ancestor at this depth: a node is counted with each
#: of its ancestors, so hostile nesting would make rows without bound.
DEPTH = 48
#: Slots that a host's pages are dealt to.
SLOTS = 32

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSE_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt".split()
)
#: An opening tag ends an open element of these, up to the list or table around it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tr", "thead", "tbody", "tfoot"}, {"table"}),
}
#: Elements, roles and class or id words that are no part of an article.
NOISE_TAGS = frozenset(
    "head script style title nav footer aside form button select option input textarea label fieldset noscript iframe "
    "template object svg canvas dialog menu datalist audio video noembed noframes xmp math search".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice popup modal overlay sidebar menu nav navbar navigation navigate breadcrumb "
    "breadcrumbs footer comment comments disqus respond replies share sharing social related recommended newsletter "
    "subscribe subscription signup login widget toolbar pagination pager".split()
)
NOISE_NAMES = frozenset("header site-header page-header top-header masthead topbar top-bar site-head".split())
CONTAINERS = ("article", "main")
#: Elements of these that hold the main text wrap the whole page.
WRAPPERS = frozenset("form fieldset".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^>=<]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>|<[!?/][^>]*(?:>|\Z)|[^<]+|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TELLING = re.compile(r"class|id\s*=|role|hidden|style", re.I)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[^a-z0-9]+")
#: Comments and tags, roughly: what is left tells whether two pages have the same text.
_MARKUP = r"(?s)<!--.*?-->|<[^>]*>|\s+"
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """A block element: where it hangs, its style, and whether it is noise by itself."""

    __slots__ = ("tag", "parent", "depth", "style", "path", "noise", "children", "container")

    def __init__(self, tag, parent, style, noise, container):
        self.tag, self.parent, self.style, self.noise, self.container = tag, parent, style, noise, container
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[str] = []
        if parent is None:
            self.path = 0
        elif self.depth > DEPTH:
            self.path = parent.path
        else:
            self.path = xxhash.xxh64_intdigest(style, parent.path) - (1 << 63)
            if not parent.children or parent.children[-1] != style:
                parent.children.append(style)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def _names_noise(name: str) -> bool:
    """Whether a class or id is a noise word, or begins or ends with one."""
    parts = [p for p in _WORDS.split(name) if p]
    return name in NOISE_NAMES or bool(parts) and (parts[0] in NOISE_WORDS or parts[-1] in NOISE_WORDS)


def _judge(tag: str, attributes: dict[str, str]) -> tuple[str, bool]:
    """Style of an element, and whether its attributes say that it is noise."""
    names = attributes.get("class", "").lower().split()
    own = [*names, attributes.get("id", "").lower()]
    noise = (
        attributes.get("role", "").lower() in NOISE_ROLES or "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or bool(_HIDDEN.search(attributes.get("style", "")))
        or tag not in ("html", "body") and any(map(_names_noise, own))
    )
    style = ".".join([tag, *sorted({_DIGITS.sub("0", n) for n in names})])
    return style, noise


class Page:
    """The block elements of a page, and its blocks of text in order."""

    def __init__(self, source: str | None):
        self.root = Node("", None, "", False, False)
        self.nodes = [self.root]
        self.blocks: list[tuple[Node, str]] = []
        self._parts: list[str] = []
        self._parse(source or "")

    def _end_block(self, owner: Node) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((owner, text))
            self._parts = []

    def _parse(self, source: str) -> None:
        stack = [self.root]
        depths: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
        at, size = 0, len(source)
        lower = None

        def pop_to(depth: int) -> None:
            self._end_block(stack[-1])
            while len(stack) > depth:
                depths[stack.pop().tag].pop()

        def close(tags: set, borders: set) -> None:
            """End the nearest open element of ``tags``, unless one of ``borders`` is nearer."""
            nearest = max((depths[t][-1] for t in tags if depths[t]), default=0)
            if nearest > max((depths[t][-1] for t in borders if depths[t]), default=0):
                pop_to(nearest)

        while at < size:
            token = _TOKEN.match(source, at)
            at = token.end()
            tag = token.group(2)
            if tag is None:
                text = token.group()
                if text[0] != "<" or text == "<":
                    self._parts.append(html.unescape(text) if "&" in text else text)
                continue
            tag = tag.lower()
            if token.group(1):
                if tag == "br" or tag == "p" and not depths["p"]:
                    self._parts.append(" ")
                elif depths[tag]:
                    pop_to(depths[tag][-1])
                continue
            if tag in ("br", "wbr"):
                self._parts.append(" " if tag == "br" else "")
                continue
            rest = token.group(3)
            style, noise, role = tag, False, ""
            if rest and _TELLING.search(rest):
                attributes = _attributes(rest)
                role = attributes.get("role", "").lower()
                style, noise = _judge(tag, attributes)
            if tag in RAW:  # its content is no markup
                if lower is None:
                    lower = source.lower() if source.isascii() else _ascii_lower(source)
                end = lower.find(f"</{tag}", at)
                close_at = size if end < 0 else source.find(">", end)
                at = size if close_at < 0 else min(size, close_at + 1)
                self._end_block(stack[-1])
                continue
            if tag in VOID:
                if tag not in INLINE and tag != "img":
                    self._end_block(stack[-1])
                continue
            if tag in INLINE and not noise:
                continue
            if tag in CLOSE_P and depths["p"]:
                close({"p"}, {"table", "td", "th", "button", "object", "caption"})
            if tag in CLOSES:
                close(*CLOSES[tag])
            self._end_block(stack[-1])
            parent = stack[-1]
            container = tag in CONTAINERS or role == "main"
            inside = parent.container or container
            by_tag = tag in NOISE_TAGS or tag == "header" and not inside
            node = Node(tag, parent, style, by_tag or noise and not container, inside)
            self.nodes.append(node)
            depths[tag].append(len(stack))
            stack.append(node)
        self._end_block(stack[-1])

    def style_rows(self) -> list[tuple[int, list[int], int, int]]:
        """``path, ancestors with itself, kind, feature`` of each style node of the page, each once.

        Kind 0 is presentation: the child sequences; kind 1 is content: a block's text.
        """
        lines: dict[int, list[int]] = {0: [0]}
        looks: dict[int, list[str]] = {}
        for node in self.nodes:
            if node.path not in lines:
                lines[node.path] = [*lines[node.parent.path], node.path]
            looks.setdefault(node.path, []).append(">".join(node.children))
        rows = {
            (path, 0, xxhash.xxh64_intdigest("|".join(dict.fromkeys(of))) - (1 << 63)) for path, of in looks.items()
        } | {(owner.path, 1, xxhash.xxh64_intdigest(text) - (1 << 63)) for owner, text in self.blocks}
        return [(path, lines[path], kind, feature) for path, kind, feature in rows]

    def text(self, noisy: frozenset[int] = frozenset()) -> str:
        """The article's blocks, without noise by structure and without style nodes in ``noisy``.

        An element around an ``article`` or ``main`` isn't noise by its class; on a
        page without these, one that holds most of the text isn't. Where the page's
        ``article`` elements (else its ``main``) hold at least half of that text, its
        blocks lie in them; else they are teasers, and all blocks stay. If nothing but
        noisy style nodes is left, they stay.
        """
        if not self.blocks:
            return ""
        holds_main = set()  # elements around a main element aren't noise by their class
        mains = {kind: [n for n in self.nodes if n.tag == kind] for kind in CONTAINERS}
        for found in mains.values():
            for node in found:
                up = node.parent
                while up is not None and id(up) not in holds_main:
                    holds_main.add(id(up))
                    up = up.parent
        if not holds_main:
            self._mark_largest(holds_main)
        structural: dict[int, bool] = {}
        repeated: dict[int, bool] = {}
        inside: dict[int, set] = {}
        for node in self.nodes:
            up = id(node.parent)
            own = node.noise and (node.tag in NOISE_TAGS - WRAPPERS or id(node) not in holds_main)
            structural[id(node)] = own or structural.get(up, False)
            repeated[id(node)] = repeated.get(up, False) or node.path in noisy and node.path != 0 and not node.container
            inside[id(node)] = inside.get(up, set()) | {node.tag} if node.tag in CONTAINERS else inside.get(up, set())
        kept = [(o, t) for o, t in self.blocks if not structural[id(o)]]
        important = [(o, t) for o, t in kept if not repeated[id(o)]] or kept
        size = sum(len(t) for _, t in important)
        for kind in CONTAINERS:
            within = [(o, t) for o, t in important if kind in inside[id(o)]]
            if within and 2 * sum(len(t) for _, t in within) >= size:
                important = within
                break
        return " ".join([t for _, t in important])


    def _mark_largest(self, holding: set) -> None:
        """Add the elements that hold more than half of the text outside elements of noise tags."""
        sizes: dict[int, int] = defaultdict(int)
        for owner, text in self.blocks:
            sizes[id(owner)] += len(text)
        total = 0
        for node in reversed(self.nodes):  # children before their parents
            if node.noise and node.tag in NOISE_TAGS - WRAPPERS:
                sizes[id(node)] = 0
            if node.parent is None:
                total = sizes[id(node)]
            else:
                sizes[id(node.parent)] += sizes[id(node)]
        holding.update(id(n) for n in self.nodes if 2 * sizes[id(n)] > total)


def _ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


ROWS = "array<struct<path:bigint,line:array<bigint>,kind:int,feature:bigint>>"


def style_nodes(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``host, path, pages, importance, content`` of each node of the style trees of all hosts.

    ``importance`` is the composite one, ``content`` the largest content
    importance in the node's branch (null where it holds no text). Rows are
    counted by feature first, so that a host with very many pages is spread over
    its different texts, and only sums meet at a node.
    """
    def start():
        return lambda sources: [[Page(s).style_rows() for s in sources]]

    rows = append_columns(
        pages.select(F.xxhash64(host_of(F.col(url))).alias("host"), F.col(source).alias("html")), "html", start,
        f"rows {ROWS}",
    ).select("host", F.explode("rows").alias("r")).select("host", "r.path", "r.line", "r.kind", "r.feature")
    features = rows.groupBy("host", "path", "line", "kind", "feature").agg(F.count("*").alias("c"))
    # Written, so that the pages are parsed once for all that follows.
    nodes = written(features.groupBy("host", "path", "line", "kind").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("s"), F.count("*").alias("different")
    ))
    shapes = nodes.where("kind = 0").select(
        "host", "path", F.col("n").alias("pages"), "different",
        F.when(F.col("n") > 1, (F.log("n") - F.col("s") / F.col("n")) / F.log("n")).otherwise(1.0).alias("shape"),
    )
    texts = nodes.where("kind = 1").select("host", "path", "line", "n", "s").join(
        shapes.select("host", "path", "pages"), ["host", "path"]
    ).select(
        "host", "line", "n",
        F.when(F.col("pages") > 1, F.greatest(F.lit(0.0), 1 - F.col("s") / F.col("n") / F.log("pages")))
        .otherwise(1.0).alias("content"),
    )
    below = texts.select("host", F.explode("line").alias("path"), "n", "content").groupBy("host", "path").agg(
        (F.sum(F.col("n") * F.col("content")) / F.sum("n")).alias("mean"), F.max("content").alias("content")
    )
    own = 1 - F.pow(F.lit(GAMMA), F.col("different"))
    return shapes.join(below, ["host", "path"], "left").select(
        "host", "path", "pages",
        (own * F.col("shape") + (1 - own) * F.coalesce("mean", F.lit(0.0))).alias("importance"), "content",
    )


def different_pages(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``url`` and ``source`` of each page of each host that differs from others in more than markup, once.

    A task first drops the copies it holds, so a page with very many of them is
    no heavier than others.
    """
    host, key = (unused(pages, n) for n in ("site", "key"))
    return pages.select(url, source).withColumns(
        {host: F.xxhash64(host_of(F.col(url))), key: F.xxhash64(F.regexp_replace(F.col(source), _MARKUP, ""))}
    ).dropDuplicates([host, key]).select(url, source)


def extract(pages: DataFrame, url: str = "url", source: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in column ``name``.

    White space inside a block is one space, blocks are joined by one space in
    page order. A null, empty or textless page has an empty text; a null URL
    counts as one without host, and those form one site. Copies of a page, also
    with other markup, count as one page of their site, so that their number
    doesn't make it noise; all of them stay in the result, as do repeated rows. The
    noise nodes meet the pages by host, each host in ``SLOTS`` parts. An empty table
    gives an empty result. A column of ``pages`` that bears the name is replaced.
    """
    def at_most(importance: str) -> Column:
        seen = F.col("pages") * F.coalesce(importance, F.lit(0.0)) + 1
        return seen <= NOISE * (F.col("pages") + 1)


    noisy = written(
        style_nodes(different_pages(pages, url, source), url, source)
        .where(at_most("importance") & at_most("content") & (F.col("path") != 0))
        .select("host", "path")
    )
    kept = pages.drop(name) if name.lower() != source.lower() else pages
    host, slot, noise = (unused(pages, n) for n in ("site", "slot", "noise"))
    known = kept.withColumn(host, F.xxhash64(host_of(F.col(url))))
    lists = noisy.groupBy(F.col("host").alias(host)).agg(F.collect_set("path").alias(noise))
    dealt = F.pmod(F.xxhash64(F.col(source)), F.lit(SLOTS)).cast("int")
    lists = lists.withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    joined = known.withColumn(slot, dealt).join(lists, [host, slot], "left")

    def start():
        return lambda rows: [[Page(r["html"]).text(frozenset(r["noise"] or ())) for r in rows]]

    wanted = [c for c in kept.columns if c.lower() != name.lower()]
    given = unused(pages, "given")
    ready = joined.select(*wanted, F.struct(F.col(source).alias("html"), F.col(noise).alias("noise")).alias(given))
    return append_columns(ready, given, start, f"`{name}` string", keep_source=False)
