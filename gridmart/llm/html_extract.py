"""Main-text extraction by boosted trees over DOM nodes.

A page is parsed into a tree of elements. A gradient-boosted tree ensemble gives
each element the probability of belonging to the article, from its tag class,
attribute tokens, depth, sibling statistics and the density of text, links and
tags in its subtree. Blocks are judged; an inline element (a link, a span with a
class, emphasis) inside a block of text has no vote and goes where its block goes.
Decoding is hierarchical: a dropped element drops its whole
subtree and a kept one may drop children, so an ancestor and a descendant never
contradict each other; the best consistent choice is found in one pass from the
leaves to the root.

Training uses a bounded, documented sample of pages whose own markup tells the
article (``<article>`` or ``<main>``). Each sampled page is also used in variants
in which those tags become plain containers with class names, in which the article
gets links, named spans and paragraphs, captioned figures and a header around its
title, and in which sidebars, notices, forms, menus and reader comments are inserted,
so the trees do not lean on one page layout. Scripts, styles, comments and the head are
markup and never text.

Edge cases: a null, empty or text-free html gives the empty text; unclosed,
misnested and cut-off tags are repaired as far as browsers do for paragraphs and
lists; a quote opens an attribute's value only right after its ``=``; a drawing
closed in its own tag ends there, one left open at the next HTML tag; text outside
any element counts as a child of the root; repeated rows give equal texts; extra
columns are ignored; an empty table gives no rows. A table without any sampled
article is judged by the built-in node classes alone.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridmart.llm.common import one_per_key

#: Documented bounds of the training sample: pages, and characters of one page.
MAX_PAGES = 150
MAX_PAGE_CHARS = 20_000

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mstyle msub msup msubsup mover munder munderover semantics annotation".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul xmp".split())
#: Elements whose end is implied by a sibling: tag -> tags that end it.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
           "th": {"td", "th", "tr"}, "option": {"option"}}
#: What never holds text of the page, whatever the model says.
NEVER = frozenset("head script style template noscript iframe svg textarea select button object canvas".split())

TAG_CLASSES = (
    ("root", {"#root", "html", "body"}), ("article", {"article", "main"}), ("p", {"p"}),
    ("heading", {"h1", "h2", "h3", "h4", "h5", "h6"}), ("list", {"ul", "ol", "dl", "menu"}),
    ("item", {"li", "dt", "dd"}), ("nav", {"nav"}), ("edge", {"header", "footer"}), ("aside", {"aside"}),
    ("form", {"form", "input", "fieldset", "label", "dialog"}), ("box", {"div", "section"}), ("inline", set(INLINE) - {"a"}),
    ("link", {"a"}), ("quote", {"blockquote", "pre", "xmp", "figure", "figcaption"}),
    ("table", {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}),
)
#: Attribute tokens by meaning; a node has the feature if its class, id, role or label names one.
TOKENS = (
    ("good", {"article", "content", "post", "entry", "main", "story", "body", "text", "page", "prose"}),
    ("menu", {"nav", "menu", "navbar", "breadcrumb", "breadcrumbs", "tabs", "pagination", "pager", "toc", "navigation"}),
    ("edge", {"header", "footer", "masthead", "banner", "copyright", "topbar", "bottom", "contentinfo"}),
    ("side", {"sidebar", "aside", "side", "rail", "widget", "related", "recommended", "complementary", "promo", "more"}),
    ("notice", {"notice", "cookie", "cookies", "consent", "alert", "modal", "popup", "gdpr", "message", "subscribe",
                "newsletter", "paywall", "warning"}),
    ("advert", {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "adsense"}),
    ("form", {"form", "search", "login", "signup", "share", "social"}),
    ("reader", {"comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "reviews"}),
)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<decl>[!?])[^>]*(?:>|\Z)|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)"
                  r"(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]++)?+)?+)*+)(?:>|\Z))", re.S)
#: Tags that end a drawing left open, as in browsers, and those of a drawing that may hold them.
_BREAKOUT = re.compile(r"<(?:b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|"
                       r"meta|nobr|ol|p|pre|ruby|s|small|span|strong|strike|sub|sup|table|tt|u|ul|var)[\s/>]", re.I)
_HOLDS_HTML = re.compile(r"<(?:foreignObject|desc|title)[\s/>]", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "at")

    def __init__(self, tag: str, attrs: str, parent: "Node | None") -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []  # elements and raw text in page order
        self.at = -1


def parse(page: str | None) -> Node:
    """Tree of a page; raw texts keep their character references."""
    root = Node("#root", "", None)
    here, pos, page = root, 0, page or ""
    while True:
        m = _TAG.search(page, pos)
        if m is None:
            break
        if m.start() > pos:
            here.children.append(page[pos:m.start()])
        pos = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            up = here
            while up is not root and up.tag != name:
                up = up.parent
            if up is not root:
                here = up.parent
            continue
        if name in CLOSES_P:
            up = here
            while up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                here = up.parent
        if name in IMPLIED:
            up = here
            while up.tag in INLINE or up.tag == "p":
                up = up.parent
            while up.tag in IMPLIED and name in IMPLIED[up.tag]:
                here = up = up.parent
        node = Node(name, m["attrs"] or "", here)
        here.children.append(node)
        closed = (m["attrs"] or "").endswith("/")
        if name in RAW and not (closed and name == "svg"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, pos)
            stop, after = (end.start(), end.end()) if end else (len(page), len(page))
            if name == "svg" and (out := _BREAKOUT.search(page, pos, stop)) and not (
                    end and _HOLDS_HTML.search(page, pos, out.start())):
                after = out.start()
            if name == "textarea":
                node.children.append(page[pos:stop])
            if name == "xmp":  # shown as it stands, so its references stay
                node.children.append(html_lib.escape(page[pos:stop], quote=False))
            pos = after
        elif name not in VOID and not closed:
            here = node
    if pos < len(page):
        here.children.append(page[pos:])
    return root


def elements(root: Node) -> list[Node]:
    """Elements in page order; a node's ``at`` is its index."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        node.at = len(out)
        out.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return out


_ROOTS = frozenset(("#root", "html", "body"))


def followers(nodes: list[Node]) -> np.ndarray:
    """Which elements are inline parts of a text block and go where it goes.

    A text block has text of its own or no blocks inside; the page's root is none.
    An inline element that stands among the blocks of a container is judged itself.
    """
    blocks, text = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
    for i in range(len(nodes) - 1, -1, -1):
        v = nodes[i]
        text[i] = any(isinstance(c, str) and not c.isspace() for c in v.children)
        if i:
            blocks[v.parent.at] |= v.tag not in INLINE and v.tag not in VOID or blocks[i] and v.tag in INLINE
    out = np.zeros(len(nodes), bool)
    for i, v in enumerate(nodes):
        if v.tag in INLINE:
            up = v.parent
            out[i] = out[up.at] or up.tag not in INLINE and up.tag not in _ROOTS and (text[up.at] or not blocks[up.at])
    return out


_TAG_OF = {t: i for i, (_, tags) in enumerate(TAG_CLASSES) for t in tags}
_TOKEN_OF: dict[str, list[int]] = {}
for _i, (_, _names) in enumerate(TOKENS):
    for _t in _names:
        _TOKEN_OF.setdefault(_t, []).append(_i)
N_FEATURES = len(TAG_CLASSES) * 2 + len(TOKENS) * 2 + 16
#: Columns that name boilerplate: all token classes but the first, and four tag classes.
_FLAGS = [i for i, (name, _) in enumerate(TAG_CLASSES) if name in ("nav", "edge", "aside", "form")] + list(
    range(len(TAG_CLASSES) + 1, len(TAG_CLASSES) + len(TOKENS)))


def features(nodes: list[Node]) -> np.ndarray:
    """One row per element."""
    n = len(nodes)
    text, links, tags, commas = (np.zeros(n) for _ in range(4))
    depth, place, siblings = np.zeros(n), np.zeros(n), np.ones(n)
    parent = np.zeros(n, int)
    x = np.zeros((n, N_FEATURES), np.float32)
    first_token = len(TAG_CLASSES)
    for i, node in enumerate(nodes):
        kids = 0
        for c in node.children:
            if isinstance(c, str):
                if node.tag not in NEVER:
                    text[i] += len(c.strip())
                    commas[i] += c.count(",") + c.count(".")
            else:
                place[c.at] = kids
                kids += 1
        for c in node.children:
            if not isinstance(c, str):
                siblings[c.at] = kids
        if node.parent is not None:
            parent[i] = node.parent.at
            depth[i] = depth[parent[i]] + 1
        if node.tag in _TAG_OF:
            x[i, _TAG_OF[node.tag]] = 1
        if node.attrs and not node.attrs.isspace():
            for a in _ATTR.finditer(node.attrs):
                if a[1].lower() in ("class", "id", "role", "aria-label", "itemprop"):
                    for token in _SPLIT.split(a[2] or a[3] or a[4] or ""):
                        for k in _TOKEN_OF.get(token.lower(), ()):
                            x[i, first_token + k] = 1
    own, title, joined = text.copy(), np.array([v.tag == "h1" for v in nodes], float), followers(nodes)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        own[p] += own[i] if joined[i] else 0
        title[p] += title[i]
        links[i] += text[i] if nodes[i].tag == "a" else 0
        links[i] = min(links[i], text[i])
        text[p] += text[i]
        links[p] += links[i]
        commas[p] += commas[i]
        tags[p] += tags[i] + 1
    total = max(text[0], 1.0)
    up = first_token + len(TOKENS)
    for i in range(1, n):  # tag classes and tokens of ancestors, inherited downwards
        p = parent[i]
        x[i, up:2 * up] = np.maximum(x[p, up:2 * up], x[p, :up])
    rest = 2 * up
    par = parent
    x[:, rest:] = np.stack([
        np.log1p(text), np.log1p(own), links / np.maximum(text, 1), text / (tags + 1), np.log1p(tags),
        text / total, depth, place, siblings, (place + 1) / siblings, commas / np.maximum(text, 1) * 100,
        text / np.maximum(text[par], 1), links[par] / np.maximum(text[par], 1), (text == 0).astype(float),
        x[:, _FLAGS + [up + i for i in _FLAGS]].any(axis=1),  # named as boilerplate, itself or above
        title > 0,
    ], axis=1)
    return x


@dataclass
class Boosted:
    """Gradient-boosted regression trees on the logistic loss, over feature bins."""

    base: float
    edges: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature, bin and leaf value per heap slot
    depth: int

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 4, rate: float = 0.3,
            bins: int = 24, l2: float = 1.0) -> "Boosted":
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)
        good = y.mean()
        base = float(np.log((good + 1e-3) / (1 - good + 1e-3)))
        z = np.full(len(y), base)
        model = Boosted(base, edges, [], depth)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            slots = 1 << (depth + 1)
            feature, cut, value = np.full(slots, -1), np.zeros(slots, int), np.zeros(slots)
            where = np.ones(len(y), int)
            for slot in range(1, slots):
                rows = np.flatnonzero(where == slot)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                value[slot] = -rate * gs / (hs + l2)
                if slot >= slots // 2 or len(rows) < 20:
                    continue
                best, at = 1e-3, None
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    gl = np.cumsum(np.bincount(b[rows, j], g[rows], len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b[rows, j], h[rows], len(e) + 1))[:-1]
                    gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                    gain = np.round(gain, 6)  # equal splits stay equal on any machine: the first one counts
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, at = gain[k], (j, k)
                if at is not None:
                    feature[slot], cut[slot] = at
                    where[rows] = 2 * slot + (b[rows, at[0]] > at[1])
            model.trees.append((feature, cut, value))
            z += value[where]
        return model

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.ones(len(x), int)
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f < 0, at, 2 * at + (b[rows, np.maximum(f, 0)] > cut[at]))
            z += value[at]
        return z


_BAD_TAGS = frozenset("nav header footer aside form dialog".split())


def plain_logit(nodes: list[Node]) -> np.ndarray:
    """Stand-in for the model where nothing could be trained: drop the known boilerplate."""
    x = features(nodes)
    bad = x[:, len(TAG_CLASSES) + 1:len(TAG_CLASSES) + len(TOKENS)].any(axis=1)
    return np.where([n.tag in _BAD_TAGS for n in nodes] | bad, -4.0, 4.0)


def decode(nodes: list[Node], logit: np.ndarray) -> np.ndarray:
    """Kept elements of the most probable choice in which dropping drops the subtree.

    keep(v) = gain of v + the sum over children of max(keep, drop);
    drop(v) = 0, as gains are log-odds against dropping. The root is kept, and an
    inline part of a text block is kept with it.
    """
    n = len(nodes)
    gain, joined = np.clip(logit, -8, 8), followers(nodes)
    own = np.array([any(isinstance(c, str) and not c.isspace() for c in v.children) for v in nodes])
    for i in range(n - 1, 0, -1):
        if joined[i]:
            own[nodes[i].parent.at] |= own[i]
    # An element without text of its own is a container: its own vote counts little.
    gain = np.where(own, gain, 0.25 * gain)
    gain = np.where(joined, 0.0, np.where([v.tag in NEVER for v in nodes], -1e6, gain))
    worth = gain.copy()
    for i in range(n - 1, 0, -1):
        if worth[i] > 0 or joined[i]:
            worth[nodes[i].parent.at] += worth[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[nodes[i].parent.at] and (worth[i] > 0 or joined[i])
    return kept


def text_of(nodes: list[Node], kept: np.ndarray) -> str:
    """Text of the kept elements: white space runs become one space, blocks are separated."""
    parts: list[str] = []
    stack: list[Node | str] = [nodes[0]]
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            parts.append(c)
        elif kept[c.at]:
            if c.tag in INLINE:
                stack.extend(reversed(c.children))
            else:
                parts.append(" ")
                stack.append(" ")
                stack.extend(reversed(c.children))
        else:
            parts.append(" ")
    return " ".join(html_lib.unescape("".join(parts)).split())


# --- training -------------------------------------------------------------

_WORDS = re.compile(r"\w{3,}")
#: Attribute that names a box in the truth and is taken out of what the model sees.
_UNNAMED = ' class="menu unnamed"'


def article_mask(nodes: list[Node]) -> np.ndarray | None:
    """Which elements belong to the article by the page's own tags; None without such a tag."""
    inside = np.zeros(len(nodes), bool)
    for i, v in enumerate(nodes):
        p = v.parent
        if v.tag in NEVER or v.tag in _BAD_TAGS:
            continue
        if v.tag in ("article", "main") or (p is not None and inside[p.at]):
            inside[i] = True
    if not inside.any():
        return None
    for i in range(len(nodes) - 1, 0, -1):  # what holds the article is kept as well
        if inside[i]:
            inside[nodes[i].parent.at] = True
    return inside


def variants(page: str, other: str, seed: int) -> list[tuple[str, str]]:
    """(html, html with the article marked by its tag): the page and changed layouts of it.

    The second form tells the truth; the first is what the model sees.
    """
    words = _WORDS.findall(re.sub(r"<[^>]*>", " ", other))[:4000] or ["word"]
    r = np.random.default_rng(seed)

    def some(lo: int, hi: int) -> str:
        return " ".join(words[k] for k in r.integers(0, len(words), int(r.integers(lo, hi))))

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{some(1, 4)}</a></li>' for i in range(k)) + "</ul>"

    def pick(*names: str) -> str:
        return names[int(r.integers(0, len(names)))]

    def paragraphs(lo: int, hi: int) -> str:
        """One to five, so that a paragraph's place among its siblings tells little."""
        return "".join(f"<p>{some(lo, hi)}</p>" for _ in range(int(r.integers(1, 6))))

    def boxes() -> list[str]:
        return [
            f'<aside class="{pick("sidebar", "related", "widget")}"><h3>{some(1, 3)}</h3>{links(4)}{paragraphs(5, 30)}</aside>',
            f'<div class="{pick("sidebar", "side-bar", "related-posts", "promo")}"><h4>{some(1, 4)}</h4>{paragraphs(8, 40)}{links(3)}</div>',
            f'<div class="{pick("cookie-notice", "notice", "alert", "newsletter", "consent")}">{paragraphs(6, 40)}<button>{some(1, 2)}</button></div>',
            f'<form action="/s" class="{pick("search", "login", "subscribe")}"><label>{some(1, 4)}</label><input name="q">{paragraphs(2, 12)}</form>',
            f'<section id="{pick("comments", "respond", "discussion")}"><h3>{some(1, 3)}</h3>' + "".join(
                f'<div class="comment"><b>{some(1, 2)}</b>{paragraphs(8, 60)}</div>' for _ in range(3)) + "</section>",
            f'<div class="{pick("ad", "advert", "sponsored", "ads banner")}">{some(4, 30)}</div>',
            f'<div class="{pick("menu", "breadcrumb", "nav tabs", "pagination")}">{links(5)}</div>',
            f"<header><h2>{some(1, 4)}</h2>{paragraphs(3, 12)}</header>",
            f'<div class="{pick("footer", "site-footer", "copyright")}">{paragraphs(5, 25)}{links(3)}</div>',
            f'<div role="{pick("complementary", "navigation", "contentinfo")}">{paragraphs(5, 30)}</div>',
            f"<div{_UNNAMED}>{links(6)}</div>",  # told by its links alone
        ]

    def enriched(inner: str) -> tuple[str, str]:
        """The article with parts of it wrapped and named: as the truth tells it and as the model sees it."""
        blocks = re.split(r"(<p>.*?</p>|<h1>.*?</h1>)", inner, flags=re.S | re.I)
        told, seen = [], []
        for i, block in enumerate(blocks):
            how = r.random() if i % 2 else 1.0
            t = s = block
            if block[:2].lower() == "<p":
                text = block[3:-4]
                if how < 0.15 and (words_in := _WORDS.findall(re.sub(r"<[^>]*>|&[^;]*;", " ", text))):
                    word = words_in[int(r.integers(0, len(words_in)))]
                    wrap = pick('<a href="/w">', '<span class="more">', '<a class="related" href="#">')
                    tag = wrap[1:].split()[0]
                    place = re.compile(rf"(?<![\w<&/]){word}(?!\w)")
                    t, s = (f"<p>{place.sub(f'{w}{word}</{tag}>', text, count=3)}</p>" for w in (f"<{tag}>", wrap))
                elif how < 0.25:
                    t = s = f'<p><a href="/w">{text}</a></p>'
                elif how < 0.4:
                    s = f'<p class="{pick("message-body", "text more", "lead notice", "body side")}">{text}</p>'
                elif how < 0.5:
                    t = s = f'<figure><img src="/i.png"><figcaption>{some(4, 14)}</figcaption></figure>{block}'
            elif block[:3].lower() == "<h1" and how < 0.5:
                t, s = f"<div>{block}</div>", f"<header>{block}</header>"
            told.append(t)
            seen.append(s)
        return "".join(told), "".join(seen)

    out = [(page, page)]
    parts = re.split(r"(<article[^>]*>.*?</article>)", page, maxsplit=1, flags=re.S | re.I)
    if len(parts) != 3:
        return out
    before, article, after = parts
    for k in range(3):
        extra = boxes()
        r.shuffle(extra)
        inner = re.sub(r"^<article[^>]*>|</article>$", "", article, flags=re.I)
        plain, inner = enriched(inner)
        at = [[m.end() for m in re.finditer(r"</h1>|</p>", t)] for t in (plain, inner)]
        if at[0]:  # boilerplate inside the article
            cut = int(r.integers(0, len(at[0])))
            plain, inner = (t[:a[cut]] + extra[0] + t[a[cut]:] for t, a in zip((plain, inner), at))
        b, a = "".join(extra[1:4]), "".join(extra[4:8])
        if r.random() < 0.5:  # a site's own title
            b = f'<header><h1><a href="/">{some(1, 3)}</a></h1>{pick(links(4), "")}</header>{b}'
        truth = f"{before}{b}<article>{plain}</article>{a}{after}"
        opening, closing = [
            ("<article>", "</article>"),
            (f'<div class="{pick("post", "entry-content", "article-body", "content", "story text")}">', "</div>"),
            ("<main>", "</main>") if k else ("<div>", "</div>"),
        ][k]
        seen = f"{before}{b}{opening}{inner}{closing}{a}{after}"
        out.append((seen.replace(_UNNAMED, ""), truth))
    return out


def truth_of(truth: list[Node]) -> np.ndarray | None:
    """Labels of a variant: the article's elements without the boilerplate put into it."""
    inside = article_mask(truth)
    if inside is None:
        return None
    first = len(TAG_CLASSES) + 1  # all token classes but the first name boilerplate
    marked = features(truth)[:, first:len(TAG_CLASSES) + len(TOKENS)].any(axis=1)
    for i, v in enumerate(truth):
        if marked[i] or (v.parent is not None and i and not inside[v.parent.at]):
            inside[i] = False
    return inside


def train(pages: list[str]) -> Boosted | None:
    xs, ys = [], []
    for i, page in enumerate(pages):
        for seen, told in variants(page, pages[i - 1], i):
            truth = elements(parse(told))
            y = truth_of(truth)
            nodes = elements(parse(seen))
            if y is None or len(y) != len(nodes):
                continue
            votes = ~followers(nodes)
            votes[0] = False  # the root is always kept
            xs.append(features(nodes)[votes])
            ys.append(y[votes])
    if not xs or len(set(np.concatenate(ys))) < 2:
        return None
    return Boosted.fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def extract_pages(pages: list[str | None], model: Boosted | None) -> list[str]:
    """Main texts; the nodes of all pages are scored together."""
    trees = [elements(parse(p)) for p in pages]
    if model is None:
        return [text_of(t, decode(t, plain_logit(t))) for t in trees]
    logits = model.logit(np.concatenate([features(t) for t in trees])) if trees else np.zeros(0)
    out, at = [], 0
    for t in trees:
        out.append(text_of(t, decode(t, logits[at:at + len(t)])))
        at += len(t)
    return out


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", max_pages: int = MAX_PAGES) -> Boosted | None:
    """Train on about ``max_pages`` pages with an article tag, chosen by a hash of their key; one row of each key."""
    told = pages.where(F.col(html).rlike("(?i)<(article|main)[ >]") & (F.char_length(html) <= MAX_PAGE_CHARS))
    n = told.count()
    order = F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(1 << 20))
    share = (1 << 20) if n <= max_pages else int((1 << 20) * 0.95 * max_pages / n)
    chosen = told.where(order < share).select(
        F.col(key).alias("key"), F.col(html).alias("html"), F.xxhash64(html).alias("__mark"))
    schema = T.StructType([T.StructField("html", T.StringType())])
    rows = one_per_key(chosen, lambda b: [(x,) for x in b.column("html").to_pylist()], "key", schema).collect()
    return train(sorted(r.html for r in rows))


def extract(pages: DataFrame, model: Boosted | None, key: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, in one pass without a shuffle."""
    schema = T.StructType([
        T.StructField("page_id", pages.schema[key].dataType), T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    sent = pages.sparkSession.sparkContext.broadcast(model)  # some ten kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 64):
                part = b.slice(start, 64)
                texts = extract_pages(part.column(2).to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.select(F.col(key).alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col(html).alias("html")).mapInArrow(run, schema)
