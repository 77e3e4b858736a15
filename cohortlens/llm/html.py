"""Main text of web pages: boosted trees over DOM-node features, decoded down the tree.

A page is parsed into block elements and text runs (a run is the text between
two block boundaries; inline markup only leaves its text). Each node has
features: tag class, attribute tokens by group, the nearest labelled ancestor,
depth, sibling statistics, subtree text, link and tag density. Gradient-boosted
trees give its log-odds of belonging to the main text. Decoding maximises the
sum of log-odds over the tree under one constraint: below a rejected node
nothing is kept. So ancestor and descendants never contradict each other. The
kept runs, in page order, are the blocks of the text.

Training needs no labels from outside: of all distinct pages whose mark-up names
an article with text, the ``SAMPLE_PAGES`` first by the hash of the page (the
documented bound) are taken apart, and set up anew in variants that know their labels: other
containers for the article, and menus, headers, footers, sidebars, notices,
adverts, forms, link lists and comments around and inside it, filled with texts
of other pages. Where no page of the table names its article, all text of a page
outside boxes named as something else stands for it. Parsing, features, scoring and decoding run in Spark tasks, one
page at a time.

Scripts, styles and other elements that show no text (titles, frames, templates,
lists of choices, text fields, what describes a formula or drawing) are dropped
while parsing; formulas, text in drawings and fallback text are runs like any.
A null or empty page has an empty text; unclosed and cut-off mark-up is closed
at the end of the page; pages of one block or none are legal.
"""

from __future__ import annotations

import html as _html
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 250
VARIANTS = 3
TREES = 40
DEPTH = 4
RATE = 0.25
BINS = 32

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# How HTML treats its elements.
HIDDEN = frozenset("template select datalist annotation annotation-xml desc metadata defs symbol".split())
RAW = frozenset("script style textarea title iframe".split())
VOID = frozenset("br hr img input meta link area base col embed param source track wbr".split())
FALLBACK = frozenset("noscript object canvas audio video".split())
FORMULA = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts "
                    "none mtable mtr mtd semantics".split())
DRAWING = frozenset("svg g path rect circle ellipse line polyline polygon text tspan textpath use image marker mask pattern filter clippath view set animate "
                    "animatetransform animatemotion lineargradient radialgradient stop switch foreignobject".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var ruby rb rt rp nobr".split()) \
    | FALLBACK | FORMULA | DRAWING
SPACED = frozenset("br mtr mtd text".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}

# Attribute word stems and elements by what they usually hold.
GROUPS = {
    "content": ("article", "content", "main", "post", "entry", "story", "text", "prose", "body"),
    "nav": ("nav", "menu", "breadcrumb", "pagin", "pager", "toc", "tabs"),
    "header": ("header", "masthead", "topbar", "logo", "branding"),
    "footer": ("footer", "copyright", "legal", "colophon", "bottom"),
    "side": ("sidebar", "aside", "side", "widget", "related", "recommend", "rail", "share", "social", "tags", "teaser"),
    "notice": ("notice", "cookie", "consent", "gdpr", "alert", "warning", "popup", "modal", "overlay", "disclaimer", "paywall"),
    "ad": ("ad", "ads", "adv", "advert", "sponsor", "promo", "banner", "outbrain", "taboola"),
    "form": ("form", "search", "login", "signup", "subscri", "newsletter", "register", "contact"),
    "comment": ("comment", "reply", "replies", "disqus", "discussion", "respond", "feedback"),
}
_TAG_GROUP = {"article": "content", "main": "content", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form",
              "fieldset": "form", "button": "form", "dialog": "notice"}
_NAMES = list(GROUPS)
_EXACT = {"ad", "ads", "adv", "side", "body", "text", "post", "main", "toc", "tabs", "tags", "rail", "form", "legal", "bottom", "nav"}
_ATTRS = ("class", "id", "role", "itemprop", "aria-label", "data-role")


def attribute_groups(attrs: str) -> set[int]:
    """Groups whose stems begin a word of the naming attributes (short stems must be whole words)."""
    words = []
    for name, a, b, c in _ATTR.findall(attrs):
        if name.lower() in _ATTRS:
            words += [w.lower() for w in _PART.findall(a or b or c)]
    return {i for i, g in enumerate(_NAMES) for stem in GROUPS[g] for w in words if (w == stem if stem in _EXACT else w.startswith(stem))}


class Node:
    __slots__ = ("tag", "parent", "depth", "groups", "children", "text", "links", "tags", "label", "run")

    def __init__(self, tag: str, parent: int, depth: int, groups: frozenset | set, label: int | None, run: bool):
        self.tag, self.parent, self.depth, self.groups, self.label, self.run = tag, parent, depth, groups, label, run
        self.children, self.text, self.links, self.tags = [], "", 0, 0


def parse(page: str | None) -> list[Node]:
    """Nodes of a page in page order; node 0 is the root. Runs without a word are left out."""
    nodes = [Node("html", -1, 0, frozenset(), None, False)]
    stack, run, in_link = [0], None, 0
    places: dict[str, list[int]] = {}  # where in the stack the open elements of every tag stand
    unended = set()  # raw elements without an end tag in the rest of the page
    hidden, opened = "", Counter()  # the outermost hidden element, and the elements open in it with itself
    page = page or ""
    at, end = 0, len(page)

    def add(text: str):
        nonlocal run
        if not text or hidden:
            return
        if run is None:
            if text.isspace():
                return
            run = ([], [])
        run[0].append(text)
        if in_link:
            run[1].append(text)

    def close_run():
        nonlocal run
        if run is not None:
            text = " ".join(_html.unescape("".join(run[0])).split())
            if text:
                up = stack[-1]
                node = Node("#run", up, nodes[up].depth + 1, frozenset(), None, True)
                node.text, node.links = text, len(" ".join(_html.unescape("".join(run[1])).split()))
                nodes[up].children.append(len(nodes))
                nodes.append(node)
            run = None

    def pop_to(i: int):
        nonlocal in_link
        close_run()
        in_link = 0
        for node in stack[i:]:
            places[nodes[node].tag].pop()
        del stack[i:]

    def last(tags: tuple) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def find(tag: str, limit: tuple = ()) -> int:
        """Place in the stack of the innermost open ``tag`` that no element of ``limit`` is inside of, or 0."""
        i = last((tag,))
        return i if i > last(limit) else 0

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if hidden:
                if opened[tag]:
                    opened[tag] -= 1
                    hidden = hidden if opened[hidden] else ""
                    continue
                # A hidden element ends with what it lies in.
                if not (hidden != "template" and tag in ("svg", "math") or tag not in INLINE and find(tag)):
                    continue
                hidden = ""
            if tag == "a":
                in_link = 0
            elif tag not in INLINE and (i := find(tag)):
                pop_to(i)
            continue
        nodes[stack[-1]].tags += 1
        closed = m[3].rstrip().endswith("/")
        if tag in RAW:
            stop = None if tag in unended else re.compile(f"</{tag}\\b[^>]*>?", re.I).search(page, at)
            if stop is None:
                unended.add(tag)
            at = stop.end() if stop else at if closed else end
            continue
        if hidden:
            # Only a template may hold blocks; any other has lost its end tag.
            if hidden == "template" or tag not in CLOSES_P or tag == "hr":
                opened[tag] += not closed and tag not in VOID
                continue
            hidden = ""
        if tag in HIDDEN:
            if not closed:
                hidden, opened = tag, Counter((tag,))
            continue
        if tag in SPACED:
            add(" ")
            continue
        if tag in VOID or tag in INLINE:
            if tag == "a":
                in_link = 1
            continue
        if tag in ("html", "head", "body"):
            continue
        if tag in CLOSES_P and (i := find("p", ("td", "th", "li", "div", "article", "section", "body"))):
            pop_to(i)
        if tag in SAME and (i := find(tag, SAME[tag])):
            pop_to(i)
        close_run()
        groups = attribute_groups(m[3])
        if tag in _TAG_GROUP:
            groups.add(_NAMES.index(_TAG_GROUP[tag]))
        y = re.search(r'data-y="([01])"', m[3]) if "data-y" in m[3] else None
        up = stack[-1]
        node = Node(tag, up, nodes[up].depth + 1, groups, int(y[1]) if y else None, False)
        nodes[up].children.append(len(nodes))
        places.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes))
        nodes.append(node)
    close_run()
    return nodes


_TAGS = ("div", "p", "h1", "h2", "h3", "li", "ul", "ol", "section", "article", "main", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "pre", "button", "#run")
_WIDTH = len(_TAGS) + 3 * len(_NAMES) + 18


_TAG_NO = {t: i for i, t in enumerate(_TAGS)}


def feature_blocks(nodes: list[Node], most: int = 1 << 15):
    """Features of the nodes in page order, ``most`` rows at a time: memory is that of one block, however long a page.

    One row per node: tag, attribute groups (own, nearest, any above), depth, siblings, subtree densities.
    A subtree is a run of nodes, so its sums are differences of running sums.
    """
    n, k, g0 = len(nodes), len(_NAMES), len(_TAGS)
    up = np.array([v.parent for v in nodes])
    p = np.maximum(up, 0)
    own, near, above, end = [0] * n, [0] * n, [0] * n, list(range(1, n + 1))
    for i, v in enumerate(nodes):
        own[i] = near[i] = above[i] = sum(1 << g for g in v.groups)
        if v.parent >= 0:
            near[i] = near[i] or near[v.parent]
            above[i] |= above[v.parent]
    for i in range(n - 1, 0, -1):  # a node's children lie behind it
        end[nodes[i].parent] = max(end[nodes[i].parent], end[i])
    end, masks = np.array(end), [np.array(m) for m in (own, near, above)]

    def below(values: list[int]) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return (total[end] - total[:-1]).astype(float)

    chars = below([len(v.text) for v in nodes])
    links = below([v.links for v in nodes])
    words = below([v.text.count(" ") + 1 if v.run else 0 for v in nodes])
    runs = below([v.run for v in nodes])
    tags = below([v.tags for v in nodes])
    punct = below([v.text.count(".") + v.text.count(",") for v in nodes])
    paragraphs = below([v.tag == "p" for v in nodes])
    children = np.array([len(v.children) for v in nodes])
    numbers = dict(_TAG_NO)
    tag = np.array([numbers.setdefault(v.tag, len(numbers)) for v in nodes])
    _, kind, of_kind = np.unique(up * len(numbers) + tag, return_inverse=True, return_counts=True)
    same = of_kind[kind]
    siblings = np.where(up >= 0, children[p], 1)
    depth = np.array([v.depth for v in nodes])
    for lo in range(0, n, most):
        a = slice(lo, min(lo + most, n))
        q, at = p[a], np.arange(lo, min(lo + most, n))
        x = np.zeros((len(at), _WIDTH))
        known = np.flatnonzero(tag[a] < g0)
        x[known, tag[a][known]] = 1
        for j, mask in enumerate(masks):
            x[:, g0 + j * k:g0 + (j + 1) * k] = (mask[a, None] >> np.arange(k)) & 1
        c, w = np.maximum(chars[a], 1.0), np.maximum(words[a], 1.0)
        x[:, g0 + 3 * k:] = np.stack([
            depth[a], siblings[a], same[a], at / n, np.log1p(chars[a]), np.log1p(words[a]), links[a] / c, chars[a] / w,
            np.log1p(runs[a]), tags[a] / w, punct[a] / w, paragraphs[a], chars[a] / max(chars[0], 1.0), chars[a] / np.maximum(chars[q], 1.0),
            links[q] / np.maximum(chars[q], 1.0), np.log1p(chars[q]), paragraphs[q], children[a]], axis=1)
        yield x


def features(nodes: list[Node]) -> np.ndarray:
    """All rows of ``feature_blocks``."""
    return np.concatenate(list(feature_blocks(nodes)))


class Trees:
    """Boosted regression trees of fixed depth, stored as arrays (split feature, threshold, leaf value)."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, base: float):
        self.feature, self.cut, self.leaf, self.base = feature, cut, leaf, base

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (2 ** DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order logistic boosting on histograms of at most ``BINS`` quantile bins per feature."""
    inner = 2 ** DEPTH - 1
    if not len(y):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, 2 ** DEPTH)), 0.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)  # bin b: edge[b-1] < x <= edge[b]
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    f = np.full(len(y), base)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, size = 2 ** level - 1, 2 ** level
            best = np.full(size, 1e-3)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (at - first) * BINS + binned[:, j]
                gs = np.bincount(cell, g, size * BINS).reshape(size, BINS)
                hs = np.bincount(cell, h, size * BINS).reshape(size, BINS)
                gl, hl = np.cumsum(gs, axis=1)[:, :len(e)], np.cumsum(hs, axis=1)[:, :len(e)]
                gt, ht = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
                gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                b = gain.argmax(axis=1)
                v = gain[np.arange(size), b]
                for s in np.flatnonzero(v > best):
                    best[s], feature[first + s], cut[first + s] = v[s], j, e[b[s]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        slot = at - inner
        leaf = RATE * np.bincount(slot, g, 2 ** DEPTH) / (np.bincount(slot, h, 2 ** DEPTH) + 1)
        f += leaf[slot]
        trees.append((feature, cut, leaf))
    return Trees(*(np.array([t[i] for t in trees]) for i in range(3)), base)


def decode(nodes: list[Node], log_odds: np.ndarray) -> list[bool]:
    """Keep or reject every node: greatest sum of log-odds of kept nodes, nothing kept below a rejected one."""
    z = np.clip(log_odds, -6.0, 6.0).tolist()
    z[0] = 0.0
    best = list(z)
    for i in range(len(nodes) - 1, 0, -1):
        if not nodes[i].run and not nodes[i].children:
            best[i] = 0.0
        if best[i] > 0:
            best[nodes[i].parent] += best[i]
    keep = [True] * len(nodes)
    for i in range(1, len(nodes)):
        keep[i] = keep[nodes[i].parent] and best[i] > 0
    return keep


def _labels(nodes: list[Node]) -> np.ndarray:
    """1 for nodes of the article and all that holds some of it, by the nearest label above."""
    y = np.zeros(len(nodes))
    near = [0] * len(nodes)
    for i, v in enumerate(nodes):
        near[i] = v.label if v.label is not None else (near[v.parent] if v.parent >= 0 else 0)
        y[i] = near[i]
    for i in range(len(nodes) - 1, 0, -1):
        y[nodes[i].parent] = max(y[nodes[i].parent], y[i])
    return y


def _variant(blocks: list[str], others: list[str], rng: random.Random) -> str:
    """A page around the article's blocks, with labels in ``data-y``."""
    def text() -> str:
        return rng.choice(others) if others else "text"

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{" ".join(text().split()[:rng.randint(1, 4)])}</a></li>' for i in range(n))

    def box(tag: str, names: tuple, body: str, y: int = 0) -> str:
        name = rng.choice(names)
        attr = f' {rng.choice(("class", "class", "id"))}="{name}"' if name else ""
        return f'<{tag}{attr} data-y="{y}">{body}</{tag}>'

    def paragraphs(n: int) -> str:
        return "".join(f"<p>{text()}</p>" for _ in range(n))

    def junk(kind: str) -> str:
        if kind == "nav":
            return box(*rng.choice((("nav", ("", "site-nav", "menu")), ("div", ("menu", "navbar", "breadcrumbs")), ("ul", ("menu", "nav")))), f"<ul>{links(rng.randint(2, 9))}</ul>")
        if kind == "header":
            return box(rng.choice(("header", "div")), ("header", "masthead", "site-header", "topbar"), f"<h2>{text()[:40]}</h2><p>{text()[:60]}</p>")
        if kind == "footer":
            return box(*rng.choice((("footer", ("", "footer")), ("div", ("footer", "site-footer", "copyright")))), f"&copy; {text()[:90]}" + f"<p>{text()}</p>" * rng.randint(0, 1))
        if kind == "side":
            return box(*rng.choice((("aside", ("", "sidebar")), ("div", ("sidebar", "related", "widget", "share-buttons", "social")))),
                       rng.choice((paragraphs(rng.randint(1, 3)), f"<h3>{text()[:30]}</h3><ul>{links(4)}</ul>", text())))
        if kind == "notice":
            return box(rng.choice(("div", "section", "div")), ("cookie-notice", "notice", "consent-banner", "alert", "gdpr-popup"), f"<p>{text()}</p>" + "<button>OK</button>" * rng.randint(0, 1))
        if kind == "ad":
            return box(*rng.choice((("div", ("ad", "ads", "advert", "sponsored", "promo", "banner-ad", "advertisement")), ("aside", ("ad", "promo")), ("section", ("sponsored",)))), rng.choice((text(), f"<p>{text()}</p>")))
        if kind == "form":
            return box(*rng.choice((("form", ("", "search", "login")), ("div", ("newsletter", "subscribe-form", "search-form")))),
                       f'<label>{text()[:30]}</label><input type="text"><p>{text()[:80]}</p><button>{text()[:12]}</button>')
        return box(*rng.choice((("section", ("comments", "comment-list")), ("div", ("comments", "comment", "user-comments", "replies", "disqus")), ("ol", ("comment-list",)))),
                   rng.choice((paragraphs(rng.randint(1, 5)), "".join(f'<div class="comment"><b>{text()[:10]}</b><p>{text()}</p></div>' for _ in range(rng.randint(1, 4))))))

    inside = list(blocks)
    for kind in rng.sample(("ad", "comment", "side", "form", "notice"), rng.choice((0, 0, 1, 1, 2))):
        inside.insert(len(inside) if kind == "comment" else rng.randint(1, len(inside)), junk(kind))
    tag, names = rng.choice((("article", ("", "post", "")), ("article", ("",)), ("main", ("", "content")), ("div", ("content", "post-content", "entry-content", "article-body", "main", "story")),
                             ("section", ("content", "article")), ("div", ("",))))
    main = box(tag, names, "".join(inside), 1)
    if rng.random() < 0.4:
        main = f'<div class="{rng.choice(("wrapper", "container", "page", "row", "main"))}">{main}</div>'
    kinds = ["nav", "header", "footer", "side", "notice", "ad", "form", "comment"]
    before = [junk(k) for k in kinds if k not in ("footer", "comment") and rng.random() < 0.4]
    after = [junk(k) for k in kinds if k not in ("nav", "header") and rng.random() < 0.4]
    rng.shuffle(before)
    return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def _article(page: str | None, whole: bool) -> tuple[list[Node], int, list[bool], list[str]] | None:
    """(nodes, the article's node, which nodes are of it, its blocks), or None if it has no text.

    The article is the first ``article`` or ``main`` element (``whole``: the page) without boxes named as something else.
    """
    nodes = parse(page)
    top = 0 if whole else next((i for i, v in enumerate(nodes) if v.tag in ("article", "main")), None)
    if top is None:
        return None
    inside = [False] * len(nodes)
    inside[top] = True
    for i in range(top + 1, len(nodes)):
        v = nodes[i]
        inside[i] = inside[v.parent] and not (v.groups - {0})
    blocks = [f"<{nodes[v.parent].tag}>{_html.escape(v.text)}</{nodes[v.parent].tag}>" if nodes[v.parent].tag in ("p", "h1", "h2", "h3", "blockquote", "pre") else f"<p>{_html.escape(v.text)}</p>"
              for v, ok in zip(nodes, inside, strict=True) if v.run and ok]
    return (nodes, top, inside, blocks) if blocks else None


def train_pages(pages: list[str], seed: int = 5, whole: bool = False) -> Trees:
    """Trees from pages whose mark-up names the article (``whole``: from whole pages)."""
    rng = random.Random(seed)
    articles, texts, originals = [], [], []
    for page in pages:
        found = _article(page, whole)
        if found is not None:
            nodes, top, inside, blocks = found
            articles.append(blocks)
            texts += [_html.escape(v.text) for v in nodes if v.run]
            y = np.array(inside, float)
            y[[max(nodes[top].parent, 0), 0]] = 1
            originals.append((nodes, y))
    if not articles:
        return fit(np.zeros((0, _WIDTH)), np.zeros(0))
    xs, ys = [features(n) for n, _ in originals], [y for _, y in originals]
    for blocks in articles:
        for _ in range(VARIANTS):
            nodes = parse(_variant(blocks, texts, rng))
            xs.append(features(nodes))
            ys.append(_labels(nodes))
    return fit(np.concatenate(xs), np.concatenate(ys))


def main_text(page: str | None, trees: Trees) -> str:
    nodes = parse(page)
    keep = decode(nodes, np.concatenate([trees.log_odds(x) for x in feature_blocks(nodes)]))
    return "\n\n".join(v.text for v, ok in zip(nodes, keep, strict=True) if ok and v.run)


def _sample(pages: DataFrame, html: str, whole: bool) -> list[str]:
    """The SAMPLE_PAGES first distinct pages by hash of which ``_article`` finds the article.

    Growing shares of the hashes are looked through in Spark tasks until there are enough or all were seen.
    """
    page = F.col(f"`{html}`").cast("string")
    named = pages.select(page.alias("html")).where("html is not null" if whole else "html rlike '(?i)<(article|main)[\\\\s/>]'").withColumn("h", F.xxhash64("html"))
    place = F.pmod("h", F.lit(1 << 30))
    n, share = named.count(), 0.0

    def usable(batches):
        seen = set()
        for batch in batches:
            keep = []
            for i, h in enumerate(batch.column("h").to_pylist()):
                if h not in seen:
                    seen.add(h)
                    if _article(batch.column("html")[i].as_py(), whole) is not None:
                        keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    found = []
    while n and share < 1.0 and len(found) < SAMPLE_PAGES:
        share = min(1.0, max(8 * share, 4 * SAMPLE_PAGES / n))
        found = (named.where(place < int(share * (1 << 30))).mapInArrow(usable, "html string, h long")
                 .dropDuplicates(["h"]).orderBy(place, "h").limit(SAMPLE_PAGES).collect())
    return sorted(r.html for r in found)


def train(pages: DataFrame, html: str = "html") -> Trees:
    """Trees from at most SAMPLE_PAGES distinct pages that name their article; from whole pages if there is none."""
    named = _sample(pages, html, whole=False)
    return train_pages(named) if named else train_pages(_sample(pages, html, whole=True), whole=True)


def _together(group: list[list[Node]], most: int = 1 << 15):
    """Feature blocks of some pages, those of short pages joined up to about ``most`` rows."""
    held, size = [], 0
    for nodes in group:
        for x in feature_blocks(nodes, most):
            held.append(x)
            size += len(x)
            if size >= most:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def extract(pages: DataFrame, trees: Trees, carry: list[str], html: str = "html") -> DataFrame:
    """``carry`` columns plus text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast((trees.feature, trees.cut, trees.leaf, trees.base))

    def run(batches):
        model = Trees(*shared.value)
        for batch in batches:
            out, group, size = [], [], 0
            for page in [*batch.column("__html").to_pylist(), None]:
                group.append(parse(page))
                size += len(group[-1])
                if size > 20_000 or len(out) + len(group) > batch.num_rows:
                    odds = np.concatenate([model.log_odds(x) for x in _together(group)])
                    for nodes in group:
                        keep = decode(nodes, odds[:len(nodes)])
                        odds = odds[len(nodes):]
                        out.append("\n\n".join(v.text for v, ok in zip(nodes, keep, strict=True) if ok and v.run))
                    group, size = [], 0
            out = out[:batch.num_rows]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[*carry, "text", "n_chars"])

    kept = pages.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{html}`").cast("string").alias("__html"))
    schema = pages.select(*[F.col(f"`{c}`") for c in carry]).schema.add("text", "string").add("n_chars", "long")
    return kept.mapInArrow(run, schema)
