"""Main text of web pages by a tree-structured graphical model over DOM nodes.

A page becomes a tree of block elements. Each node has a hidden state, content or not; a node's
observed features (tag, words of its class, id and role, length of its own text, part of it in links; its share of the page's
text, links below it, its place and its paragraphs) depend on its state, and its state on its parent's. Both tables are counted on labelled pages (`pages_for_training`,
smoothed). Sum-product message passing, upward then downward, gives every node's marginal;
text of nodes that are likelier content is kept in page order.

Labelled pages come from templates: common ways to mark up an article and its surroundings, with
words of fixed lists, in fixed pseudo-random combinations. In half of them the names are left out or generated, and telling elements
may be plain ones, so that unfamiliar markup is judged by what its text is to the page.

Output: character references decoded, white space inside a block one space, blocks trimmed and
joined by one newline. Markup, comments, scripts, styles and the like never count as text.

Defined cases: a null or empty page gives an empty text. Broken markup is read as far as it goes: unclosed
elements end with their parents, an open head at the first thing that cannot stand in it; a self-closed svg or math is
empty; a tag cut off at the end of the page is dropped. Depth is unbounded (no recursion) and very long pages are read whole. Rows are handled one by one, so repeated rows, null ids and null urls
pass through; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import html
import itertools
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tourlens.llm.common import slices

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe object svg math canvas audio video head title select option textarea button datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: What can stand in a head; anything else ends it, as its end tag is optional.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
FOREIGN = frozenset(["svg", "math"])
TOP = frozenset("#root html body".split())
#: Elements that hold others; what is in one of the rest rarely differs from it.
HOLDERS = frozenset("article aside center details div fieldset footer form header main nav ol section table tbody td tr ul".split())
SCOPE = frozenset("html body article section div ul ol dl table main aside nav header footer form td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(>|\Z)", re.S
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    parent: int
    tag: str
    names: tuple[str, ...]
    chars: int = 0
    linked: int = 0
    label: int | None = None


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (node, text) in page order; a new list for each block
    blocks: list[list[tuple[int, str]]] = field(default_factory=list)


def _names(attributes: str) -> tuple[str, ...]:
    found = []
    for name, value in _NAMES.findall(attributes):
        name = name.lower()
        if name in ("hidden",) or (name == "aria-hidden" and "true" in value) or (name == "style" and "display:none" in value.replace(" ", "")):
            found.append("hidden")
        elif name in ("class", "id", "role", "itemprop"):
            split = re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()
            found += _WORDS.findall(split)
    return tuple(dict.fromkeys(found))


def parsed(source: str, labels: bool = False, root: int = 0) -> Page:
    """Block elements as a tree in page order, with the texts of each block."""
    page = Page()
    page.nodes.append(Node(-1, "#root", (), label=root))
    stack: list[tuple[str, int, bool]] = [("#root", 0, False)]  # tag, its node, unseen
    links = unseen = foreign = at = 0
    block: list[tuple[int, str]] = []

    def text(chunk: str) -> None:
        if stack[-1][0] == "head" and chunk.strip():
            close_to(len(stack) - 1)
        if unseen or not chunk:
            return
        node = stack[-1][1]
        chunk = html.unescape(chunk)
        block.append((node, chunk))
        n = len(chunk) - chunk.count(" ")
        page.nodes[node].chars += n
        page.nodes[node].linked += n if links else 0

    def cut() -> None:
        nonlocal block
        if block:
            page.blocks.append(block)
            block = []

    def close_to(depth: int) -> None:
        nonlocal links, unseen, foreign
        while len(stack) > depth:
            tag, _, hides = stack.pop()
            links -= tag == "a"
            foreign -= tag in FOREIGN
            unseen -= hides
            if tag not in INLINE:
                cut()

    end = len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if not m:
            rest = source[at:]
            text(rest if not re.search(r"<[/a-zA-Z!?]", rest) else rest[: re.search(r"<[/a-zA-Z!?]", rest).start()])
            break
        text(source[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if not m[4]:  # cut off inside a tag
            break
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
                if tag in INLINE and stack[depth][0] in SCOPE or tag == "p" and stack[depth][0] in SCOPE:
                    break
            continue
        if stack[-1][0] == "head" and tag not in HEAD:
            close_to(len(stack) - 1)
        if tag == "br":
            text("\n")
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close_to(depth)
                    break
                if stack[depth][0] in SCOPE:
                    break
        if tag in SAME:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in SAME[tag]:
                    close_to(depth)
                    break
                if stack[depth][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        if tag not in INLINE:
            cut()
        if tag in VOID:
            continue
        attributes = m[3]
        own = tag not in INLINE
        names = _names(attributes) if "=" in attributes or "hidden" in attributes.lower() else ()
        if own or names:
            label = None
            if labels:
                mark = re.search(r'data-main="([01])"', attributes)
                label = int(mark[1]) if mark else page.nodes[stack[-1][1]].label
            page.nodes.append(Node(stack[-1][1], tag, names, label=label))
            node = len(page.nodes) - 1
        else:
            node = stack[-1][1]
        hides = tag in UNSEEN
        if attributes.rstrip().endswith("/") and (foreign or tag in FOREIGN or tag not in UNSEEN and not own):
            continue
        stack.append((tag, node, hides))
        links += tag == "a"
        foreign += tag in FOREIGN
        unseen += hides
        if tag in RAW:
            shut = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            if shut and not hides:
                text(source[at : shut.start()])
            at = shut.end() if shut else end
            close_to(len(stack) - 1)
    close_to(1)
    cut()
    return page


def _features(page: Page) -> list[list[str]]:
    """Of each node: its tag, names, length and links, and what it is to its page: its share, links below it, place, paragraphs."""
    nodes = page.nodes
    chars, linked = [n.chars for n in nodes], [n.linked for n in nodes]
    below = [0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        p = nodes[i].parent
        chars[p] += chars[i]
        linked[p] += linked[i]
        below[p] += nodes[i].tag == "p" and nodes[i].chars > 40
    largest = [1] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        largest[node.parent] = max(largest[node.parent], chars[i])
    total, before, out = max(chars[0], 1), 0, []
    for i, node in enumerate(nodes):
        length = 0 if not node.chars else min(1 + int(math.log2(node.chars) / 2), 6)
        part = min(int(4 * node.linked / node.chars), 3) if node.chars else "-"
        links = min(int(4 * linked[i] / chars[i]), 3) if chars[i] else "-"
        share = "top" if node.tag in TOP else min(int(8 * chars[i] / total), 7) if 8 * chars[i] >= total else "-"
        kind = f"{node.tag}{'' if node.names else ' plain'}"
        out.append([f"t:{kind}", f"c:{length}", f"l:{part}", f"s:{share} {links}", f"p:{min(below[i], 3)}", f"w:{int(4 * before / total)}", *(f"n:{x}" for x in node.names)])
        if i and node.tag in HOLDERS and nodes[node.parent].tag in TOP:  # what competes for the page
            out[-1].append(f"r:{min(int(math.log2(largest[node.parent] / max(chars[i], 1))), 4)}")
        before += node.chars
    return out


def _link(parent: Node, child: Node) -> tuple[bool, bool]:
    """Kinds of edges with a table of their own: from the page itself or below it, to an element that holds others or not."""
    return parent.tag in TOP, child.tag in HOLDERS


@dataclass(frozen=True)
class TreeModel:
    """Log tables: features given the state, and a state given the parent's for each kind of edge."""

    feature: dict[str, tuple[float, float]]
    unknown: tuple[float, float]
    root: tuple[float, float]
    edge: dict[tuple[bool, bool], tuple[tuple[float, float], tuple[float, float]]]  # by `_link`, then [parent][child]

    @classmethod
    def fitted(cls, pages: list[Page]) -> TreeModel:
        counts, states, roots = [Counter(), Counter()], [0, 0], [1, 1]
        edges = {(x, y): [[1.0, 1.0], [1.0, 1.0]] for x in (False, True) for y in (False, True)}
        for page in pages:
            for node, features in zip(page.nodes, _features(page), strict=True):
                states[node.label] += 1
                counts[node.label].update(features)
                if node.parent >= 0:
                    parent = page.nodes[node.parent]
                    edges[_link(parent, node)][parent.label][node.label] += 1
                else:
                    roots[node.label] += 1
        names = set(counts[0]) | set(counts[1])
        log = lambda n, k: math.log((n + 0.2) / (states[k] + 0.4))
        feature = {x: (log(counts[0][x], 0), log(counts[1][x], 1)) for x in names}
        edge = {k: tuple(tuple(math.log(x / sum(row)) for x in row) for row in table) for k, table in edges.items()}
        return cls(feature, (0.0, 0.0), tuple(math.log(x / sum(roots)) for x in roots), edge)

    def marginals(self, page: Page) -> list[float]:
        """Probability of content of each node: messages from leaves to the root, then back."""
        nodes = page.nodes
        n = len(nodes)
        local = []
        for node, features in zip(nodes, _features(page), strict=True):
            a, b = self.root if node.parent < 0 else (0.0, 0.0)
            for x in features:
                fa, fb = self.feature.get(x, self.unknown)
                a += fa
                b += fb
            local.append((a, b))
        up = [list(x) for x in local]
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        edges = [((0.0, 0.0), (0.0, 0.0))] + [self.edge[_link(nodes[x.parent], x)] for x in nodes[1:]]
        for i in range(n - 1, 0, -1):  # children come after their parents
            (e00, e01), (e10, e11) = edges[i]
            a, b = up[i]
            sent[i] = m0, m1 = _add(e00 + a, e01 + b), _add(e10 + a, e11 + b)
            parent = up[nodes[i].parent]
            parent[0] += m0
            parent[1] += m1
        down = [(0.0, 0.0)] * n
        out = [0.0] * n
        for i in range(n):
            if i:
                p, ((e00, e01), (e10, e11)) = nodes[i].parent, edges[i]
                a = up[p][0] + down[p][0] - sent[i][0]
                b = up[p][1] + down[p][1] - sent[i][1]
                m0, m1 = _add(a + e00, b + e10), _add(a + e01, b + e11)
                top = max(m0, m1)
                down[i] = (m0 - top, m1 - top)
            d = up[i][0] + down[i][0] - up[i][1] - down[i][1]
            out[i] = 1 / (1 + math.exp(min(d, 700.0)))
        return out


def _add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def extracted(source: str | None, model: TreeModel) -> str:
    if not source:
        return ""
    page = parsed(source)
    content = model.marginals(page)
    lines = []
    for block in page.blocks:
        line = _SPACE.sub(" ", "".join(chunk for node, chunk in block if content[node] >= 0.5)).strip()
        if line:
            lines.append(line)
    return "\n".join(lines)


# Ways to mark up a page: (opening tag, its words) of the main text and of what surrounds it.
MAIN = (
    '<article>|<article>|<article>|<article class="post entry">|<main>|<main id="content"><article>|<div class="article-body">|<div id="content" class="content">|<section class="story text">|'
    '<div class="post-content" itemprop="articleBody">|<div class="main"><div class="entry-content">|<div role="main">|<div>|<section>|<body class="page">|<td>'
).split("|")
MENUS = '<nav>|<nav class="menu">|<ul class="nav">|<div class="menu">|<div id="navigation" role="navigation">|<ul class="breadcrumbs">|<div class="tags">|<div class="pagination">|<ul class="links social share">'.split("|")
AROUND = (
    '<header>|<header class="site-header" role="banner">|<div class="header masthead">|<footer>|<footer class="site-footer" role="contentinfo">|<div id="footer">|<div class="footer copyright">|'
    '<aside>|<aside class="sidebar">|<div class="sidebar widget">|<div class="related recommended more">|<div role="complementary">|<div class="author bio byline">|<div class="newsletter subscribe signup">'
).split("|")
NOTICES = (
    '<div class="ad">|<div class="ads advert advertisement">|<div class="sponsor sponsored promo">|<div class="banner">|<aside class="ad">|<div class="cookie notice consent">|<div id="cookie-banner" role="alert">|'
    '<div class="alert warning message">|<div class="notice">|<div class="paywall note">|<p class="premium subscription paywall">|<div class="gdpr privacy popup modal overlay" role="dialog">|<section class="promo">|<p class="notice">|<p class="ad">|<p class="disclaimer">|<div hidden>|<span class="ad">'
).split("|")
COMMENTS = (
    '<section class="comments">|<div id="comments" class="comment-list">|<ol class="comment-thread replies">|<div class="comment reply user">|<article class="comment">|<div id="disqus_thread" class="discussion responses">|<li class="comment">'
).split("|")
FORMS = '<form>|<form class="search" role="search">|<form class="login contact">|<fieldset>|<div class="search-form form">'.split("|")


#: Part of the training pages whose names say nothing.
ANONYMOUS = 0.5


def _renamed(source: str, rng: random.Random) -> str:
    """A page whose classes, ids and roles are left out, or generated, and whose telling elements may be plain ones."""
    name = {}

    def other(m: re.Match) -> str:
        return f' class="{name.setdefault(m[0], "css-" + "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=6)))}"'

    source = re.sub(r' (?:class|id|role|itemprop)="[^"]*"', other if rng.random() < 0.7 else "", source)
    for tag in ("article", "main", "section", "nav", "header", "footer", "aside"):
        if rng.random() < 0.6:
            source = re.sub(rf"(</?){tag}\b", r"\1div", source)
    return source


def _closing(opening: str) -> str:
    return "".join(f"</{x}>" for x in reversed(re.findall(r"<([a-z]+)", opening)))


def pages_for_training(n: int = 800, seed: int = 7, anonymous: float = ANONYMOUS) -> list[Page]:
    """Labelled pages: every way to mark up a part, combined pseudo-randomly with texts of varied length."""
    rng = random.Random(seed)
    mains, menus, around = itertools.cycle(MAIN), itertools.cycle(MENUS), itertools.cycle(AROUND)
    notices, comments, forms = itertools.cycle(NOTICES), itertools.cycle(COMMENTS), itertools.cycle(FORMS)

    def say(low: int, high: int) -> str:
        return " ".join("x" * rng.randint(1, 9) for _ in range(rng.randint(low, high)))

    def marked(opening: str, label: int) -> str:
        return re.sub(r"<([a-z]+)", rf'<\1 data-main="{label}"', opening)

    def noise(opening: str, inner: str) -> str:
        return marked(opening, 0) + inner + _closing(opening)

    def paragraphs(low: int, high: int) -> str:
        return "".join(f"<p>{say(1, 90)}</p>" for _ in range(rng.randint(low, high)))

    def listed() -> str:
        items = "".join(f'<li><a href="/">{say(1, 3)}</a></li>' for _ in range(rng.randint(2, 8)))
        return rng.choice([items, f"<ul>{items}</ul>", re.sub("</?li>", " ", items)])

    def main_text() -> str:
        parts = [f"<h1>{say(1, 9)}</h1>"] if rng.random() < 0.7 else []
        short = rng.random() < 0.3
        parts.append(f"<p>{say(1, 12) if short else say(15, 120)}</p>" if rng.random() < 0.8 else say(20, 120))
        for _ in range(rng.randint(0, 7) if not short else rng.randint(0, 2)):
            parts.append(
                rng.choices(
                    [
                        f"<p>{say(1, 120)}</p>",
                        f"<h2>{say(1, 8)}</h2>",
                        f"<ul>{''.join(f'<li>{say(1, 20)}</li>' for _ in range(rng.randint(1, 5)))}</ul>",
                        f"<ol>{''.join(f'<li>{say(1, 20)}</li>' for _ in range(rng.randint(1, 5)))}</ol>",
                        f"<blockquote>{rng.choice([say(3, 40), f'<p>{say(3, 40)}</p>'])}</blockquote>",
                        f"<pre>{say(3, 30)}</pre>",
                        f"<table><tr><td>{say(1, 5)}</td><td>{say(1, 5)}</td></tr></table>",
                        f"<figure><figcaption>{say(2, 12)}</figcaption></figure>",
                        f"<p>{say(4, 40)} <a href='/'>{say(1, 3)}</a> {say(2, 20)}</p>",
                        f"<div>{say(5, 80)}</div>",
                        f"<section><h3>{say(1, 6)}</h3><p>{say(5, 80)}</p></section>",
                        f"<h3>{say(1, 6)}</h3><dl><dt>{say(1, 3)}</dt><dd>{say(2, 15)}</dd></dl>",
                        noise(next(notices), rng.choice([say(1, 30), paragraphs(1, 2)])),
                        noise(next(around), rng.choice([say(1, 25), listed()])),
                        noise(next(menus), listed()),
                    ],
                    [10, 2, 3, 2, 1, 1, 1, 1, 2, 1, 1, 1, 3, 2, 2],
                )[0]
            )
        return "".join(parts)

    pages = []
    for _ in range(n):
        opening = next(mains)
        body = [noise(next(menus), listed())] if rng.random() < 0.8 else []
        for _ in range(rng.randint(0, 2)):
            body.append(noise(next(around), rng.choice([say(1, 25), paragraphs(1, 2), listed(), f"<h2>{say(1, 5)}</h2>{listed()}", f"<h1>{say(1, 5)}</h1>"])))
        if rng.random() < 0.8:
            body.append(noise(next(notices), rng.choice([say(1, 40), paragraphs(1, 2)])))
        body.append(marked(opening, 1) + main_text() + _closing(opening).replace("</body>", ""))
        if rng.random() < 0.5:
            inner = [f"<p>{say(1, 80)}</p>", say(3, 60), f"<article class='comment' data-main='0'>{paragraphs(1, 2)}</article>", f"<h3>{say(1, 3)}</h3><ul><li>{say(3, 60)}</li><li><p>{say(3, 60)}</p></li></ul>"]
            body.append(noise(next(comments), "".join(rng.sample(inner, rng.randint(1, 3)))))
        if rng.random() < 0.4:
            body.append(noise(next(forms), f"<label>{say(1, 3)}</label><input><button>{say(1, 2)}</button>{say(0, 8)}<p>{say(1, 15)}</p>"))
        for _ in range(rng.randint(0, 2)):
            body.append(noise(next(around), rng.choice([say(1, 25), paragraphs(1, 2), listed()])))
        bare = rng.random() < 0.25  # a text without any frame
        source = main_text() if bare else f'<html data-main="0"><head></head><body data-main="0">{"".join(body)}</body></html>'
        if rng.random() < anonymous:
            source = _renamed(source, rng)
        pages.append(parsed(source, labels=True, root=int(bare)))
    return pages


def trained() -> TreeModel:
    return TreeModel.fitted(pages_for_training())


def main_texts(pages: DataFrame, model: TreeModel, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url, text and n_chars of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(source).cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [extracted(x, shared.value) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return rows.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
