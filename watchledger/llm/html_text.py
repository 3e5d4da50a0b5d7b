"""Main text of web pages by a tree-structured graphical model.

A page is parsed into its tree of block elements.  Each element has a hidden
label, content or not.  A unary potential scores its own features (kind of tag,
words in class, id and role, text length, share of links, sentences, place in the
page); a parent-child potential scores the pair of labels on every edge.  Because
the graph is a tree, one sum-product pass upward and one downward give exact
content marginals.  Blocks whose element has a marginal above one half are kept.

Training maximises the conditional likelihood of labelled pages: at most about
``TRAIN_PAGES`` pages of the table (the documented bound, chosen by a hash of
the id) that mark their article by ``<article>`` or ``<main>``, each also laid out anew
in ``LAYOUTS`` ways with other tags, class names, side columns, notices, forms and
reader comments, so that no single tag decides.  A few written pages are always
among them, so an empty table has a model too.

Character references are decoded; white space inside a block becomes one space;
blocks are trimmed and joined by a newline in page order.  Null html and pages
without content give an empty text.  Broken markup is closed as browsers do;
repeated rows agree; further columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import blocks, record

TRAIN_PAGES = 200
LAYOUTS = 3
STEPS = 150
PENALTY = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never page text: code, form controls, the head, and what stands in for media that are shown.
SILENT = frozenset("script style noscript template textarea select option button iframe object canvas audio video head title datalist".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCK = frozenset(
    "html body article aside section nav header footer main div p h1 h2 h3 h4 h5 h6 ul ol menu li dl dt dd blockquote pre figure figcaption address"
    " form fieldset legend table caption thead tbody tfoot tr td th details summary dialog hgroup center hr".split())
#: An open element on the left ends when one on the right begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
        "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
#: Tags beyond which an implied end does not look.
SCOPE = frozenset("html body table ul ol menu dl article section main div td th nav aside header footer form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|style|aria-hidden|data-content)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?。؟](?:\s|\Z)")


@dataclass
class Page:
    """Block elements in document order and the runs of text inside them."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    marks: list[str | None] = field(default_factory=list)
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, characters in links

    def add(self, tag: str, parent: int, attrs: str) -> int:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs else {}
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(" ".join([found.get("class", ""), found.get("id", ""), found.get("role", ""), "hiddenelement" if hidden else ""]))
        self.marks.append(found.get("data-content"))
        return len(self.tags) - 1


def parse(text: str) -> Page:
    page = Page()
    page.add("html", -1, "")
    stack: list[tuple[str, int]] = [("html", 0)]  # tag, block element it lies in
    silent = links = 0
    pieces: list[str] = []
    linked = 0

    def close_run():
        nonlocal linked
        if pieces:
            words = html.unescape("".join(pieces)).split()
            if words:
                page.runs.append((stack[-1][1], " ".join(words), linked))
            pieces.clear()
        linked = 0

    def pop():
        nonlocal silent, links
        tag, _ = stack[-1]
        if tag in BLOCK or "-" in tag:
            close_run()
        stack.pop()
        silent -= tag in SILENT
        links -= tag == "a"

    def pop_to(at: int):
        while len(stack) > at:
            pop()

    position, end = 0, len(text)
    while position < end:
        m = _TOKEN.search(text, position)
        upto = m.start() if m else end
        if upto > position and not silent:
            piece = text[position:upto]
            pieces.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        position = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        block = tag in BLOCK or "-" in tag
        if m["end"] or m["end2"]:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == tag:
                    pop_to(at)
                    break
                if not block and (stack[at][0] in BLOCK or "-" in stack[at][0]):
                    break
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in VOID:
            if block:
                close_run()
            elif tag == "br" and not silent:
                pieces.append(" ")
            continue
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            continue
        if block:
            for at in range(len(stack) - 1, 0, -1):
                open_ = stack[at][0]
                if open_ == "p" or open_ == "head" or tag in ENDS.get(open_, ()):
                    pop_to(at)
                    break
                if open_ in SCOPE:
                    break
            close_run()
            stack.append((tag, page.add(tag, stack[-1][1], attrs)))
        else:
            stack.append((tag, stack[-1][1]))
        silent += tag in SILENT
        links += tag == "a"
        if tag in RAW:
            close = re.compile(rf"</{tag}", re.I).search(text, position)
            position = close.start() if close else end
    pop_to(1)
    close_run()
    return page


#: Words of class, id and role names, by what they speak for.
NAMES = {
    "main": "article content main post entry story body text page",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs toolbar skip toc",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner",
    "side": "sidebar side aside widget related recommended trending popular rail complementary teaser",
    "foot": "footer foot copyright legal colophon bottom contentinfo",
    "head": "header masthead head top logo topbar branding",
    "notice": "cookie cookies consent gdpr notice popup modal overlay alert paywall newsletter subscribe signup dialog",
    "comment": "comment comments disqus reply replies respond discussion reader readers reviews",
    "social": "share social sharing follow buttons likes",
    "form": "form search login contact input",
    "hidden": "hiddenelement hidden",
}
TAG_GROUPS = [{"html"}, {"body"}, {"article"}, {"main"}, {"section"}, {"div", "center"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6", "hgroup"}, {"ul", "ol", "menu", "dl"}, {"li", "dt", "dd"},
              {"blockquote", "pre"}, {"figure", "figcaption"}, {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"nav"}, {"header"}, {"footer"}, {"aside"},
              {"form", "fieldset", "legend"}, {"address"}, {"details", "summary", "dialog"}]
_TAG = {t: i for i, group in enumerate(TAG_GROUPS) for t in group}
_NAME = {w: i for i, words in enumerate(NAMES.values()) for w in words.split()}
_LENGTHS = np.asarray([1, 25, 80, 250, 1000, 4000])
_SHARES = np.asarray([0.001, 0.25, 0.6])
_N_TAG, _N_NAME = len(TAG_GROUPS) + 1, len(NAMES)
_EDGE_KINDS = 5


def _offsets(*sizes: int) -> list[int]:
    return [0, *np.cumsum(sizes).tolist()]


# tag | own length | subtree length | link share | sentences | place in the page | any name | (tag x name kinds below)
_AT = _offsets(_N_TAG, len(_LENGTHS) + 1, len(_LENGTHS) + 1, len(_SHARES) + 1, 4, 3, 2)
FEATURES = _AT[-1] + _N_NAME
_SLOTS = 7


def features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """Indicator features of every element (dense slots) and its names (0/1 matrix)."""
    n = len(page.tags)
    own, linked, sentences = np.zeros(n), np.zeros(n), np.zeros(n)
    before = np.full(n, -1.0)
    seen = 0
    for e, text, in_links in page.runs:
        if before[e] < 0:
            before[e] = seen
        seen += len(text)
        own[e] += len(text)
        linked[e] += min(in_links, len(text))
        sentences[e] += len(_SENTENCE.findall(text))
    total, links, ends = own.copy(), linked.copy(), sentences.copy()
    for e in range(n - 1, 0, -1):  # children come after their parents
        p = page.parents[e]
        total[p] += total[e]
        links[p] += links[e]
        ends[p] += ends[e]
        if before[e] >= 0 and (before[p] < 0 or before[e] < before[p]):
            before[p] = before[e]
    where = np.maximum(before, 0) / max(seen, 1)
    names = np.zeros((n, _N_NAME), bool)
    for e, name in enumerate(page.names):
        if name.strip():
            for w in _WORD.findall(name):
                if (k := _NAME.get(w.lower())) is not None:
                    names[e, k] = True
    slots = np.stack([
        np.asarray([_TAG.get(t, _N_TAG - 1) for t in page.tags]),
        np.searchsorted(_LENGTHS, own, "right") + _AT[1],
        np.searchsorted(_LENGTHS, total, "right") + _AT[2],
        np.searchsorted(_SHARES, links / np.maximum(total, 1), "right") + _AT[3],
        np.minimum(np.ceil(np.log2(ends + 1)), 3).astype(int) + _AT[4],
        (where > 0.1).astype(int) + (where > 0.9) + _AT[5],
        names.any(axis=1) + _AT[6],
    ], axis=1)
    return slots, names


def edge_kinds(page: Page, names: np.ndarray) -> np.ndarray:
    """Kind of the edge to the parent: text block, list, container, boilerplate by tag, any boilerplate name."""
    kinds = np.full(len(page.tags), 2)
    for e, t in enumerate(page.tags):
        if t in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption"):
            kinds[e] = 0
        elif t in ("ul", "ol", "menu", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tr", "td", "th"):
            kinds[e] = 1
        elif t in ("nav", "header", "footer", "aside", "form", "dialog"):
            kinds[e] = 3
    kinds[names[:, 1:].any(axis=1)] = 4
    return kinds


@dataclass
class Forest:
    """The elements of many pages, by depth."""

    slots: np.ndarray
    names: np.ndarray
    kinds: np.ndarray
    parents: np.ndarray
    levels: list[np.ndarray]

    @staticmethod
    def of(pages: list[Page]) -> Forest:
        slots, names, kinds, parents, depths, at = [], [], [], [], [], 0
        for page in pages:
            s, m = features(page)
            slots.append(s)
            names.append(m)
            kinds.append(edge_kinds(page, m))
            parents += [p + at if p >= 0 else -1 for p in page.parents]
            depth = [0] * len(page.tags)
            for e in range(1, len(depth)):
                depth[e] = depth[page.parents[e]] + 1
            depths += depth
            at += len(page.tags)
        depth = np.asarray(depths)
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []
        return Forest(np.concatenate(slots), np.concatenate(names), np.concatenate(kinds), np.asarray(parents), levels)


def sum_product(forest: Forest, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the elements (n, 2) and of the edges to the parents (n, 2 parent, 2 child)."""
    n = len(forest.parents)
    up = np.zeros((n, 2))
    up[:, 1] = weights[forest.slots].sum(axis=1) + forest.names @ weights[_AT[-1] :]
    table = edges[forest.kinds]
    message = np.zeros((n, 2))
    for level in reversed(forest.levels[1:]):
        message[level] = np.logaddexp.reduce(table[level] + up[level][:, None, :], axis=2)
        np.add.at(up, forest.parents[level], message[level])
    belief, pairs = up.copy(), np.zeros((n, 2, 2))
    for level in forest.levels[1:]:
        outside = (belief[forest.parents[level]] - message[level])[:, :, None] + table[level]
        belief[level] += np.logaddexp.reduce(outside, axis=1)
        both = outside + up[level][:, None, :]
        pairs[level] = np.exp(both - np.logaddexp.reduce(both.reshape(-1, 4), axis=1)[:, None, None])
    return np.exp(belief - np.logaddexp.reduce(belief, axis=1)[:, None]), pairs


def train(pages: list[Page], labels: list[np.ndarray], steps: int = STEPS, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Unary weights and edge potentials of the largest penalised likelihood."""
    forest, y = Forest.of(pages), np.concatenate(labels).astype(int)
    weights, edges = np.zeros(FEATURES), np.zeros((_EDGE_KINDS, 2, 2))
    child = np.flatnonzero(forest.parents >= 0)
    seen = np.zeros_like(edges)
    np.add.at(seen, (forest.kinds[child], y[forest.parents[child]], y[child]), 1)
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(edges), np.zeros_like(edges)]
    for step in range(1, steps + 1):
        marginal, pairs = sum_product(forest, weights, edges)
        miss = y - marginal[:, 1]
        slope = np.bincount(forest.slots.ravel(), weights=np.repeat(miss, _SLOTS), minlength=FEATURES)[:FEATURES]
        slope[_AT[-1] :] = miss @ forest.names
        expected = np.zeros_like(edges)
        np.add.at(expected, forest.kinds[child], pairs[child])
        for k, (value, gradient) in enumerate(((weights, slope - penalty * weights), (edges, seen - expected - penalty * edges))):
            first, second = state[2 * k], state[2 * k + 1]
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            value += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights, edges


def marked(page: Page) -> np.ndarray | None:
    """Labels from ``data-content`` marks, or from one ``<article>`` or ``<main>``; None if the page has neither."""
    roots = {e for e, m in enumerate(page.marks) if m == "1"}
    if not roots:
        for tag in ("article", "main"):
            found = [e for e, t in enumerate(page.tags) if t == tag]
            if len(found) == 1:
                roots = set(found)
                break
    if not roots:
        return None
    y = np.zeros(len(page.tags), bool)
    for e in range(1, len(y)):
        y[e] = e in roots or (y[page.parents[e]] and page.marks[e] != "0" and page.tags[e] not in ("nav", "aside", "footer", "form", "dialog"))
    return y


def layout(rng: random.Random, title: str, paragraphs: list[str], others: list[str]) -> str:
    """A labelled page with the same article in other surroundings."""
    say = lambda: html.escape(rng.choice(others))
    link = lambda: f'<a href="/{rng.randrange(999)}">{html.escape(rng.choice(others)[: rng.randrange(6, 30)])}</a>'
    links = lambda k: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(k)) + "</ul>"
    plain = lambda: rng.choice(["", f' class="c{rng.randrange(99)}"'])
    name = lambda *names: f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}"' if rng.random() < 0.6 else plain()
    sure = lambda *names: f' {rng.choice(["class", "id"])}="{rng.choice(names)}"'
    comment = lambda: f"<div{sure('comment', 'reply')}><p>{say()} {say()}</p></div>"
    form = lambda: f'<form{name("search", "login-form", "contact")}><label>{say()[:20]}</label><input name="q"><p>{say()[:60]}</p></form>'
    tag, box = rng.choice(["article", "main", "div", "div", "section"]), rng.choice(["div", "nav", "div"])
    inner = [f"<p>{html.escape(p)}</p>" if rng.random() < 0.95 else f"<blockquote>{html.escape(p)}</blockquote>" for p in paragraphs]
    if rng.random() < 0.3:
        inner.insert(rng.randrange(len(inner) + 1), f'<div data-content="0"{sure("ad", "advert", "promo", "sponsored")}>{say()}</div>')
    if rng.random() < 0.3:
        inner.append(f'<section data-content="0"{sure("comments", "reader-comments", "discussion")}><h2>{say()[:20]}</h2>{comment()}{comment()}</section>')
    if rng.random() < 0.2:
        inner.append(f'<div data-content="0"{sure("share", "social", "related")}>{links(3)}</div>')
    if rng.random() < 0.2:
        inner.insert(0, f"<ul>{''.join(f'<li>{html.escape(p[:120])}</li>' for p in paragraphs[:3])}</ul>")
    body = [f"<{box}{name('menu', 'navbar', 'top-nav')}>{links(rng.randrange(3, 9))}</{box}>"]
    if rng.random() < 0.5:
        body.insert(0, f"<{rng.choice(['header', 'div'])}{name('header', 'masthead', 'topbar')}><p>{say()[:40]}</p></header></div>")
    if rng.random() < 0.5:
        body.append(f"<div{sure('cookie-notice', 'consent', 'popup', 'newsletter')}><p>{say()}</p></div>")
    if rng.random() < 0.5:
        body.append(f"<div{sure('ad', 'ads', 'banner')}>{say()}</div>")
    article = f'<{tag} data-content="1"{name("content", "post", "entry", "story", "article-body")}><h1>{html.escape(title)}</h1>{"".join(inner)}</{tag}>'
    body.append(f"<div{name('wrapper', 'container', 'page')}>{article}</div>" if rng.random() < 0.5 else article)
    for chance, made in ((0.5, lambda: f"<{rng.choice(['aside', 'div'])}{sure('sidebar', 'widget', 'related')}><h3>{say()[:25]}</h3>{links(4)}<p>{say()}</p></aside></div>"),
                         (0.3, form), (0.3, lambda: f"<div{sure('comments', 'reader-comments')}>{comment()}{comment()}{comment()}</div>"),
                         (0.9, lambda: f"<{rng.choice(['footer', 'div'])}{sure('footer', 'copyright', 'bottom')}>&copy; {say()} {link()}</footer></div>")):
        if rng.random() < chance:
            body.append(made())
    return f"<html><head><title>{html.escape(title)}</title></head><body>{''.join(body)}</body></html>"


#: Sentences of the written pages.
SENTENCES = [
    "The river rose slowly during the night, and by morning the lower fields were under water.",
    "Nobody in the village could remember a spring like this one. The bridge had been closed since Monday.",
    "Engineers measured the dam twice a day. Their reports were posted on the door of the town hall!",
    "It rained.", "By noon the road was dry again, and the buses went as before.", "Why had no one been told? The mayor said that the letter came too late.",
    "Sign up now", "Read more", "About us", "All rights reserved", "We use cookies to improve this site. Accept or change your settings.",
]


def training_set(texts: list[str], layouts: int = LAYOUTS) -> tuple[list[Page], list[np.ndarray]]:
    """Pages and labels: marked pages as they are and laid out anew, and the written ones."""
    pages, labels = [], []

    def take(text: str) -> tuple[Page, np.ndarray] | None:
        page = parse(text)
        y = marked(page)
        if y is not None:
            pages.append(page)
            labels.append(y)
        return None if y is None else (page, y)

    for number, text in enumerate(texts):
        if (found := take(text)) is None:
            continue
        page, y = found
        inside = [t for e, t, _ in page.runs if y[e]]
        outside = [t for e, t, _ in page.runs if not y[e]] or SENTENCES
        rng = random.Random(number)
        for _ in range(layouts if len(inside) > 1 else 0):
            take(layout(rng, inside[0][:80], inside[1:], outside + inside[1:3]))
    for number in range(120):
        rng = random.Random(1_000_000 + number)
        take(layout(rng, "A long spring", [" ".join(rng.choices(SENTENCES[:6], k=rng.randrange(1, 8))) for _ in range(rng.randrange(1, 12))], SENTENCES))
    return pages, labels


def content(page: Page, marginals: np.ndarray) -> str:
    return "\n".join(text for e, text, _ in page.runs if marginals[e] > 0.5)


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Weights learned from a bounded sample of the pages (page_id, html) that mark their article."""
    able = pages.where(F.lower("html").rlike("<(article|main)[ >]"))
    n = able.count()
    place = F.pmod(F.xxhash64(F.lit("train"), F.col("page_id").cast("string")), F.lit(1 << 20))
    share = min(1.0, train_pages / max(n, 1))
    chosen = able.where(F.coalesce(place, F.lit(0)) < int(share * (1 << 20))).orderBy(place, "page_id", "html").limit(2 * train_pages)
    return train(*training_set([r["html"] for r in chosen.select("html").collect()]))


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    weights, edges = model

    def run(batches):
        for b in blocks(batches, "html", 1 << 20):
            trees = [parse(t or "") for t in b.column("html").to_pylist()]
            marginals, _ = sum_product(Forest.of(trees), weights, edges)
            texts, at = [], 0
            for tree in trees:
                texts.append(content(tree, marginals[at : at + len(tree.tags), 1]))
                at += len(tree.tags)
            yield record(_OUT, {"page_id": b.column("page_id"), "url": b.column("url"), "text": texts, "n_chars": [len(t) for t in texts]})

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
