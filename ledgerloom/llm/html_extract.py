"""Main text of web pages: flat text blocks, classified by a decision tree over themselves and their neighbours.

A page is cut into blocks at block-level tags, in one pass over its characters. A block knows its words, its share of
words inside links, the same of the blocks before and after it, and what the elements around it say of themselves. A
decision tree, grown here from the small labelled pages below, tells main text from the rest.

What an element says (nav, footer, a class named sidebar) holds for what lies in it, unless it is itself around the
page's article: an element that holds the main <article> or <main>, or without those nearly all plain words, says nothing.
Ids are often made from titles: one on a heading says nothing, nor one that only spells the heading of its own section.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkernel import slices

# HTML element names by their role in a page.
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
SILENT = frozenset("noscript template object svg annotation canvas audio video select button".split())
RAW = frozenset("script style textarea title iframe".split())
BARRED = frozenset("nav footer aside form menu dialog header".split())
MAIN = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an open one of these ends where the next of its kind begins
REPEATED = frozenset("p li td th tr dd dt option".split())
#: names in class, id and role that mark what is not the article, alone or as the first or last word of a longer name
NAMES = frozenset(
    """ad ads advert adverts advertisement advertising banner sponsor sponsored promo promos promotion nav navbar navigation menu
    breadcrumb breadcrumbs sidebar footer masthead comment comments commentlist replies reply discussion disqus respond cookie cookies
    consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended
    recommendations widget widgets toolbar pagination pager tags complementary contentinfo""".split()
)
#: the same, but only as a whole name
WHOLE = frozenset("header search tag".split())
#: ids of what readers write below an article
READERS = frozenset("comments comment commentlist replies respond disqus".split())
#: words by which a longer name speaks of a state or of the page's layout
STATE = frozenset("has no not is with without open opened close closed fixed enabled disabled on off single multi".split())

# Possessive throughout, so that no character of a page is looked at again by a match that fails.
_TAG = re.compile(r"""<(?:!--(?:-?>|.*?--!?>)|[!?][^>]*+>|/(?![a-zA-Z])[^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>)""", re.S)
_START = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")
_LONG_NUMBER = re.compile(r"&#([xX]?)([0-9a-fA-F]{9,});?")
_ANCHOR = re.compile(r"[^\W_]+")
_WORD_IN_NAME = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _decoded(raw: str) -> str:
    if "&" not in raw:
        return raw
    if "&#" in raw:  # numbers beyond any character, however long
        raw = _LONG_NUMBER.sub(lambda m: f"&#{m[1]}{m[2].lstrip('0')[:8] or '0'};", raw)
    return html.unescape(raw)


def marks(labels: str) -> bool:
    """Whether a class, id or role names something that is not the article."""
    for name in labels.split():
        low = name.lower()
        if low in NAMES or low in WHOLE:
            return True
        parts = [x.lower() for x in _WORD_IN_NAME.findall(name)]
        if len(parts) > 1 and (parts[0] in NAMES or parts[-1] in NAMES) and not STATE.intersection(parts):
            return True
    return False


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    box: int
    label: bool


@dataclass
class Box:
    """An element that says something of what it holds; boxes are numbered in page order, so a parent comes first."""

    parent: int
    main: bool
    barred: bool
    marked: bool
    anchor: str = ""  # the id, where that alone marks it


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(raw)} if raw.strip(" /") else {}


def _hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()


class _Page:
    """Open elements of a page while it is read; all that is asked of them is kept as counts, so each tag costs the same."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.boxes: list[Box] = []
        # name, index of the box, hidden elements, headings, label, blocks up to and with this one
        self.open: list[tuple[str, int, int, int, int, int]] = []
        self.where: dict[str, list[int]] = {}
        self.link = -1  # index of the open link
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.top = ("", -1, 0, 0, 0, 0)

    def flush(self) -> None:
        if not self.parts:
            return
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            words = text.count(" ") + 1
            linked = min(len("".join(self.linked).split()), words) if self.linked else 0
            self.blocks.append(Block(text, words, linked, self.top[3] > 0, self.top[1], self.top[4] > 0))
        self.parts.clear()
        self.linked.clear()

    def say(self, raw: str) -> None:
        if raw and not self.top[2]:
            text = _decoded(raw)
            self.parts.append(text)
            if self.link >= 0:
                self.linked.append(text)

    def cut(self, at: int) -> None:
        """Closes the open elements from this index on."""
        for i in range(len(self.open) - 1, at - 1, -1):
            self.where[self.open[i][0]].pop()
        del self.open[at:]
        if self.link >= at:
            self.link = -1
        self.top = self.open[-1] if self.open else ("", -1, 0, 0, 0, 0)

    def end(self, name: str) -> None:
        places = self.where.get(name)
        if not places:
            return
        at = places[-1]
        if name == "a":
            self.link = -1
            if self.top[5] > self.open[at][5]:  # blocks opened in the link stay open
                return
        self.cut(at)

    def start(self, name: str, raw: str) -> None:
        places = self.where.get(name)
        if name in REPEATED and places:
            at = places[-1]
            if self.top[5] == self.open[at][5]:  # only inline elements were left open in it
                self.cut(at)
        _, box, hidden, headings, label, blocks = self.top
        attrs = _attributes(raw)
        hidden += name in SILENT or (bool(attrs) and _hidden(attrs))
        marked = bool(attrs) and marks(f"{attrs.get('class', '')} {attrs.get('role', '')}")
        anchor = attrs.get("id", "") if attrs and not marked and name not in HEADING and marks(attrs.get("id", "")) else ""
        marked = marked or bool(anchor)
        main = name in MAIN and not marked
        barred = name in BARRED and not (name == "header" and any(self.where.get(m) for m in MAIN))
        if main or barred or marked:
            self.boxes.append(Box(box, main, barred, marked, anchor))
            box = len(self.boxes) - 1
        if name == "a":
            self.link = len(self.open)
        self.top = (name, box, hidden, headings + (name in HEADING), int(attrs[LABEL] == "1") if LABEL in attrs else label, blocks + (name in BLOCK and name != "p"))
        self.where.setdefault(name, []).append(len(self.open))
        self.open.append(self.top)


def parsed(page: str) -> _Page:
    """Blocks with text, in page order, and the boxes around them.

    Unclosed and misplaced tags are taken about as browsers take them; a tag or comment that never ends takes the rest of
    the page with it. Every character is read a fixed number of times.
    """
    p, at, n = _Page(), 0, len(page)
    while at < n:
        m = _START.search(page, at)
        if not m:
            p.say(page[at:])
            break
        p.say(page[at : m.start()])
        m = _TAG.match(page, m.start())
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            p.flush()
        if name in ("html", "head", "body"):
            continue
        if m[1]:
            p.end(name)
        elif name in RAW:
            end = _END[name].search(page, at)
            at = end.start() if end else n
        elif name not in VOID:
            p.start(name, m[3])
    p.flush()
    _titled(p)
    return p


#: of words outside all that speaks, how many an article has to hold to be the page's, and an element to be around the page
LEAST, WRAPS = 0.1, 0.8
FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "main", "barred", "marked", "heading")


def _slug(text: str) -> str:
    """A title as pages make anchors of it."""
    return re.sub(r"-\d+$", "", "-".join(_ANCHOR.findall(text.lower())))


def _titled(p: _Page) -> None:
    """An id that is only its element's own heading spelt as an anchor says nothing of the element.

    Reader comments are what they are under any heading; and a part whose words are mostly links is no section of a text.
    """
    first: dict[int, int] = {}
    plain, words = [0] * (len(p.boxes) + 1), [0] * (len(p.boxes) + 1)
    for i, b in enumerate(p.blocks):
        first.setdefault(b.box, i)
        plain[b.box] += b.words - b.linked
        words[b.box] += b.words
    for i in range(len(p.boxes) - 1, -1, -1):
        parent = p.boxes[i].parent
        plain[parent] += plain[i]
        words[parent] += words[i]
        if i in first and parent >= 0:
            first[parent] = min(first[i], first.get(parent, first[i]))
    for i, box in enumerate(p.boxes):
        if box.anchor and i in first:
            head = p.blocks[first[i]]
            if head.heading and _slug(head.text) == _slug(box.anchor) and box.anchor.lower() not in READERS and 2 * plain[i] >= words[i]:
                box.marked = False


def _said(p: _Page) -> list[tuple[int, bool, bool]]:
    """For each box: 1 inside the article, -1 outside where the page has one, 0 without; inside a barred element; inside a marked one."""
    n = len(p.boxes)
    plain, loose = [0] * (n + 1), 0
    for b in p.blocks:
        plain[b.box] += b.words - b.linked
        box = p.boxes[b.box] if b.box >= 0 else None
        loose += b.words - b.linked if box is None or not (box.barred or box.marked) else 0
    total = sum(plain)
    for i in range(n - 1, -1, -1):
        plain[p.boxes[i].parent] += plain[i]  # index -1, the page itself, is the last place
    around = [False] * (n + 1)
    articles = [i for i in range(n) if p.boxes[i].main and plain[i] > 0]
    # the page's article: the one with most plain words, unless it is a small part of them
    best = max(articles, key=lambda i: (plain[i], -i), default=-1)
    found = best >= 0 and plain[best] >= LEAST * loose
    if found:
        inside = [False] * (n + 1)
        for i in range(best, n):
            inside[i] = i == best or inside[p.boxes[i].parent]
        inner = [i for i in articles if inside[i]]
        best = max(inner, key=lambda i: (2 * plain[i] >= plain[best], i), default=best)  # the innermost with half of them
        while best >= 0:
            around[best] = True
            best = p.boxes[best].parent
    out = [(0, False, False)] * (n + 1)
    out[n] = (-1 if found else 0, False, False)
    for i, b in enumerate(p.boxes):
        main, barred, marked = out[b.parent]
        speaks = not around[i] if found else plain[i] < WRAPS * total
        out[i] = (1 if b.main and found else main, barred or (b.barred and speaks), marked or (b.marked and speaks))
    return out


def measured(p: _Page) -> np.ndarray:
    """A row of features for each block: itself, its neighbours (0 words and density 0 outside the page), what is said of it."""
    words = np.array([0, *(b.words for b in p.blocks), 0], float)
    density = np.array([0, *(b.linked / b.words for b in p.blocks), 0])
    said = _said(p)
    flags = np.array([[*said[b.box], b.heading] for b in p.blocks], float).reshape(-1, 4)
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], flags])


@dataclass
class Tree:
    """feature is -1 at a leaf, which then says label."""

    feature: int
    cut: float
    label: int
    low: "Tree | None" = None
    high: "Tree | None" = None

    def says(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), bool(self.label))
        below = x[:, self.feature] <= self.cut
        out = np.empty(len(x), bool)
        out[below], out[~below] = self.low.says(x[below]), self.high.says(x[~below])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 7) -> Tree:
    """A binary tree by least Gini impurity; of equal cuts the first feature's lowest."""
    label = int(2 * y.sum() >= len(y))
    if depth == 0 or y.min() == y.max():
        return Tree(-1, 0.0, label)
    best = None
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            below = x[:, f] <= v
            cost = sum(len(p) * (q := p.mean()) * (1 - q) for p in (y[below], y[~below]))
            if best is None or cost < best[0] - 1e-12:
                above = x[~below, f].min()
                best = (cost, f, (v + above) / 2)
    if best is None:
        return Tree(-1, 0.0, label)
    _, f, cut = best
    below = x[:, f] <= cut
    return Tree(f, cut, label, grow(x[below], y[below], depth - 1), grow(x[~below], y[~below], depth - 1))

LABEL = "data-main"
# Labelled pages, made up for this purpose after common layouts. {n} stands for n words of text; + in a tag
# says that what it holds is main text, - that it is not.
PAGES = """
<nav><ul><li><a>{1}</a><li><a>{1}</a><li><a>{2}</a></ul></nav><div class=ad>{6}</div><article +><h1>{6}</h1><p>{40}<p>{3}<p>{70}<b>{2}</b>{8}<br>{12}<p>{25} <a>{2}</a> {20}</article><footer>{9} <a>{1}</a></footer>
<header><a>{2}</a><nav><a>{1}</a><a>{1}</a></nav></header><div class="site no-sidebar"><main><article +><header><h1>{8}</h1><p>{4}</header><p>{55}<h2>{3}</h2><p>{1}<p>{30}<ul><li>{5}<li>{7}<li>{2}</ul><blockquote>{22}</blockquote></article><div class=share><a>{1}</a><a>{1}</a></div><section class=comments><h3>{2}</h3><p>{35}<p>{9}<p>{60}</section></main></div><footer>{12}</footer>
<div id=cookie-banner>{24} <a>{2}</a></div><div class=top><a>{1}</a><br><a>{2}</a><br><a>{1}</a></div><div class=content><h1 +>{7}</h1><p +>{48}</p><p +>{66}</p><h2 +>{3}</h2><p +>{31}</p><p +>{5}</p><p +>{44} <a>{3}</a></p></div><div class=sidebar><h3>{2}</h3><p>{30}</p><ul><li><a>{4}</a><li><a>{6}</a></ul></div><div id=footer>{10}</div>
<div><a>{1}</a></div><div><a>{2}</a></div><div><a>{1}</a></div><table><tr><td><a>{2}</a><br><a>{3}</a><br><a>{2}</a><td><h1 +>{5}</h1><p +>{80}<p +>{62}<p +>{17}<p +>{90}</table><center><a>{2}</a> <a>{1}</a></center><div>{4} <a>{1}</a></div>
<form><div id=header><a>{1}</a></div><div id=menu><a>{1}</a><br><a>{1}</a></div><div id=body><h2 +>{4}</h2><div +>{120}</div><div +>{75}</div><div +>{33}</div></div></form>
<form><label>{1}</label><label>{2}</label><p>{14}</p></form><section><h1 +>{9}</h1><p +>{38}</p><p +>{27}</p><p +>{2}</p><p +>{58}</p></section><div class=related><h4>{2}</h4><p><a>{9}</a></p><p><a>{7}</a></p></div>
<div class=masthead>{3}</div><ul class=nav><li><a>{1}</a><li><a>{1}</a></ul><div class="container comments-open"><div class="entry header-fixed"><h1 +>{6}</h1><p +>{45}</p><p +>{29}</p><figure><figcaption +>{11}</figcaption></figure><p +>{64}</p></div></div><div id=respond><p>{20}</p></div><ol class=commentlist><li>{45}<li>{12}<li>{70}</ol>
<main +><h1>{3}</h1><p>{16}<p>{21}<pre>{30}</pre><p>{8}<dl><dt>{1}<dd>{12}<dt>{2}<dd>{9}</dl></main><aside><h2>{2}</h2><p>{40}<p>{22}</aside><footer><p>{18}<p><a>{3}</a></footer>
<div role=navigation><a>{1}</a><br><a>{1}</a></div><div role=alert>{15}</div><article +><h1>{10}</h1><p>{2}<p>{35}<p>{4}</article><div class=newsletter-signup><h3>{4}</h3><p>{26}</div><div class=widget><p>{19}</div>
<div class=menu><a>{1}</a></div><div class="single search"><h1 +>{4}</h1><p +>{52}</p><p +>{41}</p></div><p><a>{1}</a> <a>{1}</a> <a>{2}</a></p><p><a>{4}</a></p><p><a>{5}</a></p>
<p><a>{2}</a></p><p><a>{1}</a> {1} <a>{1}</a></p><h1 +>{7}</h1><p +>{34} <a>{2}</a> {15}</p><p +>{71}</p><p +>{18}</p><p +>{49}</p><p><a>{6}</a></p><p>{2} <a>{3}</a></p><p>{6}</p>
<div><a>{1}</a></div><div>{3}</div><div +>{110}</div><div +>{14}</div><div +>{85}</div><div><a>{3}</a> <a>{2}</a></div><div>{5}</div>
<article +><h1>{5}</h1><p>{60}<div class=ads ->{12}</div><p>{47}<aside ->{20}</aside><p>{9}<footer ->{11}</footer></article><div class=recommended><article><h3><a>{8}</a></h3><p>{14}</article><article><h3><a>{6}</a></h3><p>{18}</article></div>
<main><h1 +>{6}</h1><p +>{3}<p +>{50}<p +><a>{4}</a><p +>{22}<div id=comments -><article class=comment><p>{40}</article><article class=comment><p>{25}</article></div></main><div id=sidebar><p>{16}</div>
<article +><h1>{4}</h1><p>{12}</article><nav><a>{1}</a></nav><div class=popup>{30}</div>
<div class=promo>{9}</div><article +><h1>{7}</h1><p>{1}<p>{28}<p>{6}<p>{33}</article><div class=disqus><p>{50}<p>{8}<p>{31}</div><p>{13}</p>
<p>{6}</p><article +><h1>{5}</h1><p>{65}<p>{20}</article><p>{30}</p><p>{45}</p><p>{4}</p>
<h1 +>{8}</h1><p +>{42}</p><p +>{57}</p><p +>{63}</p><h3>{2}</h3><ul><li><a>{5}</a><li><a>{4}</a><li><a>{7}</a></ul><p>{7} <a>{1}</a></p>
<div><a>{1}</a> <a>{1}</a> <a>{1}</a></div><h2 +>{5}</h2><p +>{26}</p><p +>{39}</p><ul><li +>{8}<li +>{11}<li +>{6}</ul><p +>{44}</p><div><a>{2}</a> <a>{2}</a></div><div>{8}</div>
<p +>{150}</p>
<h1 +>{3}</h1><p +>{24}</p>
<div><a>{1}</a></div><p +>{36}</p><p +>{2}</p><p +>{40}</p><p +>{3}</p><p +>{51}</p><div><a>{4}</a></div>
<article +><p>{20}<p><a>{2}</a><p>{18}<ul><li><a>{3}</a><li><a>{5}</a></ul><p>{37}</article><div class=tags><a>{1}</a> <a>{1}</a></div>
<nav><a>{1}</a></nav><article +><h1>{4}</h1><p>{3}<p>{140}<p>{2}<p>{180}<p>{1}<p>{6}</article>
<ul><li><a>{1}</a></ul><main +><p>{9}<p>{112}<p>{1}<p>{125}<p>{4}<p>{2}</main>
<article +><p>{2}</article>
<div><a>{1}</a></div><h1 +>{5}</h1><p +>{130}</p><p +>{3}</p><p +>{150}</p><p +>{2}</p><p +>{110}</p><p +>{48}</p><p +>{21}</p>
<ul><li><a>{1}</a><li><a>{2}</a></ul><h1 +>{3}</h1><p +>{70}</p><p +>{33}</p><div class=sidebar>{20}</div>
<article +><h1>{6}</h1><p>{30}<p>{1}<p><a>{3}</a><ul><li>{2}<li>{2}</ul><div class=related -><a>{4}</a></div></article>
<article +><p>{30}<p><a>{4}</a><p>{12}</article>
<main +><p>{44}<p>{2}<p><a>{5}</a><p>{3}<p><a>{2}</a></main>
<div><a>{1}</a><a>{1}</a></div><h1 +>{2}</h1><p +>{29}</p><p +>{88}</p><h2 +>{1}</h2><p +>{54}</p>
<article +><h2>{3}</h2><p>{10} <a>{9}</a><p><a>{12}</a><p>{6}</article><div class=breadcrumbs><a>{1}</a> {1} <a>{2}</a></div>
"""


def labelled_page(line: str) -> str:
    line = re.sub(r" ([+-])(?=>)", lambda m: f" {LABEL}={int(m[1] == '+')}", line)
    return re.sub(r"\{(\d+)\}", lambda m: " word" * int(m[1]) + " ", line)


def trained(pages: str = PAGES) -> Tree:
    """A tree grown from labelled pages, one a line."""
    rows, labels = [], []
    for line in pages.strip().splitlines():
        p = parsed(labelled_page(line))
        rows.append(measured(p))
        labels.append([b.label for b in p.blocks])
    return grow(np.concatenate(rows), np.concatenate(labels).astype(int))


def main_text(page: str | None, tree: Tree) -> str:
    """Blocks that the tree takes for main text, joined by one space."""
    p = parsed(page or "")
    if not p.blocks:
        return ""
    return " ".join(b.text for b, says in zip(p.blocks, tree.says(measured(p)), strict=True) if says)


def extract(pages: DataFrame, *more: Column, labelled: str = PAGES) -> DataFrame:
    """page_id, url, text, n_chars for each page, and strings that `more` takes from its row.

    A null or empty page has an empty text; a null page_id or url stays null; repeated rows are rows of their own; an
    empty table gives an empty result; other columns are ignored. Whole pages are read, of any length, in time that
    grows with it; a task holds about a megabyte of pages, or one page, at a time.
    """
    tree = trained(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for a, z in slices(x.column(2)):
                b = x.slice(a, z - a)
                texts = [main_text(t, tree) for t in b.column(2).to_pylist()]
                yield pa.record_batch({"page_id": b.column(0), "url": b.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())} | {n: b.column(3 + i) for i, n in enumerate(names)})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *more)
    names = rows.columns[3:]
    return rows.mapInArrow(run, ", ".join(["page_id long, url string, text string, n_chars long", *(f"`{n}` string" for n in names)]))
