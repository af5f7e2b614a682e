"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each block has its own word count
and link density, those of its neighbours, and marks of the elements around it. A
decision tree, trained on the blocks of the labelled pages below, tells main text
from the rest.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: A value is quoted, or runs to white space or the tag's end whatever quotes it holds.
_VALUE = r"(?:\"[^\"]*\"|'[^']*'|[^\s>]*)"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*{_VALUE})*+)(?:>|\Z)", re.S)
_ATTR = re.compile(rf"([^\s=/]+)(?:\s*=\s*({_VALUE}))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Their content is no text of the page.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head", "title"}
#: Their content runs to the closing tag, whatever stands in between. But for scripts and styles, one that is
#: self-closed has none, and of one without a closing tag only the tag is skipped.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "title", "textarea"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr", "img"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements for parts around the article.
AROUND = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "textarea", "fieldset"}
CONTENT = {"article", "main"}
#: Their ids name a place in the text, not a part of the page.
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "span", "a"}
#: Words in class, id or role that tell of parts around the article.
HINTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
         "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup",
         "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "side", "menu",
         "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar",
         "social", "share", "sharing", "related", "recommended", "recommendations", "teaser", "widget", "search",
         "pagination", "pager", "copyright", "legal", "disclaimer", "tags", "toc", "skip", "complementary",
         "contentinfo", "header"}
#: Words that tell of readers' comments.
TALK = {"comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "reactions"}
GOOD = {"article", "content", "post", "entry", "story", "body", "main", "text"}
#: Words that say nothing about what a part is for; beside a hint they don't weaken it.
NEUTRAL = {"box", "bar", "block", "section", "list", "links", "link", "wrapper", "wrap", "container", "area", "inner", "outer", "panel",
           "left", "right", "top", "bottom", "primary", "secondary", "global", "site", "page", "items", "item", "group", "row", "col", "column",
           "posts", "news", "module", "region", "policy", "message", "icons", "buttons", "form", "slot", "unit", "main", "media", "the", "js", "container"}
#: Openings of lines that a site puts on all its pages.
FORMULA = re.compile(r"(©|\(c\)\s|copyright\b|imprint\b|all rights reserved|terms of (use|service)|privacy policy|powered by|print (this|version)\b)", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    around: bool  # inside an element for parts around the article, or a small part that a class or id names so
    talk: bool  # inside readers' comments
    article: bool  # inside an article or main element
    content: bool  # inside a class that names the article
    heading: bool
    item: bool  # inside a list item or table cell
    hints: tuple[int, ...] = ()  # numbers of the elements around it whose class, id or role is a hint


def _names(value: str, words: set[str]) -> bool:
    """Whether a class or id names a part by one of ``words``, and by nothing else but neutral words."""
    for part in value.split():
        found = [w.lower() for w in _WORD.findall(part)]
        if found and found[0] not in ("has", "with", "no", "is", "without") and any(w in words for w in found) and all(
                w in words or w in HINTS or w in NEUTRAL or w.isdigit() for w in found):
            return True
    return False


def _marks(tag: str, attrs: str) -> tuple[bool, bool, bool, bool]:
    """(hint, talk, content, hidden) as an element's attributes tell."""
    hint, content, talk, hidden = False, False, False, False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name in ("class", "id", "role", "aria-label") and tag not in ("html", "body") and not (name == "id" and tag in TEXT_TAGS):
            talk |= _names(value, TALK)
            hint |= tag not in CONTENT and _names(value, HINTS)
            for part in value.split():
                words = [w.lower() for w in _WORD.findall(part)]
                content |= bool(words) and all(w in GOOD for w in words)
    return hint, talk, content, hidden


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks in page order; character references decoded, white space single."""
    out: list[Block] = []
    bare = ("", False, False, False, False, False, False, False, ())
    stack: list[tuple] = []  # (tag, around, talk, article, content, heading, item, silent, hints)
    hinted = 0
    parts: list[tuple[str, bool]] = []
    links = 0
    unclosed: set[str] = set()  # elements of RAW without a closing tag in the rest of the page

    def flush() -> None:
        if not parts:
            return
        raw = "".join(p for p, _ in parts)
        text = " ".join(raw.split())
        if text:
            linked = sum(len(p.split()) for p, a in parts if a)
            _, around, talk, article, content, heading, item, _, hints = stack[-1] if stack else bare
            out.append(Block(text, len(text.split()), linked, around, talk, article, content, heading, item, hints))
        parts.clear()

    def say(text: str) -> None:
        if text and not (stack and stack[-1][7]):
            parts.append((html.unescape(text), links > 0))

    page = page or ""
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # closing
            if tag == "a":
                links = max(0, links - 1)
                continue
            if tag in INLINE:
                continue
            flush()
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
                links = 0
            continue
        if tag in RAW:
            if tag not in SILENT:
                flush()
            code = tag in ("script", "style")
            if tag in unclosed or (m[3].endswith("/") and not code):
                continue
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif code:
                at = n
            else:
                unclosed.add(tag)
            continue
        if tag == "a":
            links += 1
            continue
        if tag in INLINE:
            hint, talk, _, hidden = _marks(tag, m[3]) if m[3] else (False, False, False, False)
            if tag == "img" or not (hint or talk or hidden):
                continue
        flush()
        if tag in VOID or m[3].endswith("/"):
            continue
        links = 0
        if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "option"):
            # an open one of the same kind ends here
            same = ("p", "h1", "h2", "h3", "h4", "h5", "h6") if tag[0] in "ph" else (tag,)
            if stack and stack[-1][0] in same:
                stack.pop()
        up = stack[-1] if stack else bare
        hint, talk, content, hidden = _marks(tag, m[3])
        around = tag in AROUND and tag != "form" or tag == "header" and not (up[3] or up[4])
        if hint or tag == "form":
            hinted += 1
        if tag in CONTENT:  # what wasn't closed before an article doesn't hold it
            up = (up[0], False, up[2], up[3], up[4], False, False, up[7], ())
        stack.append((tag, up[1] or around, up[2] or talk, up[3] or tag in CONTENT, up[4] or content, up[5] or tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
                      up[6] or tag in ("li", "td", "th", "dd", "dt"), up[7] or hidden or tag in SILENT, (*up[8], hinted) if hint or tag == "form" else up[8]))
    flush()
    _weigh(out)
    return out


def _weigh(page: list[Block]) -> None:
    """A hint counts for a part of the page: one on an element that holds most of its words is a layout's name."""
    total = sum(b.words for b in page)
    held: dict[int, int] = {}
    for b in page:
        for h in b.hints:
            held[h] = held.get(h, 0) + b.words
    for b in page:
        b.around |= any(2 * held[h] <= total for h in b.hints)


FEATURES = ("words", "density", "words before", "density before", "words after", "density after",
            "around", "talk", "article", "content", "heading", "item", "formula", "article on page", "content on page")


def features(page: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block; beyond the page's ends neighbours have no words."""
    words = np.array([b.words for b in page], float)
    density = np.array([b.linked / b.words for b in page], float)
    before = lambda v: np.r_[0.0, v[:-1]]
    after = lambda v: np.r_[v[1:], 0.0]
    flags = np.array([[b.around, b.talk, b.article, b.content, b.heading, b.item, FORMULA.match(b.text) is not None] for b in page], float).reshape(-1, 7)
    on_page = [np.full(len(page), float(any(getattr(b, c) and not b.talk for b in page))) for c in ("article", "content")]
    return np.c_[words, density, before(words), before(density), after(words), after(density), flags, on_page[0], on_page[1]]


# ------------------------------------------------------------------ decision tree

def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 12) -> tuple:
    """A binary classification tree by Gini impurity, ``least`` rows in a leaf: (share of 1,) or (feature, border, left, right)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for border in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= border
            a, b = y[left], y[~left]
            if min(len(a), len(b)) < least:
                continue
            cost = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(border), left)
    if best is None:
        return (share,)
    _, f, border, left = best
    return (f, border, grow(x[left], y[left], depth - 1, least), grow(x[~left], y[~left], depth - 1, least))


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Share of main text in each row's leaf."""
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    left = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[left], out[~left] = classify(tree[2], x[left]), classify(tree[3], x[~left])
    return out


_WORDS = ("the river rose over its banks in a night of rain and fields along old roads stood under water until noon when people came back to "
          "their houses with boats bread lamps letters children dogs and told what they had seen on hills beyond town").split()


def labelled_pages(number: int = 320, seed: int = 7) -> list[str]:
    """The labelled table: pages whose blocks begin with + where they are main text and with - where not.

    Pages differ in what holds the article (an element, a class that names it, or nothing),
    in the wrapper around everything, in the lengths of paragraphs, and in menus, link
    lists, adverts, notices, forms, comments and closing lines around and inside it.
    """
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(rng.choice(_WORDS) for _ in range(rng.randint(low, high)))

    def linked(mark: str, low: int = 1, high: int = 9) -> str:
        return f"<a href=x>{mark}{words(low, high)}</a>"

    def paragraph() -> str:
        high = rng.choice((3, 8, 30, 60, 120))
        link = f' {linked("", 1, 3)} {words(4, 20)}' if rng.random() < 0.2 else ""
        return f"<p>+{words(1, high)}{link}</p>"

    def body(inside: bool) -> str:
        parts = [paragraph() for _ in range(rng.randint(2, 8))]
        extra = [f"<h2 id={rng.choice(('related-work', 'search-and-rescue', 'legal-history'))}>+{words(1, 6)}</h2>",
                 "<ul>" + "".join(f"<li>+{words(1, 12)}</li>" for _ in range(rng.randint(1, 6))) + "</ul>", f"<blockquote>+{words(2, 40)}</blockquote>",
                 f"<table><tr><td>+{words(1, 4)}</td><td>+{words(1, 2)}</td></tr></table>", f"<figure><img src=x><figcaption>+{words(2, 15)}</figcaption></figure>",
                 f"<p class=share-price>+{words(3, 25)}</p>", f"<p id=tags>+{words(3, 25)}</p>"]
        around = [f"<div class={rng.choice(('ad', 'advert-box', 'promo', 'newsletter-signup', 'related-posts'))}>-{words(3, 60)}</div>", f"<aside><p>-{words(3, 60)}</p></aside>",
                  f"<form>-{words(1, 20)} <button>-{words(1, 2)}</button></form>", f"<div class=notice><p>-{words(3, 60)}</p></div>", f"<nav>{linked('-')}{linked('')}</nav>"]
        if inside:
            extra += [f"<p>{linked('+', 2, 8)}</p>", f"<p>+Copyright {words(1, 9)}</p>", f"<p>+All rights reserved {words(0, 4)}</p>"]
        for part in rng.sample(extra, rng.randint(0, 4)) + rng.sample(around, rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), part)
        top = rng.choice((f"<h1>+{words(1, 8)}</h1>", f'<div class="post-header"><h1>+{words(1, 8)}</h1></div>', "", f"<h1>+{words(1, 8)}</h1><h2>{linked('+', 2, 6)}</h2>" if inside else ""))
        return top + "".join(parts)

    def menu() -> str:
        many = rng.randint(2, 24)
        return rng.choice((
            "<ul>" + "".join(f"<li>{linked('-')}</li>" for _ in range(many)) + "</ul>", "".join(f"<div>{linked('-')}</div>" for _ in range(min(many, 6))),
            "<p>" + " | ".join(linked("-" if i == 0 else "", 1, 3) for i in range(min(many, 6))) + "</p>", f"<nav>{linked('-')}<ul><li>{linked('-')}</li></ul></nav>",
            "<div id=menu>" + " ".join(linked("-" if i == 0 else "", 1, 3) for i in range(min(many, 6))) + "</div>"))

    def end() -> str:
        if rng.random() < 0.6:  # most pages of the table end with what comes before
            return ""
        return rng.choice((f"<footer><p>-{words(2, 60)}</p></footer>", f"<div class=footer>-{words(2, 20)}</div>", f"<p>-Copyright {words(1, 6)}</p>", f"<div>-Imprint {words(0, 3)}</div>",
                           f"<p>-© {words(1, 5)}</p>", f"<p>-Copyright {words(1, 6)}</p><p>{linked('-')}</p>"))

    def talk() -> str:
        return rng.choice((f"<section id=comments><h3>-{words(1, 3)}</h3>" + "".join(f"<p>-{words(1, 60)}</p>" for _ in range(rng.randint(1, 6))) + "</section>",
                           "".join(f"<article class=comment><p>-{words(1, 60)}</p></article>" for _ in range(rng.randint(1, 3))), *[""] * 6))

    pages = []
    for i in range(number):
        kind = i % 4  # an element, a class, or nothing at all around the article
        text = body(kind < 2)
        held = (f"<article>{text}</article>" if kind == 0 else f"<main>{text}</main>" if kind == 1 and i % 8 < 4 else f"<article class=post>{text}</article>"
                if kind == 1 else f"<div class={rng.choice(('content', 'post-body', 'entry-content'))}>{text}</div>" if kind == 2 else text)
        head = "".join(menu() for _ in range(rng.randint(0, 2))) + (f"<header><h1>-{words(1, 3)}</h1><p>-{words(2, 12)}</p></header>" if rng.random() < 0.4 else "")
        side = f"<aside class=sidebar><h3>-{words(1, 3)}</h3><p>-{words(3, 40)}</p></aside>" if rng.random() < 0.3 else ""
        tail = (menu() if rng.random() < 0.25 else "") + talk() + end()
        wrap = rng.choice(("{}", "{}", '<div class="layout sidebar-right">{}</div>', '<div class="has-header side-nav-layout">{}</div>', "<form>{}</form>"))
        pages.append(f"<body>{wrap.format(head + held + side + tail)}</body>")
    return pages


@functools.lru_cache(maxsize=1)
def trained_tree() -> tuple:
    """The tree grown on the blocks of the labelled pages."""
    x, y = [], []
    for page in labelled_pages():
        found = blocks(page)
        y.extend(b.text[0] == "+" for b in found)
        for b in found:
            b.text = b.text[1:]
        x.append(features(found))
    return grow(np.concatenate(x), np.array(y, float))


def main_texts(pages: list[str | None], tree: tuple | None = None) -> list[str]:
    """Main text of each page: its main blocks, joined by line feeds."""
    found = [blocks(p) for p in pages]
    rows = [features(b) for b in found if b]
    if not rows:
        return ["" for _ in pages]
    keep = iter(classify(tree or trained_tree(), np.concatenate(rows)) >= 0.5)
    return ["\n".join([b.text for b in page if next(keep)]) for page in found]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null, empty and textless pages have empty text. Rows are independent: repeated
    rows and ids give repeated rows, null ids and urls stay; unclosed and
    stray tags end with the element around them; a quote that isn't closed in its tag
    belongs to an unquoted value, which white space ends. An empty table gives an empty
    one; other columns are not read.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{markup}`").cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    tree = trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts = main_texts(batch.column("html").to_pylist(), tree)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string").withColumn(
        "n_chars", F.char_length("text").cast("long"))
