"""Main text of web pages from flat text blocks.

A page is cut into blocks at its block-level tags. Each block is described by
its own word count and link density, those of its two neighbours, and what
its open tags and their class, id and role words say (menu, footer, notice
... or article). A decision tree, trained on the small labelled pages below,
keeps or drops each block.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textnp as T
from .common import ready

#: name, in the order of a block's feature vector.
FEATURES = (
    "words", "link_density", "previous_words", "previous_density", "next_words", "next_density",
    "boilerplate_tag", "boilerplate_name", "article", "heading", "list_item",
)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|[^<]+|<""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements without any main text of their own.
_SKIP = set(
    "head script style noscript template svg math iframe object canvas audio video button select textarea "
    "option datalist input".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_PLAIN_TAGS = set("nav footer aside form menu dialog fieldset".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role values that name boilerplate.
_HINTS = set(
    "ad ads adv advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored sponsors "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside complementary footer foot "
    "contentinfo masthead topbar toolbar comment comments commentlist disqus reply replies respond related recommended "
    "recommendations share sharing social pagination pager pagenav widget widgets search searchform form copyright "
    "disclaimer skip tags byline".split()
)
_OUTER_HINTS = {"header", "head", "banner"}
#: First words of names that sort an article ("tag-garden"), and words that make a name one of the layout.
_TAXONOMY = set("tag tags category cat topic section author format type status postid".split())
_LAYOUT = set("with has have no without is not layout page site col cols column columns grid row wrapper".split())
_ARTICLE_HINTS = set("article content post entry story main maincontent body text".split())


def _names(attributes: str) -> set[str]:
    found = set()
    for m in _NAMES.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        for name in value.split():
            parts = [w.lower() for w in _WORDS.findall(name)]
            # "with-sidebar", "page-no-comments": the layout, not the part; "tag-advertising": what it is about.
            if len(parts) > 1 and (parts[0] in _TAXONOMY or _LAYOUT & set(parts)):
                found.update(w for w in parts if w in _ARTICLE_HINTS)
            elif parts and parts[0] not in _LAYOUT:
                found.update(parts)
    return found


_MAIN = re.compile(r"<(?:article|main)(?=[\s/>])", re.I)


def _main_start(page: str) -> int:
    """Where the page's first main element starts, or else its first article; -1 without any.
    Later articles may be comments or teasers."""
    starts = [(m[0].lower() != "<main", m.start()) for m in _MAIN.finditer(page)]
    return min(starts)[1] if starts else -1


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """(text, features) of a page's blocks, in page order. Character
    references are decoded, white space inside a block is one space."""
    out: list[list] = []  # text, words, linked words, plain tag, plain name, article, heading, item
    stack: list[tuple[str, int, int, int]] = []  # tag, plain tag, plain name, article
    open_tags: dict[str, int] = {}
    plain_tag = plain_name = article = links = 0
    text: list[str] = []
    linked: list[str] = []
    heading = item = 0

    def flush():
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                n = joined.count(" ") + 1
                in_links = min(n, sum(len(x.split()) for x in linked))
                out.append([joined, n, in_links, plain_tag > 0, plain_name > 0, article > 0, heading, item])
            text.clear(), linked.clear()

    def close(tag: str):
        nonlocal plain_tag, plain_name, article
        while stack:
            name, a, b, c = stack.pop()
            open_tags[name] -= 1
            plain_tag, plain_name, article = plain_tag - a, plain_name - b, article - c
            if name == tag:
                return

    at, size, main_start = 0, len(page), _main_start(page)
    while at < size:
        m = _TOKEN.match(page, at)
        if m is None:  # an open quote: the rest up to the next tag end
            end = page.find(">", at)
            at = size if end < 0 else end + 1
            continue
        at = m.end()
        token = m[0]
        if m[2] is None:
            if token[0] != "<" or token == "<":
                piece = html.unescape(token) if "&" in token else token
                text.append(piece)
                if links:
                    linked.append(piece)
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in _BLOCK:
                flush()
                if open_tags.get(tag):
                    close(tag)
                if tag in _HEADINGS:
                    heading = 0
                elif tag == "li":
                    item = 0
            continue
        attributes = m[3] or ""
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in _SKIP or (attributes and _HIDDEN.search(attributes) and tag not in ("html", "body")):
            if tag in _BLOCK:
                flush()
            at = _after(page, at, tag)
            continue
        if tag == "a":
            links += 1
            continue
        if tag not in _BLOCK:
            continue
        flush()
        links = 0  # a block ends an unclosed link
        if open_tags.get("p") and stack and stack[-1][0] == "p":
            close("p")
        if tag in _HEADINGS:
            heading, item = 1, 0
        elif tag == "li":
            heading, item = 0, 1
        else:
            heading = 0
        names = _names(attributes) if attributes and tag not in ("html", "body") else set()
        hinted = bool(names & _HINTS) or (not article and bool(names & _OUTER_HINTS))
        if hinted and (m.start() == main_start or at <= main_start < _after(page, at, tag)):
            hinted = False  # the main text itself or what it lies in
        inside = tag in ("article", "main") or (tag in ("div", "section") and bool(names & _ARTICLE_HINTS) and not hinted)
        plain = tag in _PLAIN_TAGS or (tag == "header" and not article)
        stack.append((tag, int(plain), int(hinted), int(inside)))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        plain_tag, plain_name, article = plain_tag + plain, plain_name + hinted, article + inside
    flush()

    rows = []
    none = ["", 0, 0]
    for k, b in enumerate(out):
        before, after = (out[k - 1] if k else none), (out[k + 1] if k + 1 < len(out) else none)
        density = [x[2] / x[1] if x[1] else 0.0 for x in (b, before, after)]
        rows.append(
            (b[0], [b[1], density[0], before[1], density[1], after[1], density[2],
                    float(b[3]), float(b[4]), float(b[5]), float(b[6]), float(b[7])])
        )
    return rows


_ENDS: dict[str, re.Pattern] = {}


def _after(page: str, at: int, tag: str) -> int:
    """Where the element ``tag`` that is open at ``at`` ends (nested ones counted)."""
    find = _ENDS.setdefault(tag, re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>?", re.I))
    depth = 1
    raw = tag in ("script", "style", "textarea")
    for m in find.finditer(page, at):
        depth += -1 if m[1] else (0 if raw else 1)
        if not depth:
            return m.end()
    # Never closed: raw text runs to the end of the page, others are ignored.
    return len(page) if raw else at


# Labelled page layouts: html, then one mark per block (1: main text). In them
# ^ stands for a few words, ~ for any number and % for a paragraph; each layout
# is filled FILLS times with seeded lengths, so that the tree learns which
# features matter and not the length of an example.
LAYOUTS = [
    ("<nav><ul><li><a href=a>^</a><li><a href=b>^</a></ul></nav><article><h1>^</h1><p>~<p>^<p>~</article><footer>~</footer>",
     "0011110"),
    ("<nav><a href=a>^</a> <a href=b>^</a></nav><div class=ad>~</div><article><h1>^</h1><p>~<p>~</article><footer>~</footer>",
     "001110"),
    ("<header><div>^</div><a href=x>^</a></header><main><h1>^</h1><p>%<p>~ <a href=x>^</a></main><aside><h2>^</h2><p>~</aside>",
     "0011100"),
    ("<div class=banner>~</div><article><p>^<p>~</article><div id=cookie-notice>~</div>", "0110"),
    ("<div class=menu><a href=a>^</a> <a href=b>^</a></div><div class=content><h2>^</h2><p>%</p><p>~</p><ul><li>~<li>^</ul></div>"
     "<div class=comments><p>~<p>^</div>", "01111100"),
    ("<div><a href=a>^</a> | <a href=b>^</a></div><h1>^</h1><div>%</div><div>%</div><div>%</div><div><a href=a>^</a>"
     " <a href=b>^</a></div>", "011110"),
    ("<article><h1>^</h1><p>~<div class=share><a href=x>^</a></div><p>~<div class=related><a href=x>~</a></div><p>~</article>"
     "<section class=comments><h3>^</h3><p>~</section>", "11010100"),
    ("<div class=sidebar><h3>^</h3><ul><li><a href=x>~</a><li><a href=y>^</a></ul></div><article><p>~<blockquote>~</blockquote>"
     "<p>~</article>", "000111"),
    ("<form><p>~<p>~</form><main><p>~</main><footer><p>~<p><a href=x>^</a></footer>", "00100"),
    ("<p><a href=a>^</a><p>%<p>%<p><a href=b>^</a> <a href=c>^</a>", "0110"),
    ("<article><h1><a href=x>^</a></h1><p>~<h2>^</h2><p>~ <a href=z>^</a> ~<ul><li>^<li>~</ul><p>~</article>", "1111111"),
    ("<div><a href=q>^</a></div><div>%</div><div>%</div><div>^</div>", "0110"),
    ("<article><p>~<form>~</form><p>~<div class=newsletter><p>~</div><p>^</article><nav>~</nav>", "101010"),
    ("<article><h1>^</h1><p>^<p>^<p>~<p>^</article><footer>~</footer><div class=notice>~</div>", "1111100"),
    ("<p>%", "1"),
    ("<h1>^</h1><p>%", "11"),
    ("<div>%</div><footer>~</footer>", "10"),
    ("<nav>~</nav><h2>^</h2><div>%</div>", "011"),
    ("<div class=ad>%</div><div>%</div><div>%</div><div class=promo>%</div><footer>%</footer>", "01100"),
    ("<nav>%</nav><div class=sidebar>%</div><div>%</div><p>%</p><div class=comments><p>%<p>%</div>", "001100"),
    ("<header>%</header><div class=cookie>%</div><div>%</div><form>%</form><div>%</div><div class=footer>%</div>", "001010"),
    ("<div class=ad>%</div><article><h1>^</h1><p>~<p>%</article><footer>%</footer>", "01110"),
    ("<nav><ul><li><a href=a>^</a><li><a href=b>^</a></ul></nav><div class=advert>~</div><div>%</div><div>%</div><aside>%</aside>",
     "000110"),
    ("<article><p>~<aside>~</aside><p>~<ul class=comments><li>~<li>~</ul></article><div class=popup>~</div>", "101000"),
    ("<div class='content-with-sidebar'><article class='post tag-advertising'><p>~<p>~</article><div class=sidebar>~</div></div>", "110"),
    ("<div class='layout-sidebar-right'><nav>~</nav><main><h1>^</h1><p>~</main></div><div class=comments>~</div>", "0110"),
]
FILLS = 12


def labelled_pages() -> list[tuple[str, str]]:
    """The labelled table: (html, marks) of every layout and fill."""
    rng = np.random.default_rng(11)
    spans = {"^": (1, 7), "~": (1, 90), "%": (12, 90)}
    return [
        (re.sub(r"[\^~%]", lambda m: " ".join(["word"] * int(rng.integers(*spans[m[0]]))), layout), marks)
        for layout, marks in LAYOUTS
        for _ in range(FILLS)
    ]


class DecisionTree:
    """A binary tree of thresholds, grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, leaf: int = 1):
        self.root = self._grow(x, y, depth, leaf)

    def _grow(self, x, y, depth, leaf):
        share = float(y.mean())
        if depth == 0 or share in (0.0, 1.0):
            return share
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] < cut
                n = int(left.sum())
                if min(n, len(y) - n) < leaf:
                    continue
                impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[left], y[~left]))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(cut))
        if best is None:
            return share
        _, f, cut = best
        left = x[:, f] < cut
        return f, cut, self._grow(x[left], y[left], depth - 1, leaf), self._grow(x[~left], y[~left], depth - 1, leaf)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of label 1 in each row's leaf."""
        out = np.zeros(len(x))

        def walk(node, rows):
            if isinstance(node, float):
                out[rows] = node
                return
            f, cut, low, high = node
            left = x[rows, f] < cut
            walk(low, rows[left])
            walk(high, rows[~left])

        walk(self.root, np.arange(len(x)))
        return out


def train(labelled: list[tuple[str, str]] | None = None) -> DecisionTree:
    """The tree of a labelled table (html, one 0/1 mark per block)."""
    x, y = [], []
    for page, marks in labelled if labelled is not None else labelled_pages():
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(marks)} marks for {len(found)} blocks: {page[:80]}")
        x += [features for _, features in found]
        y += [float(m) for m in marks]
    return DecisionTree(np.array(x), np.array(y))


def main_text(page: str | None, tree: DecisionTree) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = tree.predict(np.array([f for _, f in found])) >= 0.5
    return "\n".join(t for (t, _), k in zip(found, keep) if k)


def _extract(tree: DecisionTree):
    def run(batches):
        for batch in batches:
            for rows in T.pieces(batch, "html"):
                texts = [main_text(page, tree) for page in rows.column("html").to_pylist()]
                yield pa.record_batch(
                    [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run


def extract_pages(pages: DataFrame, labelled: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: page_id, url, text
    (kept blocks joined by a line end), n_chars.

    A null or empty page, and one without main text, gives an empty text.
    Whole pages are read; nothing is cut. Null ids and urls and repeated rows
    pass through; extra columns are ignored.
    """
    ready(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract(train(labelled)), "page_id long, url string, text string, n_chars long"
    )
