"""Main text of web pages: boosted trees over the nodes of the document tree.

A page is parsed into a tree of block elements (inline markup does not break a block). For every
node the trees give the log-odds that it holds main text, from the density of its subtree (characters by tag, share in links,
sentences), tokens of class, id and role of the node and of its ancestors, depth, and sibling statistics. The
decoding is hierarchical: a node is kept or dropped with all below it, so no kept
node has a dropped ancestor; among all such choices the one with the highest sum of log-odds
wins, by one pass over the tree. A kept node without kept text counts as dropped.

The trees are trained on ``PAGES`` generated pages with known main text (``training_pages``): seeded layouts
with menus, headers, footers, sidebars, notices, adverts, forms and reader comments, with and without telling names, with sloppy
markup. Scripts, styles and other parts that show no text are no nodes.

Null or empty html gives an empty text. Each row is judged by itself; repeated rows and other columns
change nothing. Broken, cut or very long pages are parsed as far as they go; markup that never ends is dropped.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.llm import boosting

PAGES = 1_200
SEED = 1

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(
    "script style noscript template iframe object svg math canvas audio video textarea select option datalist title".split())
#: What these hold is no markup and ends at the first end tag of the same name.
RAW = frozenset("script style textarea iframe title".split())
#: One of these may hold another of the same name.
NESTED = frozenset("object svg math template".split())
_EDGE = {t: re.compile(rf"<(/?){t}(?=[\s/>]|\Z)(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(/?)(?:>|\Z)", re.I) for t in HIDDEN}
_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in HIDDEN}
BLOCK = frozenset(
    "html body address article aside blockquote button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr label legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "body", "button", "label", "td", "th", "tr"}
CLOSED_BY_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table body html".split())

#: Words in class, id and role that speak for and against main text.
GOOD_TOKENS = frozenset("article body content entry main post story text page single blog news hentry prose".split())
BAD_TOKENS = frozenset(
    "ad ads adv advert advertisement aside banner bar breadcrumb breadcrumbs button comment comments consent contact cookie cookies copyright "
    "disqus footer foot form gdpr head header hero links login masthead menu meta nav navbar navigation newsletter notice pager "
    "pagination popup privacy promo promoted recommended related reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe tags teaser toolbar top widget".split())
TAG_KIND = {t: i for i, ts in enumerate((
    "html body", "div center", "p pre", "h1", "h2 h3 h4 h5 h6 hgroup", "article main", "section", "ul ol dl menu", "li dt dd",
    "blockquote figure figcaption", "nav", "header", "footer address", "aside", "form fieldset button label legend dialog",
    "table tbody thead tfoot tr", "td th", "details summary hr")) for t in ts.split()}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<|[^<]+", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Nodes in page order, and text blocks with the node that each belongs to."""

    kind: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)  # first node after the subtree
    good: list[int] = field(default_factory=list)
    bad: list[int] = field(default_factory=list)
    inner: list[int] = field(default_factory=list)  # inline tags
    linked: list[int] = field(default_factory=list)  # characters in links
    block_node: list[int] = field(default_factory=list)
    blocks: list[str] = field(default_factory=list)


_named: dict[str, tuple[int, int]] = {}


def _tokens(attributes: str) -> tuple[int, int]:
    if not attributes or "=" not in attributes:
        return 0, 0
    if attributes not in _named:
        if len(_named) > 20_000:
            _named.clear()
        words = {w.lower() for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[1] or m[2] or m[3] or "")}
        _named[attributes] = len(words & GOOD_TOKENS), len(words & BAD_TOKENS)
    return _named[attributes]


def _after_hidden(html: str, tag: str, at: int) -> int:
    """Where the page goes on after the hidden element whose start tag ends at ``at``; -1 if nothing ends it.

    Of nested ones too few of which are closed, the last end tag counts.
    """
    if tag in RAW:
        end = _END[tag].search(html, at)
        return end.end() if end else -1
    depth, last = 1, -1
    for m in _EDGE[tag].finditer(html, at):
        if m[1]:
            depth, last = depth - 1, m.end()
            if not depth:
                break
        elif tag not in NESTED:
            return -1
        elif not m[2]:
            depth += 1
    return last


def parse(html: str) -> Page:
    """The tree of a page; unclosed and misplaced tags are mended as browsers do in the common cases.

    A head holds no text outside hidden elements, so its own tags, which a page may leave out, are passed over. A hidden element
    that is never closed hides nothing, but for scripts and the like, whose content is no markup: they hide the rest of the page.
    """
    page = Page()
    open_: list[tuple[str, int]] = []
    runs: list[str] = []
    links = 0
    never: set[str] = set()  # hidden elements of which no more end tags come

    def push(tag: str, attributes: str) -> None:
        node = len(page.kind)
        page.kind.append(TAG_KIND.get(tag, 1))
        page.parent.append(open_[-1][1] if open_ else -1)
        page.depth.append(len(open_))
        page.end.append(0)
        good, bad = _tokens(attributes)
        page.good.append(good)
        page.bad.append(bad)
        page.inner.append(0)
        page.linked.append(0)
        open_.append((tag, node))

    def pop() -> None:
        page.end[open_.pop()[1]] = len(page.kind)

    def flush() -> None:
        if runs:
            text = " ".join("".join(runs).split())
            runs.clear()
            if text:
                page.block_node.append(open_[-1][1])
                page.blocks.append(text)

    push("html", "")
    tokens = _TOKEN.finditer(html)
    while m := next(tokens, None):
        s = m[0]
        if s[0] != "<" or s == "<":
            text = entities.unescape(s) if "&" in s else s
            runs.append(text)
            if links:
                page.linked[open_[-1][1]] += len(text.strip())
            continue
        if s[1] in "!?":
            continue
        tag = (m[2] or m[5] or "").lower()
        closing = s[1] == "/"
        if tag == "head":
            continue
        if tag in HIDDEN:
            if closing or tag in never or s.endswith("/>") and tag in ("svg", "math"):
                continue
            end = _after_hidden(html, tag, m.end())
            if end < 0 and tag in RAW and tag != "title":
                break
            if end < 0 and tag == "title":
                # The text up to the next tag is the title.
                end = html.find("<", m.end())
                if end < 0:
                    break
            if end < 0:
                if not _END[tag].search(html, m.end()):
                    never.add(tag)
            else:
                tokens = _TOKEN.finditer(html, end)
            continue
        if tag not in BLOCK:
            if tag == "br":
                runs.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
            page.inner[open_[-1][1]] += 0 if closing else 1
            continue
        if closing:
            if tag in ("body", "html"):
                continue
            for at in range(len(open_) - 1, 0, -1):
                if open_[at][0] == tag:
                    flush()
                    while len(open_) > at:
                        pop()
                    links = 0
                    break
                if tag == "p" and open_[at][0] in SCOPES:
                    break
            continue
        flush()
        if tag in ("html", "body"):
            good, bad = _tokens(m[3] or m[6] or "")
            continue
        if tag in CLOSES_P and any(t == "p" for t, _ in open_[-2:]):
            while open_[-1][0] != "p":
                pop()
            pop()
            links = 0
        same = CLOSED_BY_SAME.get(tag)
        if same:
            for at in range(len(open_) - 1, 0, -1):
                if open_[at][0] in same:
                    while len(open_) > at:
                        pop()
                    break
                if open_[at][0] in SCOPES:
                    break
        if tag == "hr":
            continue
        push(tag, m[3] or m[6] or "")
    flush()
    while open_:
        pop()
    return page


FEATURES = 34


def features(pages: list[Page]) -> np.ndarray:
    """One row a node of all pages, in order."""
    sizes = np.array([len(p.kind) for p in pages])
    n = int(sizes.sum())
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    root = np.unique(base) if n else base

    def column(name: str) -> np.ndarray:
        return np.array([v for p in pages for v in getattr(p, name)], np.float64)

    kind, depth, good, bad = column("kind").astype(int), column("depth"), column("good"), column("bad")
    at = np.arange(n)
    parent = np.where(column("parent") < 0, at - base, column("parent")).astype(int) + base
    end = column("end").astype(int) + base
    starts = np.cumsum(sizes) - sizes
    own = np.zeros((n, 5))  # characters, words, stops, blocks, long blocks
    nodes = np.array([v + b for p, b in zip(pages, starts) for v in p.block_node], np.int64)
    texts = [t for p in pages for t in p.blocks]
    if texts:
        chars = np.array([len(t) for t in texts], float)
        np.add.at(own, nodes, np.stack([
            chars, [t.count(" ") + 1 for t in texts],
            [t.count(".") + t.count(",") + t.count("?") + t.count("!") for t in texts],
            np.ones(len(texts)), chars > 80], axis=1))
    tags = np.stack([column("inner"), column("linked"), np.ones(n), kind == 2, kind == 8], axis=1)
    sums = np.zeros((n + 1, 10))
    np.cumsum(np.concatenate([own, tags], axis=1), axis=0, out=sums[1:])
    sub = sums[end] - sums[at]
    chars, words, stops, blocks, longs, inner, linked, count, paragraphs, items = sub.T

    # What ancestors say, from the top down.
    over_good, over_bad, over_main, over_aside = (np.zeros(n) for _ in range(4))
    is_main, is_aside = kind == 5, np.isin(kind, [10, 11, 12, 13, 14])
    for level in range(1, int(depth.max()) + 1 if n else 0):
        here = np.flatnonzero(depth == level)
        up = parent[here]
        over_good[here] = over_good[up] + good[up]
        over_bad[here] = over_bad[up] + bad[up]
        over_main[here] = over_main[up] + is_main[up]
        over_aside[here] = over_aside[up] + is_aside[up]

    # Siblings: those of one parent, in page order.
    order = np.lexsort((at, parent))
    order = order[~np.isin(order, root)]
    siblings, place = np.ones(n), np.zeros(n)
    before, after = np.zeros(n), np.zeros(n)
    alike = np.zeros(n)
    if len(order):
        up = parent[order]
        new = np.append(True, up[1:] != up[:-1])
        group = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        counts = np.diff(np.append(firsts, len(order)))
        siblings[order] = counts[group]
        place[order] = np.arange(len(order)) - firsts[group]
        before[order[1:]] = np.where(new[1:], 0, chars[order[:-1]])
        after[order[:-1]] = np.where(new[1:], 0, chars[order[1:]])
        key = up * 32 + kind[order]
        _, inv, kinds = np.unique(key, return_inverse=True, return_counts=True)
        alike[order] = kinds[inv] / counts[group]
    page_chars = chars[base] if n else chars
    one = np.maximum(chars, 1)
    return np.stack([
        kind, depth, good, bad, over_good, over_bad, over_main, over_aside, np.log1p(chars), np.log1p(own[:, 0]),
        np.log1p(words), stops / np.maximum(words, 1), blocks, longs, longs / np.maximum(blocks, 1),
        linked / one, inner / one, chars / count, chars / np.maximum(blocks, 1), paragraphs, items, items / count,
        chars / np.maximum(page_chars, 1), chars / np.maximum(chars[parent], 1), siblings, place / np.maximum(siblings - 1, 1),
        alike, np.log1p(before), np.log1p(after), np.log1p(chars[parent]), at - base, (at - base) / np.maximum(np.repeat(sizes, sizes), 1),
        words / np.maximum(blocks, 1), over_main + is_main - over_aside - is_aside,
    ], axis=1)


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """Kept or dropped by node: the best choice in which nothing is kept below a dropped node."""
    n = len(page.kind)
    keep, drop = list(odds), list(-odds)
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and keep[i] > drop[i]
    return kept


def texts_of(htmls: list[str | None], trees: boosting.Trees) -> list[str]:
    """The main text of each page."""
    pages = [parse(h or "") for h in htmls]
    if not pages:
        return []
    odds = trees.log_odds(features(pages))
    out, at = [], 0
    for page in pages:
        n = len(page.kind)
        kept = decode(page, odds[at:at + n])
        out.append("\n\n".join(t for v, t in zip(page.block_node, page.blocks) if kept[v]))
        at += n
    return out


# -- training ---------------------------------------------------------------

_SYLLABLES = "a be ci do en fa ge hi in ka le mo na or pe ra si to un ve the ing er an tion ou é ü ñ sch".split()


def _generated(rng: random.Random) -> tuple[str, set[str]]:
    """A page and the texts of its main blocks. Every word is new, so blocks can be told apart."""

    def word():
        return "".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4)))

    def words(a, b):
        return " ".join(word() for _ in range(rng.randint(a, b)))

    noisy = rng.random() < 0.15

    def sentence(a=3, b=25):
        w = [word() + (rng.choice(["", "", "###", "%%%", "&amp;&amp;", "$$$", " |"]) if noisy else "") for _ in range(rng.randint(a, b))]
        return (" ".join(w)).capitalize() + rng.choice([".", ".", ".", "?", "!", ""])

    def paragraph():
        return " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 3, 5, 9])))

    named = rng.random() < 0.7  # layouts with telling names
    semantic = rng.random() < 0.7

    def box(tag, names, inside, plain="div"):
        tag = tag if semantic else plain
        attribute = f' {rng.choice(["class", "id"])}="{rng.choice(names)}"' if named and names else (
            f' class="c{rng.randint(0, 99)}"' if rng.random() < 0.5 else "")
        return f"<{tag}{attribute}>{inside}</{tag}>"

    def links(a, b, most=3):
        return "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, most)}</a></li>' for _ in range(rng.randint(a, b))) + "</ul>"

    main: list[str] = []

    def own(text):
        main.append(" ".join(entities.unescape(re.sub("<[^>]*>", " " if "<br" in text else "", text)).split()))
        return text

    def block():
        r = rng.random()
        if r < 0.75:
            text = paragraph()
            if rng.random() < 0.15:
                text = f'<a href="/x">{words(1, 4)}</a> ' + text
            if rng.random() < 0.1:
                text = f"<b>{words(1, 8)}</b> " + text
            if rng.random() < 0.08:
                return "<p><b>" + own(sentence()) + "<br>"
            return "<p>" + own(text) + rng.choice(["</p>", "</p>", "</p>", ""])
        if r < 0.83:
            return f"<h2>{own(words(1, 7))}</h2>"
        if r < 0.9:
            return "<ul>" + "".join(f"<li>{own(sentence(2, 15))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if r < 0.95:
            return f"<blockquote>{own(paragraph())}</blockquote>"
        return f"<div>{own(paragraph())}</div>"

    def advert():
        return box(rng.choice(["div", "aside"]), ["ad", "ads", "advert", "ad-slot", "sponsored", "promo"], rng.choice([
            sentence(), f"<p>{sentence()}</p>", f'<a href="//{word()}">{words(2, 8)}</a>', f"<p>{sentence()}</p><a href='/b'>{words(1, 3)}</a>"]))

    article = [f"<h1>{own(words(2, 10))}</h1>"] if rng.random() < 0.85 else []
    if rng.random() < 0.25:
        article.append(box("div", ["meta", "share", "social"], links(2, 4, 1)))
    article += [block() for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 20]))]
    if rng.random() < 0.15:  # hardly any text
        main.clear()
        short = own(sentence(1, 6))
        article = [f"<h1>{short}</h1>", f"<p><b>{short}<br>"][rng.choice([0, 0, 1]):]
    if rng.random() < 0.25:
        article.insert(rng.randint(min(1, len(article)), len(article)), "</p>" + advert())
    if rng.random() < 0.15:
        article.append(box("div", ["related", "tags", "share"], f"<h3>{words(1, 2)}</h3>" + links(2, 6, 8)))
    content = box(rng.choice(["article", "article", "main", "section"]),
                  ["content", "article-body", "post", "entry-content", "main", "story"], "".join(article))
    if rng.random() < 0.3:
        content = box("main", ["page", "wrapper", "main"], content)
    parts = []
    if rng.random() < 0.3:
        parts.append(box("div", ["cookie", "notice", "consent-banner", "gdpr", "popup"], f"<p>{sentence(8, 25)}</p><button>{words(1, 2)}</button>"))
    if rng.random() < 0.5:
        parts.append(box("header", ["header", "masthead", "site-head"], rng.choice([f"<h1>{words(1, 3)}</h1>", f"<p>{words(2, 6)}</p>", words(1, 4)])))
    if rng.random() < 0.8:
        parts.append(box("nav", ["nav", "menu", "navbar", "breadcrumbs"], rng.choice([links(3, 10), " ".join(f'<a href="/{word()}">{word()}</a>' for _ in range(rng.randint(3, 9)))])))
    if rng.random() < 0.4:
        parts.append("<!-- ad 1 -->" + advert())
    if rng.random() < 0.2:
        parts.append("<form" + (' class="search"' if named else "") + f"><label>{words(1, 3)}</label><input name=q><button>{word()}</button></form>")
    side = box("aside", ["sidebar", "widget", "related", "recommended"], f"<h3>{words(1, 3)}</h3>" + rng.choice([
        links(3, 10, 9), f"<p>{sentence()}</p>", "".join(f"<p><a href='/{word()}'>{words(3, 9)}</a></p>" for _ in range(rng.randint(2, 6)))]))
    middle = [content]
    if rng.random() < 0.4:
        middle.insert(rng.randint(0, 1), side)
    if rng.random() < 0.4:
        one = lambda: rng.choice([
            f"<div class='comment'><b>{word()}</b><p>{paragraph()}</p></div>", f"<li><p>{sentence()}</p><a href='#'>{word()}</a></li>",
            f"<div><span>{word()}</span><p>{paragraph()}</p></div>"])
        said = "".join(one() for _ in range(rng.randint(1, 6)))
        middle.append(box("section", ["comments", "comment-list", "disqus", "responses replies"], f"<h3>{words(1, 2)}</h3>" + said))
    if rng.random() < 0.2:
        middle.append(box("form", ["subscribe", "newsletter", "signup", "comment-form"], f"<p>{sentence()}</p><input name=m><button>{word()}</button>", "form"))
    inside = "".join(middle)
    parts.append(f'<div class="wrap">{inside}</div>' if rng.random() < 0.3 else inside)
    if rng.random() < 0.15:
        parts.append(advert())
    if rng.random() < 0.85:
        parts.append(box("footer", ["footer", "site-footer", "copyright", "foot"], rng.choice([
            f"&copy; {word()} &middot; {sentence()}", links(2, 8), f"<p>&copy; {words(2, 8)}</p>", f"<p>{sentence()}</p>" + links(2, 5)])))
    head = f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title><script>var t=\"</p>\";</script><style>p{{}}</style></head><body>"
    page = head + "".join(parts) + rng.choice(["</body></html>", "</body></html>", ""])
    return page, set(main)


def training_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[str, set[str]]]:
    rng = random.Random(seed)
    return [_generated(rng) for _ in range(n)]


def train(n: int = PAGES, seed: int = SEED) -> boosting.Trees:
    """Trees for nodes: 1 where a node's subtree holds main text."""
    made = training_pages(n, seed)
    pages = [parse(h) for h, _ in made]
    labels, weights = [], []
    for page, (_, main) in zip(pages, made):
        own = np.zeros(len(page.kind))
        for v, t in zip(page.block_node, page.blocks):
            own[v] += t in main
        total = np.append(0, np.cumsum(own))
        labels.append(total[np.array(page.end)] - total[:-1] > 0)
        # Nodes without text say nothing.
        own = np.zeros(len(page.kind))
        np.add.at(own, np.array(page.block_node, int), 1)
        total = np.append(0, np.cumsum(own))
        weights.append(np.where(total[np.array(page.end)] - total[:-1] > 0, 1.0, 0.05))
    return boosting.fit(features(pages), np.concatenate(labels).astype(float), np.concatenate(weights))


def extract(pages: DataFrame, trees: boosting.Trees | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = trees or train()

    def run(batches):
        for batch in batches:
            htmls = batch.column("html").to_pylist()
            texts = [t for i in range(0, len(htmls), 64) for t in texts_of(htmls[i:i + 64], model)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select("page_id", "url", F.col("html").cast("string"))
    types = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string").withColumn(
        "n_chars", F.length("text").cast("long"))
