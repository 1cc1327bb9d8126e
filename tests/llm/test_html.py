"""Extraction on pages that the trees have not seen, parsing and decoding."""

import time

import numpy as np
import pytest

from modelferry.llm import html_extract as H
from modelferry.llm.common import prepare


@pytest.fixture(scope="module")
def trees():
    return H.train()


def test_held_out_pages(trees):
    pages = H.training_pages(250, 4321)
    hit = more = less = 0
    for text, (_, main) in zip(H.texts_of([h for h, _ in pages], trees), pages):
        got = set(text.split("\n\n")) - {""}
        hit, more, less = hit + len(got & main), more + len(got - main), less + len(main - got)
    assert hit / (hit + more) > 0.97 and hit / (hit + less) > 0.97


def test_blocks_and_references(trees):
    page = ("<html><head><title>no</title></head><body><nav><ul><li><a href=/a>Menu</a></li></ul></nav><article><h1>A &amp; B</h1>"
            "<p>One  <b>two</b>\n three&nbsp;four<br>five.<p>Six <a href='x>y'>seven</a>, a &lt; b.<script>var x='</p>';</script>"
            "<ul><li>first item here.<li>second item here.</ul></article><footer>&copy; me</footer>")
    assert H.texts_of([page], trees) == [
        "A & B\n\nOne two three four five.\n\nSix seven, a < b.\n\nfirst item here.\n\nsecond item here."]


@pytest.mark.parametrize("script", [
    "<script>for(i=0;i<n;i++){f(i)}</script>", "<script><!-- f()\n</script>", "<SCRIPT>a<b&&'</scripts>'</Script >", "<style>a<b{}</style>",
    "<style><!-- p{}</style>", "<textarea>a<b</textarea>", "<svg><style/><path d='m'/></svg>"])
def test_scripts_end_at_their_own_end_tag(script):
    assert H.parse(f"<body>{script}<p>Article</p></body>").blocks == ["Article"]
    assert H.parse(f"<head>{script}</head><body><p>Article</p></body>").blocks == ["Article"]


ARTICLE = "<article><h1>A title here</h1><p>Some text in here, with a comma. And more.</p><p>Another paragraph, long enough to count.</p></article>"


@pytest.mark.parametrize("start", [
    "<head><meta charset=x><title>x</title>", "<html><head><title>x</title><link>", "<title>x</title>", "<body><noscript>", "<head><title>x",
    "<body><svg><svg><text>in</text></svg><text>LABEL</text></svg>", "<svg><svg></svg>", "<video src=a>", "<body><object><object></object></object>",
    "<head><noscript><style>a{}</style></noscript></head>", "<svg><title>LABEL</title></svg>", "<title>a <p> b</title>", "<svg a='>'/>"])
def test_open_heads_and_hidden_elements_keep_the_article(trees, start):
    assert H.texts_of([start + ARTICLE], trees) == [
        "A title here\n\nSome text in here, with a comma. And more.\n\nAnother paragraph, long enough to count."]


@pytest.mark.parametrize("part", ["<svg>", "<noscript>", "<svg></svg>", "<option>a", "<title>", "<svg", "</svg>"])
def test_many_hidden_elements_take_linear_time(part):
    started = time.monotonic()
    H.parse("<body>" + part * 20_000 + ARTICLE)
    assert time.monotonic() - started < 10


@pytest.mark.parametrize("page", [
    None, "", "   ", "plain text only", "<", "<<>>", "<p", "<!-- open", "<script>never", "</div></p></body>", "<div " + "a" * 5000,
    "<div>" * 3000 + "deep", "<p>" * 2000 + "x", "<a href=\"" * 50, "&#xZZ; &bogus; &#1114112;", "<table><tr><td>a<td>b<tr><td>c</table>", "\x00<p>\x00</p>",
])
def test_odd_pages_do_not_fail(trees, page):
    assert isinstance(H.texts_of([page, page], trees)[1], str)


def test_a_tree_is_whole():
    for html, _ in H.training_pages(50, 77):
        p = H.parse(html)
        for i, up in enumerate(p.parent):
            assert up < i and p.end[i] > i and (i == 0 or p.end[i] <= p.end[up])


def test_decoding_is_best_and_consistent():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(2, 9))
        page = H.Page(kind=[1] * n, parent=[-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        odds = rng.normal(size=n)

        def value(kept):
            return sum(o if k else -o for o, k in zip(odds, kept))

        kept = H.decode(page, odds)
        choices = [[True] + [bool(m >> i & 1) for i in range(n - 1)] for m in range(1 << (n - 1))]
        allowed = [c for c in choices if all(not c[i] or c[page.parent[i]] for i in range(1, n))]
        assert kept in allowed and value(kept) == pytest.approx(max(map(value, allowed)))


def test_rows_and_types(spark, trees):
    prepare(spark)
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>Some text in here, with a comma.</p></article>", 7), (1, "u", None, 8), (None, None, "", 9)],
        "page_id long, url string, html string, text int")
    rows = H.extract(pages, trees).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 0), (1, 0), (1, 32)]
    assert H.extract(pages.where("false"), trees).count() == 0
