import numpy as np
import pytest

from noticeflow.llm import html_extract as H

from ..conftest import SF_SMALL

TREE = H.train()
P = "the quick brown fox jumps over the lazy dog and runs on through the quiet green wood until night falls over it"


def text(page):
    return H.main_text(page, TREE)


def test_article_alone_is_kept():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
    <body class="with-sidebar"><!-- <p>no</p> --><header><a href=/>Home</a></header><nav><ul><li><a href=a>One</a></li></ul></nav>
    <div class="ad-box">{P}</div><article><h1>Title  &amp;\n more</h1><p>Short.<p>{P} <a href=x>link</a> &eacute;&#33;</p>
    <div class="share-buttons"><a href=s>Share</a></div><p>One<br>two</p></article><aside><p>{P}</p></aside>
    <section id="comments"><p>{P}</p></section><div class="cookie-notice">{P}</div><form><p>{P}</p><button>Go</button></form>
    <footer>&copy; x</footer></body></html>"""
    assert text(page) == f"Title & more\nShort.\n{P} link é!\nOne two"


def test_pages_without_article():
    assert text(f"<div><a href=a>Home</a> <a href=b>News</a></div><div>{P}</div><div>{P}</div><footer>{P}</footer>") == f"{P}\n{P}"
    assert text(f"<p>{P}") == P
    assert text("<nav>a</nav>") == text("") == text(None) == text("<<<>>") == text("<p></p>") == ""


@pytest.mark.parametrize("page", ["<p>a <b>b", "<article><p>a <b>b</p></article>", "<main>a <b>b</b></main>"])
def test_broken_markup_does_not_crash(page):
    H.blocks(page)
    H.blocks(page + "<a href='x")
    H.blocks(page + "<!--")
    H.blocks(page + "<script>")
    H.blocks("</div></p>" * 50 + page)
    H.blocks("<div>" * 3000 + page)


def test_block_features():
    (first, f1), (second, f2) = H.blocks("<nav><a href=a>One two</a> three</nav><article><h2>Four</h2></article>")
    named = dict(zip(H.FEATURES, f1))
    assert (first, named["words"], named["boilerplate_tag"], named["next_words"]) == ("One two three", 3, 1, 1)
    assert named["link_density"] == pytest.approx(2 / 3)
    named = dict(zip(H.FEATURES, f2))
    assert (second, named["heading"], named["article"], named["previous_words"]) == ("Four", 1, 1, 3)


def test_tree_learns_its_table():
    pages = H.labelled_pages()
    wrong = total = 0
    for page, marks in pages:
        got = TREE.predict(np.array([f for _, f in H.blocks(page)])) >= 0.5
        wrong += int((got != (np.array(list(marks)) == "1")).sum())
        total += len(marks)
    assert wrong < 0.02 * total
    x = np.array([[0.0, 1], [1, 1], [0, 0], [1, 0]])
    assert H.DecisionTree(x, np.array([0.0, 1, 1, 0])).predict(x).tolist() == [0, 1, 1, 0]


def test_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in H.extract_pages(pages).collect()}
    for page in pages.collect():
        inner = page.html.split("<article>")[1].split("</article>")[0]
        r = got[page.page_id]
        assert r.url == page.url and r.n_chars == len(r.text)
        # Nothing of the article is lost and nothing else is taken.
        import html
        import re

        assert r.text.split() == html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2), (2, None, f"<article><p>{P}<p>{'w ' * 100_000}", 3)]
    odd = H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in odd) == [(0, 0), (1, 0), (1, 0), (2, len(P) + 200_000)]
    assert H.extract_pages(pages.limit(0)).collect() == []


@pytest.mark.parametrize("wrapper", [
    '<div class="content-with-sidebar">{}</div>', '<div class="layout-sidebar-right">{}</div>', '<div id="page-no-comments">{}</div>',
    '<div class="widget"><article>{}</article></div>', '<article class="post category-search tag-advertising">{}</article>',
    '<main class="search">{}</main>', '<section class="tag-newsletter">{}</section>',
])
def test_names_of_layouts_and_topics_drop_no_article(wrapper):
    body = f"<p>{P}</p><p>{P}</p>"
    assert text(f"<nav><a href=a>Home</a></nav>{wrapper.format(body)}<footer>{P}</footer>") == f"{P}\n{P}"
    # The parts inside are still told apart.
    inner = f'{body}<div class="sidebar">{P}</div><section id="comments"><p>{P}</p></section><div class="share-box">{P}</div>'
    assert text(f"<nav><a href=a>Home</a></nav>{wrapper.format(inner)}<footer>{P}</footer>") == f"{P}\n{P}"


def test_articles_that_are_comments_or_teasers_go():
    page = f"""<div class="search"><article><p>{P}</p></article></div><section id="comments"><article class="comment"><p>{P}</p></article>
    </section><div class="related"><article><p>{P}</p></article></div>"""
    assert text(page) == P
