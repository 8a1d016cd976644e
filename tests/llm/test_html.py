"""Main texts of pages."""

from __future__ import annotations

import html
import re

import pytest

from adperf.llm import html_text

ARTICLE = "<article><h1>Head line</h1><p>First words, and more of them here.</p><p>Be.</p></article>"
TEXT = "Head line\nFirst words, and more of them here.\nBe."


def test_pages_equal_their_articles(spark, tables):
    pages = tables("pages")
    frame = spark.createDataFrame([(p["page_id"], p["url"], p["html"]) for p in pages], "page_id long, url string, html string")
    found = {r.page_id: r for r in html_text.extract(frame).collect()}
    for p in pages:
        inner = p["html"].split("<article>")[1].split("</article>")[0].split("<footer")[0]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(b for b in blocks if b)
        assert found[p["page_id"]].text == want and found[p["page_id"]].n_chars == len(want)


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav>{}",
    "<header><p>The site of all the news, every day.</p></header>{}<footer>&copy; all rights, and much more text here</footer>",
    "<div class='cookie-notice'><p>We use cookies, and we tell you so at length, as we must.</p></div>{}",
    "{}<aside><p>Another story, which is long, and about other things entirely.</p></aside>",
    "{}<section id=comments><p>I do not agree, says a reader, at some length, with commas.</p></section>",
    "<form><p>Your name, please</p><input value=x><button>Send</button></form>{}",
    "<script>if (a < b) document.write('<p>not text</p>')</script>{}<style>p { color: red }</style>",
    "<!-- <p>not text</p> -->{}<div class=\"ad\">Buy this now, it is cheap, and good for you.</div>",
    "<div hidden><p>Hidden words, which nobody sees, stay away.</p></div>{}",
    "<div role=navigation>Home, News, Sport, Weather, Money</div>{}",
])
def test_everything_around_the_article_goes(around):
    assert html_text.main_text(f"<html><head><title>T</title></head><body>{around.replace("{}", ARTICLE)}</body></html>") == TEXT


def test_article_without_an_article_element():
    page = ("<body><div class=menu><a href=1>one</a> <a href=2>two</a></div><div class=content><h2>Head</h2>"
            "<p>Words, words, and words.</p><p>More words, of the same kind, follow here.</p><ul><li>An item<li>Another</ul></div>"
            "<div class=links><a href=3>third thing to read</a></div></body>")
    assert html_text.main_text(page) == (
        "Head\nWords, words, and words.\nMore words, of the same kind, follow here.\nAn item\nAnother")


COMMENT = "<p>I do not agree, says a reader, at some length, with commas.</p>"


@pytest.mark.parametrize("around", [
    f"{{}}<section id=\"comments\"><h2>2 comments</h2><article class=\"comment-body\">{COMMENT}</article><article class=\"comment-body\">{COMMENT * 3}</article></section>",
    f"{{}}<div class=\"related\"><article class=\"card\"><h3>Another story</h3>{COMMENT}</article></div>",
    f"{{}}<article class=\"comment\">{COMMENT}</article>",
    f"<div class=wrap>{{}}<div class=\"sidebar\"><main><article>{COMMENT * 9}</article></main></div></div>",
])
def test_articles_that_are_comments_or_cards_go(around):
    assert html_text.main_text(f"<body>{around.replace('{}', ARTICLE)}</body>") == TEXT


def test_comments_inside_the_article_element_go():
    page = f"<body><article class=post><p>{TEXT.splitlines()[1]}</p><div id=comments><article class=comment>{COMMENT}</article></div></article></body>"
    assert html_text.main_text(page) == TEXT.splitlines()[1]


LONG = "Words, and more words, of the same long kind, follow here. " * 8


def test_all_sibling_parts_of_an_article_stay():
    page = (f"<body><div class=links><a href=3>third thing to read</a></div><div class=text><h2>Head</h2><div class=s1><p>{LONG}</p></div>"
            "<h2>Next</h2><div class=s2><p>Short, and last, but content.</p><p><a href=1>See this source</a></p></div></div></body>")
    assert html_text.main_text(page) == f"Head\n{LONG.strip()}\nNext\nShort, and last, but content.\nSee this source"


def test_all_articles_of_a_page_stay():
    page = f"<body><article><p>{LONG}</p><ul><li><a href=1>A source</a></ul></article><article><p>Short, and last.</p></article></body>"
    assert html_text.main_text(page) == f"{LONG.strip()}\nA source\nShort, and last."


@pytest.mark.parametrize("page", [
    "<div class='content has-sidebar'>{}</div>",
    "<div class='post no-comments'>{}</div>",
    "<div id=main-widget>{}</div>",
    "<div class='elementor-widget elementor-widget-text'>{}</div>",
    "<article class='post sidebar'>{}</article>",
    "<div class=sidebar><article>{}</article></div>",
    "<main class=widget><div class=sidebar><p>Other words, of no use.</p></div>{}</main>",
    "<div class=page>{}<div class=sidebar><p>Other words, of no use.</p></div></div>",
    "<article>{}<div class=comments><p>I do not agree, says a reader, at some length.</p></div></article>",
])
def test_class_words_of_the_layout_do_not_empty_a_page(page):
    text = f"<div class=article-header><h1>Head line</h1></div><p>{LONG}</p><p>Last words.</p>"
    assert html_text.main_text(f"<body>{page.replace('{}', text)}</body>") == f"Head line\n{LONG.strip()}\nLast words."


def test_references_white_space_inline_marks_and_broken_markup():
    page = "<article><p>A&amp;B &lt;x&gt; &#233;&nbsp;\n\t c<b>d</b><i> e</i><br>f<p>unclosed <b>bold<p>last &amp;amp; one"
    assert html_text.main_text(page) == "A&B <x> é cd e f\nunclosed bold\nlast &amp; one"
    assert html_text.main_text("<article><p title='a > b'>x < y, z</p></article>") == "x < y, z"


@pytest.mark.parametrize("page", [None, "", "<p></p>", "<!-- x", "<script>a", "<nav><a href=x>y</a></nav>", "<", "</", "<a <b"])
def test_pages_without_text_are_empty(page):
    assert html_text.main_text(page) in ("", "<", "</")


def test_long_and_deep_pages():
    deep = "<div>" * 3000 + "words, words" + "</div>" * 3000
    assert html_text.main_text(deep) == "words, words"
    deeper = "<div class=a>" * 20_000 + "<p>words, words</p>" + "</div>" * 20_000
    assert html_text.main_text(deeper) == "words, words"
    many = "<article>" + "".join(f"<p>word{i}, and on.</p>" for i in range(20_000)) + "</article>"
    assert html_text.main_text(many).count("\n") == 19_999


def test_rows_repeat_and_extra_columns_do_not_matter(spark):
    frame = spark.createDataFrame(
        [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "y"), (None, None, None, None)], "page_id long, url string, html string, text string")
    rows = sorted(html_text.extract(frame).collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)]
    assert html_text.extract(frame.limit(0)).collect() == []
