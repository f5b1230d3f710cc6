"""HTML extraction: what goes, what stays, odd markup, and the given pages against their articles."""

import html
import re

import pytest

from stratum.llm import html_text as H
from stratum.llm.common import table

LONG = "A paragraph of real text, long enough to count as such in every way."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("  \n ", ""), ("just text &amp; more", "just text & more"),
    (f"<body><header>Site</header><nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}</p><p>Hi.</p></article><footer>f</footer></body>", f"T\n\n{LONG}\n\nHi."),
    (f"<div class='cookie-notice'>{LONG}</div><div id=content><p>{LONG}</p><p>ok</p></div><div class=sidebar><p>{LONG}</p></div>", f"{LONG}\n\nok"),
    (f"<main><p>{LONG}</p><aside>{LONG}</aside><form><label>{LONG}</label></form><p>End.</p></main><section id=comments><article class=comment>{LONG}</article></section>", f"{LONG}\n\nEnd."),
    (f"<div class=ad>buy<article><p>a  <b>b</b>\n c<br>d<p>{LONG}</article>", f"a b c d\n\n{LONG}"),
    (f"<p>{LONG}</p><script>x = '<p>no</p>'", LONG),
    (f"<article><header><h1>Head</h1></header><p>x &lt; y &eacute;&#8212;&nbsp;z</p><p>{LONG}</p></article>", f"Head\n\nx < y é— z\n\n{LONG}"),
    (f"<article><p>{LONG}</p><div hidden>{LONG}</div><p style='display: none'>{LONG}</p></article>", LONG),
    ("<article><p>Hi.</p></article>", "Hi."),
])
def test_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("start", [
    "<html><head><title>T</title><body>", "<head><meta charset=utf-8><link href=x><style>a{}</style><body class=c>", "<head><title>T</title>",
    "<head><script>x = 1</script>\n<img src=x>", "<head><noscript><img src=x></noscript><body>", "<head><template><p>no</p><body>"])
def test_head_without_end_tag(start):
    assert H.main_text(f"<!doctype html>{start}<nav>Menu</nav><article><h1>T</h1><p>{LONG}</p></article>") == f"T\n\n{LONG}"


@pytest.mark.parametrize("name", ["notice-period", "share-price", "related-works", "widgetry", "menu-of-the-day", "commentary", "loginless", "search-results-explained"])
def test_words_beside_others_drop_no_text_of_an_article(name):
    for text in (LONG, "Three months."):
        assert H.main_text(f"<article><p>{LONG}</p><div class='x {name}'><p>{text}</p></div><p>{LONG}</p></article>") == f"{LONG}\n\n{text}\n\n{LONG}"


@pytest.mark.parametrize("name", ["notice", "cookie-notice", "ad", "ad-slot-3", "share-buttons", "related", "related-posts", "newsletter_signup", "sidebar-left",
                                  "promo box", "comment-17", "comments", "social-links", "sponsored"])
def test_boilerplate_classes_go_from_an_article(name):
    assert H.main_text(f"<article><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div><p>End.</p></article>") == f"{LONG}\n\nEnd."


def test_doubtful_link_lists_go():
    links = "<a href=x>Other</a> <a href=y>Another one</a>"
    assert H.main_text(f"<article>{f'<p>{LONG}</p>' * 8}</article>".replace("</article>", f"<div class='related-works'>{f'<p>{links}</p>' * 6}</div></article>")).count("Other") < 3


def test_text_ends_a_head():
    assert H.main_text(f"<head><title>T</title>\n{LONG}") == LONG
    assert H.main_text(f"<head><title>T</title>\n<style>a</style></head><p>{LONG}") == LONG


def test_ratios_decide_without_article_or_main(monkeypatch):
    """Title and paragraphs in divs of their own: what lies near long lines stays, what lies far from them goes."""
    body = f"<div><h1>Title</h1></div><div><p>{LONG}</p></div><div><p>Short.</p></div><div><p>{LONG}</p></div>"
    far = "<div><span>a</span><span>b</span></div>" * 8
    text = f"Title\n\n{LONG}\n\nShort.\n\n{LONG}"
    got = H.main_text(f"<body>{far}{body}{far}")
    assert got.startswith(text) and got[len(text):] in ("", "\n\nab")       # smoothing reaches the next line
    monkeypatch.setattr(H, "DEVIATIONS", 100)
    assert H.main_text(f"<body>{far}{body}{far}") == ""
    assert H.main_text(f"<body>{far}<article>{body}</article>{far}") == text    # an article decides by itself


def test_very_long_and_deep_pages():
    assert H.main_text("<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>").count("\n\n") == 19_999
    assert H.main_text("<div>" * 3000 + LONG) == LONG


def test_stray_end_tags_take_linear_time():
    import time
    start = time.time()
    assert H.main_text("<article>" + "<span>" * 60_000 + "</b>" * 60_000 + "<p></p>" * 2_000 + f"<p>{LONG}</p></article>") == LONG
    assert time.time() - start < 10


def test_given_pages_equal_their_articles(spark):
    df = table(spark, "/root/testdata/sf0.01", "pages")
    rows = H.extract(df.withColumn("text", df["url"])).select("html", "text").collect()
    for r in rows:
        body = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", x))).strip() for x in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(p for p in parts if p)


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "<p>x")], "page_id bigint, html string")
    assert sorted(r["text"] for r in H.extract(df).collect()) == ["", "", "x"]
    assert H.extract(df.limit(0)).count() == 0
