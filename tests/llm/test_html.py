from __future__ import annotations

import html as H
import re
import time

import pytest

from quillstack.llm import html_extract as E
from quillstack.llm.common import load
from quillstack.llm.html_extract import extract, main_text

P = "<p>" + "This is a sentence of the article with enough words to count as content. " * 3 + "</p>"
TEXT = ("This is a sentence of the article with enough words to count as content. " * 3).strip()


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav><a href=x>Menu</a></nav><article>{P}</article><footer>foot</footer></body>",
        f"<div id=page><div class='site-header'>Site</div><ul class='menu'><li><a href=a>One</a><li><a href=b>Two</a></ul><div class=content>{P}</div><div class='sidebar'><p>side side side</p></div></div>",
        f"<main>{P}<section id='comments'><h2>Comments</h2><p>I disagree with all of this, as a reader of it for many years.</p></section></main>",
        f"<article>{P}<aside>An aside that is not part of it.</aside><form><label>Mail</label><input></form></article>",
        f"<div class='cookie-notice'><p>We use cookies to make this site better for you and for all others.</p></div><article>{P}<script>var a = '<p>no</p>';</script><style>p {{}}</style></article>",
        f"<body class='has-sidebar'><div class='layout has-sidebar'><article class='post'>{P}</article></div><div class='advert'>Buy</div></body>",
        f"<article>{P}<div hidden>hidden</div><div style='display: none'>gone</div><!-- comment --></article>",
        f"<header><h1>Site name</h1></header><article>{P}",
    ],
)
def test_boilerplate(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("  ", ""), ("plain text", "plain text"), ("<article><h1>A &amp; B</h1><p>x&nbsp;&lt;y&gt;\n\n z &#8364;&euro;</article>", "A & B\nx <y> z €€"),
        ("<article><p>one<br>two<p>three<b> four</b>five</article>", "one two\nthree fourfive"), ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"), ("<nav>only menu</nav>", ""),
        ("<article><header><h1>Title</h1></header><p>Body &am", "Title\nBody &am"),
    ],
)
def test_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><h1>Title</h1><p>Lead</p><div class=entry>{P}{P}</div></article>", f"Title\nLead\n{TEXT}\n{TEXT}"),
        (f"<main><div><h1>Title</h1><div><div>{P * 4}</div></div></div></main>", "\n".join(["Title"] + [TEXT] * 4)),
        (f"<article><section><h2>One</h2>{P * 8}</section><section><h2>Two</h2>{P}</section></article>", "\n".join(["One"] + [TEXT] * 8 + ["Two", TEXT])),
        (f"<div><div><section>{P * 8}</section><section>{P}</section></div></div>", "\n".join([TEXT] * 9)),
        (f"<div><article><h2>A</h2><div>{P * 8}</div></article><p>or</p><article><h2>B</h2>{P}</article></div>", "\n".join(["A"] + [TEXT] * 8 + ["B", TEXT])),
    ],
)
def test_nested(page, want):
    """Wrappers, sections and articles of less text keep their place."""
    assert main_text(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>foo <span hidden>x</span>bar baz</p>", "foo bar baz"),
        ("<p>foo <script>1</script>bar <b>ba</b>z</p>", "foo bar baz"),
        (f"<article>{P}<section id='discussion'>{P}</section></article>", f"{TEXT}\n{TEXT}"),
        (f"<article>{P}<section id='related-work'><h2>Related work</h2>{P}</section>{P}</article>", f"{TEXT}\nRelated work\n{TEXT}\n{TEXT}"),
        (f"<article>{P}<p class='social history'>{TEXT}</p></article>", f"{TEXT}\n{TEXT}"),
        (f"<div>{P}<p><a href=x>{TEXT}</a></p>{P}</div>", f"{TEXT}\n{TEXT}\n{TEXT}"),
        (f"<article>{P}<div class='related'><h3>More</h3><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>{P}</article>", f"{TEXT}\n{TEXT}"),
        (f"<article>{P * 3}<div class='notice'>Mind the gap.</div>{P}</article>", "\n".join([TEXT] * 4)),
        (f"<div>{P * 3}<div class='ad'>{TEXT[:120]}</div>{P}</div>", "\n".join([TEXT] * 4)),
        (f"<article>{P * 2}</article><article><a href=x>Teaser one</a></article><article><a href=y>Teaser two</a></article>", f"{TEXT}\n{TEXT}"),
        (f"<body><ul><li><a href=1>Home</a><li><a href=2>News</a></ul><span><div>{P * 2}<p>Short.</p>{P}</div></span><div><a href=3>Imprint</a></div></body>", f"{TEXT}\n{TEXT}\nShort.\n{TEXT}"),
    ],
)
def test_ratio_decides(page, want):
    """Lines of the content cluster choose the region, and whether a doubtful name is boilerplate."""
    assert main_text(page) == want


LONG = "I have read this paper for years, and the reporting on our town has never been as careful as it was in this piece, so thank you. " * 8


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article>{P}<div class='comment-list'><div class='comment'><p>{LONG}</p></div></div></article>", TEXT),
        (f"<article>{P}<div id='usercomments'><p>{LONG}</p></div></article>", TEXT),
        (f"<article>{P}<div id='userComments'><p>{LONG}</p></div></article>", TEXT),
        (f"<article>{P}<div><div class='comment'><p>{LONG}</p></div><div class='comment'><p>{LONG}</p></div></div></article>", TEXT),
        (f"<article>{P}<div class='comment'><span class='author'>Ann</span><p>{LONG}</p></div></article>", TEXT),
        (f"<main>{P}<ol class='commentlist'><li><article class='comment-body'><p>{LONG}</p></article></li></ol></main>", TEXT),
        (f"<article>{P}<div class='comment'><p>{LONG}</p></div></article>", f"{TEXT}\n{LONG.strip()}"),
        (f"<article>{P}<div class='commentary'><p>{LONG}</p></div></article>", f"{TEXT}\n{LONG.strip()}"),
        (f"<div class='post comments-open'><h1>Title</h1>{P}</div>", f"Title\n{TEXT}"),
        (f"<article><div class='post comment-section'><h1>Title</h1>{P}</div></article>", f"Title\n{TEXT}"),
        (f"<div class='c-banner'><p>We use cookies to make this site better for you and for all others.</p></div><article>{P}</article>", TEXT),
        (f"<article><div class='c-banner'><p>We use cookies to make this site better for you and for all others.</p></div>{P}</article>", TEXT),
        (f"<article><div class='cookiebar'><p>By going on you agree to all of the terms of this site and of its partners.</p></div>{P}</article>", TEXT),
        (f"<article>{P}<p class='related'>See ch. 4.</p><p class='search'>Short.</p>{P}</article>", f"{TEXT}\nSee ch. 4.\nShort.\n{TEXT}"),
        (f"<article>{P}<p>by <span class='share'>a</span> part</p><p class='menu'>Soup</p><p class='ad'>Buy!</p></article>", f"{TEXT}\nby a part\nSoup"),
    ],
)
def test_comments_and_notices(page, want):
    """Comments by their place, siblings or signature; notices by their words; paragraphs of an article by no class word."""
    assert main_text(page) == want


def test_threshold_within_article(monkeypatch):
    """Within an article the threshold decides on elements of a doubtful name."""
    page = f"<article>{P * 3}<div class='promo'><p>Win a car.</p><p>Call now.</p></div>{P}</article>"
    assert main_text(page) == "\n".join([TEXT] * 4)
    monkeypatch.setattr(E, "two_means", lambda values: -1.0)
    assert "Win a car." in main_text(page)


def plain(page):
    """What lies between the article tags of the fixture's one layout, cut at block tags."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    blocks = re.split(r"</?(?:p|h1|ul|li|div)\b[^>]*>", inner)
    return "\n".join(t for b in blocks if (t := " ".join(H.unescape(re.sub(r"<br>", " ", re.sub(r"<(?!br>)[^>]*>", "", b))).split())))


def test_whole_table(spark, monkeypatch):
    pages = load(spark, "/root/testdata/sf0.1", "pages")
    want = {r.page_id: (r.url, plain(r.html)) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text) for r in extract(pages).collect()}
    assert got == want
    # without the elements that mark articles, the ratios find them; without a threshold they don't
    pages = [(plain(r.html), r.html.replace("<article", "<div").replace("</article", "</div")) for r in pages.collect()]
    assert sum(main_text(x) == t for t, x in pages) >= 0.99 * len(pages)
    monkeypatch.setattr(E, "two_means", lambda values: 0.0)
    assert not any(main_text(x) == t for t, x in pages[:300])


@pytest.mark.parametrize(
    "page",
    ["<p>word " + "<span>a</i>" * 90_000, "<b>" + "<div><i>" * 50_000 + "x" + "</u></b>" * 50_000, "<div>a <p>" * 60_000, "<ul><li>" * 60_000 + "x", "<p>a</p>" * 100_000, "x" * 1_000_000, "<div class='ad'>b " * 50_000, "</p></i>" * 100_000],
)
def test_long(page):
    """Pages of up to a megabyte, nested or unclosed as they may be, end in seconds."""
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 20


def test_extract(spark):
    df = spark.createDataFrame([(1, None, None, "c"), (2, "u", "<article><p>a</article>", "c"), (2, "u", "<article><p>a</article>", "c")], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, extract(df).collect())) == [(1, None, "", 0), (2, "u", "a", 1), (2, "u", "a", 1)]
    assert extract(df.where("false")).count() == 0
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert main_text(long) == "\n".join(["word"] * 50_000)
