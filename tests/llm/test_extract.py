import html
import math
import re

import pytest

from swipelens.llm import extract

SCHEMA = "page_id BIGINT, url STRING, html STRING, text STRING, n_chars STRING"
WEIGHTS = extract.Weights(0.7, {"p": -0.02, "b": -0.02, "br": -0.02, "h1": -0.02, "div": -3.0, "li": -3.0, "ul": -3.0}, -1.0)


def article(page):
    """The article of a generated page, with its markup taken off."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inner)).split())


def test_articles_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    rows = extract.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


@pytest.mark.parametrize("page,want", [
    ("", ""),
    (" \n ", ""),
    ("just  text\n&amp; more", "just text & more"),
    ("<p>one<p>two<br>three</p>", "one two three"),
    ("<p>in<b>side</b> a &lt;word&gt;</p>", "inside a <word>"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<nav><a>menu</a></nav><p>the text of it</p><footer>foot</footer>", "the text of it"),
    ("<header>top</header><article><header><h1>Title of it</h1></header><p>body goes on</p><aside>x</aside></article>", "Title of it body goes on"),
    ("<p>text one two</p><script>var a = '<p>no</p>';</script><style>p{}</style><p>more words</p>", "text one two more words"),
    ("<p>text one</p><!-- <p>hidden</p> --><p>two</p><!-- open", "text one two"),
    ("<article><p>good words here</p></article><section id='comments'><p>first!</p><p>nice one</p></section>", "good words here"),
    ("<div class=\"cookieNotice\">we use cookies</div><p>good words here</p>", "good words here"),
    ("<div title=\"a > b\">good words here", "good words here"),
    ("<p title=\"open>good words here</p>", "good words here"),
    ("<body class='has-sidebar'><p>good words here</p></body>", "good words here"),
    ("<head><title>t</title><body><p>good words here", "good words here"),
    ("<p>cut short &am", "cut short &am"),
    ("<script>never closed <p>x", ""),
    ("<form><p>name</p></form><p>a&nbsp;b\x0bc</p>", "a b c"),
    ("</p></div><p>stray ends here and there and everywhere</section> are ignored here too</p>", "stray ends here and there and everywhere are ignored here too"),
    ("<ul><li>x</li><li>y</li></ul><p>" + "word " * 50 + "</p><div>z</div>", ("word " * 50).strip()),
    ("<p>" + "w " * 200_000, ("w " * 200_000).strip()),
    ("<a \"" * 20_001 + "<p>x", "x"),
])
def test_cases(page, want):
    assert extract.main_text(page, WEIGHTS) == want


def test_best_region_equals_brute_force():
    import random

    draw = random.Random(2)
    for _ in range(300):
        scores = [draw.choice([-3, -1, -0.5, 0.5, 1, 2]) for _ in range(draw.randrange(0, 12))]
        low, high = extract.best_region(scores)
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1)]
        assert sum(scores[low:high]) == pytest.approx(max([0, *sums]))


def test_nulls_clashes_repeats_and_empty_tables(spark):
    rows = [(1, "u", None, "old", "x"), (2, "u", "<p>a b</p>", "old", "x"), (2, "u", "<p>a b</p>", "old", "x"), (None, None, "", "o", "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = extract.extract(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("", 0), ("a b", 3), ("a b", 3)]
    assert extract.extract(frame.limit(0)).count() == 0
    assert extract.fit(frame) == extract.Weights()


def test_weights_come_from_labelled_pages(spark):
    page = "<nav><ul><li>m</li><li>n</li></ul></nav><article><p>one two three</p><p>four five</p></article>"
    frame = spark.createDataFrame([(i, "u", page, "", "") for i in range(5)], SCHEMA)
    found = extract.fit(frame)
    assert found.word > 0 > found.tags["p"] > found.tags["li"]
    assert extract.count_kinds("<article>a</article><article>b</article>") is None


WORDS = "one two three four five six"


@pytest.mark.parametrize("page,want", [
    # Names of chapters.
    (f"<article><p>{WORDS}</p><section id='discussion'><h2 id='related-work'>Related</h2><p>{WORDS}</p></section></article>", f"{WORDS} Related {WORDS}"),
    (f"<main><div class='notice'>{WORDS}</div><p class='disclaimer'>{WORDS}</p><div id='ad-hoc-networks'>{WORDS}</div></main>", f"{WORDS} {WORDS} {WORDS}"),
    (f"<article><div class='market-share'>{WORDS}</div><span class='comments'>seven</span></article>", f"{WORDS} seven"),
    (f"<h2 id='discussion'>Title</h2><p>{WORDS}</p>", f"Title {WORDS}"),
    # Names of the layout.
    (f"<div class='layout has-sidebar'><div class='sidebar'>no</div><article>{WORDS}</article></div>", WORDS),
    (f"<form id='aspnetForm'><div class='with-banner'><main>{WORDS}</main></div></form>", WORDS),
    (f"<main><div class='has-sidebar'><article>{WORDS}</article></div></main>", WORDS),
    # Left open before the content.
    (f"<div class='ad'>buy<article>{WORDS}</article>", WORDS),
    (f"<body><div class='ad'>buy<article>{WORDS}</article></body>", WORDS),
    (f"<aside>menu<main><p>{WORDS}</p></main>", WORDS),
    (f"<div><div class='ad'>buy<article>{WORDS}</article></div>", WORDS),
    (f"<main><aside>x<article>{WORDS}</article></main>", WORDS),
    # Still no content.
    (f"<article><p>{WORDS}</p><div class='ad-slot'>buy</div><div class='social-share'>x</div><div class='shareBar'>y</div><p>{WORDS}</p></article>", f"{WORDS} {WORDS}"),
    (f"<main><article><p>{WORDS}</p></article><section id='comments'><article class='comment'>first {WORDS}</article></section></main>", WORDS),
    (f"<main><p>{WORDS}</p><div class='comments-area'><article>first {WORDS}</article></div></main>", WORDS),
    (f"<article>{WORDS}</article><aside><article>card {WORDS}</article></aside>", WORDS),
    (f"<article>{WORDS}</article><div class='related-posts'><article>card {WORDS}</article></div>", WORDS),
    (f"<aside><article>{WORDS}</article></aside>", WORDS),
    # Formulas.
    ("<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p></article>", "where x = 2 holds"),
])
def test_names_inside_and_around_the_content(page, want):
    assert extract.main_text(page, extract.Weights(1.0, {}, -0.02)) == want


PARTS = [
    "<ul>" + "<li>short</li>" * 8 + "</ul>", "<ol>" + "<li><a href='/x'>link</a></li>" * 8 + "</ol>",
    "<table><tr><th>k</th><td>v</td></tr><tr><th>k</th><td>v</td></tr></table>", "<div>a</div>" * 8,
    "<div><div><div>deep</div></div></div>", "<p><a href='/x'>more</a></p>", "<blockquote>so</blockquote>",
    "<aside>no</aside><p>short</p>",
]


@pytest.fixture(scope="module")
def table_weights(spark):
    return extract.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("place", ["{0}{1}", "{1}{0}", "{1}{0}{1}", "{0}{1}{0}", "{0}"])
def test_lists_tables_links_and_divs_of_an_article_stay(table_weights, part, place):
    inner = place.format(part, f"<p>{WORDS}</p>")
    page = f"<body><nav><ul><li><a>menu</a></li></ul></nav><div class='ad'>buy</div><article>{inner}</article><footer>foot</footer></body>"
    want = " ".join(re.sub(r"<[^>]+>", " ", inner.replace("<aside>no</aside>", " ")).split())
    assert extract.main_text(page, table_weights) == want


def test_weights_count_what_is_scored():
    page = "<nav><ul><li>m</li></ul></nav><div class='ad'>buy</div><article><p>one <b>two</b></p><aside>no</aside></article><footer><div>f</div></footer>"
    inside, outside = extract.count_kinds(page)
    assert dict(inside) == {"article": 1, "p": 2, "#": 2}
    assert dict(outside) == {extract.OUT: 6, "article": 1}
    found = extract.Weights.of_counts({"#": 100_000, "p": 4_000, "li": 2}, {"div": 500, "#": 5})
    assert found.tags["li"] == extract.TAG_BOUNDS[1] and found.tags["td"] == extract.UNSEEN
    assert found.tags["div"] == extract.TAG_BOUNDS[0] and found.of("a") == 0


@pytest.mark.parametrize("page,want", [
    # Unnamed blocks around marked content.
    (f"<article><p>{WORDS}</p><p>{WORDS}</p></article><div class='x1'>All rights and so on reserved</div>", f"{WORDS} {WORDS}"),
    (f"<div><a>Home</a><a>News</a><a>Sport page</a></div><article><p>{WORDS}</p></article>", WORDS),
    # A card as an article does not take the page away from unmarked content.
    (f"<div><p>{WORDS} {WORDS}</p><p>{WORDS}</p></div><article>card</article>", f"{WORDS} {WORDS} {WORDS} card"),
    # Wrappers of a page without marked content.
    (f"<form id='f'><p>{WORDS}</p><input name='q'></form>", WORDS),
    (f"<div class='layout has-sidebar'><div class='sidebar'>no</div><p>{WORDS}</p></div>", WORDS),
    (f"<div class='social-science'><p>{WORDS}</p></div><footer>foot</footer>", WORDS),
    (f"<form><div class='social-science'><p>{WORDS}</p></div><div class='sidebar'>{WORDS} {WORDS}</div></form>", WORDS),
    (f"<div class='sidebar'>{WORDS} {WORDS}</div><p>{WORDS}</p>", WORDS),
    # Quotes delimit directly after "=" only.
    (f"<p title=Bob's>{WORDS}</p><p>it's {WORDS}</p>", f"{WORDS} it's {WORDS}"),
    (f"<p title = \"a > b's\">{WORDS}</p>", WORDS),
    (f"<p it's>{WORDS}</p><p>don't</p>", f"{WORDS} don't"),
    # Comments, notices and sidebars inside the content.
    (f"<article><p>{WORDS}</p><div class='comment'>x</div><ul id='comment-list'><li>x</li></ul></article>", WORDS),
    (f"<main><div class='cookie-notice'>x</div><p>{WORDS}</p><div class='newsletter-signup'>x</div><div class='sidebar'>x</div></main>", WORDS),
    (f"<main><div class='comment-on-the-law'>{WORDS}</div></main>", WORDS),
])
def test_evidence_around_and_inside_the_content(page, want):
    assert extract.main_text(page, extract.Weights(1.0, {}, -0.02)) == want


def test_names_are_learned_and_the_scan_decides(spark):
    labelled = (
        "<div class='qq7'><p>{0} links and things to buy now</p></div><article><div class='zz'><p>one two three four {0}</p></div></article>"
        "<section id='legal-x'>all of the rights are reserved {0}</section>"
    )
    frame = spark.createDataFrame([(i, "u", labelled.format(i), "", "") for i in range(6)], SCHEMA)
    found = extract.fit(frame)
    assert set(found.names) == {"div.qq7", "section.legal-x"} and max(found.names.values()) < 0
    words = " ".join(f"w{i}" for i in range(30))
    page = f"<div class='qq7'>some words here that nobody wants</div><div><p>{words}</p></div><section id='legal-x'>more words of no use here</section>"
    assert extract.main_text(page, found) == words
    everything = extract.main_text(page, extract.Weights(1.0, {}, 0.0))
    assert everything != words and words in everything
    # Names that few pages show, or that hold content as well, are no evidence.
    assert extract.fit(frame.limit(2)).names == {}
    assert "div.zz" not in found.names
    assert extract.name_scores({"a": 5, "b": 1}, {"a": 5, "b": 9, "c": 1}) == pytest.approx({"b": math.log(1.5 / 9.5), "c": math.log(0.5 / 1.5)})


def test_deep_pages_take_linear_time(table_weights):
    page = "<div class='a'><p>x " * 50_000
    assert extract.main_text(page, table_weights).split() == ["x"] * 50_000
    assert extract.main_text("<form>" * 50_000 + WORDS, table_weights) == WORDS
