import re
import time
from html import unescape

import pytest

from tripaudit.llm import html_text
from tripaudit.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"

PAGES = [
    ("<article><h1>T</h1><p>one  two<br>three</p><p>four</article><footer>f</footer>", "T one two three four"),
    ("<nav><a href='/'>Home</a></nav><main><p>A &amp; B&nbsp;C</p></main><aside>x</aside>", "A & B C"),
    ("<article><p>in<b>li</b>ne</p><div class='ad'>buy</div><p>next</p><section class='comments'><p>reader</p></section></article>", "inline next"),
    ("<div class='ad'>never closed<article><p>text</p></article>", "text"),
    ("<header>site</header><article><header><h1>Head</h1></header><p>Body</p></article>", "Head Body"),
    ("<script>var t='</p><article>no</article>'</script><article>yes<!-- <p>no</p> --></article>", "yes"),
    ("<article><p>a</p>\n\n<form><p>no</p><input></form><ul><li>x</li><li>y</li></ul></article>", "a x y"),
    ("<article><p title='a>b'>q</p></article>", "q"),
    ("plain text only", "plain text only"),
    ("<article></article>", ""),
    ("", ""),
    (None, ""),
    ("<p>5 < 6 and 7 > 3</p>", "5 < 6 and 7 > 3"),
    ("<body><ul><li><a href=a>Home page link</a></li></ul><div><p>" + "long text here " * 9 + "</p><p>more of it</p></div><div class=footer>(c)</div>",
     ("long text here " * 9 + "more of it")),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_extract(page, text):
    assert html_text.extract(page) == text


def test_far_apart_paragraphs_stay():
    page = "<article><p>first</p>" + "<div></div>" * 30 + "<p>last</p></article>"
    assert html_text.extract(page) == "first last"


A, B, C = ("first part of it " * 5).strip(), ("second part of it " * 4).strip(), ("third part of it " * 6).strip()
LINKS = "<ul>" + "<li><a href=x>Some other page</a></li>" * 5 + "</ul>"


@pytest.mark.parametrize("page, text", [
    (f"<div><p>{A}</p></div><div><p>{B}</p></div>", f"{A} {B}"),
    (f"<section><h2>One</h2><p>{A}</p></section><section><h2>Two</h2><div><div><p>{B}</p></div></div></section>", f"One {A} Two {B}"),
    (f"<div><p>{A}</p></div><div class='ad'><p>buy</p><p>buy</p><p>buy</p><p>buy</p></div><div><p>The end.</p></div>", f"{A} The end."),
    (f"<div><p>{A}</p></div><nav>{LINKS}</nav><div><p>{B}</p></div>{LINKS}<div><p>{C}</p></div>", f"{A} {B} {C}"),
    (f"<div><p>{A}</p></div>{LINKS}<div><p>short</p></div>{LINKS}<div><p>{C}</p></div>{LINKS}<p>site name</p>", f"{A} short {C}"),
    (f"<p>{A}</p><p><a href=x>a link of the text</a></p><p>{B}</p>", f"{A} a link of the text {B}"),
    (f"<div>one</div>{LINKS}<div>two</div>", "one two"),
])
def test_unmarked_pages_keep_every_passage(page, text):
    assert html_text.extract(f"<body>{LINKS}{page}{LINKS}</body>") == text


CARDS = "".join(f"<article><a href=x><h3>Card {i}</h3></a></article>" for i in range(3))


@pytest.mark.parametrize("page, text", [
    (f"<div><p>{A}</p></div><div><p>{B}</p></div>{LINKS}{CARDS}", f"{A} {B} Card 0 Card 1 Card 2"),
    (f"<div><p>{A}</p></div><article><p>in</p></article><div><p>{B}</p></div>", f"{A} in {B}"),
    (f"<p>site name</p>{LINKS}<article><p>in</p><p><a href=x>source</a></p></article>{LINKS}<p>imprint</p>", "in source"),
    (f"<main><p>in</p>{LINKS}<p>last</p></main>", "in " + "Some other page " * 5 + "last"),
])
def test_article_is_a_weight(page, text):
    assert html_text.extract(f"<body>{page}</body>") == text


LONG = " ".join(["one paragraph of two hundred characters in an element whose name says little"] * 3)[:200].strip()


@pytest.mark.parametrize("start", [
    '<div class="layout has-sidebar">', '<div id="content" class="no-sidebar">', '<div class="search-results">', '<div title="the hidden life">',
    '<article title="the hidden life">', '<div class="main hidden-print">', '<div data-x="aria-hidden=true">', "<div class='page' id=main>",
    '<p class="lead-in">', '<div class="notice">', '<section class="legal">',
])
def test_names_are_looked_at_as_a_whole(start):
    tag = re.match("<([a-z]+)", start)[1]
    assert html_text.extract(f"{start}<p>{LONG}</p></{tag}>") == LONG
    assert html_text.extract(f"<article><p>first</p>{start}<p>{LONG}</p></{tag}></article>") == f"first {LONG}"


@pytest.mark.parametrize("block", [
    "<p class='advert'>buy</p>", "<p class=advert>buy", "<ul><li class='nav'>go<li class=nav>on</ul>", "<div class='legal'>all rights</div>",
    "<table><tr><td class='sidebar'>aside</td></tr></table>", "<div class='notice'><p>" + "<a href=x>long link text of a notice</a> " * 6 + "</p></div>",
    "<div hidden>no</div>", "<div aria-hidden='true'>no</div>", "<div class='site-footer'>f</div>", "<div class='teaser'>" + LONG + "</div>",
    "<section class='comment-list'><p>" + LONG + "</p></section>", "<div class='share_buttons'>s</div>", "<h3 class='related-posts'>more</h3>",
])
def test_boilerplate_of_any_element(block):
    assert html_text.extract(f"<article><p>first</p>{block}<p>last</p></article>") == "first last"
    assert html_text.extract(f"<div><p>{A}</p></div>{block}<div><p>{B}</p></div>") == f"{A} {B}"


def test_unmarked_blocks_go_by_the_distribution():
    """A doubted name beside the text: kept where it is text, dropped where it is short; links between passages stay empty lines."""
    notice = "<div class='notice'><p>{}</p></div>"
    assert html_text.extract(f"<div><p>{A}</p>{notice.format('short')}<p>{B}</p></div>") == f"{A} {B}"
    assert html_text.extract(f"<div><p>{A}</p>{notice.format(LONG)}<p>{B}</p></div>") == f"{A} {LONG} {B}"


@pytest.mark.parametrize("piece", ["<a ", "<script ", "<!", "</", '<a "', "<a '\"", "<div class=a", "<a b='c", "<b", "<!--", "<a href=x>", "<p class='ad'>x"])
def test_broken_markup_takes_linear_time(piece):
    start = time.process_time()
    html_text.extract(piece * 100_000)
    assert time.process_time() - start < 5


def test_deep_nesting_takes_linear_time():
    start = time.process_time()
    html_text.extract("<div>" * 50_000 + "</span>" * 50_000)
    assert time.process_time() - start < 5


def test_long_page():
    body = "<p>" + "w " * 50 + "</p>"
    assert html_text.extract("<article>" + body * 4000 + "</article>").count("w") == 200000


def test_query(spark):
    """Against the article element cut out by plain string search (the test pages all have one)."""
    pages = {p.page_id: p for p in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = REGISTRY["op8_html_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        page = pages[r.page_id].html or ""
        inner = page[page.find("<article>") + 9 : page.find("</article>")]
        want = " ".join(unescape(re.sub("<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inner)).split())
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


def test_nulls_repeats_empty(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, None, None, "a"), (2, "u", "<p>x</p>", "b"), (2, "u", "<p>x</p>", "b"), (None, "u", "y", None)]
    got = html_text.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, "y"), (1, ""), (2, "x"), (2, "x")]
    assert html_text.extract_pages(spark.createDataFrame([], schema)).collect() == []
