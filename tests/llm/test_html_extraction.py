"""Main text of pages against a plain parser, hand-written layouts and a brute-force scan."""

from __future__ import annotations

import html
import random
from html.parser import HTMLParser

import pytest

from tierlake.llm import html_extraction as H

SCHEMA = "page_id bigint, url string, html string, text string, key string"
BODY = "<article><h1>Title &amp; more</h1><p>First <b>bold</b>face\n text.<br>Next<p>Second &lt;one&gt;</p></article>"
TEXT = "Title & more First boldface text. Next Second <one>"


class Article(HTMLParser):
    """Text of article elements, blocks apart."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.out.append(" " if tag in H.BLOCKS else "")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.out.append(" " if tag in H.BLOCKS else "")

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def plain(page: str) -> str:
    parser = Article()
    parser.feed(page)
    parser.close()
    return " ".join("".join(parser.out).split())


def test_given_pages_equal_a_plain_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r for r in H.extract(pages, H.learn(pages)).collect()}
    for r in pages.collect():
        expected = plain(r.html)
        assert (found[r.page_id].url, found[r.page_id].text, found[r.page_id].n_chars) == (r.url, expected, len(expected))


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return H.learn(spark.read.parquet(f"{sf_dir}/pages.parquet"))


AROUND = [
    "<nav><ul><li><a href='/'>Home</a><li><a href=/x>News of today</a></ul></nav>",
    "<header class=top><h2>Our site, the best site of all sites</h2></header>",
    "<footer><p>All rights reserved by us and by nobody else, ever.</p></footer>",
    "<aside><h3>More to read</h3><p>A long teaser of another article, with quite a few words in it.</p></aside>",
    "<div id=sidebar><p>A long teaser of another article, with quite a few words in it.</p></div>",
    "<div class='cookie-notice'>We use cookies. <button>Fine</button></div>",
    "<div role=alert>Service will be down tonight</div>",
    "<div class='ad'>Buy this now, and this, and that as well.</div>",
    "<span class='sponsored'>Paid for by them.</span>",
    "<form action='/x'><label>Your name</label><input name=a><textarea>Say something</textarea></form>",
    "<script>if (a < b) { t = '<p>not text</p>'; }</script><style>p { color: red }</style>",
    "<noscript>Please turn it on</noscript><template><p>later</p></template>",
    "<!-- <p>hidden</p> --><!--><!---->",
    "<section id=comments><article class=comment><p>I liked reading this one a lot, thanks for it.</p></article></section>",
    "<div class='post-comments'><p>I liked reading this one a lot, thanks for it.</p></div>",
    "</div></b></table>",
]


@pytest.mark.parametrize("extra", AROUND)
def test_what_is_not_the_article_is_left_out(weights, extra):
    inside = BODY.replace("<p>Second", f"{extra}<p>Second") if not extra.startswith("<header") else BODY
    for page in (extra + BODY, BODY + extra, inside, f"<body>{extra}<div class=wrap>{BODY}</div>{extra}</body>"):
        assert H.main_text(page, weights) == TEXT
        assert H.main_text(page, H.Weights()) == TEXT


def test_pages_that_name_no_article(weights):
    menu = "".join(f"<li><a href='/{k}'>Topic {k}</a></li>" for k in range(30))
    words = " ".join(f"word{k}" for k in range(60))
    for main in (f"<div><p>{words}</p><p>{words}</p></div>", f"<div>{words}<br>{words}</div>"):
        page = f"<html><body><ul>{menu}</ul>{main}<div><ul>{menu}</ul></div></body>"
        assert H.main_text(page, weights) == H.main_text(page, H.Weights()) == f"{words} {words}"
    assert H.main_text("just some words", weights) == "just some words"
    named = f"<div>Some words before it all</div><div class='entry-content'><p>{words}</p><p>End.</p></div>"
    assert H.main_text(named, weights) == f"{words} End."


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("   ", ""), ("<", "<"), ("a < b and <3", "a < b and <3"), ("<p", ""), ("<p>a<p>b", "a b"), ("a<!-- b", "a"),
        ("<p title='x>y'>a</p>", "a"), ('<p title="x', ""), ("<p>a&nbsp;&#10; b&amp c &am d &bogus; e</p>", "a b& c &am d &bogus; e"),
        ("<p>un<b>bro</b>ken<i> word</i></p>", "unbroken word"), ("x<script>y", "x"), ("x<SCRIPT>y</ScRiPt >z", "xz"),
        ("<main><table><tr><td>one<td>two<tr><th>three</table>", "one two three"), ("<main><dl><dt>a<dd>b</dl>", "a b"), ("<main>a<br/>b<hr>c", "a b c"),
        ("<pre>x <span class=comment># kept</span></pre>", "x # kept"), ("<form><article>kept</article></form>", "kept"),
        ("<body class='has-sidebar page'><main><p>kept</p></main>", "kept"), ("</p></p>a</div>", "a"), ("<?xml x?><!DOCTYPE html>a", "a"),
    ],
)
def test_awkward_markup(page, text):
    assert H.main_text(page, H.Weights()) == text


def test_scan_is_the_best_of_all_stretches():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.randint(-5, 5) for _ in range(rng.randint(0, 14))]
        start, end = H.best_stretch(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[start:end]) == max([0, *sums])
        assert (start == end) == (max([0, *sums]) == 0)


def test_weights_have_their_signs_and_follow_the_labels(weights):
    assert weights.of
    for (_, kind, _), score in weights.of.items():
        assert score > 0 if kind == H.WORD else score < 0
    assert weights.of[H.UNKNOWN, H.WORD, "p"] > weights.of[H.UNKNOWN, H.WORD, "a"]
    assert weights.of[H.UNKNOWN, H.TAG, "li"] < weights.of[H.UNKNOWN, H.TAG, "p"]


def test_rows_nulls_repeats_long_pages_and_extra_columns(spark):
    deep = "<div>" * 20000 + "<b><li><td>x</b>" * 20000 + "</i>" * 1000
    long = "<article>" + "<p>some words &amp; signs</p>" * 40000 + "</article>"
    given = [(1, "u", None), (2, None, ""), (3, "u", BODY), (3, "u", BODY), (None, "n", BODY), (5, "d", deep), (6, "l", long)]
    rows = [(i, u, h, "own text", "k") for i, u, h in given]
    pages = spark.createDataFrame(rows, SCHEMA)
    found = H.extract(pages, H.learn(pages)).collect()
    assert sorted(((r.page_id or 0), r.n_chars) for r in found)[:5] == [(0, len(TEXT)), (1, 0), (2, 0), (3, len(TEXT)), (3, len(TEXT))]
    assert {r.page_id: r.text for r in found}[6] == " ".join(["some words & signs"] * 40000)
    passed = H.with_main_text(pages, H.Weights())
    assert sorted(passed.columns) == sorted(pages.columns) and passed.filter("key = 'k'").count() == 7
    assert {r.text for r in passed.filter("page_id = 3").collect()} == {TEXT}
    none = spark.createDataFrame([], SCHEMA)
    assert H.extract(none, H.learn(none)).collect() == [] and H.learn(none).of == {}


def test_references_across_the_text_are_those_of_the_library():
    for text in ("&lt;&eacute;&#x1F642;&notit;&copy", "&#0;&#xD800;&amp;amp;"):
        assert H.main_text(f"<article>{text}</article>", H.Weights()) == " ".join(html.unescape(text).split())
