"""Templates are found anywhere on a page, and counted per host."""

import pytest

from linkloom.llm.html_extract import Extraction, extract

SCHEMA = "page_id bigint, url string, html string"


def texts(spark, pages):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(pages, SCHEMA)).collect()}


def test_recurring_blocks_inside_articles_go(spark):
    page = "<article><h1>Title {0}</h1><div class='x7'>Join us<p>Every week by mail</p></div><p>Text {0}</p><p>Often said</p></article>"
    found = texts(spark, [(i, f"http://a.example/{i}", page.format(i)) for i in range(12)] + [(99, "http://b.example/", page.format(99))])
    assert found == {i: f"Title {i}\nText {i}\nOften said" for i in range(12)} | {99: "Title 99\nJoin us\nEvery week by mail\nText 99\nOften said"}


def test_blocks_outside_articles_are_counted(spark):
    pages = [(i, f"http://a.example/{i}", f"<body><div class='cookie'>We use cookies</div><article><p>Text {i}</p></article></body>") for i in range(12)]
    pages.append((50, "http://a.example/50", "<article><p>Start</p><div>We use cookies</div><p>End</p></article>"))
    assert texts(spark, pages)[50] == "Start\nEnd"


def test_many_pages_is_a_count(spark):
    pages = [(i, f"http://a.example/{i}", f"<article><p>Text {i}</p>{'<section><p>Sale</p></section>' if i < 10 else ''}</article>") for i in range(100)]
    pages += [(1000 + i, f"http://b.example/{i}", f"<article><p>Text {i}</p>{'<section><p>Sale</p></section>' if i < 9 else ''}</article>") for i in range(100)]
    found = texts(spark, pages)
    assert all("Sale" not in found[i] for i in range(10)) and all("Sale" in found[1000 + i] for i in range(9))


def test_a_template_around_a_template_goes_whole(spark):
    pages = [(i, f"http://a.example/{i}", f"<body><div>Hello<p>Welcome</p></div>Text {i}</body>") for i in range(12)]
    assert texts(spark, pages)[3] == "Text 3"


@pytest.mark.parametrize("html,text", [("<article><div>a<p>b</p></div>c</article>", "c"), ("<article>x<div>a<p>b</p></div></article>", "x"), ("<article><div><div>a<p>b</p></div></div>c</article>", "c"), ("<article><p>a</p><p>b</p>c</article>", "a\nb\nc")])
def test_text_after_a_template_stays(html, text):
    assert Extraction(html, frozenset(Extraction("<article><div>a<p>b</p></div></article>").hashes)).text() == text


@pytest.mark.parametrize("name", ["class='social-history'", "class='notice-of-patent'", "class='comment-analysis'", "class='related-work'", "class='lead-in reply'", "id='comments-on-keynes'", "title='class=\"sidebar\"'", "data-id='menu'"])
def test_content_is_not_dropped_by_a_word_in_a_name(name):
    assert Extraction(f"<article><p>a</p><div {name}><p>b</p></div><p>c</p></article>").text() == "a\nb\nc"


@pytest.mark.parametrize("name", ["class='sidebar'", "class='Cookie-Notice'", "class='share-buttons'", "id='comments'", "class='widget social'", "class='ad box-3'", "role=navigation", "class='comments-list col-2'", "hidden"])
def test_names_of_boilerplate(name):
    assert Extraction(f"<article><p>a</p><div {name}><p>b</p></div><p>c</p></article>").text() == "a\nc"


def test_templates_without_a_telling_tag_or_class_inside_templates(spark):
    related = "<div>Related stories<ul><li>One</li><li>Two<div>Three</div></li></ul></div>"
    pages = [(i, f"http://a.example/{i}", f"<article><p>Text {i}</p>{related}<p>End {i}</p></article>") for i in range(30)]
    pages += [(100, "http://a.example/100", "<article><p>Start</p><div>Three</div><ul><li>One</li></ul></article>")]
    found = texts(spark, pages)
    assert {found[i] for i in range(30)} == {f"Text {i}\nEnd {i}" for i in range(30)}
    assert found[100] == "Start\nOne"


def test_copies_of_one_article_are_no_template(spark):
    page = "<article><div><p>One article</p><p>in a container</p></div></article>"
    pages = [(i, f"http://a.example/{i}", page) for i in range(40)]
    assert set(texts(spark, pages).values()) == {"One article\nin a container"}


@pytest.mark.parametrize("page", ["<p>a</p><" + "a" * 5_000_000, "<p>a</p><a title=\"" + "x<b " * 400_000, "<p>a</p>" + "<a href='x" * 300_000, "<p>a</p>" + "<div>" * 300_000 + "</b>" * 300_000, "<p>a</p>" + "<b>" * 300_000 + "</i>" * 300_000, "<p>a</p><i><p>" + "<b>" * 200_000 + "</i>" * 200_000, "<p>a</p><!--" + "<!-" * 500_000])
def test_long_unclosed_markup_takes_linear_time(page):
    import time

    began = time.process_time()
    assert Extraction(page).text().startswith("a")
    assert time.process_time() - began < 6


def simple(page, templates=()):
    """Another reading of small well-formed pages by Python's own parser: a list of blocks."""
    from html.parser import HTMLParser

    blocks = frozenset("article div p h1 ul li section nav footer body".split())

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.open, self.depth = [""], [], 0

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                self.out[-1] += " " * (not self.depth and "article" in self.open)
                return
            self.open.append(tag)
            gone = tag in ("nav", "footer", "script") or dict(attrs).get("class") in ("sidebar", "comments")
            if self.depth or gone:
                self.depth += 1
            if tag in blocks:
                self.out.append("")

        def handle_endtag(self, tag):
            self.open.pop()
            if self.depth:
                self.depth -= 1
            if tag in blocks:
                self.out.append("")

        def handle_data(self, data):
            if "article" in self.open and not self.depth:
                self.out[-1] += data

    reader = Reader()
    reader.feed(page)
    texts = [" ".join(x.split()) for x in reader.out]
    return "\n".join(x for x in texts if x and x not in templates)


def test_against_another_reader_with_recurring_blocks(spark):
    import random

    rng = random.Random(5)
    word = lambda: rng.choice(["alpha", "beta &amp; co", "gamma", "delta<br>x", "<b>bold</b> text", "é"])
    promo = "<div><p>Buy our book</p><ul><li>now</li><li>or later</li></ul></div>"
    pages, expected = [], {}
    for i in range(60):
        body = "".join(rng.choice([f"<p>{word()} {i}-{k}</p>", f"<section><h1>{word()} {i}</h1><p>{word()} {k} {i}</p></section>", "<p>said often</p>", promo, f"<div class='sidebar'>{word()} {i}</div>", f"<div class='related-work'>{word()} {i} {k}</div>"]) for k in range(8))
        page = f"<body><nav><ul><li>menu {i}</li></ul></nav><article><h1>Title {i}</h1>{body}</article><footer>foot</footer></body>"
        pages.append((i, f"http://h{i % 2}.example/{i}", page))
        expected[i] = simple(page, {"Buy our book", "now", "or later"})
    assert sum(promo in p for _, _, p in pages) >= 30
    assert texts(spark, pages) == expected


@pytest.mark.parametrize("html,text", [("<!-- open <p>a</p>", ""), ("<!-- a --><p>b</p>", "b"), ("<!DOCTYPE html><p>b</p>", "b"), ("<?xml ?>b", "b"), ("a<!", "a"), ("a<", "a<")])
def test_comments_and_declarations(html, text):
    assert Extraction(html).text() == text
