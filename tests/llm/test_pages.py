import base64
import hashlib
import io
import os

import pytest
import zstandard
from helpers import LONG

from linkloom.llm.html_extract import Extraction, extract
from linkloom.llm._common import read, shared_path, stage
from linkloom.llm.warc_bundles import BundleReader, BundleWriter, lookup, parse_records, read_bundles, record, round_trip, seek_table, write_bundles

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="ad">Buy</div><aside>Side</aside>
<main><article><h1>Head &amp; tail</h1><p>One  <b>bold<br>text</p><p>Two &lt;&#233;&#x41;&copy;</p>
<ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table><form><input><button>Go</button></form><div class="share-buttons">Share</div>
<div id="comments"><p>I agree</p></div><!-- gone --><p hidden>no</p></article></main><footer>&copy; S</footer></body></html>"""


def test_main_text_of_a_page():
    assert Extraction(PAGE).text() == "Head & tail\nOne bold text\nTwo <éA©\nx\ny\nc1\nc2"


@pytest.mark.parametrize(
    "html,text",
    [("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<article><p>a &am", "a &am"), ("<article><p>cut</arti", "cut"), ("<p>a < b and c > d</p>", "a < b and c > d"), ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<script>x", ""), ("<p>a<!-- x", "a"), ("<body><p>one</p><nav>menu</nav><p>two</p></body>", "one\ntwo"), ("<p title='a>b'>t</p>", "t"), ("<P>A</P><DIV CLASS='Cookie-Notice'>x</DIV>", "A"), ("<p>a  b\n\tc</p>", "a b c"), ("<article><p>a</p></article><p>no</p><article><p>b</p></article>", "a\nb")],
)
def test_small_pages(html, text):
    assert Extraction(html).text() == text


def site(n, article=True):
    return [(i, f"http://Site.example/{i}", f"<body><div><p>Welcome to the site</p><p>All rights</p></div>{'<article>' if article else ''}<p>Text {i}</p><p>Often said</p>{'</article>' if article else ''}</body>") for i in range(n)]


def test_templates_are_removed_per_host(spark):
    pages = spark.createDataFrame(site(30, article=False) + [(100, "http://other.example/", "<body><div><p>Welcome to the site</p><p>All rights</p></div><p>x</p></body>")], "page_id bigint, url string, html string")
    texts = {r.page_id: r.text for r in extract(pages).collect()}
    assert texts[3] == "Text 3" and texts[100] == "Welcome to the site\nAll rights\nx"


def test_what_recurs_in_articles_stays(spark):
    pages = spark.createDataFrame(site(30), "page_id bigint, url string, html string")
    assert {r.text for r in extract(pages).collect()} == {f"Text {i}\nOften said" for i in range(30)}


def odd_pages(spark):
    rows = [(1, "http://a/x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://a/y", None), (4, "", ""), (5, "nothing", f"<p>{LONG}</p>"), (6, "http://a/x", "<p>one</p>"), (6, "http://a/x", "<p>one</p>"), (None, "http://a/z", "<p>é</p>"), (7, "http://a/\r\nX: y", "<p>é</p>")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' as host", "'clash' as templates", "'clash' as payload", "'clash' as n_chars")


def test_extraction_of_odd_pages(spark):
    out = extract(odd_pages(spark)).collect()
    assert len(out) == 9 and all(r.n_chars == len(r.text) for r in out)
    assert {(r.page_id, r.text) for r in out if r.page_id != 5} == {(1, "one"), (2, "one"), (3, ""), (4, ""), (6, "one"), (None, "é"), (7, "é")}
    assert extract(odd_pages(spark).limit(0)).count() == 0


def test_extraction_of_the_table(spark, sf_dir):
    import html
    import re

    def brute(page):
        m = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
        body = re.sub(r"<[^>]*$", "", m[1] if m else "")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", x).replace("<b>", ""))).strip() for x in re.split(r"</?(?:p|h1)>", body))
        return "\n".join(x for x in blocks if x)

    pages = read(spark, sf_dir, "pages")
    assert {(r.page_id, r.text) for r in extract(pages).collect()} == {(r.page_id, brute(r.html)) for r in pages.collect()}


# ---------------------------------------------------------------- bundles


def test_frames_are_independent_and_found_by_the_table():
    writer, made, places = BundleWriter(frame_bytes=500), [], []
    for i in range(20):
        made.append(record(i, f"http://x/{i}", f"payload {i} é".encode() * 9, None, False))
        places.append(writer.add(made[-1]))
    bundle = writer.finish()
    assert len(seek_table(bundle)) == len({f for f, _ in places}) > 5
    whole = zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True).read()
    assert whole == b"".join(made)
    reader = BundleReader(io.BytesIO(bundle))
    assert reader.table == seek_table(bundle)
    for i, (frame, offset) in enumerate(places):
        fields, block = reader.record(frame, offset)
        assert fields["WARC-Record-ID"] == f"<urn:page:{i}>" and block.endswith(f"payload {i} é".encode())
        assert any(o == offset for o, _, _ in parse_records(reader.frame(frame)))


def expected(pages, min_bytes=0):
    groups = {}
    for r in pages:
        data = (r.html or "").encode()
        groups.setdefault(data, []).append(r.page_id)
    out = []
    for r in pages:
        data = (r.html or "").encode()
        ids = [x for x in groups[data] if x is not None]
        target = max(ids) if ids and len(data) >= min_bytes else r.page_id
        revisit = target != r.page_id
        out.append((r.page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, sf_dir):
    for pages in (read(spark, sf_dir, "pages"), odd_pages(spark)):
        assert sorted((tuple(r) for r in round_trip(pages).collect()), key=str) == expected(pages.collect())
    assert round_trip(odd_pages(spark).limit(0)).count() == 0


def test_index_and_payloads(spark, sf_dir):
    pages, folder = read(spark, sf_dir, "pages"), shared_path(spark, "bundles")
    index = stage(write_bundles(pages, folder, bundle_bytes=20_000, frame_bytes=8_000), "test-index")
    rows, html = index.collect(), {r.page_id: r.html or "" for r in pages.collect()}
    assert len(rows) == len(html) and len({r.bundle for r in rows}) > 1
    path = folder.removeprefix("file:").replace("//", "/", 1) if folder.startswith("file:") else folder
    for r in rows[::7]:
        with open(f"{path}/{r.bundle}", "rb") as f:
            fields, block = BundleReader(f).record(r.frame, r.record_offset)
        assert fields["WARC-Record-ID"] == f"<urn:page:{r.page_id}>"
        if fields["WARC-Type"] == "response":
            assert block.split(b"\r\n\r\n", 1)[1].decode() == html[r.page_id]
    read_back = read_bundles(folder, index).collect()
    assert {r.page_id for r in read_back} == set(html)
    assert {(r.page_id, bytes(r.payload).decode()) for r in read_back if r.record_type == "response"} <= set(html.items())
    wanted = pages.filter("page_id % 9 = 0").select("page_id")
    assert {r.page_id for r in lookup(folder, index, wanted).collect()} == {i for i in html if i % 9 == 0}


def test_bundles_outside_the_index_are_not_read(spark, sf_dir):
    pages, folder = read(spark, sf_dir, "pages"), shared_path(spark, "bundles")
    write_bundles(pages.filter("page_id < 9"), folder).collect()  # as a lost attempt would leave them
    index = stage(write_bundles(pages, folder), "test-index")
    assert len(os.listdir(folder.removeprefix("file://"))) > len({r.bundle for r in index.collect()})
    assert sorted(r.page_id for r in read_bundles(folder, index).collect()) == sorted(r.page_id for r in pages.collect())


def test_an_index_of_other_bundles_is_refused(spark, sf_dir):
    pages, folder = read(spark, sf_dir, "pages"), shared_path(spark, "bundles")
    index = stage(write_bundles(pages, folder), "test-index")
    with pytest.raises(Exception, match="where the index has"):
        read_bundles(folder, index.withColumn("page_id", index.page_id + 1)).collect()


def test_string_ids(spark):
    rows = [("a", "u", "x"), ("b", "u", "x"), ("c", None, None)]
    out = round_trip(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in out} == {("a", "revisit", "b"), ("b", "response", None), ("c", "response", None)}


def test_small_payloads_are_all_responses(spark):
    folder = shared_path(spark, "bundles")
    index = stage(write_bundles(odd_pages(spark), folder, min_bytes=9), "test-index")
    kinds = {(r.page_id, r.record_type) for r in read_bundles(folder, index).collect()}
    assert {(3, "response"), (4, "response"), (1, "revisit"), (6, "response")} <= kinds
