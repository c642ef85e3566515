import json
import random
import re
import time

import pytest

from statuslight.llm import warc_derivatives as wd

PAGE = """<!DOCTYPE html><html lang="fr"><head><title> A &amp;
 b </title><style>p{}</style><script>var t="</p>";</script></head><body><!-- no <b>x</b> --><p>One<b>two</b>
 three &lt;4&gt;<p>five</p><a href="/x?a=1&amp;b=2">link <i>text</i></a><a href='http://[bad'>bad</a></body></html>"""


def test_plain_text_and_metadata():
    assert wd.plain_text(PAGE).split("\n") == ["Onetwo", "three <4>", "five", "link textbad"]
    found = wd.metadata(PAGE, "http://h.example/p/", {"K": "v"})
    assert found["title"] == "A & b" and found["language"] == "fr" and found["headers"] == {"K": "v"}
    assert found["links"] == [{"url": "http://h.example/x?a=1&b=2", "text": "link text"}, {"url": "http://[bad", "text": "bad"}]


def test_records_are_linked_and_come_back(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    sources = wd.responses(pages)
    found = wd.derivatives(sources)
    assert found.count() == 2 * pages.count()
    by_id = {r.record_id: r for r in sources.collect()}
    html = {r.page_id: r.html for r in pages.collect()}
    for r in found.collect():
        source = by_id[r.refers_to]
        assert (r.page_id, r.target_uri, r.date, r.payload_digest, r.source_headers) == (source.page_id, source.target_uri, source.date, source.payload_digest, source.source_headers)
        assert r.block_digest == wd.digest(bytes(r.block)) and source.payload_digest == wd.digest(html[r.page_id].encode())
        if r.record_type == "conversion":
            assert bytes(r.block).decode() == wd.plain_text(html[r.page_id])
        else:
            assert json.loads(bytes(r.block))["headers"]["Content-Length"] == str(len(html[r.page_id].encode()))
    assert len({r.record_id for r in found.collect()}) == found.count()
    data = b"".join(bytes(r.warc) for r in wd.serialized(sources.union(found)).collect())
    records = wd.from_bytes(data)
    assert len(records) == 3 * pages.count()
    assert all(h["WARC-Block-Digest"] == wd.digest(b) for h, b in records)
    assert {h["WARC-Refers-To"] for h, _ in records if h["WARC-Type"] != "response"} == set(by_id)


def test_awkward_pages(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (None, "u", "<p>", "x"), (3, "u", "<p>" + "long <b> " * 50_000, "x"), (4, "u", "<", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, block string")
    found = wd.derivatives(wd.responses(pages))
    assert sorted(r.page_id for r in found.collect()) == [1, 1, 2, 2, 2, 2, 3, 3, 4, 4]
    assert wd.derivatives(wd.responses(pages.limit(0))).count() == 0
    raw = wd.responses(pages.limit(1)).selectExpr("page_id", "'response' as record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "cast(null as string) as payload_digest", "source_headers", "cast(null as binary) as block")
    assert {r.payload_digest for r in wd.derivatives(raw).collect()} == {wd.digest(b"")}
    assert wd.derivatives(raw.selectExpr("*").withColumn("record_type", raw.record_id)).count() == 0


#: what the walks over a page have to find, as patterns that try every beginning
PLAIN = {
    "hidden": re.compile(r"<!--.*?-->|<(script|style|noscript|template|head)\b.*?</\1\s*>", re.S | re.I),
    "head": re.compile(r"<head\b[^>]*>(.*?)</head\s*>", re.S | re.I),
    "title": re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I),
    "lang": re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I),
    "link": re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))[^>]*>(.*?)(?=</a|<a\b|\Z)", re.S | re.I),
}
PIECES = ["<a ", "<a", "</a>", "href=", " href = ", '"', "'", ">", "<", "x", " ", "<p>", "<!--", "-->", "<script", "</script>", "</SCRIPT >",
          "<head>", "<HEAD", "</head>", "<title>", "</title", "<html ", "lang=", "en", "<b", "/", "=", "\n", "<style>", "</style"]


def test_walks_find_what_the_patterns_find():
    rng = random.Random(5)
    for _ in range(20_000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 25)))
        shown = PLAIN["hidden"].sub(" ", page)
        assert wd.body(page) == shown, page
        assert wd.tags_out(wd.TAG, "", page) == wd.TAG.sub("", page) and wd.tags_out(wd.BREAKS, "", page) == wd.BREAKS.sub("", page), page
        for begin, end, name in ((wd.HEAD, wd.ENDS["head"], "head"), (wd.TITLE, wd.TITLE_END, "title")):
            plain = PLAIN[name].search(page)
            assert wd.enclosed(page, begin, end) == (plain[1] if plain else None), page
        lang = PLAIN["lang"].search(page)
        assert wd.metadata(page, "", {})["language"] == (lang[1] if lang else None), page
        plain = [(next(g for g in m.groups()[:3] if g is not None), m[4]) for m in PLAIN["link"].finditer(page)]
        assert list(wd.anchors(page)) == plain, page


@pytest.mark.parametrize("piece", ["<script>", "<!--", "<head>", "<head ", "<title>", "<html ", "<a ", "<a href=", '<a href="x', "<b ", "<p ", "<a href='x'>", "</script", "<"])
def test_pages_of_unclosed_tags_end_soon(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.monotonic()
    wd.plain_text(page), wd.metadata(page, "http://h.example/", {})
    assert time.monotonic() - start < 30
