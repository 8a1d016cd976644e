"""Archive derivatives: links, digests and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import json
import re
from html.parser import HTMLParser

from adperf.llm import html_text, warc


def records(spark, pages):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    served = warc.responses(frame)
    return served, warc.derive(served)


def test_records_link_to_their_responses_and_keep_digests(spark, tables):
    pages = [(p["page_id"], p["url"], p["html"]) for p in tables("pages")]
    served, derived = records(spark, pages)
    by_id = {r.record_id: r for r in served.collect()}
    html_of = {p[0]: p[2] for p in pages}
    rows = derived.collect()
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows} | set(by_id)) == 3 * len(pages)
    for r in rows:
        source = by_id[r.refers_to]
        assert (r.page_id, r.target_uri, r.date) == (source.page_id, source.target_uri, source.date)
        payload = "sha1:" + base64.b32encode(hashlib.sha1(html_of[r.page_id].encode()).digest()).decode()
        assert r.payload_digest == source.payload_digest == payload
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block).digest()).decode()
        assert r.content_length == len(r.block)
        if r.record_type == "metadata":
            about = json.loads(bytes(r.block))
            assert about["envelope"]["record-id"] == source.record_id
            headers = {h["name"]: h["value"] for h in about["http"]["headers"]}
            assert headers["Content-Length"] == str(len(html_of[r.page_id].encode()))
            assert len(about["html"]["links"]) == len(re.findall(r"<a href", html_of[r.page_id]))


def test_plain_text_keeps_all_visible_words():
    page = "<title>T &amp; t</title><script>x</script><nav><a href=1>m</a></nav><p>a<b>b</b> c<br>d</p><!-- no --><p>e"
    assert warc.plain_text(page) == "T & t\nm\nab c\nd\ne"


def test_files_round_trip(spark, tmp_path, tables):
    pages = [(p["page_id"], p["url"], p["html"]) for p in tables("pages")[:20]]
    served, derived = records(spark, pages)
    both = served.unionByName(derived)
    warc.write(both, str(tmp_path / "out"))
    members = [bytes(r.member) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    read = {r["WARC-Record-ID"]: r for r in warc.read([b"".join(members)])}
    want = {r.record_id: r for r in both.collect()}
    assert set(read) == set(want)
    for k, r in want.items():
        assert read[k]["block"] == r.block and read[k].get("WARC-Refers-To") == r.refers_to
        assert read[k]["WARC-Payload-Digest"] == r.payload_digest


def test_nulls_empties_long_and_repeated_pages(spark):
    pages = [(1, None, None), (2, "u", ""), (3, "v", "<p>x</p>" * 50_000), (3, "v", "<p>x</p>" * 50_000), (None, "w", "é < &")]
    _, derived = records(spark, pages)
    rows = derived.collect()
    assert len(rows) == 10
    texts = sorted(bytes(r.block).decode() for r in rows if r.record_type == "conversion")
    assert texts == ["", "", "\n".join(["x"] * 50_000), "\n".join(["x"] * 50_000), "é < &"]
    served, derived = records(spark, pages)
    own = [r.record_id for r in served.collect()]
    assert len(set(own)) == 5 and {r.refers_to for r in derived.collect()} == set(own)
    assert next(warc.parse(warc.to_bytes(rows[0].asDict())))["block"] == rows[0].block
    assert records(spark, [])[1].collect() == []


def test_extra_columns_do_not_clash(spark):
    frame = spark.createDataFrame([(1, "u", "<p>a", "x")], "page_id long, url string, html string, block string")
    assert warc.derive(warc.responses(frame)).count() == 2


def test_headers_are_kept_as_often_as_given():
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nset-cookie:b=2\r\nX-Long: one\r\n  two\r\nEmpty:\r\nno colon\r\n\r\n<p>x"
    status, headers, body = warc.split_http(block)
    assert (status, body) == ("HTTP/1.1 200 OK", b"<p>x")
    assert headers == [("Set-Cookie", "a=1"), ("set-cookie", "b=2"), ("X-Long", "one two"), ("Empty", "")]


def test_rows_of_one_id_have_records_of_their_own(spark):
    served, derived = records(spark, [(1, "u", "<p>a"), (1, "u", "<p>b"), (1, "u", "<p>a")])
    by_id = {r.record_id: r for r in served.collect()}
    assert len(by_id) == 3
    for r in derived.collect():
        assert by_id[r.refers_to].payload_digest == r.payload_digest


class Reader(HTMLParser):
    """Title, links and visible text by the standard parser."""

    def __init__(self, page):
        super().__init__()
        self.title, self.links, self.lines, self.skip, self.in_title = None, [], [[]], 0, False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        url = dict(attrs).get("href") or dict(attrs).get("src")
        if tag in ("a", "link", "img", "script") and url:
            self.links.append({"element": tag, "url": url})
        self.skip += tag in ("script", "style")
        self.in_title |= tag == "title"
        if tag == "br" or tag not in html_text.INLINE:
            self.lines.append([])

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        self.in_title &= tag != "title"
        if tag not in html_text.INLINE:
            self.lines.append([])

    def handle_data(self, data):
        if self.in_title:
            self.title = (self.title or "") + data
        if not self.skip:
            self.lines[-1].append(data)

    @property
    def text(self):
        found = (" ".join("".join(x).split()) for x in self.lines)
        return "\n".join(x for x in found if x)


def test_records_equal_brute_force(spark, tables):
    pages = {p["page_id"]: p for p in tables("pages")}
    _, derived = records(spark, [(p["page_id"], p["url"], p["html"]) for p in pages.values()])
    for r in warc.summary(derived).collect():
        reader = Reader(pages[r.page_id]["html"])
        if r.record_type == "conversion":
            assert r.content == reader.text
        else:
            about = json.loads(r.content)["html"]
            assert about["links"] == reader.links
            assert about["title"] == " ".join((reader.title or "").split())
