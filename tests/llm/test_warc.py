"""Hostile pages, heads and encodings, and an independent reading of the derivatives."""

from __future__ import annotations

import gzip
import html.parser
import random
import time
import zlib
from email.parser import BytesParser

import pytest

from specflow.llm import warc


class _Reader(html.parser.HTMLParser):
    """What a page shows, by the standard library's parser."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in warc._UNSEEN:
            self.hidden.append(tag)
        if tag in warc._BREAKS:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()
            self.text.append(" ")
        if tag in warc._BREAKS:
            self.text.append("\n")

    def handle_comment(self, data):
        self.text.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def _shown(page: str) -> str:
    reader = _Reader()
    reader.feed(page)
    reader.close()
    lines = (" ".join(line.split()) for line in "".join(reader.text).split("\n"))
    return "\n".join(line for line in lines if line)


def test_text_of_given_pages(spark, sf_dir):
    """Both records of every page against the standard library's parsers of HTML and of headers."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html_of = {r.page_id: (r.url, r.html) for r in pages.collect()}
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 2 * len(html_of)
    for row in rows:
        url, page = html_of[row.page_id]
        head, _, block = bytes(row.record).partition(b"\r\n\r\n")
        headers = BytesParser().parsebytes(head.partition(b"\r\n")[2])
        assert headers["WARC-Target-URI"] == url and headers["WARC-Refers-To"] == row.refers_to
        assert headers["WARC-Source-Payload-Digest"] == warc.digest(page.encode()) and len(block) == int(headers["Content-Length"])
        if row.type == "conversion":
            assert block.decode() == _shown(page)
        else:
            fields = BytesParser().parsebytes(block)
            assert fields["warc-header-warc-type"] == "response" and fields["http-header-content-length"] == str(len(page.encode()))


@pytest.mark.parametrize("unit", ["<!--", "<script>", "<head>", "<a", "<p", "</script ", "<title>", "<title", "<!-- -->", "<b>x</b>", "&amp", "<", "<script></style>"])
def test_time_is_in_proportion(unit):
    def seconds(size: int) -> float:
        page = unit * (size // len(unit))
        began = time.process_time()
        warc.plain_text(page)
        warc.title_of(page)
        return time.process_time() - began

    small, large = min(seconds(1 << 18) for _ in range(2)), seconds(1 << 22)
    assert large < 16 * 4 * max(small, 0.02)


def test_unclosed_parts_are_kept_as_text():
    assert warc.plain_text("a <!-- b") == "a <!-- b"
    assert warc.plain_text("a <!-- b > c") == "a c"
    assert warc.plain_text("a<script>x</SCRIPT >b<style>y") == "a by"
    assert warc.plain_text("1 < 2 <i>and</i> 3 <4") == "1 < 2 and 3 <4"
    assert warc.plain_text("<header>h</header><headline>t") == "h\nt"
    assert warc.title_of("<title>a <b>c</b></title>") == "a c" and warc.title_of("<title>x") == ""


def test_line_breaks_in_urls_stay_in_their_header(spark, tmp_path):
    urls = ["http://a/\r\nWARC-Type: warcinfo", "http://a/\r\n\r\nx", "http://a/\nb\x00", " http://a/ ", "http://ä/ü"]
    pages = spark.createDataFrame([(i, url, "<p>t") for i, url in enumerate(urls)], "page_id long, url string, html string")
    warc.write_warc(warc.responses(pages), str(tmp_path / "in"))
    rows = warc.derivatives(warc.read_warc(spark, str(tmp_path / "in"))).collect()
    assert sorted({r.target_uri for r in rows}) == sorted(
        ["http://a/%0D%0AWARC-Type: warcinfo", "http://a/%0D%0A%0D%0Ax", "http://a/%0Ab%00", "%20http://a/%20", "http://ä/ü"]
    )
    warc.write_warc(warc.derivatives(warc.read_warc(spark, str(tmp_path / "in"))), str(tmp_path / "out"))
    again = warc.read_warc(spark, str(tmp_path / "out")).collect()
    assert sorted(bytes(r.record) for r in again) == sorted(bytes(r.record) for r in rows) and len(rows) == 2 * len(urls)


def _response(http: str, payload: bytes) -> bytes:
    block = f"HTTP/1.1 200 OK\r\n{http}\r\n".encode() + payload
    extra = [("WARC-IP-Address", "1.2.3.4"), ("WARC-Concurrent-To", "<urn:x>"), ("WARC-Truncated", "length")]
    return warc.make_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:r>"), *extra], block)


def test_encodings_are_undone():
    page = "<p>straße</p>" * 50
    raw = zlib.compressobj(wbits=-15)
    packed = gzip.compress(page.encode())
    chunked = b"".join(b"%x;q=1\r\n%s\r\n" % (len(packed[i : i + 20]), packed[i : i + 20]) for i in range(0, len(packed), 20)) + b"0\r\n\r\n"
    cases = [
        ("Content-Encoding: gzip\r\n", packed), ("Content-Encoding: deflate\r\n", zlib.compress(page.encode())),
        ("Content-Encoding: deflate\r\n", raw.compress(page.encode()) + raw.flush()), ("", page.encode()),
        ("Content-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n", chunked), ("Content-Encoding: GZIP, identity\r\n", packed),
    ]
    for http, payload in cases:
        metadata, conversion = warc._derivatives_of(_response(http, payload))
        assert conversion["block"] == "\n".join(["straße"] * 50)
        assert "warc-header-warc-ip-address: 1.2.3.4\r\n" in metadata["block"] and "warc-header-warc-truncated: length" in metadata["block"]
        assert conversion["source_payload_digest"] == warc.digest(payload)
    assert [d["type"] for d in warc._derivatives_of(_response("Content-Encoding: gzip\r\n", b"no gzip"))] == ["metadata", "conversion"]


@pytest.mark.parametrize("packed", ["plain", "one member", "member a record"])
def test_files_are_read_piece_by_piece(packed, monkeypatch):
    draw = random.Random(1)
    records = [warc.make_record([("WARC-Type", "resource")], draw.randbytes(draw.choice((0, 1, 10, 5000)))) for _ in range(60)]
    whole = b"".join(r + b"\r\n\r\n" for r in records)
    content = {"plain": whole, "one member": gzip.compress(whole), "member a record": b"".join(gzip.compress(r + b"\r\n\r\n") for r in records)}[packed]
    pieces = warc._pieces
    for size in (7, 100, 1 << 20):
        monkeypatch.setattr(warc, "_pieces", lambda content, size=size: pieces(content, size))
        assert list(warc._split(content)) == records
    with pytest.raises(ValueError, match="no record begins"):
        list(warc._split(whole + b"junk"))
