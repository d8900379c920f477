"""WARC derivatives: from each response a linked metadata record and a plain-text conversion record.

Records are WARC/1.1 bytes in a column. A derivative has an id of its own, made from its source's id and its type,
names its source in WARC-Refers-To, and keeps the source's target, date and digests in its head. The metadata record
lists all WARC and HTTP headers of the source as fields, the conversion record holds the page's text. Transfer and
content encodings (chunked, gzip, deflate) are undone first; a body in another encoding is read as it stands. Pages are
read in one pass, in time in proportion to their length.

Files are written by Spark's text writer, with the blank lines that end a record as separator, and read by one task
each, as a gzip stream can't be split: piece by piece, so that a task holds the packed file and one record.

Defined results: a null url gives records without a target; line breaks and other controls in a header's value, and
blanks at its ends, are written as ``%0A`` and the like, so that a head stays one; a null or empty page gives an empty
text; records other than responses have no derivatives; a response whose HTTP head doesn't end has headers only; repeated
rows give repeated records with equal ids; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
_ENDS = "\r\n\r\n"

#: Elements that a reader doesn't see, and those that stand on lines of their own.
_UNSEEN = ("script", "style", "noscript", "template", "head")
_BREAKS = {
    "p", "div", "br", "hr", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "header",
    "footer", "nav", "aside", "main", "blockquote", "pre", "body", "html",
}
_TAG = re.compile(r"<(/?)([a-zA-Z!?][^\s/<>]*)")
_ENDS_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*_UNSEEN, "title")}
_TITLE = re.compile(r"<title(?:\s[^<>]*)?>", re.I)
_CONTROL = re.compile(r"[\x00-\x1f\x7f]|^ +| +$")
_CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def derived_id(source_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source_id} {kind}')}>"


def make_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without the blank lines that follow it. Headers without a value are left out."""
    lines = [VERSION, *(f"{name}: {one_line(value)}" for name, value in headers if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def one_line(value: str) -> str:
    """The value with what would end its line, or be lost at its ends, percent-encoded."""
    return _CONTROL.sub(lambda found: "".join(f"%{ord(c):02X}" for c in found[0]), value)


def parse_head(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    """The first line of a WARC or HTTP head, and its headers in order; folded lines are joined."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return first, headers


def header(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((value for key, value in headers if key.lower() == name.lower()), None)


def plain_text(page: str) -> str:
    """What a reader sees: no scripts, styles, comments or head; blocks on lines of their own."""
    lines = (" ".join(line.split()) for line in html.unescape("".join(_seen(page))).split("\n"))
    return "\n".join(line for line in lines if line)


def _seen(page: str) -> Iterator[str]:
    """The page without tags, in one pass.

    An end that was once looked for in vain is not looked for again, so each character is passed a fixed number of times.
    """
    at, missing = 0, set()

    def end_of(what: str, begin: int) -> int:
        """Behind the next end of an element, comment or tag; -1 if there is none."""
        if what in missing:
            return -1
        if what in _ENDS_OF:
            found = _ENDS_OF[what].search(page, begin)
            end = found.end() if found else -1
        else:
            end = page.find(what, begin)
            end = end + len(what) if end >= 0 else -1
        if end < 0:
            missing.add(what)
        return end

    while (i := page.find("<", at)) >= 0:
        yield page[at:i]
        if page.startswith("<!--", i) and (end := end_of("-->", i + 4)) >= 0:
            yield " "
            at = end
            continue
        tag = _TAG.match(page, i)
        name = tag[2].lower() if tag else ""
        if tag and not tag[1] and name in _UNSEEN and (end := end_of(name, i)) >= 0:
            yield " "
            at = end
            continue
        if not tag or (end := end_of(">", i)) < 0:
            yield "<"
            at = i + 1
            continue
        if name in _BREAKS:
            yield "\n"
        at = end
    yield page[at:]


def title_of(page: str) -> str:
    begin = _TITLE.search(page)
    end = _ENDS_OF["title"].search(page, begin.end()) if begin else None
    return " ".join(html.unescape("".join(_seen(page[begin.end() : end.start()]))).split()) if end else ""


def decoded(payload: bytes, http: list[tuple[str, str]]) -> bytes:
    """The body as the page was before it was packed for the way; what can't be unpacked stays as it is."""
    codings = []
    for name in ("Content-Encoding", "Transfer-Encoding"):
        codings += [c.strip().lower() for key, value in http if key.lower() == name.lower() for c in value.split(",")]
    for coding in reversed(codings):
        try:
            if coding == "chunked":
                payload = _unchunked(payload)
            elif coding in ("gzip", "x-gzip"):
                payload = _unpacked(payload, 31)
            elif coding == "deflate":
                payload = _unpacked(payload, 15 if payload[:1] == b"\x78" else -15)
        except (zlib.error, ValueError):
            return payload
    return payload


def _unpacked(payload: bytes, bits: int) -> bytes:
    """All members of a packed stream; of one that is cut off, what is there."""
    parts = []
    while payload:
        stream = zlib.decompressobj(bits)
        parts.append(stream.decompress(payload))
        payload = stream.unused_data
    return b"".join(parts)


def _unchunked(payload: bytes) -> bytes:
    parts, at = [], 0
    while (end := payload.find(b"\r\n", at)) >= 0:
        size = int(payload[at:end].partition(b";")[0].strip() or b"x", 16)
        if size == 0:
            break
        parts.append(payload[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(parts)


def _response(page_id: int | None, url: str | None, page: str | None, date: str) -> bytes:
    payload = (page or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    return make_record(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", derived_id(f"{page_id} {url} {digest(block)}", "response")),
            ("WARC-Date", date),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", digest(payload)),
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        block,
    )


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """page_id and record: each page as the response a crawler would have stored."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                rows = zip(*(part.column(name).to_pylist() for name in ("page_id", "url", "html")), strict=True)
                records = [_response(*row, date) for row in rows]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(records, pa.binary())], names=["page_id", "record"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(build, "page_id long, record binary")


def _parts(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


#: Headers of the source that its derivatives name otherwise.
_NAMED = {"warc-record-id", "warc-block-digest", "warc-payload-digest"}


def _derivatives_of(record: bytes) -> Iterator[dict]:
    head, _, block = record.partition(b"\r\n\r\n")
    _, headers = parse_head(head)
    if header(headers, "WARC-Type") != "response":
        return
    http_head, _, payload = block.partition(b"\r\n\r\n")
    status, http = parse_head(http_head)
    body = decoded(payload, http)
    kind = header(http, "Content-Type") or ""
    charset = _CHARSET.search(kind)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    source_id = header(headers, "WARC-Record-ID") or ""
    kept = {
        "refers_to": source_id,
        "target_uri": header(headers, "WARC-Target-URI"),
        "source_block_digest": header(headers, "WARC-Block-Digest") or digest(block),
        "source_payload_digest": header(headers, "WARC-Payload-Digest") or digest(payload),
        "source_status": status,
        "source_content_type": kind,
    }
    fields = [
        ("source-record-id", source_id),
        ("source-block-digest", kept["source_block_digest"]),
        ("source-payload-digest", kept["source_payload_digest"]),
        ("http-status", status),
        *((f"warc-header-{name.lower()}", value) for name, value in headers if name.lower() not in _NAMED),
        *((f"http-header-{name.lower()}", value) for name, value in http),
        ("title", title_of(page)),
    ]
    text = plain_text(page).encode()
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{name}: {one_line(value)}\r\n" for name, value in fields).encode()),
        "conversion": ("text/plain; charset=utf-8", text),
    }
    for name, (content_type, content) in blocks.items():
        own = derived_id(source_id, name)
        built = make_record(
            [
                ("WARC-Type", name),
                ("WARC-Record-ID", own),
                ("WARC-Date", header(headers, "WARC-Date")),
                ("WARC-Refers-To", source_id),
                ("WARC-Target-URI", kept["target_uri"]),
                ("WARC-Source-Block-Digest", kept["source_block_digest"]),
                ("WARC-Source-Payload-Digest", kept["source_payload_digest"]),
                ("WARC-Block-Digest", digest(content)),
                ("Content-Type", content_type),
            ],
            content,
        )
        yield kept | {
            "type": name, "record_id": own, "content_type": content_type, "content_length": len(content),
            "block_digest": digest(content), "block": content.decode("utf-8", "replace"), "record": built,
        }


_DERIVED = pa.schema(
    [("page_id", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
     ("target_uri", pa.string()), ("source_status", pa.string()), ("source_content_type", pa.string()),
     ("source_block_digest", pa.string()), ("source_payload_digest", pa.string()), ("content_type", pa.string()),
     ("content_length", pa.int64()), ("block_digest", pa.string()), ("block", pa.string()), ("record", pa.binary())]
)
_DERIVED_DDL = ", ".join(
    f"{f.name} {({pa.int64(): 'long', pa.string(): 'string', pa.binary(): 'binary'})[f.type]}" for f in _DERIVED
)


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response in ``record``: its metadata and its conversion, with a page_id if the input has one."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                columns = zip(part.column("page_id").to_pylist(), part.column("record").to_pylist(), strict=True)
                rows = [{"page_id": page_id} | d for page_id, record in columns if record for d in _derivatives_of(record)]
                yield pa.RecordBatch.from_pylist(rows, schema=_DERIVED)

    page_id = F.col("page_id") if "page_id" in records.columns else F.lit(None)
    return records.select(page_id.cast("long").alias("page_id"), "record").mapInArrow(build, _DERIVED_DDL)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files with the rows of ``record``, one file for each partition."""
    rows = records.filter(F.col("record").isNotNull()).select(F.col("record").cast("string").alias("value"))
    rows.write.option("lineSep", _ENDS).option("compression", compression).text(path)


def _pieces(content: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The file's bytes, unpacked member by member, in pieces of a bounded size."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[at : at + size] for at in range(0, len(content), size))
        return
    at, stream = 0, zlib.decompressobj(31)
    while at < len(content) or stream.unconsumed_tail:
        packed = stream.unconsumed_tail or content[at : at + size]
        at += 0 if stream.unconsumed_tail else len(packed)
        yield stream.decompress(packed, size)
        if stream.eof:
            at -= len(stream.unused_data)
            stream = zlib.decompressobj(31)
    yield stream.flush()


def _split(content: bytes) -> Iterator[bytes]:
    """The records of a file, of which no more than one and a piece is held."""
    held, seen, at = bytearray(), 0, 0
    pieces = _pieces(content)

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while held[at : at + 2] == b"\r\n":  # between records
            at += 2
        del held[:at]
        seen, at = seen + at, 0
        if len(held) < 2 or held[:2] == b"\r\n":
            if more():
                continue
            if not held:
                return
        looked = 0
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not more():
                break
        if not held.startswith(b"WARC/") or end < 0:
            raise ValueError(f"no record begins at byte {seen}")
        _, headers = parse_head(bytes(held[:end]))
        at = end + 4 + int(header(headers, "Content-Length") or 0)
        while len(held) < at and more():
            pass
        yield bytes(held[:at])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """path and record of every record in the WARC files under a folder or pattern."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                some: list[bytes] = []
                for record in _split(content):
                    some.append(record)
                    if len(some) == 1000:
                        yield pa.RecordBatch.from_pydict({"path": [name] * len(some), "record": some})
                        some = []
                if some:
                    yield pa.RecordBatch.from_pydict({"path": [name] * len(some), "record": some})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, "path string, record binary")
