"""Derivative records of web archives: metadata and plain text linked to responses.

A response record keeps the HTTP message as it was served.  The builder makes, for
each response, one `metadata` record (a JSON summary of the envelope, the HTTP
headers, the page's title and links) and one `conversion` record (the page as plain
text).  Both refer to the response by `WARC-Refers-To`, repeat its target URI and
date, carry its payload digest in the metadata, and have digests of their own.
Record ids are named after the row's id, URL, payload digest and place in the scan, so
every row has its own and a task that runs again writes the same.

Defined cases: a null URL gives records without a target URI; a null page is a
response with an empty body, whose conversion has an empty text; repeated rows give
records of their own; nothing is cut, however long; other columns are
not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.llm import html_text

VERSION = "WARC/1.1"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard one of URLs
FETCHED = "2024-01-01T00:00:00Z"
_HREF = re.compile(r"<(a|link|img|script)\b[^>]*?\b(?:href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_BREAKS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|object|svg)\b.*?(?:</\1\s*>|\Z)"
    r"|</?(?P<tag>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.I | re.S,
)

RECORD = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, date string,"
    " content_type string, payload_digest string, block_digest string, content_length long, block binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, json.dumps(parts))}>"


def plain_text(page: str) -> str:
    """All visible text of a page, one line for each block."""
    def mark(m: re.Match[str]) -> str:
        tag = (m["tag"] or "").lower()
        return "" if tag and tag in html_text.INLINE and tag != "br" else "\x00"

    parts = _BREAKS.sub(mark, page.replace("\x00", " ")).split("\x00")
    lines = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in parts)
    return "\n".join(x for x in lines if x)


def http_message(page: str) -> bytes:
    body = page.encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body; a block without an empty line is all body.

    Headers are pairs in their order, as often as they are given, without the blanks
    around a value; a line that begins with a blank goes on with the one before.
    """
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif colon:
            headers.append((name, value.strip()))
    return status, headers, body


def responses(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = FETCHED
) -> DataFrame:
    """One response record for each page row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, page, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = http_message(page or "")
                payload = digest(split_http(block)[2])
                rows.append((
                    page_id, "response", record_id("response", page_id, url, date, payload, place), None, url, date,
                    "application/http; msgtype=response", payload, digest(block), len(block), block,
                ))
            yield _batch(rows)

    return pages.select(
        F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"),
        F.monotonically_increasing_id(),  # the row's place in the scan
    ).mapInArrow(run, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response among the records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                block = r["block"] or b""
                status, headers, body = split_http(block)
                page = body.decode("utf-8", "replace")
                title = _TITLE.search(page)
                about = {
                    "envelope": {
                        "record-id": r["record_id"], "target-uri": r["target_uri"], "date": r["date"],
                        "payload-digest": r["payload_digest"], "block-digest": r["block_digest"],
                        "content-length": len(block), "content-type": r["content_type"],
                    },
                    "http": {"status": status, "headers": [{"name": k, "value": v} for k, v in headers]},
                    "html": {
                        "title": re.sub(r"\s+", " ", html.unescape(title[1])).strip() if title else None,
                        "links": [
                            {"element": m[0].lower(), "url": html.unescape(m[1] or m[2] or m[3])}
                            for m in _HREF.findall(page)
                        ],
                    },
                }
                for kind, media, out in (
                    ("metadata", "application/json", json.dumps(about, ensure_ascii=False).encode()),
                    ("conversion", "text/plain", plain_text(page).encode()),
                ):
                    rows.append((
                        r["page_id"], kind, record_id(kind, r["record_id"]), r["record_id"], r["target_uri"],
                        r["date"], media, r["payload_digest"], digest(out), len(out), out,
                    ))
            yield _batch(rows)

    found = records.filter(F.col("record_type") == "response")
    return found.select(*[c.split()[0] for c in RECORD.split(", ")]).mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = [c.split() for c in RECORD.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, names, strict=True)],
        names=[n for n, _ in names],
    )


def to_bytes(record: dict) -> bytes:
    """One record in WARC form."""
    fields = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]),
        ("WARC-Date", record["date"]), ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Refers-To", record["refers_to"]), ("WARC-Payload-Digest", record["payload_digest"]),
        ("WARC-Block-Digest", record["block_digest"]), ("Content-Type", record["content_type"]),
        ("Content-Length", len(record["block"])),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + record["block"] + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[dict]:
    """The records of a file as dictionaries of headers, with the block under `block`."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers | {"block": data[start:stop]}
        at = stop + 4


def write(records: DataFrame, path: str) -> None:
    """Records as compressed members, one row each, in Parquet files under `path`.

    Members of any number of rows joined in any order are a valid compressed file,
    so each executor writes its own rows and nothing is gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [gzip.compress(to_bytes(r), mtime=0) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    records.mapInArrow(run, "member binary").write.parquet(path)


def read(members: Iterable[bytes]) -> Iterator[dict]:
    """Records of compressed members."""
    for member in members:
        yield from parse(gzip.decompress(member))


def summary(records: DataFrame) -> DataFrame:
    """Records with their block as text, for reports and checks."""
    return records.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type",
        "payload_digest", "block_digest", "content_length", F.col("block").cast("string").alias("content"),
    )
