"""WARC derivatives (operator 8): responses become linked metadata and conversion records.

Input are response records as bytes (WARC headers, HTTP head, payload), as they lie in a
WARC file (``records_of_files``) or as made from a table of pages (``response_records``).
Each gives a ``metadata`` record (JSON: the source's WARC headers as they are, HTTP status
and headers, title, links) and, for HTML and plain text, a ``conversion`` record (the plain
text).  Both refer to the response by its own ``WARC-Record-ID``, repeat its target URI and
date and have their own block digest; the source's digests are carried over and checked
against its bytes (``digests_ok``).  Record ids are UUIDs made from the response's id and
the kind, so a re-run task writes the same records.  The conversion is a narrow map.

Markup is read in one forward pass over ``<``, ``>`` and quotes, so a page takes time in
proportion to its length whatever it holds.

Defined cases: a null page body is an empty payload; a null URL gives records without a
target URI; control characters in header values are percent-encoded; equal rows of pages
are different responses with different ids; a record of another type than response has no
derivatives; bytes that are no WARC record (null too) give one ``invalid`` row that says why;
other payloads than HTML and plain text have no conversion; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import sys as _sys
import uuid

import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import column, text_slices

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

# Fixed values of the format.
VERSION = "WARC/1.0"
DATE = "2024-01-01T00:00:00Z"
RESPONSE_TYPE = "application/http; msgtype=response"

# Fixed values of HTML: elements without visible text, elements that end a line, elements with links.
HIDDEN = ("script", "style", "noscript", "template")
BREAKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr td th table article section header footer nav main title head body blockquote pre".split())
LINKED = frozenset("a area link img script iframe source".split())

MARK = re.compile("[>\"']")
NAME = re.compile(r"/?\s*([a-zA-Z][a-zA-Z0-9]*)")
URL = re.compile(r"""[\s"'](?:href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*HIDDEN, "title")}
SPACES = re.compile(r"[ \t\r\f\v ]+")
CONTROL = re.compile("[\x00-\x1f\x7f]")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
FAR = 1 << 16  # characters within which a quoted value of a tag must end

SCHEMA = (
    "page_id bigint, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length bigint, block_digest string, source_block_digest string, source_payload_digest string, digests_ok boolean, block string"
)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def header_value(value: str) -> str:
    """A value on one header line."""
    return CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


# --- markup --------------------------------------------------------------------------


def tag_end(page: str, at: int) -> int:
    """The place of the ``>`` that closes the tag opened at ``at``, past quoted values that end
    within ``FAR`` characters; the next ``>`` at all if there is none; -1 without any."""
    pos, limit = at + 1, at + FAR
    while (m := MARK.search(page, pos, limit)) is not None:
        if m[0] == ">":
            return m.start()
        close = page.find(m[0], m.end(), limit)
        if close < 0:
            break
        pos = close + 1
    return page.find(">", at + 1)


def markup(page: str):
    """(kind, text) of a page in one pass: ``text``, ``hidden``, ``break`` for an element that
    ends a line, ``tag`` for any other; then for links ``link`` (name, value) and for the
    first title ``title``."""
    at, titled = 0, False
    while True:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        nxt = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            yield "hidden", ""
            if end < 0:
                return
            at = end + 3
        elif nxt and (nxt in "/!?" or nxt.isascii() and nxt.isalpha()):
            end = tag_end(page, lt)
            if end < 0:  # no tag can close any more
                yield "text", page[lt:]
                return
            inside = page[lt + 1 : end]
            at = end + 1
            m = NAME.match(inside)
            name = m[1].lower() if m else ""
            opening = bool(m) and not inside.startswith("/")
            yield ("break" if name in BREAKS else "tag"), name
            if opening and name in LINKED and (u := URL.search(inside)):
                yield "link", (name, html.unescape(u[1] or u[2] or u[3] or ""))
            if opening and name == "title" and not titled:
                titled = True
                close = ENDS["title"].search(page, at)
                if close:
                    yield "title", html.unescape("".join(t for k, t in markup(page[at : close.start()]) if k == "text")).strip()
            if opening and name in HIDDEN and not inside.endswith("/"):
                close = ENDS[name].search(page, at)
                yield "hidden", ""
                if not close:
                    return
                at = close.end()
        else:
            yield "text", "<"
            at = lt + 1


def described(page: str) -> tuple[str, str | None, list[dict]]:
    """(plain text, title, links): visible text with one block element per line, blank lines
    and outer spaces removed."""
    out, title, links = [], None, []
    for kind, value in markup(page):
        if kind == "text":
            out.append(value)
        elif kind == "break":
            out.append("\n")
        elif kind == "hidden":
            out.append(" ")
        elif kind == "link":
            links.append({"path": value[0], "url": value[1]})
        elif kind == "title":
            title = value
    lines = (SPACES.sub(" ", x).strip() for x in html.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x), title, links


# --- records -------------------------------------------------------------------------


def serialised(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """The bytes of one record (headers, block, two line ends)."""
    head = "".join(f"{k}: {header_value(v)}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes):
    """(headers, block) of every record in ``data``; ValueError where there is none."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        first, *lines = data[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not first.startswith("WARC/"):
            raise ValueError("no WARC record")
        headers = dict((x.split(":", 1)[0].strip(), x.split(":", 1)[1].strip()) for x in lines if ":" in x)
        size = next((v for k, v in headers.items() if k.lower() == "content-length"), "")
        if not size.isdigit() or end + 4 + int(size) > len(data):
            raise ValueError("bad length of a WARC record")
        start = end + 4
        yield headers, data[start : start + int(size)]
        at = start + int(size)
        while data.startswith(b"\r\n", at):
            at += 2


def response_of(uri: str | None, date: str, name: str, body: bytes) -> bytes:
    """A response record of a page."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    digests = [("WARC-Block-Digest", sha1(block)), ("WARC-Payload-Digest", sha1(body))]
    return serialised([("WARC-Type", "response"), ("WARC-Record-ID", record_id(name)), ("WARC-Target-URI", uri), ("WARC-Date", date), *digests, ("Content-Type", RESPONSE_TYPE)], block)


def response_records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """page_id and record (bytes) of a table of raw pages (page_id, url, html).  Equal rows are
    numbered; only they are shuffled."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    rows = rows.withColumn("k", F.xxhash64("page_id", "url", "html"))
    again = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
    if again.isEmpty():
        rows = rows.withColumn("copy", F.lit(0))
    else:
        equal = Window.partitionBy("page_id", "url", F.md5("html")).orderBy("k")
        alone = rows.join(again, "k", "left_anti").withColumn("copy", F.lit(0))
        rows = alone.unionByName(rows.join(again, "k", "left_semi").withColumn("copy", F.row_number().over(equal) - 1))

    def work(batches):
        for part in text_slices(batches, "html"):
            records = []
            for page, uri, body, copy in zip(*(column(part, c).to_pylist() for c in ("page_id", "url", "html", "copy"))):
                data = (body or "").encode()
                name = f"response:{page}:{uri}:{sha1(data)}" + (f":{copy}" if copy else "")
                records.append(response_of(uri, date, name, data))
            yield pa.RecordBatch.from_arrays([column(part, "page_id"), pa.array(records, pa.binary())], names=["page_id", "record"])

    return rows.select("page_id", "url", "html", "copy").mapInArrow(work, "page_id bigint, record binary")


def records_of_files(files: DataFrame) -> DataFrame:
    """page_id (NULL) and record of the records in WARC files, given as a ``binaryFile`` scan of
    uncompressed files; a file that is no WARC from some place on gives its rest as one record."""

    def work(batches):
        for part in text_slices(batches, "content"):
            for data in column(part, "content").to_pylist():
                records, rest = [], data or b""
                try:
                    for headers, block in parse(rest):
                        records.append(serialised([(k, v) for k, v in headers.items() if k.lower() != "content-length"], block))
                except ValueError:
                    done = sum(map(len, records))
                    records.append(rest[done:])
                yield pa.RecordBatch.from_arrays([pa.nulls(len(records), pa.int64()), pa.array(records, pa.binary())], names=["page_id", "record"])

    return files.select("content").mapInArrow(work, "page_id bigint, record binary")


def digest_ok(declared: str | None, data: bytes) -> bool | None:
    """Whether a declared digest is that of the data; None if it is absent or of another kind."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return None
    found = hashlib.new(kind.lower(), data)
    return value.upper() in (base64.b32encode(found.digest()).decode().rstrip("="), base64.b32encode(found.digest()).decode(), found.hexdigest().upper())


def derived(data: bytes | None) -> list[tuple]:
    """The derivative rows of one record, without page_id."""
    try:
        headers, block = next(parse(data or b""), (None, b""))
        if headers is None:
            raise ValueError("no WARC record")
    except ValueError as problem:
        return [("invalid", None, None, None, None, None, None, None, None, None, None, str(problem))]
    get = {k.lower(): v for k, v in headers.items()}.get
    if get("warc-type") != "response":
        return []
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *fields = head.decode("utf-8", "replace").split("\r\n")
    http = dict((x.split(":", 1)[0].strip(), x.split(":", 1)[1].strip()) for x in fields if ":" in x)
    kind = next((v for k, v in http.items() if k.lower() == "content-type"), "text/html")
    charset = CHARSET.search(kind)
    try:
        page = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    is_html, is_text = "html" in kind.lower(), kind.lower().startswith("text/plain")
    text, title, links = described(page) if is_html else (page, None, [])
    envelope = {
        "Format": "WARC",
        "WARC-Header-Metadata": headers,
        "Payload-Metadata": {"HTTP-Response-Metadata": {"Response-Message": status, "Headers": http, "HTML-Metadata": {"Title": title, "Links": links}}},
    }
    made = [("metadata", "application/json", json.dumps({"Envelope": envelope}, ensure_ascii=False))]
    if is_html or is_text:
        made.append(("conversion", "text/plain", text))
    checks = [c for c in (digest_ok(get("warc-block-digest"), block), digest_ok(get("warc-payload-digest"), payload)) if c is not None]
    of, rows = get("warc-record-id"), []
    for record_type, content_type, body in made:
        raw = body.encode("utf-8", "replace")
        rows.append(
            (record_type, record_id(f"{record_type}:{of}"), of, get("warc-target-uri"), get("warc-date"), content_type, len(raw), sha1(raw),
             get("warc-block-digest"), get("warc-payload-digest"), all(checks) if checks else None, raw.decode())
        )
    return rows


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response record (page_id, record)."""

    def work(batches):
        types = [pa.int64(), *[pa.string()] * 6, pa.int64(), *[pa.string()] * 3, pa.bool_(), pa.string()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for part in text_slices(batches, "record"):
            rows = [(page, *row) for page, data in zip(column(part, "page_id").to_pylist(), column(part, "record").to_pylist()) for row in derived(data)]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return records.select(F.col("page_id").cast("bigint").alias("page_id"), "record").mapInArrow(work, SCHEMA)


def warc_bytes(records: DataFrame) -> DataFrame:
    """page_id, record_type and the serialised record (binary) of derivatives, ready for a file."""

    def work(batches):
        for part in text_slices(batches, "block"):
            data = []
            for r in part.to_pylist():
                fields = [
                    ("WARC-Type", r["record_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Refers-To", r["refers_to"]), ("WARC-Target-URI", r["target_uri"]),
                    ("WARC-Date", r["warc_date"]), ("WARC-Block-Digest", r["block_digest"]), ("Content-Type", r["content_type"]),
                ]
                data.append(serialised(fields, r["block"].encode()))
            yield pa.RecordBatch.from_arrays([column(part, "page_id"), column(part, "record_type"), pa.array(data, pa.binary())], names=["page_id", "record_type", "record"])

    return records.where("record_type <> 'invalid'").mapInArrow(work, "page_id bigint, record_type string, record binary")
