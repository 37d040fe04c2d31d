"""WARC responses and the records derived from them: metadata and plain-text conversions."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .page_text import INLINE

#: Names of the WARC 1.1 format.
VERSION = "WARC/1.1"
SPACE = uuid.NAMESPACE_URL


#: What is no text: comments, declarations, the contents of scripts and the like.  Head has no end tag on many pages,
#: and holds nothing else.
DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|title|noscript|template|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.S | re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
REST = r"[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*>"  # of a tag; a quoted > does not end it
WITHIN = re.compile(rf"</?(?:{'|'.join(sorted(INLINE - {'br', 'img'}))})(?:\s{REST}|>)", re.I)
TAG = re.compile(rf"</?[a-zA-Z]{REST}|</?[a-zA-Z][^>]*>")
META = re.compile(rb"<meta[^>]*?charset\s*=\s*[\"']?\s*([a-zA-Z0-9_.:-]+)", re.I)
CHARSET = re.compile(r"charset\s*=\s*[\"']?([a-zA-Z0-9_.:-]+)", re.I)


def plain(source: str) -> tuple[str, str]:
    """Title, and the visible blocks of a page, one a line."""
    found = TITLE.search(source)
    title = " ".join(html.unescape(found[1]).split()) if found else ""
    body = DROP.sub(" ", source).replace("\n", " ")  # line breaks of the source are spaces
    lines = TAG.sub("\n", WITHIN.sub("", body)).split("\n")
    return title, "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in lines) if x)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; folded and malformed lines are kept out."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode(errors="replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):  # unknown: all but the two line ends that close a record
        return fields, rest.removesuffix(b"\r\n\r\n")
    return fields, rest[: int(size)]


def _unchunked(body: bytes) -> bytes | None:
    """A chunked body's payload, None if it is malformed."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        digits = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", digits):
            return None
        size = int(digits, 16)
        if size == 0:
            return b"".join(parts)
        if end + 2 + size > len(body):
            return None
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def decoded(lines: list[str], body: bytes) -> tuple[bytes, str, list[str]]:
    """Payload without transfer coding, its text, and what could not be decoded (taken as it is then)."""
    headers = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
    problems = []
    if "chunked" in headers.get("transfer-encoding", "").lower():
        whole = _unchunked(body)
        body, problems = (body, ["transfer-encoding"]) if whole is None else (whole, [])
    payload, coding = body, headers.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip", "deflate"):
        for bits in (47, -15):  # with gzip's or zlib's head, or bare
            try:
                body = zlib.decompress(body, bits)
                break
            except zlib.error:
                continue
        else:
            problems.append("content-encoding")
    elif coding not in ("", "identity"):
        problems.append("content-encoding")
    found = CHARSET.search(headers.get("content-type", ""))
    meta = META.search(body[:2048])
    charset = found[1] if found else meta[1].decode() if meta else "utf-8"
    try:
        return payload, body.decode(charset, errors="replace"), problems
    except (LookupError, ValueError):
        return payload, body.decode(errors="replace"), [*problems, "charset"]


def _id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(0).join(parts))}>"


def _line(url: str | None) -> str:
    """A header value: line breaks would end the header."""
    return " ".join((url or "").split())


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """page_id and record: a response record per page, its id made from page_id, url and body.

    Null html is an empty body, a null url an empty target.  Equal rows are one record and have one id.
    """

    def build(batches):
        for batch in batches:
            out = []
            for page, url, source in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                body = (source or "").encode()
                block = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                    + body
                )
                digest = sha1(body)
                out.append(record([
                    ("WARC-Type", "response"), ("WARC-Record-ID", _id(str(page), _line(url), digest)), ("WARC-Date", date),
                    ("WARC-Target-URI", _line(url)), ("Content-Type", "application/http; msgtype=response"),
                    ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", sha1(block)),
                ], block))
            yield batch.select(["page_id"]).append_column("record", pa.array(out, pa.binary()))

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(build, f"page_id {kind}, record binary")


def derive(records: DataFrame) -> DataFrame:
    """Two records of every response: metadata (fetch fields) and conversion (plain text).

    Columns: page_id, record_type, record_id, refers_to, target_uri, date,
    payload_digest (the response's, preserved), block_digest, n_bytes (of the block),
    record (the bytes).  Both records name the response in WARC-Refers-To, its target and
    date, and each other in WARC-Concurrent-To; the metadata lists the response's HTTP status,
    headers and digests, whether its payload digest holds, and what could not be decoded: a length that is no
    number (the record's rest is taken), a chunked or compressed body, an unknown charset.  Rows whose record is null, or that are no
    responses, give no record.  The plain text is every visible block, furniture included.
    """

    def build(batches):
        for batch in batches:
            rows, source = [], []
            for i, data in enumerate(batch.column("record").to_pylist()):
                fields, block = parse(data) if data else ({}, b"")
                if fields.get("warc-type") != "response":
                    continue
                head, _, body = block.partition(b"\r\n\r\n")
                status, *lines = head.decode(errors="replace").split("\r\n")
                origin = fields.get("warc-record-id", "")
                target, date = fields.get("warc-target-uri", ""), fields.get("warc-date", "")
                payload = fields.get("warc-payload-digest")
                payload_bytes, source_text, problems = decoded(lines, body)
                length = fields.get("content-length", "")
                if not (length.isascii() and length.isdigit()):
                    problems.append("content-length")
                title, text = plain(source_text)
                text = text.encode(errors="replace")
                notes = [
                    ("http-status", status), *(("http-header", line) for line in lines), ("payload-digest", payload or ""),
                    ("payload-digest-holds", str(payload in (sha1(body), sha1(payload_bytes))).lower()), ("source-block-digest", fields.get("warc-block-digest", "")),
                    ("source-content-type", fields.get("content-type", "")), ("title", title), ("text-bytes", str(len(text))), *(("not-decoded", x) for x in problems),
                ]
                blocks = {
                    "metadata": ("application/warc-fields", "".join(f"{a}: {b}\r\n" for a, b in notes).encode()),
                    "conversion": ("text/plain; charset=utf-8", text),
                }
                ids = {kind: _id(origin, kind) for kind in blocks}
                for (kind, (form, made)), other in zip(blocks.items(), reversed(ids.values())):
                    whole = record([
                        ("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", date), ("WARC-Refers-To", origin),
                        ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", target),
                        ("WARC-Concurrent-To", other), ("WARC-Payload-Digest", payload if kind == "metadata" else None),
                        ("WARC-Block-Digest", sha1(made)), ("Content-Type", form),
                    ], made)
                    source.append(i)
                    rows.append((kind, ids[kind], origin, target, date, payload, sha1(made), len(made), whole))
            columns = list(zip(*rows)) or [[]] * 9
            kinds = [pa.string()] * 7 + [pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["page_id", "record_type", "record_id", "refers_to", "target_uri", "date", "payload_digest",
                 "block_digest", "n_bytes", "record"],
            )

    shape = "record_type string, record_id string, refers_to string, target_uri string, date string, payload_digest string"
    return records.select("page_id", "record").mapInArrow(
        build,
        f"page_id {records.schema['page_id'].dataType.simpleString()}, {shape}, block_digest string, n_bytes long, record binary",
    )

