"""WARC derivatives: metadata and plain-text conversion records linked to their responses."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
RECORD = "page_id bigint, record_type string, record_id string, refers_to string, target_uri string, date string, " \
         "content_type string, block_digest string, payload_digest string, source_headers string, block binary"
NAMES = [part.split()[0] for part in RECORD.split(", ")]
#: date of responses that come without one
NO_DATE = "1970-01-01T00:00:00Z"

HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|head)\b", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "head")} | {None: re.compile("-->")}
HEAD = re.compile(r"<head\b[^>]*>", re.I)
BREAKS = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>", re.I)
TAG = re.compile(r"<[/!?a-z][^>]*>", re.I)
SPACE = re.compile(r"[^\S\n]+")
TITLE, TITLE_END = re.compile(r"<title\b[^>]*>", re.I), re.compile("</title", re.I)
ROOT, LANGUAGE = re.compile(r"<html\b[^>]*", re.I), re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
ANCHOR, ANCHOR_END = re.compile(r"<a\b", re.I), re.compile(r"</a|<a\b", re.I)
HREF, BARE = re.compile(r"\bhref\s*=\s*", re.I), re.compile(r"[^\s>]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    """An identifier that depends on the parts only, so that a repeated task gives the same."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def body(page: str) -> str:
    """The page without its head, scripts, styles and comments; what is never closed stays.

    One walk over the page: an end that was looked for in vain is not looked for again, so
    pages of unclosed tags take time in proportion to their length as well.
    """
    parts, at, missing = [], 0, set()
    for begin in HIDDEN.finditer(page):
        name = begin[1].lower() if begin[1] else None
        if begin.start() < at or name in missing:
            continue
        end = ENDS[name].search(page, begin.end())
        if end is None:
            missing.add(name)
        else:
            parts += [page[at : begin.start()], " "]
            at = end.end()
    return "".join([*parts, page[at:]])


def tags_out(pattern: re.Pattern, by: str, text: str) -> str:
    """``pattern.sub``; behind the last ``>`` no tag ends, so nothing is tried there."""
    last = text.rfind(">") + 1
    return pattern.sub(by, text[:last]) + text[last:]


def enclosed(text: str, begin: re.Pattern, end: re.Pattern) -> str | None:
    """What stands between the first tag ``begin`` and the next ``end``."""
    first = begin.search(text, 0, text.rfind(">") + 1)
    last = end.search(text, first.end()) if first else None
    return text[first.end() : last.start()] if last else None


def plain_text(page: str, shown: str | None = None) -> str:
    """The visible text: a line per block element, runs of white space as one blank. ``shown``: ``body(page)`` if known."""
    text = tags_out(TAG, "", tags_out(BREAKS, "\n", body(page) if shown is None else shown))
    lines = (SPACE.sub(" ", line).strip() for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def anchors(text: str) -> Iterator[tuple[str, str]]:
    """Address and content of the links in ``text``.

    The address is quoted or ends at a blank; the content ends with the link or where the
    next one begins. A tag without an address is passed with all that stands before its end.
    """
    last, at = text.rfind(">"), 0
    while (begin := ANCHOR.search(text, at)) and (end := text.find(">", begin.end())) >= 0:
        at = end + 1
        for given in HREF.finditer(text, begin.end(), end + 1):
            found = _address(text, given.end(), last)
            if found:
                href, behind = found
                shown = text.index(">", behind) + 1
                stop = ANCHOR_END.search(text, shown)
                at = stop.start() if stop else len(text)
                yield href, text[shown:at]
                break


def _address(text: str, at: int, last: int) -> tuple[str, int] | None:
    """The attribute's value that begins at ``at``, and where it ends; a ``>`` has to follow (``last`` is the last one)."""
    if text[at : at + 1] in ("'", '"'):
        close = text.find(text[at], at + 1)
        if 0 <= close < last:
            return text[at + 1 : close], close + 1
    bare = BARE.match(text, at)
    return (bare[0], bare.end()) if bare and bare.end() <= last else None


def metadata(page: str, uri: str, headers: dict[str, str], shown: str | None = None) -> dict:
    """Title, language and links of a page with the headers of its response. ``shown``: ``body(page)`` if known."""
    visible = body(page) if shown is None else shown
    head = enclosed(page, HEAD, ENDS["head"])
    title = enclosed(visible if head is None else body(head), TITLE, TITLE_END)
    language = next((m for m in (LANGUAGE.search(root[0], 5) for root in ROOT.finditer(page)) if m), None)
    links = []
    for address, content in anchors(visible):
        href = html.unescape(address.strip())
        try:
            href = urljoin(uri, href)
        except ValueError:
            pass
        links.append({"url": href, "text": " ".join(html.unescape(tags_out(TAG, "", content)).split())})
    return {
        "title": None if title is None else " ".join(html.unescape(tags_out(TAG, "", title)).split()),
        "language": language[1] if language else None,
        "headers": headers,
        "links": links,
    }


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = NO_DATE) -> DataFrame:
    """Response records of raw pages: an HTTP head and the page as payload, in the columns of ``RECORD``.

    A null page is an empty one, a null address stays null; rows without an id take no part.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    ).where(F.col("page_id").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = page.encode()
                headers = {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
                head = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
                block = head.encode() + payload
                out.append((page_id, "response", identifier("response", str(page_id), url or "", digest(payload)), None, url, date,
                            "application/http; msgtype=response", digest(block), digest(payload), json.dumps(headers), block))
            yield _batch(out)

    return rows.mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.string()] * 9, pa.binary()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of an HTTP response; without a head the block is the payload."""
    if not block.startswith(b"HTTP/"):
        return {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:])
    return {k.strip(): v.strip() for k, _, v in pairs if k.strip()}, payload


def derivatives(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response in ``records`` (columns of ``RECORD``).

    Both refer to the response (``refers_to``), keep its address, date and headers, and
    carry the digest of its payload as ``payload_digest`` next to that of their own block.
    Records of other types give none. A null block is an empty response; an empty page
    gives an empty text and no links; bytes that are no UTF-8 are replaced. Rows repeat as
    the responses do, with equal identifiers; other columns are ignored. Every response is
    derived where it is: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for r in batch.slice(at, 500).to_pylist():
                    headers, payload = http_parts(r["block"] or b"")
                    page = payload.decode("utf-8", "replace")
                    source, uri, shown = r["record_id"] or "", r["target_uri"], body(page)
                    kept = r["payload_digest"] or digest(payload)
                    blocks = {
                        "metadata": (json.dumps(metadata(page, uri or "", headers, shown), ensure_ascii=False).encode(), "application/json"),
                        "conversion": (plain_text(page, shown).encode(), "text/plain"),
                    }
                    for kind, (block, content_type) in blocks.items():
                        out.append((r["page_id"], kind, identifier(kind, source), r["record_id"], uri, r["date"], content_type,
                                    digest(block), kept, json.dumps(headers), block))
                yield _batch(out)

    chosen = records.where(F.col("record_type") == "response").select(*NAMES)
    return chosen.mapInArrow(run, RECORD)


def to_bytes(record: dict) -> bytes:
    """A record as it stands in a WARC file. Line ends in values are dropped."""
    block = record["block"] or b""
    fields = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Date", record["date"]),
        ("WARC-Target-URI", record["target_uri"]), ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Block-Digest", record["block_digest"]), ("WARC-Payload-Digest" if record["record_type"] == "response" else "WARC-Source-Payload-Digest", record["payload_digest"]),
        ("WARC-Source-Headers" if record["record_type"] != "response" else "", record["source_headers"]),
        ("Content-Type", record["content_type"]), ("Content-Length", str(len(block))),
    ]
    head = b"".join(f"{k}: {v}".replace("\r", "").replace("\n", "").encode() + b"\r\n" for k, v in fields if k and v is not None)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def from_bytes(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records in ``data``."""
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no record begins here")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin, size = end + 4, int(headers["Content-Length"])
        found.append((headers, data[begin : begin + size]))
        at = begin + size + 4
    return found


def serialized(records: DataFrame) -> DataFrame:
    """``page_id, record_type, record_id, warc``: every record as the bytes of a WARC file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                warc = pa.array([to_bytes(r) for r in part.to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "record_type", "record_id")), warc], ["page_id", "record_type", "record_id", "warc"])

    return records.select(*NAMES).mapInArrow(run, "page_id bigint, record_type string, record_id string, warc binary")
