"""Derived WARC records: metadata and plain text of response records, linked back to them.

Every response gives a ``metadata`` record (JSON: source headers, title, links) and a ``conversion``
record (plain text). Both name the response in WARC-Refers-To and carry its target, date and payload
digest. Identifiers are name-based, so a task that runs again makes the same record.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator, Set
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
# A quoted attribute value ends at the next tag at the latest, so an open quote costs no more than its own tag.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>""")
# Comments and declarations as a whole, start tags of elements that show no text.
OPENING = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b[^>]*>|<[!?][^>]*>", re.S | re.I)
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style noscript template svg".split()}
# What stands in these is no markup; without an end tag they run to the end of the page.
RAW = frozenset(("script", "style"))
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINK = re.compile(r"""(?:^|\s)(href|src|action)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"[ \t\r\f\v ]+")
LINES = re.compile(r"\s*\n\s*")
# Elements that begin a line of their own.
BLOCKS = frozenset(
    (
        "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot "
        "th thead title tr ul"
    ).split()
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    name = "\x1f".join("" if p is None else str(p) for p in parts)
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def without_hidden(markup: str, names: Set[str], keep_tags: bool = False) -> str:
    """Comments, declarations and the elements ``names`` become a space each; with ``keep_tags`` start tags stay.

    A closed-in-itself svg has no content. Elements other than RAW that are never closed lose their tag's meaning,
    not the rest of the page.
    """
    parts, at, look, endless = [], 0, 0, set()
    while found := OPENING.search(markup, look):
        name = (found[1] or "").lower()
        look = found.end()
        if name:
            if name not in names or name in endless or (name == "svg" and found[0].endswith("/>")):
                continue
            close = CLOSING[name].search(markup, look)
            if close is None and name not in RAW:
                endless.add(name)
                continue
            look = close.end() if close else len(markup)
        parts.append(markup[at : found.end() if name and keep_tags else found.start()])
        at = look
    return " ".join([*parts, markup[at:]])


def plain_text(markup: str) -> str:
    """Visible text; block elements begin a line, runs of white space become one space, blank lines go."""
    shown = without_hidden(markup, CLOSING.keys())
    broken = TAG.sub(lambda m: "\n" if m[2].lower() in BLOCKS else "", shown)
    return LINES.sub("\n", SPACE.sub(" ", html.unescape(broken))).strip()


def links(markup: str, base: str | None) -> list[dict[str, str]]:
    """Targets of href, src and action in document order, made absolute where ``base`` allows it."""
    found = []
    for tag in TAG.finditer(without_hidden(markup, RAW, keep_tags=True)):
        if tag[1] or "=" not in tag[3]:
            continue
        for name, a, b, c in LINK.findall(tag[3]):
            target = html.unescape(a or b or c).strip()
            try:
                target = urljoin(base or "", target)
            except ValueError:
                pass  # not an address; it stays as it is written
            found.append({"path": f"{tag[2].upper()}@/{name.lower()}", "url": target})
    return found


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order, body. Without a blank line everything is body."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *rest = head.decode("latin-1").split(CRLF)
    fields = [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in rest) if sep]
    return first, fields, body


def charset(fields: list[tuple[str, str]]) -> str:
    kind = next((v for k, v in fields if k.lower() == "content-type"), "")
    found = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    try:
        return "".encode(found[1]) is not None and found[1] if found else "utf-8"
    except LookupError:
        return "utf-8"


def header_text(fields: list[tuple[str, str | None]]) -> str:
    """The header of a record. Line ends inside a value would end the field, so they become spaces."""
    return CRLF.join(
        ["WARC/1.1", *(f"{k}: {' '.join(v.splitlines())}" for k, v in fields if v is not None)]
    )


def derive_one(source_id: str, target: str | None, date: str, block: bytes) -> list[dict]:
    status, fields, body = parse_http(block)
    markup = body.decode(charset(fields), "replace")
    payload = digest(body)
    title = TITLE.search(markup)
    meta = {
        "Envelope": {
            "WARC-Header-Metadata": {
                "WARC-Record-ID": source_id,
                "WARC-Target-URI": target,
                "WARC-Date": date,
                "WARC-Type": "response",
                "WARC-Payload-Digest": payload,
                "WARC-Block-Digest": digest(block),
                "Content-Length": len(block),
            },
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Response-Message": status,
                    "Headers": fields,
                    "Entity-Length": len(body),
                    "HTML-Metadata": {
                        "Title": html.unescape(title[1]).strip() if title else None,
                        "Links": links(markup, target),
                    },
                }
            },
        }
    }
    made = (
        ("metadata", "application/json", json.dumps(meta, ensure_ascii=False, separators=(",", ":"))),
        ("conversion", "text/plain; charset=utf-8", plain_text(markup)),
    )
    out = []
    for kind, content_type, text in made:
        data = text.encode("utf-8", "replace")
        own, own_digest = record_id(kind, source_id), digest(data)
        header = header_text(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", own),
                ("WARC-Refers-To", source_id),
                ("WARC-Target-URI", target),
                ("WARC-Date", date),
                ("WARC-Block-Digest", own_digest),
                ("WARC-Source-Payload-Digest", payload),
                ("Content-Type", content_type),
                ("Content-Length", str(len(data))),
            ]
        )
        out.append(
            {
                "record_type": kind,
                "record_id": own,
                "refers_to": source_id,
                "target_uri": target,
                "content_length": len(data),
                "block_digest": own_digest,
                "payload_digest": payload,
                "header": header,
                "block": data.decode(),
            }
        )
    return out


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """page_id, record_id, target_uri, date, block (binary HTTP message) of pages (page_id, url, html).

    A null html is an empty body. Repeated rows have the same identifier; rows of one page with another url or body do not.
    """
    markup = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(markup).cast("string"),
        F.lit(CRLF + CRLF),
    )
    name = F.sha1(F.concat_ws("\x1f", F.col("page_id").cast("string"), F.col("url"), F.sha1(markup)))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    # A name-based identifier: version 5, variant 10.
    dashed = F.concat(
        F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-5"), parts[2], F.lit("-a"), parts[3], F.lit("-"), parts[4], F.lit(">")
    )
    return pages.select(
        "page_id",
        dashed.alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, markup).cast("binary").alias("block"),
    )


FIELDS = (
    ("record_type", "string"),
    ("record_id", "string"),
    ("refers_to", "string"),
    ("target_uri", "string"),
    ("content_length", "long"),
    ("block_digest", "string"),
    ("payload_digest", "string"),
    ("header", "string"),
    ("block", "string"),
)


def derive(records: DataFrame, key: str = "page_id") -> DataFrame:
    """Metadata and conversion record of every response (``key``, record_id, target_uri, date, block).

    A null block is an empty one; a block without an HTTP head is taken as the body. A null target leaves out
    its header line. Two rows per row of input, repeated or not; an empty table gives an empty one. Other
    columns do not enter, so none can clash.
    """
    source = records.select(key, "record_id", "target_uri", F.col("date").cast("string"), F.coalesce("block", F.lit(b"")))
    key_type = source.schema[0].dataType.simpleString()
    kinds = {"string": pa.string(), "long": pa.int64()}

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for row, (own, target, date, block) in enumerate(zip(*columns, strict=True)):
                two = derive_one(own, target, date, block)
                rows += [row] * len(two)
                made += two
            arrays = [pa.array([m[n] for m in made], kinds[t]) for n, t in FIELDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *arrays], [key, *(n for n, _ in FIELDS)]
            )

    return source.mapInArrow(convert, ", ".join([f"`{key}` {key_type}", *(f"{n} {t}" for n, t in FIELDS)]))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files: Spark's own writer and commit, one file per task, each record closed by two line ends."""
    text = F.concat_ws(CRLF + CRLF, "header", "block")
    records.select(text.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def op10_derived_records(pages: DataFrame) -> DataFrame:
    """Metadata and conversion records of all ``pages``; null addresses and pages as in ``responses`` and ``derive``."""
    return derive(responses(pages))
