"""WARC derivatives: linked metadata and plain-text conversion records of response records.

Every response gives two records that refer to it (``WARC-Refers-To`` with its target uri
and date): a *metadata* record whose warc-fields block keeps the source's headers, its
payload and block digests, its HTTP status line and headers, the title and the outlinks;
and a *conversion* record whose block is the page's text. The metadata record names the
conversion record (``WARC-Concurrent-To``), so the three can be joined either way. Ids are
name-based, so reruns and recomputed tasks give the same ids.

Shape of the job: one narrow pass in Arrow batches, no shuffle; records of a page depend on
that page alone. HTML is read by a single scan over its tags, linear in its length.

Defined results: a null payload is empty, a null target uri leaves its headers out,
null headers are no headers. Control characters in header values are percent-encoded.
Repeated rows give repeated records with equal ids. Very long payloads are read whole, one at
a time. Only the named columns are read; clashing names have no effect. An empty table gives
an empty table.

``responses_of`` makes response records from a table of urls and html, which has no HTTP
headers or dates: the status line, the content type and the date of its records are its own.
"""

from __future__ import annotations

import re
import uuid
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracover.llm.text import rows_in_chunks

VERSION = "WARC/1.1"
END = "\r\n\r\n"
HIDDEN = {"script", "style", "noscript", "template"}
#: Tags that end a line of text.
BREAKS = set(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)
_TAG = re.compile(r"<!--|-->|<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]*)>|<[!?/][^<>]*>")
_LINK = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BLANK = re.compile(r"[ \t\r\f\v ]+")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def digest(block: bytes) -> str:
    return "sha1:" + b32encode(sha1(block).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(names))}>"


def clean(value: str) -> str:
    """A header value on one line."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def page_text(html: str) -> tuple[str, str, list[str]]:
    """Text, title and link targets of an HTML page, by one scan over its tags.

    Text inside hidden elements and comments is left out, up to the end if they are never
    closed; tags that break lines do; entities are decoded; blanks are collapsed, empty
    lines dropped.
    """
    out, title, links = [], [], []
    at, hidden, comment, in_title = 0, "", False, False
    for tag in _TAG.finditer(html):
        if not hidden and not comment:
            piece = html[at:tag.start()]
            out.append(piece)
            if in_title:
                title.append(piece)
        at = tag.end()
        if tag[0] == "<!--":
            comment = comment or not hidden
        elif tag[0] == "-->":
            if not comment and not hidden:
                out.append("-->")
            comment = False
        elif comment or not tag[2]:
            continue
        else:
            name = tag[2].lower()
            if hidden:
                hidden = "" if tag[1] and name == hidden else hidden
                continue
            if name in HIDDEN and not tag[1]:
                hidden = "" if tag[3].endswith("/") else name
            elif name in BREAKS:
                out.append("\n")
                if name == "title":
                    in_title = not tag[1]
            if name == "a" and not tag[1] and (link := _LINK.search(tag[3])):
                links.append(unescape(link[1] or link[2] or link[3] or ""))
    if not hidden and not comment:
        out.append(html[at:])
    lines = (_BLANK.sub(" ", x).strip() for x in unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x), _BLANK.sub(" ", unescape("".join(title))).strip(), links


def record(headers: list[tuple[str, str]], block: str) -> str:
    """A record without its closing blank lines; its own length and digest come last in the header."""
    raw = block.encode()
    full = [*headers, ("WARC-Block-Digest", digest(raw)), ("Content-Length", str(len(raw)))]
    return "\r\n".join([VERSION, *(f"{k}: {clean(v)}" for k, v in full)]) + END + block


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records in a WARC stream."""
    at = 0
    while (start := data.find(VERSION.encode(), at)) >= 0:
        head_end = data.index(END.encode(), start)
        lines = data[start:head_end].decode().split("\r\n")[1:]
        headers = dict(x.split(": ", 1) for x in lines)
        at = head_end + len(END) + int(headers["Content-Length"])
        yield headers, data[head_end + len(END):at]


def derivatives(source: dict) -> list[dict]:
    """Metadata and conversion record of one response (id, uri, date, http, payload)."""
    payload = (source["payload"] or "").encode()
    http = source["http"] or ""
    text, title, links = page_text(source["payload"] or "")
    refers = [("WARC-Refers-To", source["record_id"])]
    if source["uri"] is not None:
        refers += [("WARC-Refers-To-Target-URI", source["uri"]), ("WARC-Target-URI", source["uri"])]
    refers += [("WARC-Refers-To-Date", source["date"]), ("WARC-Date", source["date"])]
    of = {kind: record_id(kind, source["record_id"]) for kind in ("metadata", "conversion")}
    kept = [
        ("source-payload-digest", digest(payload)), ("source-block-digest", digest(http.encode() + payload)),
        ("source-content-length", str(len(http.encode()) + len(payload))),
        *(("source-http-header", x) for x in http.split("\r\n") if x),
        ("title", title), ("text-digest", digest(text.encode())), *(("outlink", x) for x in links),
    ]
    fields = "".join(f"{k}: {clean(v)}\r\n" for k, v in kept)
    made = []
    for kind, content, block, links_to in (
        ("metadata", "application/warc-fields", fields, [("WARC-Concurrent-To", of["conversion"])]),
        ("conversion", "text/plain; charset=utf-8", text, []),
    ):
        headers = [("WARC-Type", kind), ("WARC-Record-ID", of[kind]), *refers, *links_to,
                   ("WARC-Payload-Digest", digest(block.encode())), ("Content-Type", content)]
        made.append({
            "warc_type": kind, "record_id": of[kind], "refers_to": source["record_id"], "target_uri": source["uri"],
            "concurrent_to": of["conversion"] if kind == "metadata" else None,
            "source_payload_digest": digest(payload), "block_digest": digest(block.encode()),
            "content_length": len(block.encode()), "n_links": len(links), "record": record(headers, block),
        })
    return made


_FIELDS = [
    ("warc_type", "string"), ("record_id", "string"), ("refers_to", "string"), ("target_uri", "string"), ("concurrent_to", "string"),
    ("source_payload_digest", "string"), ("block_digest", "string"), ("content_length", "bigint"), ("n_links", "bigint"), ("record", "string"),
]


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in_chunks(batches, "payload", 4 << 20):
        rows, made = [], []
        for i, source in enumerate(batch.drop_columns(["id"]).to_pylist()):
            for x in derivatives(source):
                rows.append(i)
                made.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(rows, pa.int32()))] + [
                pa.array([m[name] for m in made], pa.string() if kind == "string" else pa.int64()) for name, kind in _FIELDS
            ], names=["id", *[name for name, _ in _FIELDS]],
        )


def derive(responses: DataFrame, id_col: str, record_id_col: str, uri_col: str, date_col: str, http_col: str, payload_col: str) -> DataFrame:
    """Two rows per response: id, the fields of the derived record and its text (``record``)."""
    source = responses.select(
        responses[id_col].alias("id"), responses[record_id_col].alias("record_id"), responses[uri_col].alias("uri"),
        responses[date_col].alias("date"), responses[http_col].alias("http"), responses[payload_col].alias("payload"),
    )
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_derive, f"id {kind}, " + ", ".join(f"{n} {k}" for n, k in _FIELDS)).withColumnRenamed("id", id_col)


def responses_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of stored pages: id, record_id, uri, date, http and payload; the id is a digest of the row."""
    def part(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))

    name = F.md5(F.concat_ws("\x1f", part(pages[id_col]), part(pages[url_col]), part(pages[html_col])))
    groups = [F.substr(name, F.lit(at), F.lit(size)) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    size = F.octet_length(F.coalesce(pages[html_col], F.lit(""))).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    return pages.select(
        pages[id_col].alias("id"), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">")).alias("record_id"),
        pages[url_col].alias("uri"), F.lit(date).alias("date"), http.alias("http"), pages[html_col].alias("payload"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files, one per task: records are text, and the line separator is their closing blank lines."""
    records.select("record").write.option("lineSep", END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of all records of the WARC files in a folder; a file is read by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for content in batch.column("content").to_pylist():
                for headers, block in parse(content):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([list(headers.items())], kind), pa.array([block], pa.binary())], names=["headers", "block"]
                    )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "headers map<string,string>, block binary")
