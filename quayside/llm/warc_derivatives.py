"""Derivatives of web archive responses: linked metadata and plain-text conversion records.

Responses are written and read as WARC files by Spark's own text and binary
sources. Every response gives a metadata record with its links and the headers
it came with, and a conversion record with its text. Both name the response
they refer to and carry digests of their own and of their source. What cannot
be read is told apart as rows with an error instead of ending the job.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.page_blocks import read_page

#: Capture time where a table of pages has none.
DATE = "2024-01-01T00:00:00Z"
#: Records end with two line ends.
RECORD_END = "\r\n\r\n"
#: Type of the rows that stand for bytes which are no record.
DAMAGED = "damaged"
#: Header fields in their order, with repeats.
Fields = list[tuple[str, str]]
_CHARSET = re.compile(r"charset=\s*\"?([\w.:-]+)", re.IGNORECASE)


def _record_id(*parts: Column) -> Column:
    """A name made of the content, so that a run that is repeated names records alike."""
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]).cast("binary"))
    pieces = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def response_records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """One response record a page as text, its end left to the file's line separator.

    Null html is an empty payload and a null url an empty one. Rows that repeat
    are records that repeat, with one identifier.
    """
    page, url = F.col("page_id").cast("string"), F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit(""))
    html = F.coalesce("html", F.lit(""))
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html,
    )
    lines = [
        F.lit("WARC/1.0"), F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.lit("response"), page, url, html)),
        F.concat(F.lit("WARC-Target-URI: "), url), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.sha2(html.cast("binary"), 256)),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.sha2(block.cast("binary"), 256)),
        F.concat(F.lit("WARC-Page-ID: "), F.coalesce(page, F.lit(""))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return pages.select(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write text records as gzip WARC files; one file a partition, whole or absent."""
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def fields_of(lines: list[str]) -> Fields:
    """Names (lower-cased) and values of header lines, in order and with repeats; a line that starts blank goes on."""
    found: Fields = []
    for line in lines:
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
            continue
        name, _, value = line.partition(":")
        found.append((name.strip().lower(), value.strip()))
    return found


def parse_warc(chunks: Iterator[bytes]) -> Iterator[tuple[Fields, bytes, str | None]]:
    """Header fields, block and error (null if sound) of every record of a stream.

    Plain and gzip streams are read, with one gzip member or one a record. A
    record without a usable length is told with its error, and reading goes on
    at the next record's first line. The bytes of a record that the stream ends
    in, and of a gzip member that does not unpack, are told as cut off.
    """
    held = bytearray()
    stream = _unzipped(chunks)
    at, broken = 0, None

    def more() -> bool:
        """Another chunk, with what lies before ``at`` let go."""
        nonlocal at, broken
        del held[:at]
        at = 0
        try:
            chunk = next(stream, None)
        except zlib.error as error:
            broken, chunk = f"damaged gzip member: {error}", None
        held.extend(chunk or b"")
        return chunk is not None

    def find(mark: bytes, low: int) -> int:
        """How far after ``at`` the mark is first found from ``low`` after it on; -1 once the stream has ended."""
        while (place := held.find(mark, at + low)) < 0:
            low = max(low, len(held) - at - len(mark) + 1)
            if not more():
                return -1
        return place - at

    while True:
        while held[at : at + 1] in (b"\r", b"\n") or (at == len(held) and more()):
            at += held[at : at + 1] in (b"\r", b"\n")
        head = find(b"\r\n\r\n", 0)
        if head < 0:
            if len(held) > at or broken:
                yield [], bytes(held[at:]), broken or "cut off in its header"
            return
        begun = held.startswith(b"WARC/", at)
        fields = fields_of(held[at : at + head].decode("utf-8", "replace").split("\r\n")[1:]) if begun else []
        told = dict(fields).get("content-length", "")
        if not (begun and told.isascii() and told.isdigit()):
            skipped = find(b"\r\nWARC/", head + 2 if begun else 0)
            size = skipped + 2 if skipped >= 0 else len(held) - at
            block = bytes(held[at + (head + 4 if begun else 0) : at + size])
            yield fields, block, "no content length" if begun else "no record"
            at += size
            continue
        size = head + 4 + int(told)
        while len(held) - at < size:
            if not more():
                yield fields, bytes(held[at + head + 4 :]), broken or "cut off in its block"
                return
        yield fields, bytes(held[at + head + 4 : at + size]), None
        at += size


def _unzipped(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """A stream without its gzip members' wrapping."""
    begun = b""
    for chunk in chunks:
        begun += chunk
        if len(begun) > 1:
            break
    if begun[:2] != b"\x1f\x8b":
        yield begun
        yield from chunks
        return
    reader = None
    for chunk in chain([begun], chunks):
        while chunk:
            reader = reader or zlib.decompressobj(31)
            yield reader.decompress(chunk)
            chunk = reader.unused_data
            if reader.eof:
                reader = None
    if reader is not None:
        raise zlib.error("the stream ends inside it")


READ = (
    "record_type string, record_id string, target_uri string, date string, page_id string, "
    "headers array<struct<name:string,value:string>>, block binary, error string"
)


def read_warc(spark: SparkSession, path: str, suffix: str = "*.gz") -> DataFrame:
    """The records of WARC files, one row each; a task reads the files it is given one after another.

    ``error`` is null for sound records; others have the type ``DAMAGED`` and
    say what is wrong, and count with ``read.where("error is not null")``.
    A file is one value for Spark, so files stay below 2 GB, as archives are written.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(path).select("content")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in READ.split(", ")]
        header = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        kinds = [pa.string()] * 5 + [header, pa.binary(), pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer()
                pieces = (data[at : at + (1 << 20)].to_pybytes() for at in range(0, len(data), 1 << 20))
                rows, held = [], 0
                for fields, block, error in parse_warc(pieces):
                    told = dict(fields)
                    rows.append((
                        DAMAGED if error else told.get("warc-type"), told.get("warc-record-id"), told.get("warc-target-uri"),
                        told.get("warc-date"), told.get("warc-page-id"),
                        [{"name": name, "value": value} for name, value in fields], block, error,
                    ))
                    held += len(block)
                    if held > 1 << 23:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(parsed, READ)


def _payload(block: bytes) -> tuple[Fields, str, bytes]:
    """HTTP header fields, the status line and the body of a response block."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return [], "", block
    status, *lines = head.decode("latin-1").split("\r\n")
    return fields_of(lines), status, body


def _joined(body: bytes) -> bytes:
    """A chunked body in one piece; bytes that follow no chunk size stay as they are."""
    out, at = [], 0
    while at < len(body):
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if re.fullmatch(rb"[0-9A-Fa-f]+", size) is None:
            out.append(body[at:])
            break
        length = int(size, 16)
        if not length:
            break
        out.append(body[end + 2 : end + 2 + length])
        at = end + 2 + length + 2
    return b"".join(out)


def _decoded(body: bytes, http: Fields) -> bytes:
    """The body as its transfer and content encodings mean it; as far as it unpacks, and as it is if it does not."""
    codings = [c.strip().lower() for kind in ("transfer-encoding", "content-encoding")
               for name, value in http if name == kind for c in reversed(value.split(","))]
    for coding in codings:
        if coding == "chunked":
            body = _joined(body)
        elif coding in ("gzip", "x-gzip", "deflate"):
            unpacked = None
            for bits in (31,) if "gzip" in coding else (15, -15):
                reader = zlib.decompressobj(bits)
                try:
                    unpacked = reader.decompress(body)
                    break
                except zlib.error:
                    continue
            body = body if unpacked is None else unpacked
    return body


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _named(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {source}')}>"


def derivatives(fields: Fields, block: bytes) -> list[dict]:
    """The metadata and the conversion record of one response; the text is that of the decoded body."""
    http, status, raw = _payload(block)
    source, body = dict(fields), _decoded(raw, http)
    charset = _CHARSET.search(dict(http).get("content-type", ""))
    try:
        html = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        html = body.decode("utf-8", "replace")
    found, targets = read_page(html)
    links = list(dict.fromkeys(targets))
    source_id = source.get("warc-record-id") or ""
    payload = source.get("warc-payload-digest") or _digest(raw)
    told = [("status", status)] + [(f"http-{name}", value) for name, value in http]
    told += [(name, value) for name, value in fields if name != "content-length"]
    facts = "".join(f"{name}: {value}\r\n" for name, value in [*told, *(("outlink", f"{x} L a/@href") for x in links)])
    text = "\n".join(b.text for b in found if "title" not in b.place.inside)
    out = []
    for kind, content_type, data in (
        ("metadata", "application/warc-fields", facts.encode()), ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        out.append({
            "record_type": kind, "record_id": _named(kind, source_id), "refers_to": source_id,
            "target_uri": source.get("warc-target-uri") or "", "date": source.get("warc-date") or "",
            "page_id": source.get("warc-page-id") or "", "content_type": content_type, "content_length": len(data),
            "block_digest": _digest(data), "source_payload_digest": payload,
            "source_block_digest": source.get("warc-block-digest") or _digest(block),
            "n_links": len(links), "block": data.decode(),
        })
    return out


DERIVED = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, page_id string, "
    "content_type string, content_length long, block_digest string, source_payload_digest string, "
    "source_block_digest string, n_links long, block string"
)


def derived(records: DataFrame) -> DataFrame:
    """Two rows for every response record; records of other types, and damaged ones, give none.

    Missing header fields are empty, an empty payload gives an empty text, and
    records that repeat give records that repeat, under one identifier.
    """
    names = [part.split()[0] for part in DERIVED.split(", ")]
    kinds = [pa.int64() if "long" in part else pa.string() for part in DERIVED.split(", ")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                sources, held = part.column(0).to_pylist(), part.column(1).to_pylist()
                rows = [row for s, b in zip(sources, held, strict=True) for row in derivatives([(f["name"], f["value"]) for f in s or ()], b or b"")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[n] for row in rows], kind) for n, kind in zip(names, kinds, strict=True)], names=names
                )

    return records.where("record_type = 'response'").select("headers", "block").mapInArrow(made, DERIVED)


def derivative_records(rows: DataFrame) -> DataFrame:
    """Derivative rows as records for ``write_warc``."""
    fields = (
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Page-ID", "page_id"),
        ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "source_payload_digest"),
        ("WARC-Source-Block-Digest", "source_block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    )
    lines = [F.lit("WARC/1.0")] + [F.concat(F.lit(f"{name}: "), F.col(c).cast("string")) for name, c in fields]
    return rows.select(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), F.col("block")).alias("value"))
