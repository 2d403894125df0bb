"""WARC: a converter of legacy ARC archives, with writers and readers of both forms.

All archives are written by Spark's text writer and read by its binary-file reader, so they lie wherever Spark can
write; nothing opens a path by itself. A file is a gzip stream of records packed up to PACK_BYTES bytes, so no file grows
with the table; a longer record stands alone. Records are found by their headers' declared lengths, never by searching.

ARC, versions 1 and 2, as published: each file starts with a `filedesc:` record whose block declares the version and
names the fields of the header lines; each record is a header line, as many bytes as it declares, and a line end.
The converter makes, for each ARC record, a WARC/1.1 record: WARC-Date from the 14-digit archive date, WARC-Type from
the block (a response for an HTTP message, else a resource) and the duplicate decision, WARC-Record-ID as a name-based UUID of the ARC header line and the payload digest,
WARC-Payload-Digest and WARC-Block-Digest as base32 SHA-1, and the HTTP header with the page id kept in the block.
Of records with equal payloads the one with the largest page id stays a response; the others become revisits
without payload, which keep the digest, the full payload's length and the response they refer to.

Payloads and HTTP headers are bytes all the way: columns of them are BINARY, and the text writer gets them as a cast, which copies bytes as they
are. So images and pages in old encodings keep every byte; block and payload digests are checked when a WARC file is read. In a
header line, bytes that are no UTF-8 are percent-encoded, as a target URI wants them.

Defined results: a null html is an empty payload; a null URL is written as `urn:page:<id>`; blanks and controls in a URL are
percent-encoded; repeated page ids with equal payloads: all rows that hold the largest id are responses; a null
page id is written and read as null, and counts as smaller than any other.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.storage import new_path, stored

#: Bytes from which a packed archive is closed; one longer page makes one longer file.
PACK_BYTES = 8_000_000
#: The archives' compression. Its fastest level takes a third of the time of the usual one and gives files a fifth larger.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

#: The fields of ARC header lines by version.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc")
_ARC_ROW = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("archive_date", T.StringType()), T.StructField("content_type", T.StringType()),
    T.StructField("ip", T.StringType()), T.StructField("header_line", T.StringType()), T.StructField("http_header", T.BinaryType()), T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("block_digest", T.StringType()),
])


def _percent(error: UnicodeError) -> tuple[str, int]:
    """Bytes that are no UTF-8, percent-encoded."""
    return "".join(f"%{b:02X}" for b in error.object[error.start : error.end]), error.end


codecs.register_error("percent", _percent)


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


# --- ARC


def _arc_record(version: str, url: str, date: str, page_id: int | None, body: bytes) -> bytes:
    """One ARC record: header line, HTTP response, no line end."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n" + (f"X-Page-Id: {page_id}\r\n" if page_id is not None else "") + "\r\n"
    more = f" 200 {base32_sha1(body)} - 0 pages.arc" if version == "2" else ""
    return f"{url} 192.0.2.1 {date} text/html{more} {len(http) + len(body)}\n{http}".encode() + body


def _filedesc(version: str, date: str) -> bytes:
    block = f"{version} 0 starmart\n{ARC_FIELDS[version]}\n"
    more = " 200 - - 0 pages.arc" if version == "2" else ""
    return f"filedesc://pages.arc 0.0.0.0 {date} text/plain{more} {len(block)}\n{block}".encode()


def _safe_url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def write_arc(pages: DataFrame, path: str, version: str = "1", date: str = "20240229120000") -> None:
    """Write page rows (page_id, url, html as text or bytes) as gzipped ARC files below `path`. Each file starts with its filedesc record,
    because the rows of a file are first packed into one value per file."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records, size = [_filedesc(version, date)], 0
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                records.append(_arc_record(version, _safe_url(url, page_id), date, page_id, html.encode() if isinstance(html, str) else html or b""))
                size += len(records[-1])
                if size > PACK_BYTES:
                    yield _value(records)
                    records, size = [_filedesc(version, date)], 0
            if len(records) > 1:
                yield _value(records)

    _write(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(pack, "value binary"), path)


def _value(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"\n".join(records)], pa.binary())], names=["value"])


def _write(packed: DataFrame, path: str) -> None:
    """A file for each value, with a line end after it. The cast copies the bytes, valid as text or not."""
    packed.select(F.col("value").cast("string")).write.options(maxRecordsPerFile=1, lineSep="\n", **GZIP).text(path)


def _inflated(raw: bytes) -> bytes:
    """The content of a gzip file, of one member or of many."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw:
        one = zlib.decompressobj(31)
        out += [one.decompress(raw), one.flush()]
        raw = one.unused_data.lstrip(b"\0")
    return b"".join(out)


def arc_records(raw: bytes) -> Iterator[tuple[dict[str, str], str, bytes]]:
    """(fields, header line, block) of each record but the filedesc ones. The version line of the last filedesc record says
    which fields a header line has; without one, the number of blanks decides."""
    fields: list[str] | None = None
    at = 0
    while at < len(raw):
        if raw[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = raw.find(b"\n", at)
        if end < 0:
            raise ValueError(f"header line without end at byte {at}")
        line = raw[at:end].rstrip(b"\r").decode("utf-8", "percent")
        parts = line.split(" ")
        if not parts[-1].isdigit():
            raise ValueError(f"header line without a length at byte {at}: {line[:200]!r}")
        block = raw[end + 1 : end + 1 + int(parts[-1])]
        if len(block) != int(parts[-1]):
            raise ValueError(f"record at byte {at} declares {parts[-1]} bytes, {len(block)} are there")
        at = end + 1 + len(block)
        if line.startswith("filedesc:"):
            said = block.decode("utf-8", "replace").split("\n")
            version = said[0].split(" ")[0]
            fields = (said[1] if len(said) > 1 and said[1].strip() else ARC_FIELDS[version]).strip().split(" ")
            continue
        names = fields or next((f.split(" ") for f in ARC_FIELDS.values() if len(f.split(" ")) == len(parts)), None)
        if names is None or len(parts) != len(names):
            raise ValueError(f"header line has {len(parts)} fields: {line[:200]!r}")
        yield dict(zip(names, parts, strict=True)), line, block


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its empty line, and payload; a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def _header(raw: bytes | str, name: str) -> str | None:
    text = raw.decode("utf-8", "replace") if isinstance(raw, bytes) else raw
    for line in text.split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None else None


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """One row per ARC record below `path`."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in (x.as_py() for batch in batches for x in batch.column(0)):
            rows: list[tuple] = []
            for fields, line, block in arc_records(_inflated(raw)):
                http, body = _split_http(block)
                rows.append((
                    _number(_header(http, "X-Page-Id")), fields["URL"], fields["Archive-date"], fields["Content-type"], fields["IP-address"], line, http,
                    body, len(body), base32_sha1(body), base32_sha1(block)))
                if len(rows) == 500:
                    yield _batch(rows, _ARC_ROW)
                    rows = []
            if rows:
                yield _batch(rows, _ARC_ROW)

    return _files(spark, path).mapInArrow(parse, _ARC_ROW)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[f.dataType.simpleString()]) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], names=schema.names)


# --- WARC


def decide(records: DataFrame, least: int = 0) -> DataFrame:
    """Add winner (largest page id with this payload) and its header line, for payloads of `least` bytes or more. Payload digests are counted
    first, in partial sums; only those of two records or more are joined, and adaptive execution splits a payload that
    many records share, as both sides of the join are plain exchanges."""
    twice = (records.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "header_line")).alias("best")).where("n > 1")
             .select("payload_digest", F.col("best.page_id").alias("winner"), F.col("best.header_line").alias("winner_line")))
    return records.join(stored(twice, "digests"), "payload_digest", "left")


def _record_id(header_line: str, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(_NAMESPACE, header_line + ' ' + digest)}"


def _warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def write_warc(records: DataFrame, path: str) -> None:
    """Write decided ARC rows as gzipped WARC files; a file's records are packed into one value of the text writer, each
    ended by CR LF CR LF, the very last LF being the writer's."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for r in batch.to_pylist():
                revisit = r["winner"] is not None and r["page_id"] != r["winner"]
                http, line = r["http_header"], r["header_line"]
                block = http if revisit else http + r["payload"]
                kind = "revisit" if revisit else "response" if http else "resource"
                head = [
                    "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {r['url']}", f"WARC-Date: {_warc_date(r['archive_date'])}",
                    f"WARC-Record-ID: <{_record_id(line, r['payload_digest'])}>", f"WARC-IP-Address: {r['ip']}",
                    f"WARC-Payload-Digest: sha1:{r['payload_digest']}", f"WARC-Block-Digest: sha1:{base32_sha1(block) if revisit else r['block_digest']}",
                    f"Content-Type: {'application/http; msgtype=response' if http else r['content_type']}",
                ]
                if revisit:
                    head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_record_id(r['winner_line'], r['payload_digest'])}>", f"WARC-Refers-To-Page: {r['winner']}"]
                head.append(f"Content-Length: {len(block)}")
                out.append("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r")
                size += len(out[-1])
                if size > PACK_BYTES:
                    yield _value(out)
                    out, size = [], 0
            if out:
                yield _value(out)

    made = records.select("page_id", "winner", "winner_line", "url", "archive_date", "ip", "content_type", "header_line", "http_header", "payload", "payload_digest", "block_digest").mapInArrow(convert, "value binary")
    _write(made, path)


def warc_records(raw: bytes) -> Iterator[tuple[str, bytes]]:
    """(header, block) of each record."""
    at = 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        if end < 0 or not raw.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        head = raw[at:end].decode()
        length = int(_header(head, "Content-Length"))
        block = raw[end + 4 : end + 4 + length]
        if len(block) != length or raw[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} declares {length} bytes and does not end there")
        yield head, block
        at = end + 8 + length


_WARC_ROW = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("record_id", T.StringType()), T.StructField("warc_date", T.StringType()), T.StructField("target_uri", T.StringType()),
])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record below `path`. Declared lengths and digests are checked against the bytes; a revisit's full
    length is what its HTTP header says."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in (x.as_py() for batch in batches for x in batch.column(0)):
            rows: list[tuple] = []
            for head, block in warc_records(_inflated(raw)):
                http, body = _split_http(block)
                kind, digest = _header(head, "WARC-Type"), _header(head, "WARC-Payload-Digest").removeprefix("sha1:")
                if kind != "revisit" and base32_sha1(body) != digest:
                    raise ValueError(f"payload of {_header(head, 'WARC-Record-ID')} does not have its digest")
                if base32_sha1(block) != (_header(head, "WARC-Block-Digest") or "").removeprefix("sha1:"):
                    raise ValueError(f"block of {_header(head, 'WARC-Record-ID')} does not have its digest")
                size = int(_header(http, "Content-Length") or 0) if kind == "revisit" else len(body)
                rows.append((
                    _number(_header(http, "X-Page-Id")), size, digest, kind, _number(_header(head, "WARC-Refers-To-Page")),
                    _header(head, "WARC-Record-ID").strip("<>"), _header(head, "WARC-Date"), _header(head, "WARC-Target-URI")))
            if rows:
                yield _batch(rows, _WARC_ROW)

    return _files(spark, path).mapInArrow(parse, _WARC_ROW)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> None:
    """Convert all ARC files below one path to WARC files below another."""
    write_warc(decide(read_arc(spark, arc_path), least), warc_path)


def round_trip(pages: DataFrame, version: str = "2", least: int = 0) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC records read back."""
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, version)
    convert(spark, arc, warc, least)
    return read_warc(spark, warc)
