from __future__ import annotations

import gzip
import hashlib
import base64

import pytest

from starmart.llm import archives
from starmart.llm.storage import importable, new_path

SCHEMA = "page_id long, url string, html string, winner string, payload string"


def sha(x):
    return base64.b32encode(hashlib.sha1((x or "").encode()).digest()).decode()


def brute(rows):
    best = {}
    for i, _, h, *_ in rows:
        best.setdefault(sha(h), []).append(i)
    out = []
    for i, _, h, *_ in rows:
        ids = best[sha(h)]
        top = max((x for x in ids if x is not None), default=None)
        revisit = i != top
        out.append((i, len((h or "").encode()), sha(h), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/x y\n", "<p>é</p>", "w", "p"), (2, None, None, None, None), (3, "", "", "w", "p"), (4, "http://b", "<p>é</p>", None, None), (4, "http://b", "<p>é</p>", None, None),
    (5, "https://c/ü", "line\r\n\r\nWARC/1.1\r\n\r\nfiledesc://x 1 2 3 4\n", None, None), (6, "http://d", "x" * 300_000, None, None), (7, "ftp://e", "HTTP/1.1 200 OK\r\n\r\n", None, None),
]


@pytest.mark.parametrize("version", ["1", "2"])
def test_round_trip(spark, version):
    importable(spark)
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    got = archives.round_trip(pages, version).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_null_ids_and_empty_table(spark):
    importable(spark)
    rows = [(None, "http://a", "q"), (None, "http://b", None), (9, "http://c", "q")]
    got = archives.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id) == [(9, "response", None)]
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id is None) == [("response", None), ("revisit", 9)]
    assert archives.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_records_by_declared_lengths(spark):
    importable(spark)
    path = new_path(spark, "warc")
    pages = spark.createDataFrame([(1, "http://a", "<p>1</p>"), (2, "http://b", "<p>1</p>")], "page_id long, url string, html string")
    arc = new_path(spark, "arc")
    archives.write_arc(pages.coalesce(1), arc, "1")
    archives.convert(spark, arc, path)
    raw = [archives._inflated(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    heads = [h for x in raw for h, _ in archives.warc_records(x)]
    ids = {archives._header(h, "WARC-Record-ID") for h in heads}
    revisit, = (h for h in heads if archives._header(h, "WARC-Type") == "revisit")
    assert archives._header(revisit, "WARC-Refers-To") in ids and archives._header(revisit, "WARC-Date") == "2024-02-29T12:00:00Z"
    with pytest.raises(ValueError, match="declares"):
        list(archives.warc_records(raw[0][:-3]))


def test_both_versions_and_many_members():
    one = b"filedesc://f 0.0.0.0 20240101000000 text/plain 76\n1 0 who\n" + archives.ARC_FIELDS["1"].encode() + b"\n"
    size = len(one.split(b"\n", 1)[1])
    one = one.replace(b" 76\n", b" %d\n" % size, 1)
    body = b"http://a 1.2.3.4 20240101000000 text/html 5\nhello\n"
    two = b"http://b 1.2.3.4 20240101000000 text/html 200 sum - 7 f.arc 3\nabc\n"
    raw = gzip.compress(one + b"\n") + gzip.compress(body)
    assert [(f["URL"], b) for f, _, b in archives.arc_records(archives._inflated(raw))] == [("http://a", b"hello")]
    (fields, line, block), = archives.arc_records(two)
    assert (fields["Result-code"], fields["Archive-length"], block) == ("200", "3", b"abc")
    with pytest.raises(ValueError, match="declares"):
        list(archives.arc_records(body[:-3]))


def test_bytes_that_are_no_text_stay_as_they_are(spark, monkeypatch):
    """A legacy archive with an image, a page in an old encoding, odd headers and a URL of raw bytes; and pages longer than a file."""
    importable(spark)
    monkeypatch.setattr(archives, "PACK_BYTES", 1000)
    image, latin = bytes(range(256)) * 9, "<p>caf\xe9</p>".encode("latin-1")
    rows = [(1, "http://a", image), (2, "http://b", latin), (3, "http://c", image), (4, "http://d", b"\n\r\n\x00\xff")]
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    archives.write_arc(spark.createDataFrame([(i, u, bytearray(b)) for i, u, b in rows], "page_id long, url string, html binary").coalesce(1), arc, "1")
    block = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\nX-Odd: \xe9\r\n\r\n" + latin + b"!"
    odd = b"http://e/\xe9 1.2.3.4 20010101000000 image/gif %d\n" % len(block) + block + b"\n"
    spark.createDataFrame([(bytearray(odd),)], "value binary").selectExpr("cast(value as string)").write.mode("append").text(arc)
    got = {r.page_id: r for r in archives.read_arc(spark, arc).collect()}
    assert {i: bytes(got[i].payload) for i, _, _ in rows} == {i: b for i, _, b in rows}
    assert bytes(got[7].http_header) + bytes(got[7].payload) == block and got[7].url == "http://e/%E9"
    archives.convert(spark, arc, warc)
    told = {r.page_id: r for r in archives.read_warc(spark, warc).collect()}
    assert {i: (r.payload_bytes, r.record_type, r.refers_to) for i, r in told.items()} == {
        1: (len(image), "revisit", 3), 2: (len(latin), "response", None), 3: (len(image), "response", None), 4: (5, "response", None), 7: (len(latin) + 1, "response", None)}
    raw = [archives._inflated(r.content) for r in spark.read.format("binaryFile").load(warc).collect()]
    assert block in {b for x in raw for _, b in archives.warc_records(x)}
