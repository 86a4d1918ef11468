"""WARC archives: exact round trips, the report against SQL, and the form of the files."""

import base64
import hashlib
import io
from collections import Counter
from pathlib import Path

import pytest
import zstandard

from catchment.llm import queries, warc

SF = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"
ROWS = [
    (5, "http://a.example/x y", "<p>same</p>"), (2, "http://b.example/", "<p>same</p>"), (9, None, "<p>same</p>"), (3, "http://c.example/é\r\n", ""),
    (4, "http://d.example/", None), (6, "", "ünï\r\n\r\nWARC/1.1\r\n" * 3), (7, "u", "x" * 3_000_000), (8, "u", "x" * 3_000_000), (None, "http://n.example/", "<p>same</p>"),
    (None, None, "only here"), (1, "first", "twice"), (1, "first", "twice"), (1, "second", "twice"), (10, "t", "twice"), (11, "v", "<P>same</P>"),
]


def brute(rows, min_bytes=0):
    """(id, bytes, digest, type, refers to); of equal payloads the first by id and address is the response."""
    groups = {}
    for doc, url, html in rows:
        groups.setdefault((html or "").encode(), []).append(((doc is None, doc or 0), (url is None, url or ""), doc))
    out = Counter()
    for payload, members in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for at, (*_, doc) in enumerate(sorted(members, key=lambda member: member[:2])):
            first = at == 0 or len(payload) < min_bytes
            out[(doc, len(payload), digest, "response" if first else "revisit", None if first else min(members, key=lambda m: m[:2])[2])] += 1
    return out


def ours(frame):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect())


def test_query_against_sql(spark, against_sql):
    import duckdb

    pages = duckdb.sql(f"SELECT * FROM '{SF}/pages.parquet'").df()
    against_sql(queries.op13_warc(spark, SF), queries.SQL["op13_warc"], pages=pages)


def test_odd_pages(spark):
    pages = spark.createDataFrame(ROWS, PAGE).selectExpr("*", "1 AS payload", "2 AS _same", "'x' AS path", "3 AS _id", "4 AS copy")
    for number in (1, 5):
        assert ours(warc.warc_report(spark, pages.repartition(number))) == brute(ROWS)
    assert warc.warc_report(spark, pages.limit(0)).count() == 0


def test_short_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, PAGE)
    records = warc.read_warc(warc.write_warc(pages, f"file://{tmp_path}/out", min_bytes=8))
    got = Counter((None if r.page_id is None else int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in records.collect())
    assert got == brute(ROWS, 8)


def test_payloads_come_back_and_archives_are_closed_by_size(spark, tmp_path):
    rows = [(n, f"http://h.example/{n}", f"<html>{n} " + "word " * (n % 50)) for n in range(400)] + [(1000, "big", "é" * 2_000_000)]
    files = warc.write_warc(spark.createDataFrame(rows, PAGE).coalesce(1), f"{tmp_path}/out", archive_bytes=40_000)
    listed = files.collect()
    assert len(listed) > 2 and sum(row.records for row in listed) == len(rows)
    assert all(Path(row.path).stat().st_size == row.bytes for row in listed)
    assert {int(r.page_id): bytes(r.payload).decode() for r in warc.read_warc(files, payloads=True).collect()} == {n: html for n, _, html in rows}


def frames(data):
    """The content of each frame behind the dictionary, with the dictionary that leads the file."""
    magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    at, found = 8 + size, []
    while at < len(data):
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        found.append(one.decompress(data[at:]))
        at = len(data) - len(one.unused_data)
    return magic, dictionary, found


def test_each_record_is_a_frame_under_the_dictionary(tmp_path):
    archive = warc.Archive(str(tmp_path), warc.DATE)
    texts = [f"<html><head><title>page {n}</title></head><body>{'text of the page ' * 20}{n * n}</body></html>".encode() for n in range(300)]
    for n, text in enumerate(texts):
        archive.add(warc.Page(str(n), f"http://h.example/{n}", text, warc.base32(hashlib.sha1(text).digest()), len(text), None, None, 0))
    archive.close()
    data = Path(archive.files[0][0]).read_bytes()
    magic, dictionary, records = frames(data)
    assert magic == 0x184D2A5D and dictionary.dict_id() != 0 and len(records) == len(texts) + 1
    assert records[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and all(record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") for record in records)
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(record)) for record in records)
    assert len(data) - len(dictionary.as_bytes()) < alone / 2


def test_a_changed_payload_is_told(tmp_path):
    archive = warc.Archive(str(tmp_path), warc.DATE)
    archive.add(warc.Page("1", "u", b"payload", warc.base32(hashlib.sha1(b"other").digest()), 7, None, None, 0))
    archive.close()
    with pytest.raises(ValueError, match="doesn't match its digest"):
        list(warc.read_archive(archive.files[0][0]))


def test_headers_end_at_a_blank_line():
    assert warc.headers_of(io.BytesIO(b"WARC/1.1\r\nA: b: c\r\n\r\nrest")) == {"a": "b: c"}
    assert warc.headers_of(io.BytesIO(b"")) is None
