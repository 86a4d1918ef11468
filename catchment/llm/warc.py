"""WARC archives of pages: one Zstandard frame per record under a dictionary that leads the file in a skippable frame.

The dictionary is built from the first records of the archive, so a file is read with nothing but itself. Payloads that
stand more than once are stored once; the other records refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import IO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.session import ensure_checkpoint_dir, pin

#: The frame that holds the dictionary, and the profile of records that refer to an equal payload.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"

#: Payloads of at least so many bytes are stored once.
MIN_BYTES = 0
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 1 << 30
#: Raw records that are held for the dictionary, and its size.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"

_RECORDS = "page_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary"
_FILES = "path string, records long, bytes long"


class Page(NamedTuple):
    """A row to be archived; a revisit has no payload, and its digest and length are those of what it refers to."""

    page_id: str | None
    url: str | None
    payload: bytes | None
    digest: str
    length: int
    refers_to: str | None
    refers_url: str | None
    #: Tells records of equal id, address and payload apart.
    copy: int


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def address(page_id: str | None, url: str | None) -> str:
    """The record's target; blanks and controls are escaped, so that it stays one header."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{quote(page_id or '', safe='')}"


def record_id(page_id: str | None, url: str | None, digest: str, copy: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, repr((page_id, url, digest, copy))).urn}>"


def with_headers(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join([*lines, b"", block, b"", b""])


def record(page: Page, date: str) -> bytes:
    """A response or a revisit; ids travel escaped in headers of their own, a missing one has no header."""
    headers = [
        ("WARC-Type", "response" if page.payload is not None else "revisit"),
        ("WARC-Record-ID", record_id(page.page_id, page.url, page.digest, page.copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", address(page.page_id, page.url)),
        ("WARC-Payload-Digest", f"sha1:{page.digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(page.length)),
    ]
    if page.page_id is not None:
        headers.append(("X-Page-Id", quote(page.page_id, safe="")))
    status = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page.length}\r\n\r\n".encode()
    if page.payload is not None:
        block = status + page.payload
        headers.append(("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"))
        return with_headers(headers, block)
    headers += [
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", record_id(page.refers_to, page.refers_url, page.digest, 0)),
        ("WARC-Refers-To-Target-URI", address(page.refers_to, page.refers_url)),
        ("WARC-Refers-To-Date", date),
    ]
    if page.refers_to is not None:
        headers.append(("X-Refers-To-Page-Id", quote(page.refers_to, safe="")))
    return with_headers(headers, status)


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; too few of them are the dictionary themselves."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples, level=LEVEL)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """Writes records to archives of a folder; what each closed one holds is in `files`."""

    def __init__(self, folder: str, date: str, archive_bytes: int = ARCHIVE_BYTES, sample_bytes: int = SAMPLE_BYTES) -> None:
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.root, self.date, self.archive_bytes, self.sample_bytes = folder, date, archive_bytes, sample_bytes
        self.files: list[tuple[str, int, int]] = []
        self.out: IO[bytes] | None = None
        self.held: list[bytes] = []
        self.size = 0
        self.compressor: zstandard.ZstdCompressor | None = None
        self.lead = b""

    def add(self, page: Page) -> None:
        data = record(page, self.date)
        if self.compressor is None:
            self.held.append(data)
            self.size += len(data)
            if self.size >= self.sample_bytes:
                self._begin()
            return
        self._put(data)

    def close(self) -> None:
        if self.held:
            self._begin()
        self._end()

    def _begin(self) -> None:
        # A long record is a sample by its start alone; the record itself is stored whole.
        dictionary = build_dictionary([data[: 64 << 10] for data in self.held])
        content = dictionary.as_bytes()
        self.lead = DICTIONARY_MAGIC.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
        dictionary.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        waiting, self.held = self.held, []
        for data in waiting:
            self._put(data)

    def _put(self, data: bytes) -> None:
        if self.out is None:
            # The name is new for each attempt of a task: only archives that a finished task lists are read.
            self.name, self.records, self.written = f"{uuid.uuid4()}.warc.zst", 0, 0
            self.out = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self._write(self.lead)
            about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", self.date)]
            about += [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._write(self.compressor.compress(with_headers(about, b"software: catchment\r\nformat: WARC File Format 1.1\r\n")))
        self._write(self.compressor.compress(data))
        self.records += 1
        if self.written >= self.archive_bytes:
            self._end()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _end(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.append((f"{self.root}/{self.name}", self.records, self.written))
            self.out = None


def read_exactly(stream: IO[bytes], number: int) -> bytes:
    data = stream.read(number)
    if len(data) != number:
        raise ValueError(f"archive ends {number - len(data)} bytes too early")
    return data


def headers_of(stream: IO[bytes]) -> dict[str, str] | None:
    """Names (in lower case) and values up to the blank line; None at the end of the archive."""
    first = stream.readline()
    if not first:
        return None
    if first.strip() != VERSION:
        raise ValueError(f"no record starts with {first[:40]!r}")
    found = {}
    while line := stream.readline().strip(b"\r\n"):
        name, _, value = line.partition(b":")
        found[name.decode().lower()] = value.strip().decode()
    return found


def read_archive(path: str, payloads: bool = False) -> Iterator[tuple]:
    """The response and revisit records of one archive; a response's payload is hashed again and must match its digest."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_stream(name, compression=None) as raw:
        magic, size = int.from_bytes(read_exactly(raw, 4), "little"), int.from_bytes(read_exactly(raw, 4), "little")
        if magic != DICTIONARY_MAGIC:
            raise ValueError(f"{path} has no dictionary")
        dictionary = zstandard.ZstdCompressionDict(read_exactly(raw, size))
        frames = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(raw, read_across_frames=True)
        stream = io.BufferedReader(frames, CHUNK)
        while (headers := headers_of(stream)) is not None:
            left, kind = int(headers["content-length"]), headers["warc-type"]
            if kind != "response":
                read_exactly(stream, left)
                length, digest, kept = int(headers.get("x-payload-length", 0)), headers.get("warc-payload-digest", ""), None
            else:
                while (line := stream.readline()) not in (b"\r\n", b""):
                    left -= len(line)
                left -= 2
                length, sha1, parts = left, hashlib.sha1(), []
                while left:
                    part = read_exactly(stream, min(left, CHUNK))
                    left -= len(part)
                    sha1.update(part)
                    if payloads:
                        parts.append(part)
                digest, kept = f"sha1:{base32(sha1.digest())}", b"".join(parts) if payloads else None
                if digest != headers["warc-payload-digest"]:
                    raise ValueError(f"payload of {headers['warc-record-id']} doesn't match its digest")
            if read_exactly(stream, 4) != b"\r\n\r\n":
                raise ValueError(f"record {headers.get('warc-record-id')} doesn't end where it says")
            if kind != "warcinfo":
                ids = [unquote(headers[key]) if key in headers else None for key in ("x-page-id", "x-refers-to-page-id")]
                yield ids[0], kind, headers["warc-target-uri"], length, digest.removeprefix("sha1:"), ids[1], kept


def _text(column: Column) -> Column:
    return column.cast("string")


def archive_rows(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """The records to write: one response for each payload, and revisits that know their response.

    Payloads are compared by length and SHA-256. Groups are narrow rows, counted before the shuffle; only rows of
    payloads that stand more than once are looked up, and whole payloads move only where there are such rows.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    whole = pages.select(F.col(id_col).alias("_id"), _text(F.col(url_col)).alias("_url"), html.alias("_html")).withColumn(
        "_same", F.unhex(F.sha2("_html", 256))
    )
    narrow = pin(whole.select("_id", "_url", "_same", F.unhex(F.sha1("_html")).alias("_sha1"), F.octet_length("_html").cast("long").alias("_bytes")))
    # A missing id is larger than any other, so it stands in front of the id in the order.
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_url").isNull().alias("bare"), F.col("_url").alias("url"))
    groups = (
        narrow.filter(F.col("_bytes") >= min_bytes)
        .groupBy("_same")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
        .filter("_n > 1")
        .select("_same", F.col("_first.id").alias("_first_id"), F.col("_first.url").alias("_first_url"))
    )
    placed = narrow.join(groups, "_same").withColumn(
        "_is_first", F.col("_id").eqNullSafe(F.col("_first_id")) & F.col("_url").eqNullSafe(F.col("_first_url"))
    )
    facts = ["_same", "_id", "_url", "_sha1", "_bytes", "_first_id", "_first_url"]
    # Rows that repeat id, address and payload: one of them is the response, the others are numbered.
    again = (
        placed.filter("_is_first").groupBy(*facts).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        .select(*facts, F.explode(F.sequence(F.lit(1), F.col("_n") - 1)).alias("_copy"))
    )
    revisits = pin(placed.filter("NOT _is_first").select(*facts, F.lit(0).cast("long").alias("_copy")).unionByName(again))

    def record_row(rows: DataFrame, payload: Column, first_id: Column, first_url: Column, copy: Column) -> DataFrame:
        return rows.select(
            _text(F.col("_id")).alias("id"), F.col("_url").alias("url"), payload.alias("payload"), F.col("_sha1").alias("sha1"),
            F.col("_bytes").alias("bytes"), _text(first_id).alias("first_id"), first_url.alias("first_url"), copy.cast("long").alias("copy"),
        )

    none = F.lit(None).cast("string")
    stored = whole.withColumn("_sha1", F.lit(None).cast("binary")).withColumn("_bytes", F.octet_length("_html").cast("long"))
    if not revisits.isEmpty():
        # Written, so that Spark knows the size and picks the join by it.
        path = f"{ensure_checkpoint_dir(pages.sparkSession)}/warc-keys-{uuid.uuid4()}"
        revisits.select("_same", "_id", "_url", (F.col("_copy") > 0).alias("_again")).distinct().write.parquet(path)
        keys = pages.sparkSession.read.parquet(path).toDF("_k_same", "_k_id", "_k_url", "_again")
        same = (F.col("_same") == F.col("_k_same")) & F.col("_id").eqNullSafe(F.col("_k_id")) & F.col("_url").eqNullSafe(F.col("_k_url"))
        once = stored.join(keys, same, "left_anti")
        one = stored.join(keys.filter("_again"), same, "left_semi").dropDuplicates(["_same", "_id", "_url"])
        stored = once.unionByName(one)
    return record_row(stored, F.col("_html"), none, none, F.lit(0)).unionByName(
        record_row(revisits, F.lit(None).cast("binary"), F.col("_first_id"), F.col("_first_url"), F.col("_copy"))
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Archive every row of `pages` under `folder`, a place all executors share; returns (path, records, bytes) per archive.

    Each task writes its own archives, closed beyond `archive_bytes`. Of records with equal payloads of `min_bytes` or
    more, the one with the smallest id is a response and the others are revisits of it; shorter payloads are all
    responses. NULL payloads are empty, a NULL address becomes one made of the id, a NULL id is larger than any other
    and has no header. Of rows that repeat the smallest id, the one of the smallest address is the response, and of rows
    alike in all three any one. Payloads may be as long as a row may be; other columns are ignored; an empty table
    gives no archive. What a lost task has left isn't listed and so never read.
    """
    folder = folder.rstrip("/")
    rows = archive_rows(pages, id_col, url_col, html_col, min_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            ids, urls, payloads, sha1s, sizes, first_ids, first_urls, copies = batch.columns
            for at in range(len(batch)):
                if archive is None:
                    archive = Archive(folder, date, archive_bytes)
                    archive.system.create_dir(archive.folder, recursive=True)
                payload = payloads[at].as_buffer().to_pybytes() if payloads[at].is_valid else None
                sha1 = sha1s[at].as_py() if payload is None else hashlib.sha1(payload).digest()
                archive.add(Page(ids[at].as_py(), urls[at].as_py(), payload, base32(sha1), sizes[at].as_py(), first_ids[at].as_py(), first_urls[at].as_py(), copies[at].as_py()))
        if archive is not None:
            archive.close()
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*archive.files, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["path", "records", "bytes"])

    return pin(rows.mapInArrow(write, _FILES))


def read_warc(files: DataFrame, payloads: bool = False) -> DataFrame:
    """The response and revisit records of the listed archives, one task for some archives at a time.

    `payload` is filled for responses only where `payloads` is set; ids are text, as the archive holds them.
    """
    number = max(1, min(files.count(), 4096))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64())]
                           + [("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                some, size = [], 0
                for row in read_archive(path, payloads):
                    some.append(row)
                    size += 256 + len(row[-1] or b"")
                    if size >= 4 * CHUNK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)
                        some, size = [], 0
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    return files.select("path").repartition(number).mapInArrow(read, _RECORDS)


def warc_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from archives of all pages."""
    kind = pages.schema["page_id"].dataType.simpleString()
    records = read_warc(write_warc(pages, f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4()}"))
    ids = [F.col(name).cast(kind).alias(name) for name in ("page_id", "refers_to")]
    return records.select(ids[0], "payload_bytes", "payload_digest", "record_type", ids[1])


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, payload, strlen(payload) AS payload_bytes, sha1(encode(payload)) AS hex,
             row_number() OVER (PARTITION BY payload ORDER BY page_id NULLS LAST) AS place,
             min(page_id) OVER (PARTITION BY payload) AS lowest FROM p),
q AS (SELECT *, [16 * (strpos('0123456789abcdef', substr(hex, k + 1, 1)) - 1) + strpos('0123456789abcdef', substr(hex, k + 2, 1)) - 1
                 FOR k IN range(39)] AS pairs FROM h)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((pairs[1 + 5 * i // 4] >> (3 - 5 * i % 4)) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN lowest END AS refers_to
FROM q
"""
