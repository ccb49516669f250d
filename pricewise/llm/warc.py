"""WARC archives, one Zstandard frame per record.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the compression
dictionary, followed by one frame per WARC record, as the public .warc.zst convention has
it. Every archive is one output file of Spark's text writer: a row is a whole frame, and
the writer's line separator is itself an empty skippable frame, which every Zstandard
reader steps over. So archives reach any file system that Spark writes to, through its
commit protocol, and a lost executor or a second attempt leaves no half archive. A task begins a new
archive after ``ARCHIVE_BYTES`` of records (uncompressed; a longer record is alone): the writer
begins a file every ``ARCHIVE_ROWS`` rows, and an archive is filled up to that with empty
skippable frames.

Of records with equal payloads the one with the smallest page_id is a ``response`` and the
others are ``revisit`` records that carry only the HTTP header; its Content-Length is the
payload's. Defined cases: null html is an empty payload; a null page_id sorts last (if all
of a group are null, each is a response); rows that repeat the smallest page_id of a group
are each a response; a null url leaves out the target URI, and its control characters are
percent-encoded; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, repeat

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, read

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_DICTIONARY_MAGIC = 0xEC30A437
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # magic 0x184D2A50, length 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
TYPES = ("warcinfo", "response", "revisit", "resource", "request", "metadata", "conversion",
         "continuation")

CHUNK = 1 << 16
#: The dictionary of an archive is trained on at most so many records and bytes at its head.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 4 << 20, 32 << 10
#: An archive's bytes of records, and the rows (frames) that make one file.
ARCHIVE_BYTES, ARCHIVE_ROWS = 1 << 30, 1 << 16

RECORD_SCHEMA = ("archive string, frame_offset long, record_type string, record_id string, "
                 "target_uri string, page_id long, payload_bytes long, payload_digest string, "
                 "refers_to long, payload binary, error string")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, record_id: str, date: str, block: bytes, extra: list[tuple[str, str]],
            content_type: str) -> bytes:
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date),
               ("Content-Type", content_type), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
               *extra, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _page_urn(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def page_record(page_id: int | None, url: str | None, html: str | None, first: int | None,
                date: str) -> bytes:
    """A response, or (``first`` names another page) a revisit of it."""
    payload = (html or "").encode()
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    extra = [("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")]
    if url is not None:
        extra.append(("WARC-Target-URI", _uri(url)))
    if page_id == first:
        return _record("response", _page_urn(page_id), date, http + payload, extra,
                       "application/http;msgtype=response")
    extra += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_page_urn(first)}>")]
    return _record("revisit", _page_urn(page_id), date, http, extra,
                   "application/http;msgtype=response")


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading skippable frame, and the dictionary; none for too few samples."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return b"", None
    body = zstandard.ZstdCompressor().compress(trained.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body, trained


def archive_frames(records: Iterable[bytes], level: int) -> Iterator[bytes]:
    """Frames of one archive. Only the sample at its head is held."""
    records = iter(records)
    head: list[bytes] = []
    size = 0
    for r in records:
        head.append(r)
        size += len(r)
        if len(head) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
            break
    if not head:
        return
    leading, trained = dictionary_frame(head)
    if leading:
        yield leading
    compressor = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True,
                                          write_content_size=True)
    for r in chain(head, records):
        yield compressor.compress(r)


def rolled_frames(records: Iterator[tuple[str, bytes]], date: str, level: int, limit: int,
                  rows: int) -> Iterator[bytes]:
    """Frames of as many archives as (name, record) ``records`` fill. Every archive begins with a
    warcinfo record named after its first page; all but the last have ``rows`` frames."""
    info = b"software: spark warc writer\r\nformat: WARC File Format 1.1\r\n"
    ahead = next(records, None)

    def one() -> Iterator[bytes]:
        nonlocal ahead
        yield _record("warcinfo", f"urn:archive:{ahead[0]}", date, info, [], "application/warc-fields")
        size = n = 0
        # beside these a dictionary and a warcinfo frame
        while ahead is not None and n < rows - 2 and (n == 0 or size + len(ahead[1]) <= limit):
            size, n = size + len(ahead[1]), n + 1
            yield ahead[1]
            ahead = next(records, None)

    while ahead is not None:
        n = 0
        for frame in archive_frames(one(), level):
            yield frame
            n += 1
        if ahead is not None:
            yield from repeat(EMPTY_FRAME.encode("latin-1"), rows - n)


def _writer(date: str, level: int, limit: int, archive_rows: int) -> Callable:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[str, bytes]]:
            for b in batches:
                for row in zip(*(b.column(c).to_pylist()
                                 for c in ("page_id", "url", "html", "first"))):
                    yield str(row[0]), page_record(*row, date)
        held: list[bytes] = []
        size = 0
        for frame in rolled_frames(records(), date, level, limit, archive_rows):
            held.append(frame)
            size += len(frame)
            if size >= 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
    return write


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
               level: int = 3, archive_bytes: int = ARCHIVE_BYTES, archive_rows: int = ARCHIVE_ROWS) -> str:
    """Write ``pages`` (page_id, url, html) as archives in the folder ``path``."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string"),
                        F.sha1(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("digest"))
    # one row per distinct payload after map-side aggregation; a hot payload's rows are on
    # the left of the join only, where adaptive execution splits them
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    frames = rows.join(firsts, "digest").select("page_id", "url", "html", "first") \
        .mapInArrow(_writer(date, level, archive_bytes, archive_rows), "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", EMPTY_FRAME) \
        .option("maxRecordsPerFile", archive_rows).text(path)
    return path


def split_frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every frame that holds data, decoded with the dictionary of
    the leading skippable frame if there is one."""
    view, at, size = memoryview(data), 0, len(data)
    decoder = zstandard.ZstdDecompressor()
    while at < size:
        if at + 4 > size:
            raise ValueError(f"{size - at} bytes after the last frame")
        magic = struct.unpack_from("<I", view, at)[0]
        if magic in SKIPPABLE:
            if at + 8 > size:
                raise ValueError("a skippable frame is cut off")
            length = struct.unpack_from("<I", view, at + 4)[0]
            if at + 8 + length > size:
                raise ValueError("a skippable frame is cut off")
            if at == 0 and magic == DICTIONARY_MAGIC:
                body = bytes(view[8:8 + length])
                if struct.unpack_from("<I", body)[0] != ZSTD_DICTIONARY_MAGIC:
                    body = zstandard.ZstdDecompressor().decompress(body)
                decoder = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + length
            continue
        frame, parts, begin = decoder.decompressobj(), [], at
        while not frame.eof:
            if at >= size:
                raise ValueError("a frame is cut off")
            piece = view[at:at + CHUNK]
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield begin, b"".join(parts)


def parse_record(raw: bytes) -> dict:
    """Headers and block of one record; raises ValueError where it isn't valid."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"no WARC version line: {lines[0][:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"not a header line: {line[:80]!r}")
        headers[name.lower()] = value.strip()
    for name in REQUIRED:
        if name not in headers:
            raise ValueError(f"{name} is missing")
    if headers["warc-type"] not in TYPES:
        raise ValueError(f"unknown record type {headers['warc-type']!r}")
    if not headers["content-length"].isdigit():
        raise ValueError(f"content-length is {headers['content-length']!r}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"content-length is {length}, the frame holds {len(rest) - 4}")
    block = rest[:length]
    digest = headers.get("warc-block-digest")
    if digest and digest != f"sha1:{sha1_base32(block)}":
        raise ValueError("the block digest differs")
    return {"headers": headers, "block": block}


def _urn_page(value: str | None) -> int | None:
    tail = (value or "").strip("<>").removeprefix("urn:page:")
    return int(tail) if tail.lstrip("-").isdigit() else None


def page_fields(record: dict) -> dict:
    """Fields of a response or revisit: its HTTP header and payload agree with the WARC header."""
    h = record["headers"]
    out = {"record_type": h["warc-type"], "record_id": h["warc-record-id"].strip("<>"),
           "target_uri": h.get("warc-target-uri"), "page_id": None, "payload_bytes": None,
           "payload_digest": None, "refers_to": None, "payload": None}
    if out["record_type"] not in ("response", "revisit"):
        return out
    http, sep, payload = record["block"].partition(b"\r\n\r\n")
    fields = dict(x.lower().split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])
    if not sep or not fields.get("content-length", "").isdigit():
        raise ValueError("the HTTP header has no content-length")
    out["payload_bytes"] = int(fields["content-length"])
    out["payload_digest"] = h.get("warc-payload-digest", "").removeprefix("sha1:")
    out["page_id"] = _urn_page(h["warc-record-id"])
    if out["record_type"] == "revisit":
        if payload or "warc-refers-to" not in h:
            raise ValueError("a revisit holds a payload or refers to nothing")
        out["refers_to"] = _urn_page(h["warc-refers-to"])
        return out
    if len(payload) != out["payload_bytes"]:
        raise ValueError(f"the payload has {len(payload)} of {out['payload_bytes']} bytes")
    if out["payload_digest"] != sha1_base32(payload):
        raise ValueError("the payload digest differs")
    return out | {"payload": payload}


def read_archive(name: str, data: bytes, strict: bool) -> Iterator[dict]:
    """Records of one archive. A broken record raises (``strict``), or gives a row with
    its ``error``; what follows a broken frame can't be read and is one such row."""
    try:
        for offset, raw in split_frames(data):
            try:
                row = page_fields(parse_record(raw)) | {"error": None}
            except (ValueError, UnicodeDecodeError) as e:
                if strict:
                    raise ValueError(f"{name} at {offset}: {e}") from e
                row = {"error": str(e)}
            yield row | {"archive": name, "frame_offset": offset}
    except (ValueError, zstandard.ZstdError) as e:
        if strict:
            raise ValueError(f"{name}: {e}") from e
        yield {"archive": name, "error": str(e)}


def read_warc(spark: SparkSession, path: str, strict: bool = True,
              with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in the folder ``path``."""
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    kinds = {"frame_offset": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(),
             "refers_to": pa.int64(), "payload": pa.binary()}

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names],
                names)
        for b in batches:
            for i in range(b.num_rows):
                rows, size = [], 0
                for r in read_archive(b.column(0)[i].as_py(), b.column(1)[i].as_py(), strict):
                    if not with_payload:
                        r.pop("payload", None)
                    rows.append(r)
                    size += len(r.get("payload") or b"") + 200
                    if size >= 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parse, RECORD_SCHEMA)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    path = write_warc(read(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    records = read_warc(spark, path, with_payload=False)
    return records.filter(F.col("record_type").isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


#: base32 of the digest: each ten hex digits are eight letters of five bits.
OP1_SQL = """
WITH pages_ AS (SELECT row_number() OVER () AS r, page_id, url, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT *, sha1(html) AS hex FROM pages_),
letters AS (
    SELECT r, c, j, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
        ((CAST('0x' || substr(hex, 10 * c + 1, 10) AS BIGINT) >> (35 - 5 * j)) & 31) + 1 AS BIGINT), 1) AS letter
    FROM hashed, (SELECT unnest(range(0, 4)) AS c), (SELECT unnest(range(0, 8)) AS j)),
digests AS (SELECT r, string_agg(letter, '' ORDER BY c, j) AS digest FROM letters GROUP BY r),
firsts AS (SELECT hex, min(page_id) AS first FROM hashed GROUP BY hex)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, url AS target_uri
FROM hashed JOIN digests USING (r) JOIN firsts USING (hex)
"""
