import base64
import hashlib
import struct

import pytest
import zstandard

from conftest_llm import ODD_TEXTS
from pricewise.llm import warc
from pricewise.llm.common import fresh_path

SCHEMA = "page_id long, url string, html string, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for i, _, html in rows:
        k = html or ""
        ids = [x for x in (first.get(k), i) if x is not None]
        first[k] = min(ids) if ids else None
    out = []
    for i, _, html in rows:
        b, f = (html or "").encode(), first[html or ""]
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), d, "response" if i == f else "revisit", None if i == f else f))
    return out


def key(rows):
    return sorted(rows, key=str)


def test_round_trip(spark):
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + i, None, f"<p>page {i % 7}</p>" * 20) for i in range(90)]
    rows += [(None, "http://null\r\nX: y", "<p>page 1</p>" * 20), (None, None, "only null"), rows[3], rows[20]]
    path = warc.write_warc(pages(spark, rows).repartition(3), fresh_path(spark, "t"))
    got = warc.read_warc(spark, path).filter("record_type != 'warcinfo'").collect()
    assert key([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                for r in got]) == key(brute(rows))
    text = {r.payload_digest: r.payload for r in got if r.record_type == "response"}
    assert all(base64.b32encode(hashlib.sha1(p).digest()).decode() == d for d, p in text.items())
    assert {r.target_uri for r in got if r.page_id is None} == {"http://null%0D%0AX:%20y", None}


@pytest.mark.parametrize("limit,rows", [(20_000, 64), (1 << 30, 5), (1, 3), (3_000, 1000)])
def test_archives_roll(spark, limit, rows):
    """Every file is an archive of its own, of bounded size, and nothing is lost between them."""
    data = [(i, f"http://x/{i}", f"<p>{i % 40} some words of a page</p>" * (1 + i % 9)) for i in range(200)]
    data += [(900, "http://big", "y" * 100_000)]
    path = warc.write_warc(pages(spark, data).repartition(2), fresh_path(spark, "t"),
                           archive_bytes=limit, archive_rows=rows)
    got = warc.read_warc(spark, path).collect()
    assert key([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                for r in got if r.record_type != "warcinfo"]) == key(brute(data))
    per = {}
    for r in got:
        n, size, info = per.get(r.archive, (0, 0, 0))
        per[r.archive] = (n + 1, size + (r.payload_bytes or 0) * (r.record_type == "response"), info + (r.record_type == "warcinfo"))
    assert all(info == 1 and n <= rows - 1 for n, _, info in per.values()) and len(per) > 2
    assert all(size <= limit or n == 2 for n, size, _ in per.values())


def test_a_long_page(spark):
    """Twelve MB in one page, as response and as revisit."""
    rows = [(1, "http://a", "long page " * 1_200_000), (2, "http://b", "long page " * 1_200_000), (3, None, "z")]
    path = warc.write_warc(pages(spark, rows), fresh_path(spark, "t"))
    got = warc.read_warc(spark, path, with_payload=False).filter("record_type != 'warcinfo'").collect()
    assert key([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]) == key(brute(rows))


def test_empty_table(spark):
    path = warc.write_warc(pages(spark, []), fresh_path(spark, "t"))
    assert warc.read_warc(spark, path).count() == 0


def archive(n=30):
    records = [warc.page_record(i, "http://a", f"<html>{i} some common words</html>" * 30, i, "2020-01-01T00:00:00Z")
               for i in range(n)]
    return list(warc.archive_frames(records, 3))


def test_dictionary_is_the_leading_frame():
    frames = archive(200)
    assert struct.unpack("<I", frames[0][:4])[0] == warc.DICTIONARY_MAGIC
    assert len(frames) == 201
    data = b"".join(f + warc.EMPTY_FRAME.encode() for f in frames)
    assert [r["page_id"] for r in warc.read_archive("a", data, True)] == list(range(200))
    # a raw (not compressed) dictionary is read as well
    body = zstandard.ZstdDecompressor().decompress(frames[0][8:])
    raw = struct.pack("<II", warc.DICTIONARY_MAGIC, len(body)) + body + b"".join(frames[1:])
    assert len(list(warc.read_archive("a", raw, True))) == 200
    with pytest.raises(ValueError):
        list(warc.read_archive("a", b"".join(frames[1:]), True))


def test_broken_records_are_found():
    good = warc.page_record(1, "http://a", "<p>x</p>", 1, "2020-01-01T00:00:00Z")
    bad = [good.replace(b"Content-Length: 8", b"Content-Length: 9"),
           good.replace(b"<p>x</p>", b"<p>y</p>"), good[:-2], good.replace(b"WARC/1.1", b"WARK/1.1"),
           good.replace(b"WARC-Date", b"Other"), good.replace(b"WARC-Type: response", b"WARC-Type: odd"),
           good + good]
    pack = zstandard.ZstdCompressor(write_checksum=True).compress
    for b in bad:
        data = pack(good) + pack(b) + pack(good)
        assert [r["error"] is None for r in warc.read_archive("a", data, False)] == [True, False, True]
        with pytest.raises(ValueError):
            list(warc.read_archive("a", data, True))
    cut = pack(good) + pack(good)[:-5]
    assert [r["error"] is None for r in warc.read_archive("a", cut, False)] == [True, False]
