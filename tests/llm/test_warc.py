import gzip
import io
import zipfile

import pytest

from geoweave.llm.warc import archive_pages, parse_record, record_bytes, sha1_base32, stored_members


def reader(raw):
    return lambda at, n: raw[at : at + n]


def test_zip64_directory_and_member_ranges():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True) as m:
            m.write(b"payload")
        for i in range(66_000):  # more members than the plain record can count
            z.writestr(zipfile.ZipInfo(f"x/{i}"), b"")
        z.comment = b"a comment"
    raw = buf.getvalue()
    members = stored_members(reader(raw), len(raw))
    assert len(members) == 66_001
    at, n, _ = members["archive/data.warc.gz"]
    assert raw[at : at + n] == b"payload"


def test_zip64_sizes_from_extra_field():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr(zipfile.ZipInfo("a"), b"hello")
    raw = bytearray(buf.getvalue())
    at = raw.rfind(b"PK\x01\x02")
    import struct

    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = bytearray(raw[at : at + 47])
    entry[20:28] = b"\xff" * 8
    entry[30:32] = struct.pack("<H", len(extra))
    entry[42:46] = b"\xff" * 4
    end = bytearray(raw[at + 47 :])
    end[12:16] = struct.pack("<L", len(entry) + len(extra))
    raw = bytes(raw[:at]) + bytes(entry) + extra + bytes(end)
    where, n, _ = stored_members(reader(raw), len(raw))["a"]
    assert raw[where : where + n] == b"hello"


def test_compressed_member_is_refused():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        stored_members(reader(buf.getvalue()), len(buf.getvalue()))
    with pytest.raises(ValueError):
        stored_members(reader(b"no zip"), 6)


def test_record_round_trip_and_damage():
    p = "é\r\n\r\nx".encode()
    raw = record_bytes("7", "http://a\n/b", p, None, sha1_base32(p))
    row = parse_record(raw)
    assert (row["payload"], row["url"], row["record_type"]) == (p, "http://a\n/b", "response")
    with pytest.raises(ValueError):
        parse_record(raw.replace("é".encode(), "è".encode()))
    row = parse_record(record_bytes("3", None, p, "7", sha1_base32(p)))
    assert (row["refers_to"], row["payload"], row["payload_bytes"], row["url"]) == ("7", None, len(p), None)
    assert gzip.decompress(gzip.compress(raw, 1, mtime=0)) == raw


def test_pages_against_brute_force(spark):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 70_000, "<p>b</p>", "<p>a</p>", "<p>b</p>"]
    rows = [(i, f"http://x/{i}" if i % 3 else None, h, "z") for i, h in enumerate(html)]
    rows += [(7, "http://x/7", "<p>b</p>", "again"), (None, "http://n", "only", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    got = sorted(map(tuple, archive_pages(df).collect()), key=repr)
    want = []
    for i, u, h, _ in rows:
        p = (h or "").encode()
        best = max((j for j, _, g, _ in rows if (g or "") == (h or "") and j is not None), default=None)
        ref = best if best is not None and best != i else None
        want.append((i, u, len(p), sha1_base32(p), "response" if ref is None else "revisit", ref))
    assert got == sorted(want, key=repr)
    limited = {r.page_id: r.record_type for r in archive_pages(df.filter("page_id is not null"), min_revisit_bytes=8).collect()}
    assert limited[1] == limited[2] == "response" and limited[0] == "revisit"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert archive_pages(df).collect() == []
