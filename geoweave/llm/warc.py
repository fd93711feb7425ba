"""WARC archives inside ZIP packages: writer, and a reader that never extracts a package.

A package is a ZIP file with two *stored* members: ``archive/data.warc.gz`` (one gzip member per
record) and ``indexes/index.cdxj`` (one line per record: offset, length). ZIP64 fields are always
written for the archive member.

Reading goes in three ranges per package: the tail (end-of-central-directory record, ZIP64 locator
and record), the central directory, and the local header of each member. The index gives record
ranges; runs of neighbouring records are read with one range request each, in parallel tasks.

Files are reached through ``pyarrow.fs`` from the URI of the shared folder, so they live wherever
``spark.checkpoint.dir`` points. A task writes under a name of its own attempt and reports it in the
manifest; a lost executor's half-written file is never listed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.plans.iterate import checkpoint
from geoweave.session import ensure_checkpoint_dir

ARCHIVE = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EXACT_URI = "X-Target-URI-Base64"
DATE = "2020-01-01T00:00:00Z"  # fixed value: a rewritten package has equal bytes

RUNS_PER_TASK = 4
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

MANIFEST = "path string, n_records long, n_bytes long"
RECORD = (
    "record_id string, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to string, payload binary"
)


def open_store(uri: str):
    """``(filesystem, path)`` of a folder or file URI; plain paths are local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    for scheme in ("s3a://", "s3n://"):  # Spark's names of what pyarrow calls s3
        uri = uri.replace(scheme, "s3://", 1) if uri.startswith(scheme) else uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def arrow_batches(spark: SparkSession, n_bytes: int):
    """Arrow batches of about ``n_bytes`` inside the block (rows of whole pages are large)."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


# ---- records ---------------------------------------------------------------------------------


def _clean(value: str) -> str:
    """A header value on one line: controls as percent escapes."""
    return "".join(f"%{ord(c):02X}" if c < " " else c for c in value)


def record_bytes(record_id: str, url: str | None, payload: bytes, refers_to: str | None, digest: str) -> bytes:
    """One response or revisit record. A revisit holds the HTTP head only; its Content-Length is that
    of the full payload, as the server sent it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:record:{record_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
        if _clean(url) != url:  # the address as given, which has no place in a header line
            lines.append(f"{EXACT_URI}: {base64.b64encode(url.encode()).decode()}")
    body = head
    if refers_to is None:
        body += payload
    else:
        lines += [f"WARC-Refers-To: <urn:record:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = next(int(x[15:]) for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    name = lambda x: x.removeprefix("<urn:record:").removesuffix(">") if x else None
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != full or sha1_base32(payload) != digest):
        raise ValueError(f"payload of record {fields['WARC-Record-ID']} does not match its digest")
    return {
        "record_id": name(fields["WARC-Record-ID"]),
        "url": base64.b64decode(fields[EXACT_URI]).decode() if EXACT_URI in fields else fields.get("WARC-Target-URI"),
        "payload_bytes": full,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": name(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


# ---- packages --------------------------------------------------------------------------------


class _Package:
    """Writer of one package: records go to the archive member as they come."""

    def __init__(self, folder: str):
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        self.path = f"{folder}/{name}"
        self.raw = store.open_output_stream(f"{base}/{name}")
        self.zip = zipfile.ZipFile(_Unseekable(self.raw), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, record_id: str, raw: bytes) -> None:
        packed = gzip.compress(raw, 1, mtime=0)
        self.index.append(json.dumps({"id": record_id, "offset": self.size, "length": len(packed)}))
        self.member.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        size = self.raw.tell()
        self.raw.close()
        return self.path, len(self.index), size


class _Unseekable(io.RawIOBase):
    """Append-only view of a store's output stream, for ``zipfile``."""

    def __init__(self, raw):
        self.raw_stream = raw

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.raw_stream.write(data)
        return len(data)

    def flush(self) -> None:
        pass


def write_packages(records: DataFrame, folder: str, package_bytes: int = 64 << 20) -> DataFrame:
    """Write ``records`` ``(record_id, url, html, refers_to, digest?)`` as packages under ``folder``.

    Returns the manifest ``(path, n_records, n_bytes)``, one row per package, already materialised.
    A package is closed when its archive reaches ``package_bytes``; memory is bounded by one record
    plus the index lines of one package. Null html is an empty payload; an empty table writes none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_package = None
        done = []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("record_id", "url", "html", "refers_to")), strict=True):
                rid, url, html, refers = (x.as_py() for x in row)
                payload = (html or "").encode()
                if open_package is None:
                    open_package = _Package(folder)
                open_package.add(rid, record_bytes(rid, url, payload, refers, sha1_base32(payload)))
                if open_package.size >= package_bytes:
                    done.append(open_package.close())
                    open_package = None
        if open_package is not None:
            done.append(open_package.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                ["path", "n_records", "n_bytes"],
            )

    with arrow_batches(records.sparkSession, BATCH_BYTES):
        return checkpoint(records.select("record_id", "url", "html", "refers_to").mapInArrow(run, MANIFEST))


# ---- reader ----------------------------------------------------------------------------------


def _zip64_extra(extra: bytes, wanted: list[bool]) -> list[int]:
    """The 64-bit values present for the fields that are ``wanted``, in their fixed order."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            return [struct.unpack_from("<Q", extra, at + 4 + 8 * k)[0] for k in range(sum(wanted))]
        at += 4 + size
    raise ValueError("ZIP64 sizes are missing")


def stored_members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """``name → (data offset, length, crc)`` of a package's stored members.

    ``read(offset, length)`` is a range read. Only the tail, the central directory and each member's
    local header are read. Compressed members raise: their records have no ranges of their own.
    """
    tail_at = max(0, size - 65_557)  # longest comment plus the record itself
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end-of-central-directory record")
    count, dir_size, dir_at = struct.unpack_from("<10xHLL", tail, at)
    here = tail_at + at
    if here >= 20:
        locator = read(here - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            record = read(struct.unpack_from("<8xQ", locator)[0], 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("damaged ZIP64 record")
            count, dir_size, dir_at = struct.unpack_from("<32xQQQ", record)
    directory = read(dir_at, dir_size)
    found, at = {}, 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, crc, packed, plain, n, m, k, local = struct.unpack_from("<10xH4xLLLHHH8xL", directory, at)
        name = directory[at + 46 : at + 46 + n].decode()
        wide = [x == 0xFFFFFFFF for x in (plain, packed, local)]
        if any(wide):
            values = iter(_zip64_extra(directory[at + 46 + n : at + 46 + n + m], wide))
            plain, packed, local = (next(values) if w else x for w, x in zip(wide, (plain, packed, local), strict=True))
        at += 46 + n + m + k
        if name.endswith("/"):
            continue
        if method != 0 or packed != plain:
            raise ValueError(f"member {name} is not stored")
        head = read(local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"damaged local header of {name}")
        skip = sum(struct.unpack_from("<26xHH", head))
        found[name] = (local + 30 + skip, packed, crc)
    return found


def _ranges(path: str):
    store, where = open_store(path)
    file = store.open_input_file(where)
    return file, (lambda at, n: bytes(file.read_at(n, at)))


def locate_records(manifest: DataFrame, run_bytes: int = 4 << 20) -> DataFrame:
    """``(path, start, lengths)``: runs of neighbouring records of about ``run_bytes`` each, from
    the index members of the packages listed in ``manifest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file, read = _ranges(path)
                with file:
                    members = stored_members(read, file.size())
                    out = []
                    for name in sorted(m for m in members if m.startswith("indexes/")):
                        at, n, crc = members[name]
                        raw = read(at, n)
                        if zlib.crc32(raw) != crc:
                            raise ValueError(f"index of {path} is damaged")
                        base = members[ARCHIVE][0]
                        start, lengths = None, []
                        for line in raw.decode().splitlines():
                            x = json.loads(line)
                            if lengths and (start + sum(lengths) != base + x["offset"] or sum(lengths) >= run_bytes):
                                out.append((path, start, lengths))
                                lengths = []
                            if not lengths:
                                start = base + x["offset"]
                            lengths.append(x["length"])
                        if lengths:
                            out.append((path, start, lengths))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int64()))],
                        ["path", "start", "lengths"],
                    )

    return manifest.select("path").mapInArrow(run, "path string, start long, lengths array<long>")


def read_records(located: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the located runs, each run read with one range request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "lengths")), strict=True):
                file, read = _ranges(path)
                with file:
                    raw = read(start, sum(lengths))
                at, rows = 0, []
                for n in lengths:
                    row = parse_record(gzip.decompress(raw[at : at + n]))
                    at += n
                    rows.append(row if with_payload else row | {"payload": None})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return located.mapInArrow(run, RECORD)


# ---- pages -----------------------------------------------------------------------------------


def archive_pages(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write one record per page to packages and read them all back.

    Among pages with equal payloads of at least ``min_revisit_bytes`` bytes the largest ``page_id`` is
    the response and the others revisit it; shorter payloads are all responses. Returns ``page_id,
    url, payload_bytes, payload_digest, record_type, refers_to``.

    Null html is an empty payload; a null ``page_id`` is the smallest of its group (and ``refers_to``
    null only where the whole group has none, all of it responses); repeated rows get a record each, of the same type;
    an empty table gives an empty result; other columns are ignored. Groups of equal payloads are
    resolved on ``(page_id, digest)`` rows only, by a partial aggregate and a join whose hot side
    can be split; payloads move once, by page. Packages in a given ``folder`` stay; without one they
    are deleted as soon as they have been read back.
    """
    spark = pages.sparkSession
    own = folder is None
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    html = F.coalesce(F.col("html"), F.lit("")).alias("html")
    source = pages.select("page_id", "url", html).withColumn("_d", F.sha1(F.col("html").cast("binary")))
    keys = source.select("page_id", "_d", (F.octet_length("html") >= F.lit(min_revisit_bytes)).alias("_shared"))
    best = keys.filter("_shared").groupBy("_d").agg(F.max("page_id").alias("_best"), F.count(F.lit(1)).alias("_n"))
    best = best.filter("_n > 1").select("_d", "_best")
    revisits = (
        keys.filter("_shared")
        .join(best, "_d")
        .filter(F.col("_best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_best")))
        .select(F.col("page_id").alias("_p"), F.col("_d").alias("_rd"), "_best")
        .distinct()
    )
    records = source.join(
        revisits, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("_d") == F.col("_rd")), "left"
    ).select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("record_id"),
        "url",
        "html",
        F.col("_best").cast("string").alias("refers_to"),
    )
    manifest = write_packages(records, folder)
    # fixed counts: the rows are few and small, but each stands for much reading
    located = checkpoint(locate_records(manifest.repartition(max(1, manifest.count()), "path")))
    back = read_records(located.repartition(max(1, -(-located.count() // RUNS_PER_TASK)), "path", "start"), with_payload=False)
    if own:  # what was read stays, the packages go
        back = checkpoint(back.drop("payload"))
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    as_id = lambda c: F.when(F.col(c) != "", F.col(c)).cast(pages.schema["page_id"].dataType)
    return back.select(
        as_id("record_id").alias("page_id"),
        "url",
        "payload_bytes",
        "payload_digest",
        "record_type",
        as_id("refers_to").alias("refers_to"),
    )
