"""Web archives in ZIP packages: written as stored members with an index, read back by range requests."""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the ZIP format: signatures, field limits beyond which the 64-bit records hold the value.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 0x0001
# Fixed values of the packages: where archives and indexes lie in them.
ARCHIVES, INDEXES = "archive/", "indexes/"
# The archive that a package of this writer holds.
ARCHIVE = "data.warc.gz"

# Payload bytes after which a package is closed and the next one begun.
PACKAGE_BYTES = 16 << 20
# Payloads under this size are never replaced by a reference.
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
PACKAGES = "path string, size long, records long"
RECORDS = (
    "page_id long, record_type string, url string, payload_digest string, payload_bytes long, "
    "refers_to long, payload binary, package string"
)


# --- ZIP -------------------------------------------------------------------------------------------------


def zip_stored(members: dict[str, bytes]) -> bytes:
    """A ZIP file whose members are stored as they are. All sizes and offsets stand in ZIP64 fields as well."""
    import zlib

    body, directory = bytearray(), bytearray()
    for name, data in members.items():
        raw, crc, at = name.encode(), zlib.crc32(data), len(body)
        sizes = struct.pack("<QQ", len(data), len(data))
        body += struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 33, crc, FULL32, FULL32, len(raw), 20) + raw
        body += struct.pack("<HH", ZIP64_FIELD, 16) + sizes + data
        extra = struct.pack("<HH", ZIP64_FIELD, 24) + sizes + struct.pack("<Q", at)
        directory += struct.pack(
            "<IHHHHHHIIIHHHHHII",
            CENTRAL, 45, 45, 0x800, 0, 0, 33, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32,
        ) + raw + extra
    n, start = len(members), len(body)
    end64 = struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, len(directory), start)
    locator = struct.pack("<IIQI", LOCATOR64, 0, start + len(directory), 1)
    end = struct.pack("<IHHHHIIH", END, 0, 0, min(n, FULL16), min(n, FULL16), FULL32, FULL32, 0)
    return bytes(body + directory + end64 + locator + end)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    start: int


def _range(file, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"package ends at {start + len(data)}, {start + size} expected")
    return data


def zip_directory(file) -> tuple[int, int, int]:
    """(start, size, entries) of the central directory, from the end records of a package."""
    length = file.size()
    tail_size = min(length, 22 + FULL16)
    tail = _range(file, length - tail_size, tail_size)
    at = tail.rfind(struct.pack("<I", END))
    # A comment may hold the signature by chance: the true record's comment ends with the file.
    while at >= 0 and (at + 22 > tail_size or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != tail_size):
        at = tail.rfind(struct.pack("<I", END), 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    entries, size, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == entries or FULL32 in (size, start):
        signature, _, end64, _ = struct.unpack("<IIQI", _range(file, length - tail_size + at - 20, 20))
        if signature != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = _range(file, end64, 56)
        if struct.unpack_from("<I", record)[0] != END64:
            raise ValueError("no ZIP64 end record")
        entries, size, start = struct.unpack_from("<QQQ", record, 32)
    return start, size, entries


def zip_members(file) -> list[Member]:
    """All members by the central directory; only it and each member's local header length are read."""
    start, size, entries = zip_directory(file)
    directory, at, found = _range(file, start, size), 0, []
    for _ in range(entries):
        signature, method, packed, plain, n, m, k, local = struct.unpack_from("<I6xH8xIIHHH8xI", directory, at)
        if signature != CENTRAL:
            raise ValueError("broken ZIP directory")
        name = directory[at + 46 : at + 46 + n].decode()
        extra, at = directory[at + 46 + n : at + 46 + n + m], at + 46 + n + m + k
        packed, local = _wide(extra, plain, packed, local)
        head = _range(file, local, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL:
            raise ValueError("broken ZIP member")
        found.append(Member(name, method, packed, local + 30 + sum(struct.unpack_from("<HH", head, 26))))
    return found


def _wide(extra: bytes, plain: int, packed: int, local: int) -> tuple[int, int]:
    """Packed size and offset, from the ZIP64 field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            if plain == FULL32:
                next(values)
            packed = next(values) if packed == FULL32 else packed
            local = next(values) if local == FULL32 else local
        at += 4 + size
    return packed, local


# --- WARC records ----------------------------------------------------------------------------------------


def _record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{payload_digest}')}>"


def _clean(url: str) -> str:
    """A header value on one line: control characters and blanks are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def warc_record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One record, compressed as a gzip member of its own. A revisit keeps the HTTP header and leaves out the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id, payload_digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _clean(url),
        "WARC-Payload-Digest": f"sha256:{payload_digest}",
        "WARC-Refers-To": _record_id(refers_to, payload_digest) if revisit else None,
        "X-Refers-To-Page": refers_to,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "X-Page-ID": page_id,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 3, mtime=0)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def parse_record(data: bytes) -> dict:
    """The row of one record; the digest and size of a response are taken from its payload and must match its header."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    length = int(_fields(http)["content-length"])
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != stated or len(payload) != length):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
    return {
        "page_id": None if page is None else int(page),
        "record_type": kind,
        "url": fields.get("warc-target-uri"),
        "payload_digest": stated,
        "payload_bytes": length,
        "refers_to": None if refers is None else int(refers),
        "payload": payload if kind == "response" else None,
    }


# --- Spark -----------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to``: pages of equal payloads refer to the smallest page id.

    The first page of a payload is found by an aggregate over digests and joined back by page and digest, so
    no group of equal pages comes together and payloads never move with their group.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    long = rows.where(F.octet_length("payload") >= least).select("page_id", "payload_digest")
    first = long.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to")).where("refers_to IS NOT NULL")
    again = (
        long.distinct()
        .join(first, "payload_digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"), "refers_to")
    )
    same = rows.page_id.eqNullSafe(again._page) & (rows.payload_digest == again._digest)
    return rows.join(again, same, "left").drop("_page", "_digest")


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes a record per page to ZIP packages in the folder; returns ``path, size, records`` of each.

    A package holds an archive of compressed records and an index of their offsets, both stored, and about
    ``package_bytes`` of payload. ``folder`` is a URI all machines reach. Each attempt of a task writes files
    of its own names, and only those named in the rows count, so the rows must be kept (written) before use.
    """

    def package(lines: list, archive: bytearray) -> pa.RecordBatch:
        index = "".join(json.dumps(line) + "\n" for line in lines).encode()
        data = zip_stored({f"{ARCHIVES}{ARCHIVE}": bytes(archive), f"{INDEXES}index.cdxj": index})
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        path = f"{base.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        with files.open_output_stream(path) as out:
            out.write(data)
        return pa.RecordBatch.from_pydict({"path": [path.rsplit("/", 1)[1]], "size": [len(data)], "records": [len(lines)]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, archive, size = [], bytearray(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    record = warc_record(
                        row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"]
                    )
                    lines.append({"page": row["page_id"], "filename": ARCHIVE, "offset": len(archive), "length": len(record)})
                    archive += record
                    size += len(row["payload"])
                    if size >= package_bytes:
                        yield package(lines, archive)
                        lines, archive, size = [], bytearray(), 0
        if lines:
            yield package(lines, archive)

    return pages.mapInArrow(run, PACKAGES)


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """All records of the packages, read by ranges: the end records, the directory, each index, each record.

    A package may hold several archives and indexes; each index entry names its archive by ``filename``, which may be
    missing where there is but one. Nothing is unpacked, and a task holds one index and a few records at a time. Only stored members can be
    read by range; a compressed archive or index is an error.
    """

    def records(path: str) -> Iterator[dict]:
        files, base = fs.FileSystem.from_uri(folder)
        with files.open_input_file(f"{base.rstrip('/')}/{path}") as file:
            members = {member.name: member for member in zip_members(file)}
            for name, member in members.items():
                if name.startswith((ARCHIVES, INDEXES)) and member.method:
                    raise ValueError(f"{path}: {name} is compressed")
            archives = {name.removeprefix(ARCHIVES): member for name, member in members.items() if name.startswith(ARCHIVES)}
            for name, index in members.items():
                if name.startswith(INDEXES):
                    for line in _range(file, index.start, index.size).splitlines():
                        entry = json.loads(line)
                        # An index need not name the archive where there is but one.
                        named = entry.get("filename") or (next(iter(archives)) if len(archives) == 1 else None)
                        if named not in archives:
                            raise ValueError(f"{path}: {name} has a record of archive {named!r}, which is not there")
                        data = _range(file, archives[named].start + entry["offset"], entry["length"])
                        yield parse_record(data) | {"package": path}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in RECORDS.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(field.split()[0], kinds[field.split()[1]]) for field in RECORDS.split(", ")])
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in records(path):
                    rows.append({name: row[name] for name in names})
                    size += row["payload_bytes"]
                    if len(rows) >= 1000 or size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return packages.select("path").mapInArrow(run, RECORDS)


def archived(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes all pages as packages into the folder and reads the records back, a row per page.

    The list of packages is written next to them first. NULL html is an empty payload; a NULL url has no
    target header; a NULL page id is kept and never the one that others refer to, unless all of a payload's
    are NULL, which are then all responses. Rows that repeat both page id and payload are records of the same
    kind. Payloads under 100 bytes are always responses. No pages give no packages and no rows. Extra columns
    are not read. A page of any size is one record.
    """
    listing = f"{folder.rstrip('/')}/packages"
    write_packages(with_revisits(pages), folder, package_bytes).write.parquet(listing)
    spark = pages.sparkSession
    packages = spark.read.schema(PACKAGES).parquet(listing)
    spread = packages.repartition(spark.sparkContext.defaultParallelism * 4, "path")
    return read_packages(spread, folder)
