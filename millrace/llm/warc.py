"""Pages to WARC records in ZIP packages, and range reads of single records from them."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_dir, written

ARCHIVE, INDEX = "archive/pages.warc.gz", "indexes/index.jsonl"
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 50_000
READ_BYTES = 4 << 20
_URN = "urn:millrace:page:"
_DATE = "2000-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _two_lines(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def build_record(page: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit without payload if it refers to another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{_one_line(page)}>",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_URN}{_one_line(refers_to)}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(data: bytes) -> dict:
    """The parts of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[: int(warc["content-length"])]
    inner, _, payload = block.partition(b"\r\n\r\n")
    http = _fields(inner)
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    response = warc["warc-type"] == "response"
    if response and base32_sha1(payload) != digest:
        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")

    def page(name: str) -> str | None:
        value = warc.get(name, "").removeprefix(f"<{_URN}").removesuffix(">")
        return _two_lines(value) or None

    return {
        "page": page("warc-record-id"),
        "url": _two_lines(warc.get("warc-target-uri", "")),
        "record_type": warc["warc-type"],
        "refers_to": page("warc-refers-to"),
        "payload_bytes": len(payload) if response else int(http["content-length"]),
        "payload_digest": digest,
        "payload": payload if response else None,
    }


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


_END, _LOCATOR, _END64 = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
_CENTRAL, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"


def read_directory(file) -> list[Member]:
    """The members of a ZIP file, from its central directory, ZIP64 or not.

    ``file`` offers ``size()`` and ``read_at(count, offset)``; the end of the file and
    the directory are all that is read.
    """
    size = file.size()
    tail_at = max(0, size - (22 + 0xFFFF + 20))
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(_END)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(_END, 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or 0xFFFFFFFF in (length, offset):
        if end < 20 or tail[end - 20 : end - 16] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        end64 = file.read_at(56, at)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    data = file.read_at(length, offset)
    members, at = [], 0
    for _ in range(count):
        if data[at : at + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, full, names, extras, notes = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode()
        extra, stop = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= stop:
            kind, own = struct.unpack_from("<HH", data, extra)
            if kind == 1:
                wide = extra + 4
                if full == 0xFFFFFFFF:
                    full, wide = struct.unpack_from("<Q", data, wide)[0], wide + 8
                if packed == 0xFFFFFFFF:
                    packed, wide = struct.unpack_from("<Q", data, wide)[0], wide + 8
                if header == 0xFFFFFFFF:
                    header = struct.unpack_from("<Q", data, wide)[0]
            extra += 4 + own
        members.append(Member(name, method, packed, header))
        at = stop + notes
    return members


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin in the file."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    local = file.read_at(30, member.header)
    if local[:4] != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", local, 26))


def read_package(file) -> Iterator[dict]:
    """The records of a package, in the order of its index, by ranges of a few megabytes."""
    members = {member.name: member for member in read_directory(file)}
    index, archive = members[INDEX], members[ARCHIVE]
    lines = file.read_at(index.size, data_start(file, index)).splitlines()
    base = data_start(file, archive)
    held, held_at = b"", 0
    for line in lines:
        entry = json.loads(line)
        at, length = base + entry["offset"], entry["length"]
        if at < held_at or at + length > held_at + len(held):
            held, held_at = file.read_at(max(length, min(READ_BYTES, base + archive.size - at)), at), at
        yield parse_record(gzip.decompress(held[at - held_at : at - held_at + length]))


def _open_store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write_package(store: fs.FileSystem, path: str, rows: Iterator[tuple]) -> int:
    """Stored members in one pass: records first, each compressed by itself, then their index."""
    entries, offset = [], 0
    with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        with package.open(ARCHIVE, "w", force_zip64=True) as archive:
            for page, url, payload, refers_to in rows:
                data = gzip.compress(build_record(page, url, payload, refers_to), compresslevel=1, mtime=0)
                archive.write(data)
                entries.append(json.dumps({"offset": offset, "length": len(data)}))
                offset += len(data)
        with package.open(INDEX, "w", force_zip64=True) as index:
            index.write("\n".join(entries).encode())
    return len(entries)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(folder)
        rows = (
            (page or "", url or "", payload, refers if revisit else None)
            for batch in batches
            for page, url, payload, revisit, refers in zip(
                *(batch.column(i).to_pylist() for i in (0, 1)),
                (p.as_py().encode() for p in batch.column(2)),
                *(batch.column(i).to_pylist() for i in (3, 4)),
            )
        )
        first = next(rows, None)
        while first is not None:

            def some():
                nonlocal first
                size = count = 0
                while first is not None and size < ARCHIVE_BYTES and count < ARCHIVE_RECORDS:
                    yield first
                    size, count = size + len(first[2]), count + 1
                    first = next(rows, None)

            name = f"pages-{uuid.uuid4().hex}.zip"
            records = _write_package(store, f"{root}/{name}", some())
            yield pa.record_batch([pa.array([name]), pa.array([records], pa.int64())], names=["name", "records"])

    return run


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(folder)
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        names = ("page", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")

        def made(found: list[dict]) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([r[n] for r in found], kinds.get(n, pa.string())) for n in names], names=list(names)
            )

        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{name}") as file:
                    found, size = [], 0
                    for record in read_package(file):
                        found.append(record)
                        size += len(record["payload"] or b"")
                        if size >= READ_BYTES or len(found) >= 5_000:
                            yield made(found)
                            found, size = [], 0
                    if found:
                        yield made(found)

    return run


def write_packages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write one record per page into ZIP packages under ``folder``; ``(name, records)`` per package.

    The payload is the text in UTF-8, a null text an empty one. Of pages with equal
    payloads of at least ``min_bytes`` bytes the one with the largest id is a response
    record, and the others revisit it; shorter ones are all responses. Rows that repeat
    the largest id are responses too. A null id revisits the largest one, and is a
    response if there is none. A null url is empty. Other columns are not read; an empty
    table gives no package.

    Payloads are compared by length and SHA-1; a group's largest id is aggregated before
    it is joined back, so a payload that very many pages share is never held together. A
    package has at most about ``ARCHIVE_BYTES`` of payload. Its name is new for each
    attempt, and only the packages of finished tasks are in the result. ``folder`` is any
    place that pyarrow can open on all executors.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    last = rows.where(F.col("bytes") >= min_bytes).groupBy("sha", "bytes").agg(F.max("id").alias("last"))
    joined = rows.join(last, ["sha", "bytes"], "left")
    revisit = F.coalesce(F.col("id") != F.col("last"), F.col("last").isNotNull())
    ready = joined.select(
        F.col("id").cast("string"), F.col("url").cast("string"), "payload", revisit, F.col("last").cast("string")
    )
    return written(ready.mapInArrow(_write(folder), "name string, records long"), "packages")


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """The records of packages: ``(page, url, record_type, refers_to, payload_bytes, payload_digest, payload)``.

    The directories of a package are parsed, its index is read, and each record is read by
    its range; nothing is extracted. Pages are texts; a revisit has no payload, but the
    length and the digest of the full one. One package is one row to deal out, so reading
    is spread over as many tasks as there are packages.
    """
    dealt = packages.select("name").repartition(packages.sparkSession.sparkContext.defaultParallelism, "name")
    return dealt.mapInArrow(
        _read(folder),
        "page string, url string, record_type string, refers_to string, "
        "payload_bytes long, payload_digest string, payload binary",
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Pages written to packages in the shared folder and read back, with ids of their own type."""
    kind = pages.schema[id_col].dataType
    folder = scratch_dir(pages.sparkSession, "warc")
    read = read_packages(write_packages(pages, folder, id_col, **options), folder)
    return read.select(
        F.col("page").cast(kind).alias(id_col),
        "url",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "payload",
    )
