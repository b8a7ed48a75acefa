"""Web archives in ZIP packages: written by Spark tasks, read back by byte ranges.

A package holds stored members only: ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (one line
per record with its place). The reader never extracts a package. It reads the end of the file, follows the end-of-central-
directory record and, where that says so, its ZIP64 counterpart, walks the central directory, looks up the local headers of
the members it needs, reads the index, and then fetches records as byte ranges.

* Equal payloads are found by digest: counts per digest are combined map-side, only repeated digests are attached to the pages.
* A task writes packages of about ``package_bytes``, each under a name of its own, and reports them; only the packages of the
  reported (committed) tasks are read, so a task that is run again cannot mix with its lost attempt.
* Reading has two steps: directories and indexes give one row per record, and the records are dealt out by ranges of a package,
  so that one large package is read by many tasks.

Files are opened through ``pyarrow.fs`` by URI; the folder must be one that driver and executors share.

Defined results: a null html is the empty payload; among equal payloads of at least ``min_bytes`` that with the smallest id is the
response and the others revisit it, smaller payloads are all responses; rows that repeat the smallest id are all responses; a
page without id revisits like any other and is a response where no equal page has an id; an empty table gives an empty one.
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
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.llm.shared import scratch_dir, stash

PACKAGE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
TASK_BYTES = 4 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records -----------------------------------------------------------------------------------------------------------


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header of the full payload and no body."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url:
        safe = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse_record(raw: bytes) -> dict:
    """The fields of one record; the digest of a payload that is present is recomputed and must agree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    h = _headers(head)
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda text: int(text) if (text := text.strip("<>").rpartition(":")[2]) else None
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response" and sha1_base32(payload) != digest:
        raise ValueError(f"record {h['warc-record-id']}: payload does not match its digest")
    return {
        "page_id": number(h["warc-record-id"]), "url": h.get("warc-target-uri"), "record_type": kind,
        "payload_bytes": int(_headers(http)["content-length"]), "payload_digest": digest,
        "refers_to": number(h["warc-refers-to"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None,
    }


# --- packages ------------------------------------------------------------------------------------------------------------


class Package:
    """A package in the making; bounded, so it is kept in memory until it is written in one go."""

    def __init__(self):
        self.data, self.index = io.BytesIO(), []

    def add(self, record: bytes, page_id: int | None, url: str | None) -> None:
        squeezed = gzip.compress(record, 4, mtime=0)
        place = {"page_id": page_id, "url": url, "filename": WARC, "offset": self.data.tell(), "length": len(squeezed)}
        self.index.append(json.dumps(place))
        self.data.write(squeezed)

    def bytes(self) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            for name, data in ((WARC, self.data.getbuffer()), (INDEX, "\n".join(self.index).encode())):
                z.writestr(zipfile.ZipInfo(name), data)
        return out.getvalue()


def _writer(folder: str, package_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_uri(folder)
        files.create_dir(root, recursive=True)

        def close(package: Package) -> pa.RecordBatch:
            data, name = package.bytes(), f"{uuid.uuid4().hex}.wacz"
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            return pa.RecordBatch.from_pylist([{"uri": f"{folder}/{name}", "bytes": len(data), "records": len(package.index)}])

        package = Package()
        for batch in batches:
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode()
                record = warc_record(row["page_id"], row["url"], payload, row["first"], row["revisit"], date)
                package.add(record, row["page_id"], row["url"])
                if package.data.tell() >= package_bytes:
                    yield close(package)
                    package = Package()
        if package.index:
            yield close(package)

    return write


def write_packages(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write every page as a record; return the table (uri, bytes, records) of the packages."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= min_bytes, F.sha1(F.encode("html", "UTF-8"))))
    again = rows.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    again = stash(again.where("copies > 1"), "warc-again")
    known = attach(rows, again, ["digest"], "copies")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    records = known.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    return stash(records.mapInArrow(_writer(folder, package_bytes, date), "uri string, bytes bigint, records bigint"), "warc-packages")


# --- directories ------------------------------------------------------------------------------------------------------------


class Ranges:
    """Byte ranges of a file that can only be read by place."""

    def __init__(self, uri: str):
        files, path = open_uri(uri)
        self.file = files.open_input_file(path)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        if offset < 0 or offset + length > self.size:
            raise ValueError("range beyond the file")
        return self.file.read_at(length, offset)

    def close(self) -> None:
        self.file.close()


def central_directory(src: Ranges) -> list[dict]:
    """Members (name, method, size, header) of a ZIP or ZIP64 file."""
    tail_at = max(0, src.size - 65_557)
    tail = src.read(tail_at, src.size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end + 3)  # a comment may hold the signature
    if end < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (size, start):
        locator = src.read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = src.read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, out = src.read(start, size), 0, []
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, full = struct.unpack_from("<H", raw, at + 10)[0], *struct.unpack_from("<II", raw, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", raw, at + 28)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra, e = raw[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, e)
            if tag == 1:  # the 64-bit values stand in this order, only for fields that are full
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, e + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            e += 4 + n
        out.append({"name": name, "method": method, "size": packed, "header": header})
        at += 46 + n_name + n_extra + n_comment
    return out


def member_start(src: Ranges, member: dict) -> int:
    """Where the bytes of a stored member begin."""
    if member["method"] != 0:
        raise ValueError(f"{member['name']} is compressed; only stored members can be read by range")
    head = src.read(member["header"], 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    return member["header"] + 30 + sum(struct.unpack_from("<HH", head, 26))


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            src = Ranges(uri)
            members = {m["name"]: m for m in central_directory(src)}
            starts: dict[str, int] = {}
            for name, member in members.items():
                if not (name.startswith("indexes/") and name.endswith(".cdxj")):
                    continue
                lines = src.read(member_start(src, member), member["size"]).decode().splitlines()
                rows = []
                for place in map(json.loads, filter(None, lines)):
                    own = place["filename"]
                    if own not in starts:
                        starts[own] = member_start(src, members[own])
                    rows.append({"uri": uri, "offset": starts[own] + place["offset"], "length": place["length"]})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)
            src.close()


def _records(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, Ranges] | None = None
        for batch in batches:
            rows, out, held = batch.to_pylist(), [], 0
            k = 0
            while k < len(rows):
                uri, first = rows[k]["uri"], rows[k]["offset"]
                if opened is None or opened[0] != uri:
                    if opened:
                        opened[1].close()
                    opened = (uri, Ranges(uri))
                j, stop = k, first
                while j < len(rows) and rows[j]["uri"] == uri and (j == k or stop == rows[j]["offset"] and stop - first < RANGE_BYTES):
                    stop = rows[j]["offset"] + rows[j]["length"]
                    j += 1
                data = memoryview(opened[1].read(first, stop - first))
                for r in rows[k:j]:
                    at = r["offset"] - first
                    record = parse_record(gzip.decompress(data[at : at + r["length"]]))
                    if not payloads:
                        record["payload"] = None
                    out.append(record)
                    held += record["payload_bytes"] if payloads else 0
                    if held > RANGE_BYTES:
                        yield pa.RecordBatch.from_pylist(out, _RECORD)
                        out, held = [], 0
                k = j
            yield pa.RecordBatch.from_pylist(out, _RECORD)
        if opened:
            opened[1].close()

    return read


def read_packages(packages: DataFrame, *, payloads: bool = True) -> DataFrame:
    """All records of the packages (uri, bytes): page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null
    for revisits, and everywhere with ``payloads=False``). The number of reading tasks follows the bytes to read, which
    the small table of places does not show."""
    places = packages.select("uri").mapInArrow(_indexes, "uri string, offset bigint, length bigint")
    total = packages.agg(F.sum("bytes")).first()[0] or 0
    part = F.floor(F.col("offset") / TASK_BYTES)
    dealt = places.repartition(int(total // TASK_BYTES) + 1, "uri", part).sortWithinPartitions("uri", "offset")
    return dealt.mapInArrow(_records(payloads), RECORD)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to packages in the shared folder and read their records back, without payloads."""
    folder = f"{scratch_dir(pages.sparkSession)}/wacz-{uuid.uuid4().hex[:12]}"
    return read_packages(write_packages(pages, folder, **options), payloads=False).drop("payload")
