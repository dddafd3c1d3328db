"""WARC records in ZIP-packaged archives, read by byte ranges.

Each task writes archives of its own: a ZIP with the stored members ``archive/data.warc`` and
``indexes/index.cdxj``. The reader takes the end of the file, follows the ZIP64 records if
there are any, parses the central directory, and from there reads the index and single
records by their ranges; nothing is extracted. Files are in the shared folder, opened by
the file system that its address names. A task that is run again writes new files; the
manifest lists only those of the tasks that Spark committed.

Equal payloads are stored once: the record with the smallest id is the response, the
others revisit it. Who is first is decided on digests, so pages don't move for it unless the
table of repeated payloads is too large to broadcast.
"""

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import MAX_BROADCAST_BYTES, lookup_join
from ..sources.scratch import materialise, shared_path

# Fixed values of the formats.
DATA, INDEX = "archive/data.warc", "indexes/index.cdxj"
END, END64_AT, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records after which a task opens the next archive, and that the reader yields at once.
ROLL, BATCH = 64 << 20, 8 << 20


def _open(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    return system, name


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _address(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record with its trailer. A revisit has the HTTP header, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_address(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload; names in lower case."""
    head, body = data.split(b"\r\n\r\n", 1)
    warc = _headers(head)
    body = body[: int(warc["content-length"])]
    head, payload = body.split(b"\r\n\r\n", 1)
    return warc, _headers(head), payload


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in block.decode().split("\r\n")[1:])
    return {name.lower(): value for name, value in pairs}


class Archive:
    """A ZIP that is being written to a stream, with the index of its records."""

    def __init__(self, path: str):
        system, name = _open(path)
        self.path, self.stream = path, system.open_output_stream(name)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id, data: bytes) -> None:
        self.data.write(data)
        place = {"page": page_id, "filename": DATA, "offset": self.size, "length": len(data)}
        self.lines.append(f"{_urn(page_id)} {json.dumps(place)}\n")
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines), self.size


def _written(folder: str):
    def write(batches):
        archive, done = None, []
        for batch in batches:
            for page_id, url, html, first, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip"
                    archive = Archive(f"{folder}/{name}")
                revisit = bool(shared) and first is not None and page_id != first
                archive.add(page_id, record(page_id, url, html or b"", first, revisit))
                if archive.size >= ROLL:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        columns = zip(*done, strict=True) if done else ([], [], [])
        types = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["path", "records", "bytes"])

    return write


def write_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0
) -> DataFrame:
    """Write every row as a WARC record; return ``(path, records, bytes)`` of each archive.

    The payload is ``html`` in UTF-8 (null: empty). Payloads of fewer than ``least`` bytes are
    always responses. Rows that share the smallest id of a payload are all responses; a
    null id is a revisit wherever the payload has an id. An empty table gives no archive.
    """
    spark = pages.sparkSession
    folder = shared_path(spark, "archives")
    system, name = _open(folder)
    system.create_dir(name, recursive=True)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    plain = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    sums = plain.select("page_id", F.octet_length("payload").alias("n"), F.concat_ws(":", F.sha1("payload"), F.octet_length("payload").cast("string")).alias("sum"))
    repeated = (
        sums.where(F.col("n") >= least).groupBy("sum")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select("sum", "first", F.lit(True).alias("shared"))
    )
    summed = plain.withColumn("sum", F.concat_ws(":", F.sha1("payload"), F.octet_length("payload").cast("string")))
    joined = lookup_join(summed, materialise(repeated, "payloads"), "sum", max_bytes=MAX_BROADCAST_BYTES)
    written = joined.select("page_id", "url", "payload", "first", "shared").mapInArrow(
        _written(folder), "path string, records bigint, bytes bigint"
    )
    return materialise(written, "manifest")


@dataclass(frozen=True)
class Member:
    """Where the stored bytes of a member are."""

    name: str
    start: int
    size: int


def members(file, size: int) -> dict[str, Member]:
    """The stored members of a ZIP, from its directory. ``file`` has ``read_at(length, offset)``."""
    tail_at = max(0, size - 65_557)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and not (at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator_at = tail_at + at - 20
    locator = file.read_at(20, locator_at) if locator_at >= 0 else b""
    if locator[:4] == END64_AT:
        (place,) = struct.unpack_from("<Q", locator, 8)
        record64 = file.read_at(56, place)
        if record64[:4] != END64:
            raise ValueError("no ZIP64 record where its locator points")
        count, length, start = struct.unpack_from("<QQQ", record64, 32)
    directory, found, at = file.read_at(length, start), {}, 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("no entry where the ZIP directory goes on")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        wide = _wide(directory[at + 46 + n : at + 46 + n + extra])
        values = [x if x != 0xFFFFFFFF else next(wide) for x in (plain, packed, local)]
        at += 46 + n + extra + comment
        head = file.read_at(30, values[2])
        if head[:4] != LOCAL:
            raise ValueError(f"no member at the place of {name}")
        if method == 0:
            skip = 30 + sum(struct.unpack_from("<HH", head, 26))
            found[name] = Member(name, values[2] + skip, values[1])
    return found


def _wide(extra: bytes):
    """The 64-bit values of a ZIP64 field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            yield from (x for (x,) in struct.iter_unpack("<Q", extra[at + 4 : at + 4 + n // 8 * 8]))
        at += 4 + n


def read_archive(path: str):
    """``(page, warc headers, http headers, payload)`` of the records that the index names."""
    system, name = _open(path)
    with system.open_input_file(name) as file:
        found = members(file, file.size())
        index = found[INDEX]
        for line in io.BytesIO(file.read_at(index.size, index.start)):
            place = json.loads(line.split(b" ", 1)[1])
            data = found[place["filename"]]
            if place["offset"] + place["length"] > data.size:
                raise ValueError(f"{path}: the index points beyond {data.name}")
            yield place["page"], *parse_record(file.read_at(place["length"], data.start + place["offset"]))


FIELDS = "page_id bigint, uri string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"


def _read(payloads: bool):
    def read(batches):
        names = [x.split()[0] for x in FIELDS.split(", ")] + ["payload"] * payloads
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * payloads

        def out(rows):
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for page, warc, http, payload in read_archive(path):
                    revisit = warc["warc-type"] == "revisit"
                    given = warc["warc-payload-digest"].removeprefix("sha1:")
                    if not revisit and digest(payload) != given:
                        raise ValueError(f"{path}: payload of {warc['warc-record-id']} is damaged")
                    to = warc["warc-refers-to"][len("<urn:page:") : -1] if revisit else ""
                    row = [page, warc.get("warc-target-uri"), warc["warc-type"], int(to) if to else None, given, int(http["content-length"])]
                    rows.append(row + ([None if revisit else payload] if payloads else []))
                    size += len(payload) if payloads else 200
                    if size >= BATCH:
                        yield out(rows)
                        rows, size = [], 0
                yield out(rows)

    return read


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives of a manifest, one archive at a time in a task.

    ``payload_digest`` and ``payload_bytes`` are those of the full payload. Payloads are
    checked against their digests; with ``payloads`` they are returned (null for revisits).
    """
    n = max(1, archives.count())
    return archives.select("path").repartition(n, "path").mapInArrow(_read(payloads), FIELDS + ", payload binary" * payloads)
