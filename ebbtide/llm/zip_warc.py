"""Web archives in ZIP packages: a writer, and a reader that fetches single records by byte ranges.

A package holds two stored (not compressed) members: ``archive/data.warc.gz``, every record a gzip member of its own,
and ``indexes/index.cdx``, a line of JSON per record with its place. The reader parses the end record, the ZIP64
end record and the central directory, finds the members' first bytes from their local headers and reads the index
and then each record by its range; nothing is extracted. Files are reached through the file system of their URI."""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import text_batches, width
from ebbtide.session import stage, work_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
REVISIT_BYTES = 100  # payloads below this are never stored as revisits
RECORDS_PER_FILE, RECORDS_PER_TASK = 20_000, 500
# Fixed values of the formats.
WARC, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_SIGN, END64_SIGN, LOCATOR_SIGN, CENTRAL_SIGN, LOCAL_SIGN = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
FULL16, FULL32, ZIP64_EXTRA, STORED = 0xFFFF, 0xFFFFFFFF, 0x0001, 0


class Member(NamedTuple):
    name: str
    method: int
    size: int
    packed: int
    local: int


def _opened(uri: str) -> pa.NativeFile:
    system, path = pa.fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def as_uri(path: str) -> str:
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def members(file: pa.NativeFile) -> list[Member]:
    """The central directory, of plain and of ZIP64 packages, with or without a comment at the end."""
    size = file.size()
    tail_at = max(0, size - 22 - 0xFFFF)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    at = tail.rfind(struct.pack("<I", END_SIGN))
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(struct.pack("<I", END_SIGN), 0, at)
    if at < 0:
        raise ValueError("no end of central directory record: not a ZIP package")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (length, start):
        file.seek(tail_at + at - 20)
        sign, _, end64, _ = struct.unpack("<IIQI", file.read(20))
        if sign != LOCATOR_SIGN:
            raise ValueError("no ZIP64 locator before the end record")
        file.seek(end64)
        record = file.read(56)
        if struct.unpack_from("<I", record)[0] != END64_SIGN:
            raise ValueError("no ZIP64 end record at the place its locator names")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    file.seek(start)
    directory, found, at = file.read(length), [], 0
    for _ in range(count):
        sign, _, _, flags, method = struct.unpack_from("<IHHHH", directory, at)
        if sign != CENTRAL_SIGN:
            raise ValueError("broken central directory")
        packed, plain, name_size, extra_size, comment_size = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, extent = struct.unpack_from("<HH", extra)
            if kind == ZIP64_EXTRA:
                wide = iter(struct.unpack_from(f"<{extent // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                local = next(wide) if local == FULL32 else local
            extra = extra[4 + extent :]
        found.append(Member(name, method, plain, packed, local))
        at += 46 + name_size + extra_size + comment_size
    return found


def first_byte(file: pa.NativeFile, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    file.seek(member.local)
    header = file.read(30)
    if struct.unpack_from("<I", header)[0] != LOCAL_SIGN:
        raise ValueError(f"no local header of {member.name}")
    return member.local + 30 + sum(struct.unpack_from("<HH", header, 26))


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response with the payload, or a revisit without it that names the response."""
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if url is not None:
        fields["WARC-Target-URI"] = "".join(url.splitlines())
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + payload
    if refers_to is not None:
        fields |= {"WARC-Refers-To": record_id(refers_to), "WARC-Profile": PROFILE}
        body = http
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(body))}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"{WARC}\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the payload behind the HTTP header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != WARC:
        raise ValueError("not a record of this version")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    body = rest[: int(fields["content-length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _write(folder: str, date: str):
    """(page_id, url, html, digest, refers_to) to one row per package written: (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i) for i in range(5))))
        system, base = pa.fs.FileSystem.from_uri(folder)
        row = next(rows, None)
        while row is not None:
            # A name of its own for every attempt: only packages of tasks that ended are in the written list.
            name, index, at = f"{uuid.uuid4().hex}.wacz", [], 0
            with system.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(ARCHIVE, "w", force_zip64=True) as archive:
                    while row is not None and len(index) < RECORDS_PER_FILE:
                        page, url, html, digest, refers = (x.as_py() for x in row)
                        raw = gzip.compress(warc_record(page, url, (html or "").encode(), digest, refers, date), 6, mtime=0)
                        archive.write(raw)
                        index.append(json.dumps({"offset": at, "length": len(raw)}))
                        at += len(raw)
                        row = next(rows, None)
                package.writestr(INDEX, "\n".join(index))
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [len(index)]})

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packages to the byte ranges of their records."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _opened(path) as file:
                by_name = {m.name: m for m in members(file)}
                base = first_byte(file, by_name[ARCHIVE])
                file.seek(first_byte(file, by_name[INDEX]))
                lines = [json.loads(x) for x in file.read(by_name[INDEX].size).split(b"\n") if x]
            starts = pa.array([base + x["offset"] for x in lines], pa.int64())
            lengths = pa.array([x["length"] for x in lines], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), starts, lengths], names=["path", "start", "length"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges to records; a response's payload is checked against its digest."""
    file, path = None, None
    for batch in batches:
        rows = []
        for where, start, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if where != path:
                if file is not None:
                    file.close()
                file, path = _opened(where), where
            file.seek(start)
            fields, payload = parse_record(gzip.decompress(file.read(length)))
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            kind = fields["warc-type"]
            if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {fields['warc-record-id']} in {where} does not match its digest")
            ids = [fields.get(name, "").removeprefix("<urn:page:").removesuffix(">") for name in ("warc-record-id", "warc-refers-to")]
            page, refers = (int(x) if x else None for x in ids)
            html = payload.decode() if kind == "response" else None
            rows.append((page, fields.get("warc-target-uri"), html, len(payload) if kind == "response" else None, digest, kind, refers))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[i] for r in rows], t)
                for i, t in enumerate([pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()])
            ],
            names=["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )
    if file is not None:
        file.close()


RECORD = "page_id bigint, url string, html string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to packages in ``folder``; their list (path, records).

    Of equal payloads of at least REVISIT_BYTES bytes the row with the smallest page_id is a response and rows with
    larger ids revisit it; rows that repeat the smallest id are responses too. A null html is an empty payload. Rows
    without an id are responses. Other columns are not written."""
    spark = pages.sparkSession
    text_batches(spark)
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        "html",
        F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("digest"),
    )
    digests = pages.where((F.octet_length("html") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest").distinct()
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last")
    revisits = digests.join(firsts.drop("last"), "digest").where("page_id > refers_to")
    rows = pages.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    system, path = pa.fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return stage(rows.mapInArrow(_write(folder, date), "path string, records bigint"), "packages")


def read_packages(spark: SparkSession, packages: DataFrame) -> DataFrame:
    """All records of the packages listed in ``packages`` (path), each read by its byte range.

    Columns: page_id, url, html and payload_bytes (null for revisits), payload_digest, record_type, refers_to."""
    text_batches(spark)
    places = stage(packages.select("path").repartition(width(spark), "path").mapInArrow(_places, "path string, start bigint, length bigint"), "record-places")
    runs = F.floor(F.col("start") / (1 << 22))  # neighbouring records are fetched by one task
    return places.repartition(width(spark), "path", runs).sortWithinPartitions("path", "start").mapInArrow(_fetch, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read them back: (page_id, payload_bytes, payload_digest,
    record_type, refers_to), digest and size being those of the full payload also for revisits."""
    spark = pages.sparkSession
    folder = as_uri(f"{work_folder(spark)}/wacz-{uuid.uuid4().hex}")
    records = stage(read_packages(spark, write_packages(pages, folder)).drop("html", "url"), "records")
    sizes = records.where("record_type = 'response' AND payload_bytes >= 0").groupBy("payload_digest").agg(F.max("payload_bytes").alias("full"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(sizes, "payload_digest")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.where("record_type = 'response'").select(columns).union(revisits.withColumnRenamed("full", "payload_bytes").select(columns))
