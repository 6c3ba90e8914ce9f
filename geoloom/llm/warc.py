r"""WARC archives inside ZIP packages: written by tasks, read back by byte ranges.

A package is a ZIP file with stored members: archive/data.warc.gz, whose records are gzip members of
their own, and its index indexes/index.jsonl, one line per record with offset and length. The reader parses the end record,
the ZIP64 end record and the central directory, finds the members' data and reads single records
by their range; nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import posixpath
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, read_table, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- ZIP ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    size: int
    header_offset: int


def _ranged(path: str) -> pa.NativeFile:
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def _exactly(f: pa.NativeFile, offset: int, size: int) -> bytes:
    data = f.read_at(size, offset)
    if len(data) != size:
        raise ValueError(f"package ends before byte {offset + size}")
    return data


def central_directory(f: pa.NativeFile) -> list[Member]:
    """The members that the central directory lists, with ZIP64 sizes and offsets."""
    length = f.size()
    tail_at = max(0, length - 22 - 0xFFFF)
    tail = _exactly(f, tail_at, length - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    count, size, offset = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (size, offset):
        signature, _, at, _ = struct.unpack("<4sIQI", _exactly(f, tail_at + end - 20, 20))
        if signature != b"PK\x06\x07":
            raise ValueError("ZIP64 locator is missing")
        head = _exactly(f, at, 56)
        if head[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record is missing")
        count, size, offset = struct.unpack_from("<QQQ", head, 32)
    data, members, at = _exactly(f, offset, size), [], 0
    for _ in range(count):
        fields = struct.unpack_from("<4sHHHHHHIIIHHHHHII", data, at)
        if fields[0] != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        method, packed, full, n_name, n_extra, n_note, header = fields[4], fields[8], fields[9], fields[10], fields[11], fields[12], fields[16]
        name = data[at + 46 : at + 46 + n_name].decode("utf-8")
        extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
        wide = iter(_zip64(extra))
        full = next(wide) if full == 0xFFFFFFFF else full
        packed = next(wide) if packed == 0xFFFFFFFF else packed
        header = next(wide) if header == 0xFFFFFFFF else header
        members.append(Member(name, method == 0 and packed == full, full, header))
        at += 46 + n_name + n_extra + n_note
    return members


def _zip64(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            return [x[0] for x in struct.iter_unpack("<Q", extra[at + 4 : at + 4 + size // 8 * 8])]
        at += 4 + size
    return []


def data_offset(f: pa.NativeFile, member: Member) -> int:
    """Where a member's bytes begin: behind its local header, whose extra field may differ."""
    head = _exactly(f, member.header_offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"{member.name}: no local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header_offset + 30 + n_name + n_extra


# --- WARC -----------------------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    text = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head, whose length tells the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def packed(data: bytes) -> bytes:
    """One gzip member, the same for the same data."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def unpacked(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _fields(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8").split("\r\n")[1:])}


def parse_record(data: bytes) -> dict:
    """What a record says; a response's payload must match its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    warc = _fields(head)
    block = rest[: int(warc["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("WARC record has a wrong length")
    http_head, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http_head)["content-length"])
    revisit = warc["warc-type"] == "revisit"
    if not revisit and (payload_digest(payload) != digest or len(payload) != size):
        raise ValueError(f"{warc['warc-record-id']}: payload does not match its digest")
    return {
        "page_id": _page_of(warc["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": warc["warc-type"],
        "refers_to": _page_of(warc["warc-refers-to"]) if revisit else None,
        "payload": None if revisit else payload.decode("utf-8"),
    }


def package(records: list[tuple[int | None, bytes]]) -> bytes:
    """A ZIP package of packed records and their index."""
    offset, lines = 0, []
    for page_id, data in records:
        lines.append(json.dumps({"id": page_id, "offset": offset, "length": len(data)}) + "\n")
        offset += len(data)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, parts in ((ARCHIVE, (d for _, d in records)), (INDEX, (x.encode() for x in lines))):
            with z.open(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True) as member:
                for part in parts:
                    member.write(part)
    return out.getvalue()


# --- Spark ----------------------------------------------------------------------------------------


def write_archives(pages: DataFrame, folder: str, *, page: str = "page_id", url: str = "url", html: str = "html", least_revisit_bytes: int = 0, package_bytes: int = 32 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a WARC record per row into ZIP packages under folder; return their paths.

    Of rows with equal payloads of least_revisit_bytes or more, those with the smallest page are
    responses and the others revisit it; shorter payloads are all responses. A null payload is
    empty, a null url leaves its header out, a null page sorts last. Rows that repeat the smallest
    page are responses too. Other columns are left out. An empty table writes nothing.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page).cast("long").alias("page"), F.col(url).alias("url"), body.alias("body"), F.sha1(body).alias("digest"))
    known = rows.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    known = written(known, "warc-known")  # a join of two plain exchanges is one that Spark can split by size
    marked = rows.join(known, "digest", "left").select(
        "page", "url", "body", "first", (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page")) & (F.octet_length("body") >= least_revisit_bytes)).alias("revisit")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        return write_packages(batches, folder, f"{task.partitionId():06d}", str(task.taskAttemptId()), package_bytes=package_bytes, date=date)

    return written(marked.mapInArrow(write, "path string, records long"), "warc-packages")


def write_packages(batches: Iterator[pa.RecordBatch], folder: str, part: str, attempt: str, *, package_bytes: int, date: str) -> Iterator[pa.RecordBatch]:
    """Write rows (page, url, body, first, revisit) of one task; a row (path, records) per package.

    Rows may come to another attempt in another order, so attempts never share a file; only packages
    of the attempt that Spark commits are listed and read.
    """
    fs, inner = pafs.FileSystem.from_uri(folder)
    fs.create_dir(inner, recursive=True)
    held: list[tuple[int | None, bytes]] = []
    size, made = 0, 0

    def close() -> pa.RecordBatch:
        nonlocal size, made
        name = f"pages-{part}-{made:04d}-{attempt}.zip"
        with fs.open_output_stream(posixpath.join(inner, f".{name}")) as out:
            out.write(package(held))
        fs.move(posixpath.join(inner, f".{name}"), posixpath.join(inner, name))
        row = pa.record_batch({"path": [f"{folder}/{name}"], "records": pa.array([len(held)], pa.int64())})
        held.clear()
        size, made = 0, made + 1
        return row

    for batch in batches:
        for r in batch.to_pylist():
            data = packed(record(r["page"], r["url"], r["body"].encode(), r["first"], r["revisit"], date))
            held.append((r["page"], data))
            size += len(data)
            if size >= package_bytes:
                yield close()
    if held:
        yield close()


#: Records of one range, and ranges of one reading task.
RANGE_RECORDS, TASK_RANGES = 2000, 16


def read_archives(packages: DataFrame, *, records_per_range: int = RANGE_RECORDS) -> DataFrame:
    """A row per record of the packages named in column path.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, payload (null for a
    revisit). The first step reads directories and indexes and plans ranges; the second, dealt out
    over as many tasks as the ranges fill, reads each run of records that lie side by side at once.
    Other members are passed over. A package that is damaged, lacks its archive or index, holds one
    of them compressed, or, where packages has a column records, holds another number of records, is
    an error. No path, no row.
    """
    known = F.col("records").cast("long") if "records" in packages.columns else F.lit(None).cast("long")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records in zip(batch["path"].to_pylist(), batch["records"].to_pylist(), strict=True):
                with _ranged(path) as f:
                    members = {m.name: m for m in central_directory(f)}
                    for name in (ARCHIVE, INDEX):
                        if name not in members:
                            raise ValueError(f"{path}: no member {name}")
                        if not members[name].stored:
                            raise ValueError(f"{path}: member {name} is compressed")
                    base = data_offset(f, members[ARCHIVE])
                    lines = _exactly(f, data_offset(f, members[INDEX]), members[INDEX].size).splitlines()
                    index = [json.loads(x) for x in lines]
                    if records is not None and records != len(index):
                        raise ValueError(f"{path}: {records} records were written, {len(index)} are there")
                for i in range(0, len(index), records_per_range):
                    part = index[i : i + records_per_range]
                    yield pa.record_batch({"path": [path], "offsets": pa.array([[base + x["offset"] for x in part]], pa.list_(pa.int64())), "lengths": pa.array([[x["length"] for x in part]], pa.list_(pa.int64()))})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                with _ranged(row["path"]) as f:
                    for offset, lengths in runs(list(zip(row["offsets"], row["lengths"], strict=True))):
                        data, at, records = _exactly(f, offset, sum(lengths)), 0, []
                        for n in lengths:
                            records.append(parse_record(unpacked(data[at : at + n])))
                            at += n
                        yield pa.RecordBatch.from_pylist(records, schema)

    planned = written(packages.select("path", known.alias("records")).repartition("path").mapInArrow(plan, "path string, offsets array<long>, lengths array<long>"), "warc-ranges")
    # a number of tasks, so that Spark does not merge the small rows that stand for large ranges
    tasks = max(planned.sparkSession.sparkContext.defaultParallelism, -(-planned.count() // TASK_RANGES))
    return planned.repartition(tasks).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string")


def runs(spans: list[tuple[int, int]], most: int = 200) -> Iterator[tuple[int, list[int]]]:
    """Records (offset, length) that lie side by side, as the offset of the first and all lengths."""
    start, lengths = 0, []
    for offset, n in spans:
        if lengths and (offset != start + sum(lengths) or len(lengths) == most):
            yield start, lengths
            lengths = []
        if not lengths:
            start = offset
        lengths = [*lengths, n]
    if lengths:
        yield start, lengths


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = write_archives(read_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return read_archives(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_page FROM pages)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM p
"""
