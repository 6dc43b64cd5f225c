"""WARC records in ZIP packages, written and range-read without extraction."""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import sliced
from tidemark.sources.tables import materialized, new_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Member:
    """A directory entry of a ZIP package."""

    name: str
    method: int
    packed: int
    size: int
    header: int


def _zip64(extra: bytes, wanted: list[int]) -> list[int]:
    """Sizes and offset of a directory entry; those written as all ones stand in the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            body, i, out = extra[at + 4 : at + 4 + size], 0, []
            for value in wanted:
                if value == 0xFFFFFFFF and i + 8 <= len(body):
                    value, i = struct.unpack_from("<Q", body, i)[0], i + 8
                out.append(value)
            return out
        at += 4 + size
    return wanted


def directory(source: pa.NativeFile) -> list[Member]:
    """The central directory, through its end record and, where that overflows, the ZIP64 end record."""
    size = source.size()
    tail = source.read_at(min(size, 65_557), max(0, size - 65_557))
    # The end record is the last one whose comment reaches to the end of the file.
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("not a ZIP package: no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if (count == 0xFFFF or 0xFFFFFFFF in (length, start)) and tail[end - 20 : end - 16] == b"PK\x06\x07":
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        record = source.read_at(56, at)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("broken ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    data, at, out = source.read_at(length, start), 0, []
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain, name, extra, comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        text = data[at + 46 : at + 46 + name]
        plain, packed, header = _zip64(data[at + 46 + name : at + 46 + name + extra], [plain, packed, header])
        out.append(Member(text.decode("utf-8" if flags & 0x800 else "cp437"), method, packed, plain, header))
        at += 46 + name + extra + comment
    return out


def data_start(source: pa.NativeFile, member: Member) -> int:
    """Where a member's bytes begin, behind its local header."""
    head = source.read_at(30, member.header)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"broken local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def _line(text: str | None) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record: the whole HTTP response, or for a revisit its head alone, which keeps the payload's length."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {_PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of one WARC record as written by record()."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda v: int(v[10:-1]) if v and v[10:-1] else None
    stated = next((int(x[16:]) for x in http.decode("latin-1").split("\r\n") if x.startswith("Content-Length: ")), len(payload))
    response = fields["WARC-Type"] == "response"
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI", ""),
        "payload_bytes": len(payload) if response else stated,
        "payload_digest": hashlib.sha256(payload).hexdigest() if response else fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": payload if response else None,
    }


def with_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which record each page becomes.

    Pages of equal payload of at least `least` bytes refer to the one with the
    smallest page_id, rows that repeat that id included among the responses. Where
    no page of the group has an id, all are responses. Groups are found on digests
    alone. The table of repeated digests is written, so its true size decides how
    it is joined; a digest that very many pages share is split by Spark's skew join.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    groups = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = materialized(groups.filter("n > 1 and first is not null").select("digest", "first"), "repeated-payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, package_bytes: int = 128 << 20) -> DataFrame:
    """Write records of with_revisits() to ZIP packages in folder; (uri, bytes, records) per package.

    Each record is a gzip member of a stored WARC file, so it can be read alone,
    and a stored index names its offset and length. A package is closed beyond
    package_bytes. Packages of lost attempts have other names and are in no row:
    the list is written by Spark, which commits one attempt per task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        package, count = None, 0

        def closed():
            member.close()
            package.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
            package.close()
            size = stream.tell()
            stream.close()
            return pa.record_batch([pa.array([f"{folder}/{file}"]), pa.array([size], pa.int64()), pa.array([len(lines)], pa.int64())], ["uri", "bytes", "records"])

        for batch in sliced(batches, 256):
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if package is None:
                    file, count, at, lines = f"{name}-{count:04d}.zip", count + 1, 0, []
                    stream = store.open_output_stream(f"{base}/{file}")
                    package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
                    member = package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = deflate.compress(record(page_id, url, payload, digest, refers_to)) + deflate.flush()
                member.write(data)
                lines.append(f"{'' if page_id is None else page_id} {_DATE} " + json.dumps({"offset": at, "length": len(data), "filename": DATA}))
                at += len(data)
                if at >= package_bytes:
                    yield closed()
                    package = None
        if package is not None:
            yield closed()

    return materialized(rows.mapInArrow(work, "uri string, bytes bigint, records bigint"), "packages")


def _ranges(uri: str, span: int) -> Iterator[tuple[int, int, list[int]]]:
    """(start, length, record lengths) of runs of records of about span bytes, from a package's directory and index."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as source:
        members = {m.name: m for m in directory(source)}
        starts = {}
        for name in sorted(m for m in members if m.startswith("indexes/")):
            index = members[name]
            lines = source.read_at(index.packed, data_start(source, index))
            if index.method == 8:
                lines = zlib.decompress(lines, -15)
            start, at, lengths = None, 0, []
            for line in lines.decode().split("\n"):
                if not line:
                    continue
                entry = json.loads(line[line.index("{") :])
                data = members[entry["filename"]]
                if data.method:
                    raise ValueError(f"{data.name} in {uri} is not stored")
                if data.name not in starts:
                    starts[data.name] = data_start(source, data)
                here = starts[data.name] + entry["offset"]
                if start is not None and (here != at or at - start >= span):
                    yield start, at - start, lengths
                    start = None
                if start is None:
                    start, at, lengths = here, here, []
                lengths.append(entry["length"])
                at += entry["length"]
            if start is not None:
                yield start, at - start, lengths


def read_archives(packages: DataFrame, span: int = 2 << 20, task_bytes: int = 8 << 20) -> DataFrame:
    """The records of all packages named in column uri, of the sizes in column bytes.

    One step reads directories and indexes only and lists runs of records of about
    span bytes. The list is small whatever it points to, so the number of tasks
    that share it follows the packages' sizes, about task_bytes each; every task
    range-reads its runs. So one large package is read by many tasks, and nothing
    is extracted to disk.
    Columns: page_id, url, payload_bytes, payload_digest (of the payload read; of
    a revisit the stated one), record_type, refers_to, payload (null for revisits).
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                for start, length, lengths in _ranges(uri, span):
                    yield pa.record_batch([pa.array([uri]), pa.array([start], pa.int64()), pa.array([length], pa.int64()), pa.array([lengths], pa.list_(pa.int64()))], ["uri", "start", "length", "lengths"])

    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, length, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as source:
                    data = source.read_at(length, start)
                rows, at = [], 0
                for size in lengths:
                    rows.append(parsed(zlib.decompress(data[at : at + size], 31)))
                    at += size
                yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))

    found = packages.select("uri").mapInArrow(locate, "uri string, start bigint, length bigint, lengths array<bigint>")
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    total = packages.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return found.repartition(max(1, -(-total // task_bytes)), "uri", "start").mapInArrow(read, schema)


def archived(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write a record per page to packages in the shared folder and read all of them back.

    Null html is an empty payload, a null url an empty one, a null page_id stays
    null. Repeated rows are records of their own. An empty table gives no package and no rows.
    """
    folder = new_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(with_revisits(pages, least), folder))
