import hashlib
import zipfile
from collections import defaultdict

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from tidemark.llm import warc

COLUMNS = "page_id bigint, url string, html string"


def expected(rows, least=100):
    groups = defaultdict(list)
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and i is not None:
            groups[data].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = min(groups[data]) if groups.get(data) else None
        refers = first if len(data) >= least and first is not None and first != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    long = "<p>é</p>" * 40_000
    rows = [(5, "u\r\nX: y", "a" * 100), (3, None, "a" * 100), (3, None, "a" * 100), (9, "", "a" * 99), (10, "", "a" * 99), (None, "n", "a" * 100),
            (1, "x", None), (2, "x", ""), (7, "z", long), (8, "z", long), (None, None, "b" * 200), (None, None, "b" * 200), (11, "q", "c\r\n\r\nd" * 50)]
    pages = spark.createDataFrame(rows, COLUMNS).withColumn("digest", F.lit(1)).withColumn("first", F.lit(2)).withColumn("payload", F.lit("p"))
    got = warc.archived(pages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
    texts = {(html or "").encode() for _, _, html in rows}
    assert all(bytes(r.payload) in texts for r in got if r.record_type == "response")
    assert warc.archived(pages.limit(0)).count() == 0


def test_many_packages_and_ranges(spark, tiny, tmp_path):
    rows = warc.with_revisits(spark.read.parquet(f"{tiny}/pages.parquet"))
    packages = warc.write_archives(rows.coalesce(2), f"file://{tmp_path}/warc", package_bytes=5_000)
    assert packages.count() > 4
    for r in packages.collect():  # any ZIP reader opens them, and every member is stored
        with zipfile.ZipFile(r.uri.removeprefix("file://")) as z:
            assert z.testzip() is None and {m.compress_type for m in z.infolist()} == {zipfile.ZIP_STORED}
    got = warc.read_archives(packages, span=5_000)
    pages = spark.read.parquet(f"{tiny}/pages.parquet").collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got.collect() if r.record_type == "response"} == {p.page_id: p.html for p in pages}


def test_zip64_directory(tmp_path, monkeypatch):
    """A package whose counts and offsets overflow the plain directory."""
    path = tmp_path / "large.zip"
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for i in range(6):
            z.writestr(f"m{i}é", bytes([65 + i]) * (40 * i + 1))
        z.comment = b"PK\x05 a comment"
    assert b"PK\x06\x06" in path.read_bytes()
    store, name = fs.FileSystem.from_uri(f"file://{path}")
    with store.open_input_file(name) as source:
        members = warc.directory(source)
        assert [m.name for m in members] == [f"m{i}é" for i in range(6)]
        for i, m in enumerate(members):
            assert source.read_at(m.size, warc.data_start(source, m)) == bytes([65 + i]) * (40 * i + 1)
    # All fields written as ones: sizes and offset come from the extra field, in order.
    extra = (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + b"".join(v.to_bytes(8, "little") for v in (2**33, 2**34, 2**35))
    assert warc._zip64(b"\x99\x00\x01\x00z" + extra, [0xFFFFFFFF] * 3) == [2**33, 2**34, 2**35]
    assert warc._zip64(extra, [7, 0xFFFFFFFF, 9]) == [7, 2**33, 9]


def test_not_a_package(tmp_path):
    source = pa.BufferReader(b"no archive at all")
    try:
        warc.directory(source)
    except ValueError:
        return
    raise AssertionError
