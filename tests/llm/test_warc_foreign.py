"""Damaged archives, records of other writers, and reading in many tasks."""

from __future__ import annotations

import zlib

import pytest

from wardstar.llm import token_files, warc
from wardstar.llm.tokens import default_path


def member(lines: list[str], block: bytes) -> bytes:
    data = "\r\n".join(["WARC/1.0", *lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data + b"\r\n\r\n") + packer.flush()


def archive(spark, tmp_path, *members: bytes):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members))
    return spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")


def page(k: int, size: int = 400) -> bytes:
    payload = (f"page {k} " * size).encode()
    return warc.record_bytes(k, f"u{k}", payload, warc.payload_digest(payload), None)


@pytest.mark.parametrize("size", [61, 500, 1 << 22])
@pytest.mark.parametrize("broken", [0, 1, 3, 4])
def test_damage_is_never_silent(spark, tmp_path, size, broken):
    members = [page(k) for k in range(5)]
    hurt = bytearray(members[broken])
    hurt[len(hurt) // 2 : len(hurt) // 2 + 9] = b"\0" * 9
    members[broken] = bytes(hurt)
    manifest = archive(spark, tmp_path, *members)
    with pytest.raises(Exception, match="holds no record"):
        warc.read_archives(manifest, size).collect()
    rows = warc.read_archives(manifest, size, report_damage=True).collect()
    assert {r.page_id for r in rows if r.record_type == "response"} == set(range(5)) - {broken}
    [lost] = [r for r in rows if r.record_type == "damaged"]
    start = sum(map(len, members[:broken]))
    assert lost.url.endswith(f"@{start}") and lost.payload_bytes == len(members[broken])


@pytest.mark.parametrize("size", [61, 1 << 22])
def test_a_cut_off_archive(spark, tmp_path, size):
    manifest = archive(spark, tmp_path, page(1), page(2)[:-20])
    rows = warc.read_archives(manifest, size, report_damage=True).collect()
    assert sorted(r.record_type for r in rows) == ["damaged", "response"]


def test_records_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nhello"
    manifest = archive(
        spark, tmp_path,
        member(["WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:0-1>", "Content-Type: application/warc-fields"], b"a: b\r\n\r\nc"),
        member(["warc-type:response", "warc-record-id:<urn:uuid:0-2>", "WARC-TARGET-URI:\t http://x", "content-type:application/http"], http),
        member(["WARC-Type:   revisit", "WARC-Record-ID: <urn:uuid:0-3>"], b""),
        page(9),
    )
    rows = {r.record_type if r.page_id is None else r.page_id: r for r in warc.read_archives(manifest, 97).collect()}
    assert set(rows) == {"warcinfo", "response", "revisit", 9}
    found = rows["response"]
    assert (found.url, found.payload, found.payload_bytes) == ("http://x", b"hello", 5)
    assert found.payload_digest == warc.payload_digest(b"hello")
    assert bytes(rows["warcinfo"].payload) == b"a: b\r\n\r\nc"
    assert (rows["revisit"].payload, rows["revisit"].payload_bytes) == (None, None)


def tasks(rows) -> int:
    from pyspark.sql import functions as F

    return rows.select(F.spark_partition_id().alias("p")).distinct().count()


def test_archives_and_token_files_are_read_by_several_tasks(spark):
    rows = spark.range(400).selectExpr("id as page_id", "'u' as url", "repeat(sha2(string(id), 256), 20) as html")
    manifest = warc.write_archives(rows.repartition(1))
    assert manifest.count() == 1 and tasks(warc.read_archives(manifest, 1 << 15)) > 1
    docs = spark.range(200).selectExpr("id as doc_id", "repeat(sha2(string(id), 256), 800) as text")
    files = token_files.write_token_files(docs, default_path(), file_bytes=1 << 12)
    assert files.count() > 1 and tasks(token_files.read_token_files(files)) > 1
