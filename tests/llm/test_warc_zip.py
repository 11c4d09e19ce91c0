"""WARC records in ZIP archives: round trips, and archives read by the standard library."""

import base64
import gzip
import hashlib
import io
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from basketry.llm import warc_zip

PAGES = "page_id bigint, url string, html string, size string, same string"


def rows_of(n=60):
    out = [(i, f"http://h/{i}", ["<p>a</p>", "<p>é</p>", f"<p>{i}</p>\r\n\r\n"][i % 3], "s", "t") for i in range(n)]
    out += [(100, None, None, "s", "t"), (101, "u", "", "s", "t"), (None, "a\r\nb", "", None, None)]
    out += [(200, "v", "x" * 3_000_000, "s", "t"), (200, "v", "x" * 3_000_000, "s", "t"), (None, "w", "lone", "", "")]
    return out


def expected(rows, at_least=0):
    largest = {}
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        known = largest.get(body)
        largest[body] = page_id if known is None else known if page_id is None else max(known, page_id)
    out = []
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        best = largest[body] if len(body) >= at_least else page_id
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "response" if page_id == best else "revisit",
                    None if page_id == best else best))
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [{}, {"archive_bytes": 4000, "member_bytes": 900}, {"small": 60}])
def test_round_trip(spark, settings):
    rows = rows_of()
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    got = warc_zip.round_trip(pages, **settings).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_small_payloads_and_empty_tables(spark):
    rows = rows_of(9)
    pages = spark.createDataFrame(rows, PAGES)
    got = warc_zip.round_trip(pages, at_least=9).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, 9)
    assert warc_zip.round_trip(pages.limit(0)).collect() == []


def test_payloads_and_targets_come_back(spark):
    rows = rows_of(9)
    ranges = warc_zip.record_ranges(warc_zip.archive_pages(spark.createDataFrame(rows, PAGES)))
    found = warc_zip.read_records(ranges).filter("record_type = 'response'").collect()
    html = {page_id: (text or "").encode() for page_id, _, text, *_ in rows if page_id is not None}
    assert all(html[r.record_id] == r.payload for r in found if r.record_id is not None)
    assert {r.uri for r in warc_zip.read_records(ranges).filter("record_id IS NULL").collect()} == {"a%0D%0Ab", "w"}


@pytest.mark.parametrize("small", [warc_zip.FULL32 - 1, 60])
def test_archives_are_zip_files(spark, tmp_path, small):
    pages = spark.createDataFrame(rows_of(), PAGES).coalesce(1)
    archives = warc_zip.archive_pages(pages, f"file:{tmp_path}/zips", member_bytes=700, small=small)
    listed = archives.collect()
    assert sum(r.records for r in listed) == len(rows_of())
    found = 0
    for row in listed:
        with zipfile.ZipFile(row.path.removeprefix("file:")) as archive:
            assert archive.testzip() is None and row.bytes == len(open(archive.filename, "rb").read())
            for info in archive.infolist():
                assert info.compress_type == zipfile.ZIP_STORED
                if info.filename.endswith(".warc.gz"):
                    found += gzip.decompress(archive.read(info)).count(b"WARC/1.1\r\n")
    assert found == len(rows_of())


def test_reads_archives_of_the_standard_library(tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.comment = b"PK\x05\x06 in a comment"
        archive.writestr("a", b"stored bytes")
        archive.writestr("b", b"deflated " * 50, zipfile.ZIP_DEFLATED)
        with archive.open("c", "w", force_zip64=True) as big:
            big.write(b"more")
    data = out.getvalue()

    def read(at, n):
        return data[at:at + n]

    a, b, c = warc_zip.read_directory(read, len(data))
    assert [read(warc_zip.data_offset(read, m), m.size) for m in (a, c)] == [b"stored bytes", b"more"]
    assert zlib.crc32(b"stored bytes") == a.crc
    with pytest.raises(ValueError, match="not stored"):
        warc_zip.data_offset(read, b)
    with pytest.raises(ValueError, match="no end record"):
        warc_zip.read_directory(lambda at, n: data[:50][at:at + n], 50)


def test_damage_raises():
    record = warc_zip.format_record(1, "u", b"payload", warc_zip.base32_sha1(b"payload"), None, False)
    assert warc_zip.parse_record(record).payload == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc_zip.parse_record(record.replace(b"payload\r", b"pAyload\r"))


def test_one_payload_for_a_third_of_all_pages(spark):
    pages = spark.range(6000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("html"))
    got = warc_zip.round_trip(pages).groupBy("record_type").agg(
        F.count("*").alias("n"), F.countDistinct("refers_to").alias("k"), F.max("refers_to").alias("to")).collect()
    assert sorted(map(tuple, got)) == [("response", 4001, 0, None), ("revisit", 1999, 1, 5997)]
