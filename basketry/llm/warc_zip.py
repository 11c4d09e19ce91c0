"""WARC records in ZIP archives: written per task, and read by ranges without extraction.

An archive holds stored (not deflated) members: WARC files of one gzip member per record, an index
that tells member, offset and length of each record, and a short description. The reader takes the
end of an archive first, finds the central directory there (by its ZIP64 end record if there is
one), locates the stored members and the index, and then reads each record by its byte range. A
record of which an equal payload is written elsewhere is a revisit without payload.

Archives lie in a shared folder. A task names its files afresh each time it runs; which of them
count is told by the table of archives, which Spark commits once per task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import HEAVY, materialize, scratch_folder, shuffle_partitions, ship

ship(__name__)

# An archive, and a member in it, is closed when it holds this many bytes.
ARCHIVE_BYTES = 1 << 30
MEMBER_BYTES = 128 << 20
# An archive is closed when it has this many records, too, as its index is held in memory.
ARCHIVE_RECORDS = 200_000
# Records nearby are read at once, up to this many bytes.
RANGE_BYTES = 4 << 20
LEVEL = 6
DATE = "2020-01-01T00:00:00Z"
INDEX = "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures, and what a 32-bit or 16-bit field holds if ZIP64 has its value.
LOCAL, CENTRAL, DESCRIPTOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x07\x08"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
_LONGEST_END = 22 + 0xFFFF + 20


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file, given as URI or path."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


# ---------------------------------------------------------------------------- ZIP

@dataclass
class Member:
    name: str
    crc: int
    size: int
    header: int
    method: int = 0


class ZipWriter:
    """A ZIP file of stored members, written front to back. `small` is the largest 32-bit value used."""

    def __init__(self, sink, small: int = FULL32 - 1):
        self.sink, self.small = sink, small
        self.at = 0
        self.members: list[Member] = []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def start(self, name: str) -> None:
        self.members.append(Member(name, 0, 0, self.at))
        raw = name.encode()
        # sizes and CRC follow the data; the empty ZIP64 field says that they have 64 bits
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x0808, 0, 0, 0x5A21, 0, FULL32, FULL32,
                                      len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """Adds to the open member; the place in it where the data start."""
        member = self.members[-1]
        place = member.size
        member.crc = zlib.crc32(data, member.crc)
        member.size += len(data)
        self._put(data)
        return place

    def end(self) -> None:
        member = self.members[-1]
        self._put(DESCRIPTOR + struct.pack("<IQQ", member.crc, member.size, member.size))

    def close(self) -> int:
        """Writes the directory; the file's size."""
        start = self.at
        for m in self.members:
            raw, long = m.name.encode(), b""
            size, header = m.size, m.header
            if size > self.small:
                long, size = long + struct.pack("<QQ", m.size, m.size), FULL32
            if header > self.small:
                long, header = long + struct.pack("<Q", m.header), FULL32
            extra = struct.pack("<HH", 1, len(long)) + long if long else b""
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x0808, 0, 0, 0x5A21, m.crc, size, size,
                                            len(raw), len(extra), 0, 0, 0, 0, header) + raw + extra)
        size, n = self.at - start, len(self.members)
        if max(start, size) > self.small or n >= FULL16:
            place = self.at
            self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, place, 1))
            start, size, n = FULL32, FULL32, FULL16
        self._put(END + struct.pack("<HHHHIIH", 0, 0, n, n, size, start, 0))
        return self.at


def _long_values(extra: bytes, wanted: list[bool]) -> list[int | None]:
    """The ZIP64 field's values for those of the directory entry's that do not fit in 32 bits."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values, place = [], at + 4
            for want in wanted:
                values.append(struct.unpack_from("<Q", extra, place)[0] if want else None)
                place += 8 * want
            return values
        at += 4 + n
    if any(wanted):
        raise ValueError("a directory entry lacks its ZIP64 field")
    return [None] * len(wanted)


def read_directory(read, size: int) -> list[Member]:
    """Members of a ZIP file; read(offset, length) gives a range of its `size` bytes."""
    first = max(0, size - _LONGEST_END)
    tail = read(first, size - first)
    at = len(tail) - 22
    while at >= 0 and not (tail.startswith(END, at) and
                           at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at -= 1
    if at < 0:
        raise ValueError("not a ZIP file: it has no end record")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    if n == FULL16 or FULL32 in (length, start):
        if not tail.startswith(LOCATOR64, max(at - 20, 0)):
            raise ValueError("the ZIP64 end record cannot be located")
        place = struct.unpack_from("<Q", tail, at - 12)[0]
        record = read(place, 56)
        if not record.startswith(END64):
            raise ValueError("the ZIP64 end record is not where it should be")
        n, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, out, at = read(start, length), [], 0
    for _ in range(n):
        if not directory.startswith(CENTRAL, at):
            raise ValueError("the central directory is damaged")
        method, = struct.unpack_from("<H", directory, at + 10)
        crc, packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIIHHH", directory, at + 16)
        header, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        long = _long_values(extra, [plain == FULL32, packed == FULL32, header == FULL32])
        _, packed, header = (b if a is None else a for a, b in zip(long, (plain, packed, header)))
        out.append(Member(name, crc, packed, header, method))
        at += 46 + n_name + n_extra + n_note
    return out


def data_offset(read, member: Member) -> int:
    """Where a stored member's bytes start."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored, so its records have no ranges")
    head = read(member.header, 30)
    if not head.startswith(LOCAL):
        raise ValueError(f"{member.name} is not where the directory says")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


# ---------------------------------------------------------------------------- WARC

def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(record_id: int | None) -> str:
    return f"<urn:record:{'none' if record_id is None else record_id}>"


def _record_id(name: str) -> int | None:
    text = name.rstrip(">").rpartition(":")[2]
    return None if text == "none" else int(text)


def format_record(record_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None,
                  is_revisit: bool, date: str = DATE) -> bytes:
    """A response record, or a revisit one: that has the HTTP headers but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
              f"WARC-Record-ID: {record_name(record_id)}", f"WARC-Date: {date}"]
    if uri is not None:
        # header fields are one line each
        fields.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if is_revisit:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
        block = http
    else:
        block = http + payload
    fields += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
               f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


@dataclass
class Record:
    record_id: int | None
    uri: str | None
    kind: str
    digest: str
    refers_to: int | None
    payload_bytes: int
    payload: bytes | None


def parse_record(data: bytes) -> Record:
    """A record of format_record; a revisit has no payload, but its digest and size."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2]
    if kind == "response" and base32_sha1(payload) != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return Record(
        _record_id(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, digest,
        _record_id(fields["warc-refers-to"]) if kind == "revisit" else None,
        int(_fields(http)["content-length"]), payload if kind == "response" else None)


# ---------------------------------------------------------------------------- on Spark

class _Archive:
    """One archive being written by a task."""

    def __init__(self, folder: str, small: int, member_bytes: int):
        system, path = open_folder(folder)
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zip"
        self.sink = system.open_output_stream(f"{path.rstrip('/')}/{self.path.rpartition('/')[2]}")
        self.zip, self.member_bytes = ZipWriter(self.sink, small), member_bytes
        self.index: list[str] = []
        self.member = None

    def add(self, record_id: int | None, kind: str, data: bytes) -> None:
        if self.member is None:
            self.member = f"archive/data-{len(self.zip.members):05d}.warc.gz"
            self.zip.start(self.member)
        place = self.zip.write(data)
        self.index.append(json.dumps({"id": record_id, "type": kind, "filename": self.member,
                                      "offset": place, "length": len(data)}))
        if self.zip.members[-1].size >= self.member_bytes:
            self.zip.end()
            self.member = None

    def close(self) -> pa.RecordBatch:
        if self.member is not None:
            self.zip.end()
        self.zip.start(INDEX)
        self.zip.write("".join(line + "\n" for line in self.index).encode())
        self.zip.end()
        self.zip.start("datapackage.json")
        self.zip.write(json.dumps({"profile": "data-package", "records": len(self.index)}).encode())
        self.zip.end()
        size = self.zip.close()
        self.sink.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.path]), pa.array([size]), pa.array([len(self.index)])], ["path", "bytes", "records"])


def with_first_copies(records: DataFrame, at_least: int = 0) -> DataFrame:
    """Rows record_id, uri, payload with refers_to and is_revisit.

    Of records with equal payloads of `at_least` bytes or more, that with the largest id is the
    response and the others revisit it; NULL ids are smaller than all others, and rows that repeat
    the largest id are all responses. Payloads are equal if SHA-256 and length are.
    """
    keyed = records.withColumns({"size": F.octet_length("payload"), "same": F.sha2("payload", 256)})
    groups = (keyed.filter(F.col("size") >= at_least).groupBy("same", "size")
              .agg(F.max("record_id").alias("largest"), F.count("*").alias("n")).filter("n > 1"))
    groups = materialize(groups)
    # copies of few payloads may be much of the table: there are at most HEAVY such, and they are broadcast
    total = groups.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * HEAVY >= F.lit(total)
    heavy = F.broadcast(groups.filter(is_heavy).drop("n"))
    on = ["same", "size"]
    joined = keyed.join(heavy, on).unionByName(
        keyed.join(heavy, on, "left_anti").join(groups.filter(~is_heavy).drop("n"), on, "left"))
    is_revisit = F.col("largest").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("largest"))
    return joined.select("record_id", "uri", "payload", F.when(is_revisit, F.col("largest")).alias("refers_to"),
                         is_revisit.alias("is_revisit"))


def write_archives(records: DataFrame, folder: str, date: str = DATE, level: int = LEVEL,
                   archive_bytes: int = ARCHIVE_BYTES, member_bytes: int = MEMBER_BYTES,
                   small: int = FULL32 - 1) -> DataFrame:
    """path, bytes, records of the archives written for rows record_id, uri, payload, refers_to, is_revisit.

    The result is a stored table: its archives are those of the tasks that Spark committed. No task
    holds more than a record and its archive's index. `small` is the largest value for which ZIP's
    32-bit fields are used.
    """
    def write(batches) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(5))):
                record_id, uri, payload, refers_to, is_revisit = (x.as_py() for x in row)
                data = format_record(record_id, uri, payload, base32_sha1(payload), refers_to, is_revisit, date)
                archive = archive or _Archive(folder, small, member_bytes)
                archive.add(record_id, "revisit" if is_revisit else "response",
                            gzip.compress(data, compresslevel=level, mtime=0))
                if archive.zip.at >= archive_bytes or len(archive.index) >= ARCHIVE_RECORDS:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    columns = ["record_id", "uri", "payload", "refers_to", "is_revisit"]
    return materialize(records.select(*columns).mapInArrow(write, "path string, bytes bigint, records bigint"))


def record_ranges(archives: DataFrame) -> DataFrame:
    """path, offset, length: the byte range of each record, from the archives' directories and indexes."""
    def locate(batches):
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, local = open_folder(path)
                with system.open_input_file(local) as source:
                    def read(at: int, n: int, source=source) -> bytes:
                        return source.read_at(n, at)

                    members = {m.name: m for m in read_directory(read, size)}
                    start = {}
                    index = members[INDEX]
                    listed = read(data_offset(read, index), index.size)
                if zlib.crc32(listed) != index.crc:
                    raise ValueError(f"the index of {path} is damaged")
                entries = [json.loads(line) for line in listed.splitlines()]
                with system.open_input_file(local) as source:
                    for name in {e["filename"] for e in entries}:
                        start[name] = data_offset(lambda at, n: source.read_at(n, at), members[name])
                for at in range(0, len(entries), 10_000):
                    some = entries[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(some)),
                         pa.array([start[e["filename"]] + e["offset"] for e in some], pa.int64()),
                         pa.array([e["length"] for e in some], pa.int64())], ["path", "offset", "length"])

    # an archive's directory is one task's work, so archives are dealt out first
    dealt = archives.select("path", "bytes").repartition(shuffle_partitions(archives.sparkSession), "path")
    return dealt.mapInArrow(locate, "path string, offset bigint, length bigint")


def _runs(rows: list, most: int) -> Iterator[list]:
    """Neighbouring (path, offset, length), together up to `most` bytes."""
    run: list = []
    for row in rows:
        if run and (row[0] != run[0][0] or row[1] != run[-1][1] + run[-1][2] or row[1] + row[2] - run[0][1] > most):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read_records(ranges: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """record_id, uri, record_type, payload_digest, refers_to, payload_bytes, payload of each range.

    The payload of revisits is NULL, as it is where `with_payload` is false. A damaged record raises.
    """
    names = ["record_id", "uri", "record_type", "payload_digest", "refers_to", "payload_bytes", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def fetch(batches):
        for batch in batches:
            rows = sorted(zip(*(batch.column(i).to_pylist() for i in range(3))))
            opened, last = None, None
            for run in _runs(rows, range_bytes):
                path, first = run[0][:2]
                if path != last:
                    system, local = open_folder(path)
                    opened, last = system.open_input_file(local), path
                data = opened.read_at(run[-1][1] + run[-1][2] - first, first)
                out = [[] for _ in names]
                for _, at, n in run:
                    r = parse_record(gzip.decompress(data[at - first:at - first + n]))
                    for column, value in zip(out, (r.record_id, r.uri, r.kind, r.digest, r.refers_to,
                                                   r.payload_bytes, r.payload if with_payload else None)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    # neighbours in an archive stay together; an archive may be read by many tasks
    dealt = ranges.repartition(shuffle_partitions(ranges.sparkSession), "path",
                               F.expr(f"offset div {8 * range_bytes}")).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(
        fetch, "record_id bigint, uri string, record_type string, payload_digest string, refers_to bigint, "
               "payload_bytes bigint, payload binary")


def page_records(pages: DataFrame) -> DataFrame:
    """Pages as record_id, uri, payload: the html in UTF-8, NULL as no bytes."""
    return pages.select(F.col("page_id").cast("bigint").alias("record_id"), F.col("url").alias("uri"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))


def archive_pages(pages: DataFrame, folder: str | None = None, at_least: int = 0, **settings) -> DataFrame:
    """The table of archives that hold a record per row of `pages`; the folder is a new shared one if not given.

    NULL and empty html are payloads of no bytes, and equal to each other. Repeated rows and NULL ids
    each have a record, NULL urls are records without target. No rows give no archives. Columns other
    than page_id, url and html are not read.
    """
    spark = pages.sparkSession
    folder = folder or f"{scratch_folder(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    return write_archives(with_first_copies(page_records(pages), at_least), folder, **settings)


def round_trip(pages: DataFrame, folder: str | None = None, at_least: int = 0, **settings) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, read from archives."""
    ranges = record_ranges(archive_pages(pages, folder, at_least, **settings))
    return read_records(ranges, with_payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32(hexadecimal: str) -> str:
    """DuckDB SQL: 40 hexadecimal digits in base 32; five of them are four letters."""
    chunk = f"CAST(concat('0x', substr({hexadecimal}, 5 * i + 1, 5)) AS BIGINT)"
    letters = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({chunk} >> {s}) & 31)::INT, 1)"
                          for s in (15, 10, 5, 0))
    return f"array_to_string(list_transform(range(8), lambda i: {letters}), '')"


def oracle() -> str:
    """The round trip of `pages` in DuckDB."""
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex,
        max(page_id) OVER (PARTITION BY body) AS largest FROM p)
SELECT page_id, payload_bytes, {_base32('hex')} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to FROM d"""
