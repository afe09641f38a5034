"""Web archives in ZIP packages: written from pages, and read back by ranges without extraction.

A package holds stored members: `archive/data.warc.gz`, each record a gzip member of its own, and `indexes/index.cdxj`
with the offset and length of every record. The reader parses the end record, the ZIP64 end record and the central
directory, finds the index and the stored archives, and fetches each record by its range.

Packages are rows (name, data) of a table in the shared folder: tasks write it with Spark's commit protocol, so it works
on any store and survives lost executors, and a package never exceeds `package_bytes` by more than one record.

Of pages with equal payloads of at least `least_bytes`, the one with the largest id is the response and the others
revisit it; rows that repeat that id with the same payload are responses too. Null html is an empty payload, null urls
have no target header, null ids never win over others (and are responses where no id is known); empty tables give
empty results; further columns are ignored. Very long payloads are one record each, held by one task. Equal ids with
unlike payloads are judged row by row.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, pick, shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PAGE_URN = "urn:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- packages ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    start: int  # of the local header
    size: int
    stored: bool
    crc: int


class ZipDirectory:
    """The members of a ZIP package that is read by ranges only: `fetch(offset, n)` returns bytes."""

    def __init__(self, fetch: Callable[[int, int], bytes], size: int):
        self.fetch = fetch
        tail_at = max(0, size - 65_557)  # the end record with its longest comment
        tail = fetch(tail_at, size - tail_at)
        end = tail.rfind(b"PK\5\6")
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(b"PK\5\6", 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            locator = tail[end - 20 : end] if end >= 20 else b""
            if locator[:4] != b"PK\6\7":
                raise ValueError("no ZIP64 locator")
            record = fetch(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 end record")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
        self.members = {m.name: m for m in self._central(fetch(start, length), count)}

    @staticmethod
    def _central(data: bytes, count: int) -> Iterator[Member]:
        at = 0
        for _ in range(count):
            if data[at : at + 4] != b"PK\1\2":
                raise ValueError("central directory is damaged")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            crc, packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIIHHH", data, at + 16)
            start = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            where = 0
            while where + 4 <= len(extra):
                kind, n = struct.unpack_from("<HH", extra, where)
                if kind == 1:  # holds those of these values that don't fit 32 bits, in this order
                    wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, where + 4))
                    size = next(wide) if size == 0xFFFFFFFF else size
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    start = next(wide) if start == 0xFFFFFFFF else start
                where += 4 + n
            yield Member(name, start, packed, method == 0, crc)
            at += 46 + n_name + n_extra + n_comment

    def data_start(self, member: Member) -> int:
        """Where a member's bytes begin; the local header has its own name and extra lengths."""
        head = self.fetch(member.start, 30)
        if head[:4] != b"PK\3\4":
            raise ValueError("no local header")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return member.start + 30 + n_name + n_extra

    def read(self, name: str) -> bytes:
        member = self.members[name]
        if not member.stored:
            raise ValueError(f"{name} is not stored")
        data = self.fetch(self.data_start(member), member.size)
        if zlib.crc32(data) != member.crc:
            raise ValueError(f"{name} is damaged")
        return data


def package(records: list[tuple[str, bytes]]) -> bytes:
    """A package of (page id, gzip member) records."""
    index, at = [], 0
    for page, data in records:
        index.append(json.dumps({"page": page, "offset": at, "length": len(data), "filename": DATA}))
        at += len(data)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as file:
        file.writestr(zipfile.ZipInfo(DATA), b"".join(data for _, data in records))
        file.writestr(zipfile.ZipInfo(INDEX), "\n".join(index))
    return out.getvalue()


def package_records(fetch: Callable[[int, int], bytes], size: int) -> Iterator[bytes]:
    """The records that the indexes of a package list, each fetched by its own range."""
    directory = ZipDirectory(fetch, size)
    starts: dict[str, int] = {}
    for name in directory.members:
        if not name.startswith("indexes/"):
            continue
        for line in directory.read(name).decode().splitlines():
            entry = json.loads(line)
            member = directory.members[entry["filename"]]
            if not member.stored or entry["offset"] + entry["length"] > member.size:
                raise ValueError(f"{member.name}: range outside a stored member")
            if member.name not in starts:
                starts[member.name] = directory.data_start(member)
            yield zlib.decompress(fetch(starts[member.name] + entry["offset"], entry["length"]), wbits=31)


# --- records ----------------------------------------------------------------------------------------------------------


def record(page: str, url: str | None, digest: str, payload_bytes: int, payload: bytes | None, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit has the response's HTTP header, and so its payload's length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    body = http + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{PAGE_URN}{page}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE_URN}{refers_to}>", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (lower-case names) and payload of a record."""

    def fields(head: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}

    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record")
    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


# --- jobs -------------------------------------------------------------------------------------------------------------


#: Up to so many shared digests (some 100 bytes each in memory) are broadcast; beyond, the large payloads are shuffled by digest.
MOST_BROADCAST = 300_000


def decisions(rows: DataFrame, least_bytes: int, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The rows with `payload_bytes, payload_digest, refers_to`.

    Digests and ids alone are shuffled to find which payloads recur; where their number is small enough, counted first,
    the payloads themselves stay where they are.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = rows.withColumn("payload_bytes", F.length(payload).cast("long")).withColumn("payload_digest", F.sha1(payload))
    large = F.col("payload_bytes") >= least_bytes
    shared = durable(rows.where(large).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first"))
    refers_to = F.when(large & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    if shared.count() <= most_broadcast:
        joined = rows.join(F.broadcast(shared), "payload_digest", "left")
    else:  # small payloads, which recur most, have no key here
        joined = rows.where(large).join(shared, "payload_digest", "left").unionByName(rows.where(~large), allowMissingColumns=True)
    return joined.select(*rows.columns, refers_to)


def write_packages(pages: DataFrame, path: str, *, least_bytes: int = 1000, package_bytes: int = 8 << 20, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Packages of all pages as a table (name, data) at `path`."""
    rows = decisions(pick(pages, page_id=id_col, url=url_col, html=html_col), least_bytes)
    rows = rows.select(F.col("page_id").cast("string").alias("page"), "url", "payload_digest", "payload_bytes", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), F.col("refers_to").cast("string").alias("refers_to"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            data = package(records)
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(data).hexdigest()[:32] + ".wacz"]), pa.array([data], pa.binary())], ["name", "data"])

        records, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                page = "" if row["page"] is None else row["page"]
                payload = (row["html"] or "").encode() if row["refers_to"] is None else None
                data = record(page, row["url"], row["payload_digest"], row["payload_bytes"], payload, row["refers_to"], date)
                press = zlib.compressobj(1, wbits=31)
                records.append((page, press.compress(data) + press.flush()))
                size += len(records[-1][1])
                if size >= package_bytes:
                    yield out()
                    records, size = [], 0
        if records:
            yield out()

    rows.mapInArrow(packed, "name string, data binary").write.parquet(path)


def read_packages(packages: DataFrame, data_col: str = "data", *, id_type: str = "long", with_payload: bool = False) -> DataFrame:
    """One row per record of packages in a binary column (such a table, or files read as `binaryFile`)."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                view = memoryview(value.as_buffer())
                rows = []
                for data in package_records(lambda at, n, view=view: bytes(view[at : at + n]), len(view)):
                    warc, http, payload = parse_record(data)
                    said = base64.b32decode(warc["warc-payload-digest"].partition(":")[2]).hex()
                    revisit = warc["warc-type"] == "revisit"
                    if not revisit and (hashlib.sha1(payload).hexdigest() != said or len(payload) != int(http["content-length"])):
                        raise ValueError(f"record {warc['warc-record-id']} is damaged")
                    page, target = (warc.get(k, "").removeprefix(f"<{PAGE_URN}").removesuffix(">") or None for k in ("warc-record-id", "warc-refers-to"))
                    rows.append((page, int(http["content-length"]), said, warc["warc-type"], target, *[payload] * with_payload))
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.binary()] * with_payload]
                columns = list(zip(*rows, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    read = packages.select(packages[data_col].alias("data")).mapInArrow(unpacked, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", payload binary" * with_payload)
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archived(pages: DataFrame, *, id_col: str = "page_id", **options) -> DataFrame:
    """Pages written as packages in the shared folder and read back from there."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_packages(pages, path, id_col=id_col, **options)
    return read_packages(spark.read.parquet(path), id_type=dict(pages.dtypes)[id_col])
