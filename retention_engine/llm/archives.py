"""Web archives in ZIP packages: a writer, and a reader that ranges into them without extraction.

A package holds ``archive/data.warc.gz`` (one gzip member per WARC record) and ``indexes/index.cdxj`` (one line per
record with its place), both stored without ZIP compression, so any record is one byte range of the package. The
writer always adds the ZIP64 directory records. The reader finds the end record, follows the ZIP64 locator where
there is one, walks the central directory, and reads from there on only the index and the records asked for.

Packages are written by Spark's text source, one row a file, and read by its binary source: both go through Spark's
own file systems and commit protocol, never through a path opened by Python. The text source ends each file with a
line feed; the package declares it as its one-byte archive comment.

Nulls and edge cases: a null html is empty; a null url leaves the target out; a null page_id stays null and is never
referred to (equal payloads that all lack an id are all responses); rows that repeat the smallest page_id of their
payload are all responses; an empty table writes nothing and reads nothing; other columns are ignored. A package is
closed at ``PACKAGE_BYTES``; one longer record makes a package of its own.
"""
from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import batch_rows

PACKAGE_BYTES = 4 << 20
#: Equal payloads shorter than this are written again, not referred to.
REVISIT_BYTES = 100
WARC_NAME, INDEX_NAME = b"archive/data.warc.gz", b"indexes/index.cdxj"
LINE_END = b"\n"


# ---- records

def record(page_id: int | None, url: str | None, payload: bytes | None, n: int, digest: str, kind: str,
           refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP header of its response and no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block += payload or b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = lambda h: {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in h.decode().split("\r\n")[1:])}
    warc = fields(head)
    http, payload = rest[:int(warc["content-length"])].split(b"\r\n\r\n", 1)
    return warc, fields(http), payload


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ---- packages

def package(members: list[tuple[bytes, bytes]], comment: bytes = LINE_END) -> bytes:
    """A ZIP64 archive of stored members."""
    out, central = bytearray(), bytearray()
    for name, data in members:
        at, crc, n = len(out), zlib.crc32(data), len(data)
        sizes = struct.pack("<HHQQ", 1, 16, n, n)
        out += struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x800, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(name),
                           len(sizes)) + name + sizes + data
        place = struct.pack("<HHQQQ", 1, 24, n, n, at)
        central += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x800, 0, 0, 0x21, crc, 0xFFFFFFFF,
                               0xFFFFFFFF, len(name), len(place), 0, 0, 0, 0, 0xFFFFFFFF) + name + place
    at, k = len(out), len(members)
    out += central
    end64 = len(out)
    out += struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, k, k, len(central), at)
    out += struct.pack("<IIQI", 0x07064B50, 0, end64, 1)
    out += struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, len(comment)) + comment
    return bytes(out)


class Package:
    """Reads a ZIP or ZIP64 archive by ranges. ``read(offset, length)`` gives the bytes of one range."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        tail_at = max(0, size - 22 - 0xFFFF)
        tail = read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("no ZIP end record")
        count, length, at = struct.unpack_from("<HII", tail, end + 10)
        if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":
            end64 = struct.unpack_from("<Q", tail, end - 12)[0]
            big = read(end64, 56)
            if big[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record at the place its locator names")
            count, length, at = struct.unpack_from("<QQQ", big, 32)
        self.members: dict[str, tuple[int, int, int]] = {}
        directory, p = read(at, length), 0
        for _ in range(count):
            sign, method, packed, full, names, extras, comments, local = struct.unpack_from("<I6xH8xIIHHH8xI", directory, p)
            if sign != 0x02014B50:
                raise ValueError("broken central directory")
            name = directory[p + 46:p + 46 + names].decode()
            q, stop = p + 46 + names, p + 46 + names + extras
            while q + 4 <= stop:
                kind, size_ = struct.unpack_from("<HH", directory, q)
                if kind == 1:  # ZIP64: the fields that did not fit, in this order
                    wide = list(struct.unpack_from(f"<{size_ // 8}Q", directory, q + 4))
                    full = wide.pop(0) if full == 0xFFFFFFFF else full
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    local = wide.pop(0) if local == 0xFFFFFFFF else local
                q += 4 + size_
            self.members[name] = (local, packed, method)
            p += 46 + names + extras + comments

    def span(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's data in the archive."""
        local, n, method = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        names, extras = struct.unpack("<HH", self.read(local + 26, 4))
        return local + 30 + names + extras, n

    def records(self) -> Iterator[tuple[dict, bytes]]:
        """Index entry and bytes of every record."""
        at, n = self.span(INDEX_NAME.decode())
        base, _ = self.span(WARC_NAME.decode())
        for line in self.read(at, n).decode().splitlines():
            entry = json.loads(line.split(" ", 2)[2])
            yield entry, zlib.decompress(self.read(base + entry["offset"], entry["length"]), 31)


# ---- Spark

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Each page as response or revisit. Payloads of hot groups meet only in a join that Spark can split."""
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        raw.alias("payload"))
    rows = rows.select("*", F.length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("digest"))
    long_enough = F.col("n") >= REVISIT_BYTES
    first = rows.where(long_enough).groupBy("digest").agg(F.min("page_id").alias("first")).withColumnRenamed("digest", "k")
    # Written before it is joined: a join straight on two shuffles is one that Spark can split.
    first = materialize(first, "payload-first")
    # Short payloads meet nothing; their key is their own, so that they do not gather at one.
    key = F.when(long_enough, F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("page_id", "url").cast("string")))
    out = rows.withColumn("k", key).join(first, "k", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return out.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "n", "digest",
                      F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"),
                      F.when(again, F.col("first")).alias("refers_to"))


def write(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", package_bytes: int = PACKAGE_BYTES) -> None:
    """Packages of planned records, as files of the folder ``path``."""
    batch_rows(records.sparkSession)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def closed() -> pd.DataFrame:
            z = package([(WARC_NAME, bytes(data)), (INDEX_NAME, "".join(index).encode())])
            return pd.DataFrame({"z": [z[:-len(LINE_END)]]})  # the text source adds it

        data, index = bytearray(), []
        for b in batches:
            for r in b.itertuples(index=False):
                page, refers = (None if pd.isna(x) else int(x) for x in (r.page_id, r.refers_to))
                member = _gzip(record(page, r.url, r.payload, r.n, r.digest, r.kind, refers, date))
                if data and len(data) + len(member) > package_bytes:
                    yield closed()
                    data, index = bytearray(), []
                entry = {"offset": len(data), "length": len(member), "type": r.kind, "digest": f"sha256:{r.digest}"}
                index.append(f"urn:page:{'' if page is None else page} {date} {json.dumps(entry)}\n")
                data += member
        if data:
            yield closed()

    (records.mapInPandas(build, "z binary").select(F.col("z").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", LINE_END.decode()).text(path))


RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, payload binary")


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the packages in a folder. A response's size and digest are those of the payload read; a
    digest that differs from the header is an error. A revisit has its response's, from its header."""
    def page(name: str | None) -> int | None:
        digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                rows = []
                for _, data in Package(lambda at, n, c=content: c[at:at + n], len(content)).records():
                    warc, http, payload = parse_record(data)
                    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
                    rows.append((page(warc["warc-record-id"]), warc.get("warc-target-uri"),
                                 len(payload) if kind == "response" else int(http["content-length"]), digest, kind,
                                 page(warc.get("warc-refers-to")), payload if with_payload and kind == "response" else None))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD_SCHEMA.split(", ")])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(scan, RECORD_SCHEMA)


def write_and_read(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Writes the pages as packages in the shared folder and gives the records read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "packages")
    write(plan_records(pages), path)
    return read(spark, path, with_payload)
