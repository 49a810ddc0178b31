"""WARC records in ZIP packages, read by ranges without extraction.

A package holds ``archive/data.warc.gz`` and ``indexes/index.cdxj`` as stored members, so a record's place in the package
is the member's place plus the index's offset; each record is a gzip member of its own, as is usual for WARC. ``ZipDirectory`` finds members
from the end of the file: end record, ZIP64 locator and end record, then the central directory with ZIP64 extra fields.
Only directory, index and the asked records are read. Records that are not packed are read too.

Of the records with equal payloads of at least ``least`` bytes, the one with the smallest page_id is a response,
the others are revisits that refer to it.

Defined results: null html is an empty payload; a null url is left out of the record; a null page_id is never the smallest, and
rows that repeat the smallest id are all responses, as are rows of a group whose ids are all null; an
empty table gives no packages and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import new_dir, own_columns, table, utf8, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payload bytes after which a task begins the next package.
PACKAGE = 256 << 20
PAGE, NO_PAGE = "urn:x-page:", "urn:x-no-page"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _named(page: str | None) -> str:
    return NO_PAGE if page is None else PAGE + quote(page, safe="")


def _page(told: str | None) -> str | None:
    name = (told or "").strip("<>")
    return unquote(name.removeprefix(PAGE)) if name.startswith(PAGE) else None


def warc_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """A response record, or a revisit (HTTP header only) if ``refers_to`` names a page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{_named(page)}>", "WARC-Date": date}
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(0x21, 0x7F))))
    head["WARC-Payload-Digest"] = f"sha1:{payload_digest(payload)}"
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<{_named(refers_to)}>", "WARC-Profile": REVISIT}
    block = http + payload if refers_to is None else http
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (keys in lower case) and payload of one record."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    warc = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(warc["content-length"])]
    if not warc.get("content-type", "").startswith("application/http"):
        return warc, {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return warc, http, payload


class PackageWriter:
    """A package that is written front to back, so any output stream will do."""

    def __init__(self, sink: pa.NativeFile) -> None:
        self.sink, self.zip = sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)
        self.index, self.at = io.BytesIO(), 0

    def add(self, key: str, record: bytes) -> None:
        record = gzip.compress(record, 6, mtime=0)
        self.member.write(record)
        self.index.write(f"{key} {json.dumps({'offset': self.at, 'length': len(record)})}\n".encode())
        self.at += len(record)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(INDEX, self.index.getvalue())
        self.zip.close()
        self.sink.close()


class ZipDirectory:
    """The members of a ZIP file, found with reads of its end, its directories and its members' headers."""

    def __init__(self, file: pa.NativeFile, size: int) -> None:
        self.file = file
        tail_at = max(0, size - 65557)
        tail = self._read(tail_at, size - tail_at)
        # The signature can stand in the comment too: the record's comment must reach the end of the file.
        end = len(tail)
        while (end := tail.rfind(b"PK\x05\x06", 0, end)) >= 0:
            if len(tail) - end >= 22 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
                break
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<10xHII", tail, end)
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            locator = self._read(tail_at + end - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            end64 = self._read(struct.unpack_from("<8xQ", locator)[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack_from("<32xQQQ", end64)
        self.members = dict(self._entries(self._read(start, length), count))

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    @staticmethod
    def _entries(data: bytes, count: int) -> Iterator[tuple[str, dict]]:
        at = 0
        for _ in range(count):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, packed, size, n_name, n_extra, n_note, header = struct.unpack_from("<10xH8xIIHHH8xI", data, at)
            name = data[at + 46 : at + 46 + n_name].decode()
            extra, k = data[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while k + 4 <= len(extra):
                kind, n = struct.unpack_from("<HH", extra, k)
                if kind == 1:  # the 64-bit values of those fields that are all ones, in this order
                    wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                    size = next(wide) if size == 0xFFFFFFFF else size
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header = next(wide) if header == 0xFFFFFFFF else header
                k += 4 + n
            yield name, {"method": method, "size": packed, "header": header}
            at += 46 + n_name + n_extra + n_note

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes in the package."""
        m = self.members[name]
        if m["method"] != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
        n_name, n_extra = struct.unpack_from("<26xHH", self._read(m["header"], 30))
        return m["header"] + 30 + n_name + n_extra, m["size"]

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        at, size = self.place(name)
        return self._read(at + offset, size - offset if length is None else length)


def records(uri: str, archive: str = DATA, index: str = INDEX) -> Iterator[tuple[str, bytes]]:
    """Key and bytes of each record that a package's index lists, one range read each."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as file:
        where = ZipDirectory(file, file.size())
        start, _ = where.place(archive)
        for line in where.read(index).decode().splitlines():
            key, _, told = line.partition(" ")
            told = json.loads(told[told.index("{") :])
            yield key, where._read(start + int(told["offset"]), int(told["length"]))


def write_packages(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as packages; returns their paths as ``package, n_records``."""
    rows = own_columns(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    first = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    first = first.withColumnRenamed("digest", "of")
    same = (F.col("digest") == F.col("of")) & (F.octet_length("html") >= least)
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = rows.join(first, same, "left").select("page_id", "url", "html", refers_to.cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        task, made, out, n = TaskContext.get(), 0, None, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"package": name, "n_records": n}])

        for b in batches:
            pages_, urls, refs = (b.column(c).cast(pa.string()).to_pylist() for c in ("page_id", "url", "refers_to"))
            for page, url, html, ref in zip(pages_, urls, utf8(b.column("html")), refs, strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    file = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made}.wacz"
                    name, out, made, n = f"{folder}/{file}", PackageWriter(fs.open_output_stream(f"{root}/{file}")), made + 1, 0
                out.add(_named(page), warc_record(page, url, html, ref))
                n += 1
                if out.at >= PACKAGE:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return written(rows.mapInArrow(run, "package string, n_records long"), "packages")


def read_packages(packages: DataFrame, id_type: str = "long") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("package").to_pylist():
                rows = []
                for _, data in records(uri):
                    warc, http, payload = parse_record(data)
                    revisit = warc["warc-type"] == "revisit"
                    rows.append(
                        {
                            "page": _page(warc["warc-record-id"]),
                            "payload_bytes": int(http["content-length"]) if revisit else len(payload),
                            "payload_digest": warc["warc-payload-digest"].removeprefix("sha1:") if revisit else payload_digest(payload),
                            "record_type": warc["warc-type"],
                            "refers": _page(warc.get("warc-refers-to")),
                        }
                    )
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("page", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers", pa.string())])
    found = packages.repartition(max(1, packages.count())).mapInArrow(run, "page string, payload_bytes long, payload_digest string, record_type string, refers string")
    return found.select(F.col("page").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast(id_type).alias("refers_to"))


def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    packages = write_packages(pages, new_dir(spark, "warc"))
    return read_packages(packages, pages.schema["page_id"].dataType.simpleString())


#: DuckDB has no base32: five bits at a time of the SHA-1 as hex digits.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, min(page_id) AS first_id FROM p GROUP BY d)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(p.d, 1 + CAST(floor(i * 5 / 4) AS INT), 2) || CASE WHEN i = 31 THEN '0' ELSE '' END AS INT)
     >> CAST(CASE WHEN i = 31 THEN 4 ELSE 0 END + 3 - i * 5 % 4 AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN m USING (d)
"""
