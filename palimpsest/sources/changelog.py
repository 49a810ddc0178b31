"""The paged change log: an HTTP client with retries, and Spark data sources over the same pages.

A page is ``{"values": [...], "cursor": ..., "hasMore": ...}``. Rows are dictionaries of which only ``_table, _id, _ts, _deleted`` and
``_creationTime`` have fixed types; the whole document travels as JSON text.
"""

from __future__ import annotations

import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

Row = dict[str, Any]
Transport = Callable[[str, dict[str, str], float], Any]

RAW = "_table string, _id string, _ts bigint, _deleted boolean, _creationTime double, doc string, _cursor string, __page bigint, __seq bigint"
#: Endpoints of the source service.
DELTAS, SCHEMAS = "/api/document_deltas", "/api/json_schemas"


def http_transport(url: str, headers: dict[str, str], timeout: float) -> Any:
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
        return json.loads(r.read())


def folder_transport(folder: str) -> Transport:
    """Pages from files: ``schemas.json``, and ``pages.json``, a list of pages each of which names the ``from`` cursor that it answers."""

    def get(url: str, headers: dict[str, str], timeout: float) -> Any:
        parts = urllib.parse.urlsplit(url)
        if parts.path.endswith(SCHEMAS):
            with open(os.path.join(folder, "schemas.json")) as f:
                return json.load(f)
        cursor = urllib.parse.parse_qs(parts.query).get("cursor", [""])[0]
        with open(os.path.join(folder, "pages.json")) as f:
            pages = json.load(f)
        found = next((p for p in pages if str(p["from"]) == cursor), None)
        return found or {"values": [], "cursor": cursor, "hasMore": False}

    return get


class ChangeLog:
    """The source service. Every failure, and an answer that is no object, is tried again, then raised."""

    def __init__(self, url: str, key: str = "", scheme: str = "Bearer", timeout: float = 60, retries: int = 3, transport: Transport = http_transport, sleep: Callable[[float], None] = time.sleep) -> None:
        self.url, self.timeout, self.retries, self.transport, self.sleep = url.rstrip("/"), timeout, retries, transport, sleep
        self.headers = {"Authorization": f"{scheme} {key}"} if key else {}

    def request(self, path: str, params: dict[str, str]) -> Row:
        url = f"{self.url}{path}?{urllib.parse.urlencode(params)}"
        for attempt in range(self.retries + 1):
            try:
                got = self.transport(url, self.headers, self.timeout)
                if not isinstance(got, dict):
                    raise ValueError(f"no JSON object but {type(got).__name__}")
                return got
            except Exception as e:  # whatever went wrong may pass
                if attempt == self.retries:
                    raise RuntimeError(f"{path} failed after {attempt + 1} tries: {e}") from e
                self.sleep(0.5 * 2**attempt + 0.1)
        raise AssertionError

    def page(self, cursor: str) -> tuple[list[Row], str, bool]:
        """Rows, the next cursor, and whether there is more."""
        got = self.request(DELTAS, {"cursor": cursor, "format": "json"})
        rows = [r for r in got.get("values") or [] if isinstance(r, dict)]
        after, more = str(got.get("cursor", cursor)), bool(got.get("hasMore"))
        if more and after == cursor:
            raise RuntimeError(f"the log says there is more but stays at cursor {cursor}")
        return rows, after, more

    def schemas(self) -> dict[str, Any]:
        return self.request(SCHEMAS, {"deltaSchema": "true", "format": "json"})


def admitted(row: Row) -> bool:
    """Rows without a text table, an id and a time are passed over (and counted as seen)."""
    return isinstance(row.get("_table"), str) and row.get("_id") is not None and row.get("_ts") is not None


def raw_row(row: Row, cursor: str, page: int, seq: int) -> tuple:
    """A document as columns; any ``_deleted`` that is not empty or zero marks a tombstone, and a time with a fraction is an error."""
    created = row.get("_creationTime")
    doc = json.dumps(row, separators=(",", ":"), ensure_ascii=False)
    ts = int(row["_ts"])
    if isinstance(row["_ts"], float) and ts != row["_ts"]:
        raise ValueError(f"_ts of {row['_table']} {row['_id']} is no whole number: {row['_ts']}")
    return (row["_table"], str(row["_id"]), ts, bool(row.get("_deleted")), float(created) if isinstance(created, int | float) and not isinstance(created, bool) else None, doc, cursor, page, seq)


def page_mark(page: Row) -> tuple:
    """A row without a table that tells of a page, so that pages without any accepted row are seen too."""
    return (None, None, None, False, None, json.dumps(page), page["end_cursor"], page["page"], None)


class Chunk:
    """Pages gathered until a limit is reached."""

    def __init__(self, start: str, merge_pages: int = 1, merge_rows: int = 5000, max_pages: int = 100, pages_before: int = 0) -> None:
        self.start = self.end = start
        self.limits = (merge_pages, merge_rows, max_pages)
        self.pages: list[dict[str, Any]] = []
        self.rows: list[tuple] = []
        self.before, self.more = pages_before, True

    def add(self, rows: list[Row], after: str, more: bool, seq: int) -> int:
        """Take a page; returns the next sequence number."""
        number = self.before + len(self.pages) + 1
        good = [r for r in rows if admitted(r)]
        self.rows += [raw_row(r, after, number, seq + i) for i, r in enumerate(good)]
        tables: dict[str, int] = {}
        for r in good:
            tables[r["_table"]] = tables.get(r["_table"], 0) + 1
        self.pages.append({"page": number, "start_cursor": self.end, "end_cursor": after, "rows_seen": len(rows), "rows_accepted": len(good), "tables": tables, "has_more": more})
        self.end, self.more = after, more
        return seq + len(good)

    def full(self) -> bool:
        pages, rows, most = self.limits
        return len(self.pages) >= pages or len(self.rows) >= rows or self.before + len(self.pages) >= most or not self.more

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, RAW)


def _options(options: dict[str, str]) -> ChangeLog:
    transport = folder_transport(options["folder"]) if "folder" in options else http_transport
    return ChangeLog(options.get("url", "http://localhost"), options.get("key", ""), options.get("scheme", "Bearer"), float(options.get("timeout", 60)), int(options.get("retries", 3)), transport)


class _Stream(SimpleDataSourceStreamReader):
    """One ``read`` gathers one chunk; its offset is the cursor after it."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return {"cursor": self.options.get("cursor", "0"), "seq": 0}

    def _gather(self, start: dict, end: str | None = None) -> tuple[Iterator[tuple], dict]:
        log, seq = _options(self.options), int(start["seq"])
        chunk = Chunk(start["cursor"], int(self.options.get("merge_pages", 1)), int(self.options.get("merge_rows", 5000)))
        while True:
            rows, after, more = log.page(chunk.end)
            seq = chunk.add(rows, after, more, seq)
            if chunk.full() if end is None else after == end or not more:
                marks = [page_mark(p) for p in chunk.pages] if self.options.get("marks") == "true" else []
                return iter(marks + chunk.rows), {"cursor": chunk.end, "seq": seq}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        return self._gather(start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self._gather(start, end["cursor"])[0]

    def commit(self, end: dict) -> None:
        """The cursor of record is committed by the batch function, not here."""


class _Batch(DataSourceReader):
    """All pages from a cursor on, in one partition: the log gives the next cursor only with a page."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        log, cursor, seq, page, more = _options(self.options), self.options.get("cursor", "0"), 0, 0, True
        while more:
            rows, cursor, more = log.page(cursor)
            page += 1
            for r in filter(admitted, rows):
                yield raw_row(r, cursor, page, seq)
                seq += 1


class PagedLog(DataSource):
    """``spark.read`` and ``spark.readStream`` format ``pagedlog``."""

    @classmethod
    def name(cls) -> str:
        return "pagedlog"

    def schema(self) -> str:
        return RAW

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(dict(self.options))

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedLog)


def admission_counts(log: DataFrame) -> DataFrame:
    """Per table: rows seen and accepted; for logs that hold rows of any quality."""
    good = F.col("_table").isNotNull() & F.col("_id").isNotNull() & F.col("_ts").isNotNull()
    return log.groupBy("_table").agg(F.count("*").alias("rows_seen"), F.count_if(good).alias("rows_accepted"))
