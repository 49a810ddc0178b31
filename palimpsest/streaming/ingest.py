"""Incremental ingestion: chunks of the change log merged into their tables, then the cursor moves.

A chunk's tables are all merged before the cursor is swapped, and a merge is idempotent, so a crash between the two only replays
the chunk. ``sync_once`` reads the log itself; ``sync_stream`` runs the same flush as a Structured Streaming batch function.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.naming import file_stem, physical_name
from palimpsest.functions.normalize import document_columns
from palimpsest.operators.merge import MissingColumns, check_columns, merge_into
from palimpsest.plans.reconcile import reconcile, reconcile_existing
from palimpsest.plans.schema import CURSOR, RESERVED, ColumnSpec, table_specs
from palimpsest.sources.changelog import ChangeLog, Chunk, register
from palimpsest.sources.state import CursorState, Lease, LeaseHeld, StateStore
from palimpsest.sources.store import VersionedStore

Event = Callable[[str, dict[str, Any]], None]


def log_event(name: str, values: dict[str, Any]) -> None:
    """One JSON line with sorted keys."""
    print(json.dumps({"event": name, **values}, sort_keys=True, default=str), flush=True)


@dataclass
class Settings:
    """Defaults of the sync."""

    max_pages: int = 100
    merge_pages: int = 1
    merge_rows: int = 5000
    table_concurrency: int = 1
    lease_seconds: float = 300
    schema_seconds: float = 600
    unknown_tables: str = "fail"
    coerce_drift: bool = True
    reconcile: bool = True
    lease_name: str = "incremental"


class SchemaCache:
    """The service's JSON schemas, kept in the state store for a while."""

    def __init__(self, state: StateStore, log: ChangeLog | None, seconds: float = 600, clock: Callable[[], float] = time.time) -> None:
        self.state, self.log, self.seconds, self.clock = state, log, seconds, clock

    def get(self, force: bool = False) -> tuple[dict[str, Any], bool]:
        """Schemas by source table, and whether they have just been fetched."""
        have, _ = self.state.get("incremental/schema")
        if have and not force and self.clock() - have["fetched_at"] < self.seconds:
            return have["schemas"], False
        if self.log is None:
            return (have or {"schemas": {}})["schemas"], False
        got = self.log.schemas()
        schemas = got.get("schemas", got)
        self.state.put("incremental/schema", {"fetched_at": self.clock(), "schemas": schemas})
        return schemas, True


@dataclass
class Ingest:
    """What a flush needs."""

    spark: SparkSession
    store: VersionedStore
    state: StateStore
    schemas: SchemaCache
    settings: Settings = field(default_factory=Settings)
    event: Event = log_event
    touched: set[str] = field(default_factory=set)

    def typed(self, rows: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
        """Raw rows of one table as its columns; the document's fields are read from its text."""
        app = [s for s in specs if s.name not in RESERVED]
        system = [F.col(c) for c in ("_id", "_creationTime", "_table", "_ts", "_deleted", "_cursor", "__seq")]
        return rows.select(*system, *document_columns(F.col("doc"), app))

    def _observed(self, rows: DataFrame) -> list[str]:
        """The documents' field names: distinct on the executors, a schema's worth on the driver."""
        keys = rows.select(F.explode(F.json_object_keys("doc")).alias("k")).distinct()
        return sorted(r["k"] for r in keys.collect())

    def _specs(self, table: str, schemas: dict[str, Any]) -> list[ColumnSpec]:
        s = self.settings
        if not s.reconcile and self.store.exists(table):
            return table_specs(schemas.get(table) or {})
        done = reconcile(self.store, table, schemas.get(table), s.unknown_tables, s.coerce_drift)
        for a in done.actions:
            self.event("schema_reconciled", {"table": table, **a})
        return done.specs

    def merge_table(self, table: str, rows: DataFrame, schemas: dict[str, Any]) -> int:
        """Merge one table's raw rows; returns the rows merged, 0 if the table is to be skipped."""
        specs = self._specs(table, schemas)
        if not specs:
            self.event("table_skipped", {"table": table})
            return 0
        known = {s.name for s in specs} | set(self.store.schema(table).names) | RESERVED
        check_columns(table, known, self._observed(rows))
        before = self.store.count(table)
        done = merge_into(self.store, table, self.typed(rows, specs), "__seq")
        self.touched.add(physical_name(table))
        self.event("table_merged", {"table": table, "version": done.version, "rows_before": before, "rows_after": done.rows})
        return done.rows - before

    def flush(self, raw: DataFrame) -> dict[str, int]:
        """Merge a chunk's tables; all are tried, and the first error is raised after that.

        A field that a table does not know refreshes the schemas once, after which all tables are merged again, one by one.
        """
        raw = raw.persist()
        try:
            counts = {r["_table"]: r["count"] for r in raw.groupBy("_table").count().collect()}
            schemas, _ = self.schemas.get()
            part = lambda t: raw.where(F.col("_table") == t)
            errors: dict[str, Exception] = {}

            def one(table: str) -> None:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"table-{physical_name(table)}")
                try:
                    self.merge_table(table, part(table), schemas)
                except Exception as e:  # the others go on
                    errors[table] = e
                    self.event("table_merge_failed", {"table": table, "error": str(e)[:500]})

            with ThreadPoolExecutor(max(1, self.settings.table_concurrency)) as pool:
                list(pool.map(one, sorted(counts)))
            if hard := [e for t, e in sorted(errors.items()) if not isinstance(e, MissingColumns)]:
                raise hard[0]
            if errors:
                self.event("schema_refresh", {"tables": sorted(errors)})
                fresh, _ = self.schemas.get(force=True)
                for table in sorted(counts):
                    self.merge_table(table, part(table), fresh)
            return counts
        finally:
            raw.unpersist()


def _commit_chunk(state: StateStore, lease: Lease, cursor: CursorState, at: tuple[str, str], pages: list[dict[str, Any]], merged: dict[str, int], settings: Settings, done: int) -> None:
    """Audit a chunk whose tables are merged, and swap the cursor that was read before it (``at``); the lease must still be held."""
    lease.verify()
    if cursor.read() != at:
        raise RuntimeError("the cursor has moved under this run")
    _audit(state, pages, merged, lease.owner, settings)
    start, end = pages[0]["start_cursor"], pages[-1]["end_cursor"]
    if end != start:
        cursor.advance(start, end, at[1], lease.owner, done)
    lease.heartbeat()


def _audit(state: StateStore, pages: list[dict[str, Any]], merged: dict[str, int], owner: str, settings: Settings) -> None:
    start, end = pages[0]["start_cursor"], pages[-1]["end_cursor"]
    value = {"owner": owner, "rows_merged": sum(merged.values()), "tables": merged, "start_cursor": start, "end_cursor": end, "rows_seen": sum(p["rows_seen"] for p in pages), "rows_accepted": sum(p["rows_accepted"] for p in pages), "at": time.time()}
    first, last = pages[0]["page"], pages[-1]["page"]
    single = settings.merge_pages == 1 and len(pages) == 1
    ends = f"{file_stem(start)}-{file_stem(end)}"
    stamp = int(time.time() * 1000)
    if single:
        state.append_line(f"incremental/page_audit/{stamp}-{first}-{ends}.json", {**value, "page": first})
    else:
        state.append_line(f"incremental/chunk_audit/{stamp}-{first}-{last}-{ends}.json", {**value, "start_page": first, "end_page": last})


def sync_once(ingest: Ingest, log: ChangeLog, force: bool = False) -> dict[str, Any]:
    """Read and merge chunks until the log ends or the page limit is reached."""
    s, state = ingest.settings, ingest.state
    lease = Lease(state, s.lease_name, s.lease_seconds).acquire(force)
    cursor = CursorState(state)
    start = last = None
    stats = {"pages": 0, "rows_seen": 0, "rows_accepted": 0, "rows_merged": 0, "chunks": 0, "has_more": True}
    try:
        last, tag = start, _ = cursor.read()[0], None
        ingest.event("sync_started", {"cursor": start, "owner": lease.owner})
        schemas, fresh = ingest.schemas.get()
        if fresh and s.reconcile:
            _, failed = reconcile_existing(ingest.store, schemas)
            for f in failed:
                ingest.event("schema_reconcile_failed", f)
        seq, more = 0, True
        while more and stats["pages"] < s.max_pages:
            last, tag = cursor.read()
            chunk = Chunk(last, s.merge_pages, s.merge_rows, s.max_pages, stats["pages"])
            while True:
                rows, after, more = log.page(chunk.end)
                seq = chunk.add(rows, after, more, seq)
                if chunk.full():
                    break
            with lease.kept():
                merged = ingest.flush(chunk.frame(ingest.spark)) if chunk.rows else {}
            _commit_chunk(state, lease, cursor, (last, tag), chunk.pages, merged, s, stats["pages"] + len(chunk.pages))
            stats["pages"] += len(chunk.pages)
            stats["chunks"] += 1
            for p in chunk.pages:
                stats["rows_seen"] += p["rows_seen"]
                stats["rows_accepted"] += p["rows_accepted"]
                ingest.event("page_committed", p | ({"buffered": True} if len(chunk.pages) > 1 else {}))
            stats["rows_merged"] += sum(merged.values())
        stats["has_more"] = more
        state.delete("incremental/last_error")
        stats |= {"start_cursor": start, "end_cursor": cursor.read()[0]}
        ingest.event("sync_finished", stats)
        return stats
    except Exception as e:
        ingest.event("sync_failed", {"start_cursor": start, "last_cursor": last, "error": str(e)[:500]})
        state.put("incremental/last_error", {"owner": lease.owner, "error": str(e)[:2000], "start_cursor": start, "last_cursor": last, "updated_at": time.time()})
        raise
    finally:
        lease.release()


def hit_page_cap(stats: dict[str, Any], settings: Settings) -> bool:
    return stats["pages"] >= settings.max_pages


def sync_loop(ingest: Ingest, log: ChangeLog, idle: Callable[[dict[str, Any]], bool] | None = None, sleep_seconds: float = 20, rounds: int | None = None, sleep: Callable[[float], None] = time.sleep) -> int:
    """``sync_once`` again and again. No sleep after a run that reached the page limit or when ``idle`` did some work; a held lease is waited for."""
    done = 0
    while rounds is None or done < rounds:
        done += 1
        try:
            stats = sync_once(ingest, log)
        except LeaseHeld as e:
            ingest.event("lease_held", {"error": str(e)})
            sleep(sleep_seconds)
            continue
        worked = bool(idle and idle(stats))
        if not hit_page_cap(stats, ingest.settings) and not worked:
            sleep(sleep_seconds)
    return done


def sync_stream(ingest: Ingest, options: dict[str, str], checkpoint: str, max_chunks: int = 100, force: bool = False) -> int:
    """The same flush as a Structured Streaming batch function, until the log ends; returns the chunks committed.

    Spark's trigger for what is available stops after one ``read``, so the drain is here: a run per chunk. The lease, the audit and the
    cursor are those of ``sync_once``. The cursor of record decides: a chunk that it has passed is not merged
    again, and a checkpoint that has another position than the cursor is refused. A new checkpoint starts at the cursor.
    """
    register(ingest.spark)
    s, state = ingest.settings, ingest.state
    lease = Lease(state, s.lease_name, s.lease_seconds).acquire(force)
    cursor = CursorState(state)
    flushed = 0
    try:
        options = {**options, "cursor": cursor.read()[0], "marks": "true"}
        for _ in range(max_chunks):
            seen: list[bool] = []

            def batch(df: DataFrame, _: int, seen: list[bool] = seen) -> None:
                df = df.persist()
                try:
                    marks = df.where("_table is null").select("doc").collect()  # one per page of the chunk
                    pages = sorted((json.loads(m["doc"]) for m in marks), key=lambda p: p["page"])
                    if not pages:
                        return
                    at = cursor.read()
                    if at[0] == pages[-1]["end_cursor"] != pages[0]["start_cursor"]:  # passed before a crash
                        seen.append(pages[-1]["has_more"])
                        return
                    if at[0] != pages[0]["start_cursor"]:
                        raise RuntimeError(f"the checkpoint is at {pages[0]['start_cursor']}, the cursor at {at[0]}")
                    with lease.kept():
                        merged = ingest.flush(df.where("_table is not null")) if any(p["rows_accepted"] for p in pages) else {}
                    _commit_chunk(state, lease, cursor, at, pages, merged, s, flushed + len(seen) + 1)
                    for p in pages:
                        ingest.event("page_committed", p | ({"buffered": True} if len(pages) > 1 else {}))
                    seen.append(pages[-1]["has_more"])
                finally:
                    df.unpersist()

            query = ingest.spark.readStream.format("pagedlog").options(**options).load().writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            query.awaitTermination()
            flushed += len(seen)
            if not seen or not seen[-1]:
                break
        return flushed
    finally:
        lease.release()
