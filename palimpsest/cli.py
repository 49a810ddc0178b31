"""Command line: the jobs over a store's tables.

Values come from an argument, else from ``PALIMPSEST_<NAME>`` in the environment, else from the default.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from palimpsest.functions.naming import physical_name
from palimpsest.operators import jobs, repair
from palimpsest.plans.reconcile import POLICIES
from palimpsest.sources.changelog import ChangeLog, folder_transport, http_transport
from palimpsest.sources.config import apply_config, load_config, table_list
from palimpsest.sources.files import Files
from palimpsest.sources.state import CursorState, Lease, StateStore
from palimpsest.sources.store import VersionedStore
from palimpsest.streaming.ingest import Ingest, SchemaCache, Settings, log_event, sync_loop, sync_once
from palimpsest.streaming.maintenance import Plan, TouchedTables, idle_pass


def _env(name: str, default: Any) -> Any:
    return os.environ.get(f"PALIMPSEST_{name.upper().replace('-', '_')}", default)


def _flag(name: str, default: bool) -> bool:
    return str(_env(name, default)).lower() not in ("0", "false", "no")


def _add(p: argparse.ArgumentParser, *options: tuple) -> None:
    for name, default, *kind in options:
        if isinstance(default, bool):
            p.add_argument(f"--{name}", action=argparse.BooleanOptionalAction, default=_flag(name, default))
        else:
            told = _env(name, default)
            cast = kind[0] if kind else type(default) if default is not None else str
            p.add_argument(f"--{name}", type=cast, default=cast(told) if told is not None else None)


COMMON = (("store", None), ("state", None), ("buckets", 16))
TABLES = (("tables", None), ("tables-file", None), ("max-tables", None, int))
FANOUT = (("concurrency", 4), ("stop-on-failure", False))
SYNC = (
    ("url", None), ("key", ""), ("scheme", "Bearer"), ("pages-folder", None), ("max-pages", 100), ("merge-pages", 1), ("merge-rows", 5000), ("table-concurrency", 1), ("lease-seconds", 300.0),
    ("schema-seconds", 600.0), ("unknown-tables", "fail"), ("coerce-drift", True), ("reconcile", True), ("force", False), ("seed-cursor", None),
)
MAINTENANCE = (("sleep-seconds", 20.0), ("rounds", None, int), ("optimize-pages", 50), ("optimize-rows", 5000), ("optimize-seconds", 900.0), ("maintain", True), ("optimize-cadence", 3600.0), ("compact-cadence", 86_400.0), ("cleanup-cadence", 604_800.0), ("window-start", 7), ("window-end", 12), ("keep-versions", 500), ("older-than", 259_200.0), ("idle-rows", 0), ("idle-pages", 1))
MIGRATE = (("source", None), ("format", "parquet"), ("table", None), ("mode", "overwrite"), ("where", None), ("order-by", None), ("max-rows", None, int), ("verify-count", True), ("config-folder", None))
REPAIR = (("columns", None), ("apply", False), ("limit", 1000), ("lease-seconds", 3600.0))


class Context:
    def __init__(self, args: argparse.Namespace, spark: SparkSession) -> None:
        self.args, self.spark = args, spark
        if not args.store:
            raise SystemExit("--store is required")
        self.store = VersionedStore(spark, args.store, args.buckets)
        self.state = StateStore(spark, args.state or f"{args.store.rstrip('/')}/_state")

    def tables(self) -> list[str]:
        a = self.args
        text = Files(self.spark).read(a.tables_file) if a.tables_file else None
        found = table_list(self.store, a.tables, text)
        return found[: a.max_tables] if a.max_tables is not None else found

    def each(self, job: Callable[[str], Any]) -> int:
        """The job for every table; exit status 1 if any failed."""
        a = self.args
        got = jobs.run_parallel(self.spark, {t: (lambda t=t: job(t)) for t in self.tables()}, a.concurrency, a.stop_on_failure)
        for table, r in sorted(got.items()):
            log_event("table_done" if r["ok"] else "table_failed", {"table": table, "error": r["error"], "result": str(r["result"])})
        return int(any(not r["ok"] for r in got.values()))

    def log(self) -> ChangeLog:
        a = self.args
        if not a.url and not a.pages_folder:
            raise SystemExit("--url or --pages-folder is required")
        return ChangeLog(a.url or "http://localhost", a.key, a.scheme, transport=folder_transport(a.pages_folder) if a.pages_folder else http_transport)

    def ingest(self) -> Ingest:
        a = self.args
        s = Settings(a.max_pages, a.merge_pages, a.merge_rows, a.table_concurrency, a.lease_seconds, a.schema_seconds, a.unknown_tables, a.coerce_drift, a.reconcile)
        if a.seed_cursor is not None and self.state.get("incremental/cursor")[0] is None:
            CursorState(self.state).seed(a.seed_cursor)
        return Ingest(self.spark, self.store, self.state, SchemaCache(self.state, self.log(), a.schema_seconds), s)

    def source(self, table: str) -> DataFrame:
        a = self.args
        where = a.source.format(table=table)
        return self.spark.table(where) if a.format == "table" else self.spark.read.format(a.format).load(where)

    def configure(self, table: str, folder: str | None) -> Any:
        config = load_config(Files(self.spark), folder, table) if folder else None
        return apply_config(self.store, self.state, config) if config else jobs.create_indexes(self.store, table)


def migrate_table(c: Context) -> int:
    a = c.args
    if not a.table or not a.source:
        raise SystemExit("--table and --source are required")
    got = jobs.migrate_table(c.store, a.table, c.source(a.table), a.mode, a.where, a.order_by, a.max_rows, a.verify_count)
    c.configure(a.table, a.config_folder)
    log_event("migrated", got)
    return 0


def run_parallel(c: Context) -> int:
    a = c.args
    if not a.source:
        raise SystemExit("--source is required, with {table} in it")
    return c.each(lambda t: jobs.migrate_table(c.store, t, c.source(t), a.mode, a.where, a.order_by, a.max_rows, a.verify_count))


def incremental_once(c: Context) -> int:
    ingest = c.ingest()
    log_event("sync_done", sync_once(ingest, c.log(), c.args.force))
    return 0


def incremental_loop(c: Context) -> int:
    a, ingest = c.args, c.ingest()
    plan = Plan(a.optimize_cadence, a.compact_cadence, a.cleanup_cadence, (a.window_start, a.window_end), a.keep_versions, a.older_than, a.idle_rows, a.idle_pages)
    touched = TouchedTables(a.optimize_pages, a.optimize_rows, a.optimize_seconds)

    def idle(stats: dict[str, Any]) -> bool:
        touched.add(ingest.touched, stats)
        ingest.touched.clear()
        if touched.due():
            log_event("optimized", {"tables": touched.optimize(c.store)})
        return a.maintain and idle_pass(c.store, c.state, plan, stats)

    sync_loop(ingest, c.log(), idle, a.sleep_seconds, a.rounds)
    return 0


def backfill(c: Context) -> int:
    return c.each(lambda t: jobs.backfill_generated(c.store, t, c.args.force))


def drop_current(c: Context) -> int:
    return c.each(lambda t: jobs.drop_legacy_current(c.store, t))


def create_indexes(c: Context) -> int:
    return c.each(lambda t: c.configure(t, c.args.config_folder))


def discover_repairs(c: Context) -> int:
    payload, _ = SchemaCache(c.state, c.log() if c.args.url or c.args.pages_folder else None).get()
    if c.args.schema_json:
        told = json.loads(Files(c.spark).read(c.args.schema_json) or "{}")
        payload = told.get("schemas", told)
    for r in repair.discover(c.store, payload, c.tables(), c.args.limit):
        log_event("repair_candidates", r)
    return 0


def repair_strings(c: Context) -> int:
    a, failed = c.args, False
    columns = [x.strip() for x in (a.columns or "").split(",") if x.strip()]
    for t in c.tables():
        lease = Lease(c.state, f"repair-{physical_name(t)}", a.lease_seconds).acquire() if a.apply else None
        try:
            log_event("repaired", repair.repair(c.store, t, columns, a.apply, a.limit))
        except Exception as e:  # reported, and told by the exit status
            failed = True
            log_event("repair_failed", {"table": t, "error": str(e)})
            if a.stop_on_failure:
                break
        finally:
            if lease:
                lease.release()
    return int(failed)


COMMANDS: dict[str, tuple[Callable[[Context], int], tuple]] = {
    "migrate-table": (migrate_table, MIGRATE),
    "incremental-once": (incremental_once, SYNC),
    "incremental-loop": (incremental_loop, SYNC + MAINTENANCE),
    "backfill-generated-columns": (backfill, TABLES + FANOUT + (("force", False),)),
    "drop-legacy-current": (drop_current, TABLES + FANOUT),
    "discover-quoted-json-string-repairs": (discover_repairs, TABLES + (("limit", 10_000), ("schema-json", None), ("url", None), ("key", ""), ("scheme", "Bearer"), ("pages-folder", None))),
    "repair-quoted-json-strings": (repair_strings, TABLES + REPAIR + (("stop-on-failure", False),)),
    "create-indexes": (create_indexes, TABLES + FANOUT + (("config-folder", None),)),
    "run-parallel": (run_parallel, TABLES + FANOUT + MIGRATE[:2] + MIGRATE[3:]),
    "run-generated-parallel": (backfill, TABLES + FANOUT + (("force", False),)),
    "run-drop-current-parallel": (drop_current, TABLES + FANOUT),
    "run-create-indexes-parallel": (create_indexes, TABLES + FANOUT + (("config-folder", None),)),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="palimpsest", description="versioned tables on Spark")
    sub = top.add_subparsers(dest="command", required=True)
    for name, (job, options) in COMMANDS.items():
        p = sub.add_parser(name)
        _add(p, *COMMON, *options)
        p.set_defaults(job=job)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if getattr(args, "unknown_tables", "fail") not in POLICIES:
        raise SystemExit(f"--unknown-tables must be one of {', '.join(POLICIES)}")
    spark = spark or SparkSession.builder.appName("palimpsest").config("spark.scheduler.mode", "FAIR").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return args.job(Context(args, spark))


if __name__ == "__main__":
    sys.exit(main())
