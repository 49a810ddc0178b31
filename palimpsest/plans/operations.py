"""Queries over what the store, the sync and the maintenance do, and the rows that they must leave, in DuckDB's SQL."""

from __future__ import annotations

import json
import threading
import urllib.parse
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from palimpsest.functions.jsontext import is_quoted
from palimpsest.functions.keys import GENERATED
from palimpsest.functions.naming import file_stem, physical_name
from palimpsest.operators import jobs, repair
from palimpsest.plans.queries import _QUOTED_FROM, _quoted, event_log, query, table
from palimpsest.plans.reconcile import POLICIES, SchemaDrift, UnknownTable, reconcile, reconcile_existing
from palimpsest.plans.schema import struct_of, table_specs
from palimpsest.sources.changelog import ChangeLog, register
from palimpsest.sources.config import apply_config, parse_config, table_list
from palimpsest.sources.state import Conflict, CursorState, Lease, LeaseHeld, StateStore
from palimpsest.sources.store import VersionedStore
from palimpsest.sources.workdir import shared_dir
from palimpsest.streaming import maintenance
from palimpsest.streaming.ingest import Ingest, SchemaCache, Settings, sync_loop, sync_once, sync_stream

STRING, NUMBER, INTEGER = {"type": "string"}, {"type": "number"}, {"type": "integer"}


def _store(spark: SparkSession, buckets: int = 4) -> VersionedStore:
    return VersionedStore(spark, shared_dir(spark, "store"), buckets=buckets)


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# -- schema evolution

_CODE = "CASE c_custkey % 4 WHEN 0 THEN 'bad' WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN CAST(c_custkey AS VARCHAR) || '.5' END"


def _codes(spark: SparkSession, d: str, code: str = _CODE) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("_id"), F.expr(code.replace("VARCHAR", "STRING")).alias("code"), "c_nationkey")


def _drifted(spark: SparkSession, d: str) -> tuple[VersionedStore, list[dict]]:
    store = _store(spark)
    store.overwrite("codes", _codes(spark, d))
    return store, reconcile(store, "codes", {"properties": {"code": NUMBER, "c_nationkey": INTEGER}}).actions


@query("q41_drift_coerced", f"SELECT CAST(c_custkey AS VARCHAR) AS _id, TRY_CAST({_CODE} AS DOUBLE) AS code, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def q41(spark: SparkSession, d: str) -> DataFrame:
    """A text column that the schema wants as a number, and a narrow one: coerced and widened in place."""
    return _drifted(spark, d)[0].read("codes").select("_id", "code", "c_nationkey")


@query("q42_drift_counts", f"SELECT 'code' AS name, count(c) AS before, count(TRY_CAST(c AS DOUBLE)) AS after, count(c) - count(TRY_CAST(c AS DOUBLE)) AS newly_nulled FROM (SELECT {_CODE} AS c FROM customer)")
def q42(spark: SparkSession, d: str) -> DataFrame:
    stats = next(a for a in _drifted(spark, d)[1] if a["action"] == "coerce")["stats"]
    return _rows(spark, [(c, s["before"], s["after"], s["newly_nulled"]) for c, s in stats.items()], "name string, before long, after long, newly_nulled long")


@query("q43_drift_refused", "SELECT CAST(c_custkey AS VARCHAR) AS _id, 'x' || CAST(c_custkey AS VARCHAR) AS code, true AS refused, true AS off FROM customer")
def q43(spark: SparkSession, d: str) -> DataFrame:
    """A coercion that would lose all values of a column is refused, as is any if coercion is off; the table stays."""
    store = _store(spark)
    store.overwrite("codes", _codes(spark, d, "'x' || CAST(c_custkey AS VARCHAR)").drop("c_nationkey"))
    refused = []
    for coerce in (True, False):
        try:
            reconcile(store, "codes", {"properties": {"code": NUMBER}}, coerce=coerce)
        except SchemaDrift:
            refused.append(True)
    return store.read("codes").select("_id", "code", F.lit(refused == [True, True]).alias("refused"), F.lit(len(refused) == 2).alias("off"))


@query("q44_empty_table_recreated", "SELECT * FROM (VALUES ('code', 'double', 2), ('note', 'string', 2)) AS v(name, kind, versions)")
def q44(spark: SparkSession, d: str) -> DataFrame:
    """A drifted column of an empty table changes its type without any coercion; older versions stay."""
    store = _store(spark)
    store.create("empty", struct_of(table_specs({"properties": {"code": STRING, "note": STRING}})))
    reconcile(store, "empty", {"properties": {"code": NUMBER, "note": STRING}})
    kinds = dict(store.describe("empty"))
    return _rows(spark, [(c, kinds[c], len(store.versions("empty"))) for c in ("code", "note")], "name string, kind string, versions int")


@query(
    "q45_unknown_table_policies",
    """SELECT * FROM (VALUES ('fail', true, 'error'), ('fail', false, 'error'), ('create', true, 'create'), ('create', false, 'error'), ('skip', true, 'skipped'), ('skip', false, 'skipped')) AS v(policy, has_schema, outcome)""",
)
def q45(spark: SparkSession, d: str) -> DataFrame:
    out = []
    for policy in POLICIES:
        for schema in ({"properties": {"a": STRING}}, None):
            try:
                got = reconcile(_store(spark), "new", schema, policy)
                outcome = "skipped" if got.skipped else got.actions[0]["action"]
            except UnknownTable:
                outcome = "error"
            out.append((policy, schema is not None, outcome))
    return _rows(spark, out, "policy string, has_schema boolean, outcome string")


@query(
    "q46_columns_added_to_known_tables",
    """SELECT * FROM (VALUES ('nation', 'n_name', 'string'), ('nation', 'n_nationkey', 'int'), ('nation', 'n_regionkey', 'int'), ('nation', 'note', 'string'), ('nation', 'size', 'double'),
  ('region', 'r_name', 'string'), ('region', 'r_regionkey', 'int')) AS v(table_name, name, kind)""",
)
def q46(spark: SparkSession, d: str) -> DataFrame:
    """Stored tables meet the service's schemas by physical name: new columns come, drift and unknown tables are left alone."""
    store = _store(spark)
    for t in ("nation", "region"):
        store.overwrite(t, table(spark, d, t))
    reconcile_existing(store, {"Nation": {"properties": {"note": STRING, "size": NUMBER, "n_name": NUMBER}}, "Other": {"properties": {"x": STRING}}})
    system = {f.name for f in struct_of(table_specs({}))}
    return _rows(spark, [(t, n, k) for t in store.tables() for n, k in store.describe(t) if n not in system], "table_name string, name string, kind string")


@query("q47_recreated_table", "SELECT r_regionkey, r_name, true AS old_kept FROM region WHERE r_regionkey > 1")
def q47(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark)
    first = store.overwrite("region", table(spark, d, "region"))
    store.recreate_empty("region", first.schema)
    empty = store.read("region").isEmpty() and store.count("region") == 0
    store.append("region", table(spark, d, "region").where("r_regionkey > 1"))
    return store.read("region").withColumn("old_kept", F.lit(empty and store.read("region", 1).count() == first.rows))


# -- the paged log

NATIONS = """SELECT CAST(n_nationkey AS VARCHAR) AS _id, CAST(n_nationkey + 1 AS BIGINT) AS _ts, n_regionkey = 0 AS _deleted, n_name AS name, CAST(n_regionkey AS BIGINT) AS region,
  CAST(CASE WHEN n_regionkey = 0 THEN 3 ELSE 1 END AS TINYINT) AS __status, CAST(CASE WHEN n_regionkey = 0 THEN 3 ELSE 1 END AS VARCHAR) || '#' || CAST(n_nationkey AS VARCHAR) AS __status_id,
  CAST(n_nationkey AS VARCHAR) || '#' || CAST(n_nationkey + 1 AS VARCHAR) AS __id_ts FROM nation"""
PAGE = 7


def _nations(spark: SparkSession, d: str) -> list[dict[str, Any]]:
    rows = table(spark, d, "nation").orderBy("n_nationkey").collect()
    return [{"_table": "nation", "_id": str(r["n_nationkey"]), "_ts": r["n_nationkey"] + 1, "_deleted": r["n_regionkey"] == 0, "name": r["n_name"], "region": r["n_regionkey"]} for r in rows]


_SCHEMAS = {"schemas": {"nation": {"properties": {"name": STRING, "region": INTEGER}}, "region": {"properties": {"name": STRING}}}}


def _answers(rows: list[dict[str, Any]], schemas: dict[str, Any] = _SCHEMAS, page: int = PAGE) -> Callable[[str], dict[str, Any]]:
    """The service's answer to a path with its parameters: pages of so many rows."""

    def answer(url: str) -> dict[str, Any]:
        parts = urllib.parse.urlsplit(url)
        if parts.path.endswith("schemas"):
            return schemas
        at = int(urllib.parse.parse_qs(parts.query)["cursor"][0])
        return {"values": rows[at : at + page], "cursor": str(min(at + page, len(rows))), "hasMore": at + page < len(rows)}

    return answer


def _setup(spark: SparkSession, answer: Callable[[str], dict[str, Any]], **settings: Any) -> tuple[Ingest, ChangeLog, list]:
    root = shared_dir(spark, "sync")
    store, state = VersionedStore(spark, f"{root}/store", buckets=4), StateStore(spark, f"{root}/state")
    log = ChangeLog("http://localhost", transport=lambda url, *_: answer(url), sleep=lambda _: None)
    CursorState(state).seed("0")
    events: list[tuple[str, dict]] = []
    told = Settings(**{"unknown_tables": "create", "merge_pages": 2, **settings})
    return Ingest(spark, store, state, SchemaCache(state, log), told, lambda n, v: events.append((n, v))), log, events


def _nation_rows(ingest: Ingest) -> DataFrame:
    return ingest.store.read("nation").select("_id", "_ts", "_deleted", "name", "region", *GENERATED)


@query("q48_schema_refreshed_once", f"SELECT *, CAST(1 AS BIGINT) AS refreshes FROM ({NATIONS})")
def q48(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a field that the cached schema lacks: the schema is fetched once more, the column comes, the chunk is merged."""
    ingest, log, events = _setup(spark, _answers(_nations(spark, d)))
    ingest.state.put("incremental/schema", {"fetched_at": 4e9, "schemas": {"nation": {"properties": {"name": STRING}}}})
    sync_once(ingest, log)
    return _nation_rows(ingest).withColumn("refreshes", F.lit(sum(n == "schema_refresh" for n, _ in events)).cast("long"))


@query("q49_failed_chunk_replayed", f"SELECT *, '0' AS cursor_after_failure, true AS error_kept FROM ({NATIONS})")
def q49(spark: SparkSession, d: str) -> DataFrame:
    """A chunk whose cursor could not be swapped is merged again from the start, without harm."""
    ingest, log, _ = _setup(spark, _answers(_nations(spark, d)), merge_pages=10)
    whole = CursorState.advance

    def lost(*_: Any) -> None:
        raise OSError("the store is away")

    CursorState.advance = lost
    try:
        sync_once(ingest, log)
    except OSError:
        pass
    finally:
        CursorState.advance = whole
    cursor, error = CursorState(ingest.state).read()[0], ingest.state.get("incremental/last_error")[0]
    sync_once(ingest, log)
    return _nation_rows(ingest).withColumn("cursor_after_failure", F.lit(cursor)).withColumn("error_kept", F.lit(error is not None))


@query(
    "q50_tables_merged_in_parallel",
    """SELECT 'nation' AS table_name, CAST(n_nationkey AS VARCHAR) AS _id, n_name AS name FROM nation UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
)
def q50(spark: SparkSession, d: str) -> DataFrame:
    """Three tables of one log, merged side by side; a run ends at its page limit, so runs follow until the log ends."""
    rows = []
    for t, key, name in (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"), ("supplier", "s_suppkey", "s_name")):
        rows += [{"_table": t, "_id": str(r[0]), "_ts": r[0], "name": r[1]} for r in table(spark, d, t).select(key, name).collect()]
    schemas = {"schemas": {t: {"properties": {"name": STRING}} for t in ("nation", "region", "supplier")}}
    ingest, log, _ = _setup(spark, _answers(rows, schemas, 40), merge_pages=100, table_concurrency=3)
    while sync_once(ingest, log)["has_more"]:
        pass
    parts = [ingest.store.read(t).select(F.lit(t).alias("table_name"), "_id", "name") for t in ingest.store.tables()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("q51_cursor_of_each_row", f"SELECT CAST(n_nationkey AS VARCHAR) AS _id, CAST(least((n_nationkey // {PAGE} + 1) * {PAGE}, (SELECT count(*) FROM nation)) AS VARCHAR) AS _cursor, 'nation' AS _table FROM nation")
def q51(spark: SparkSession, d: str) -> DataFrame:
    ingest, log, _ = _setup(spark, _answers(_nations(spark, d)))
    sync_once(ingest, log)
    return ingest.store.read("nation").select("_id", "_cursor", "_table")


@query(
    "q52_audit_of_chunks",
    f"""SELECT c AS chunk, CAST(least(c * {2 * PAGE}, n) AS VARCHAR) AS start_cursor, CAST(least((c + 1) * {2 * PAGE}, n) AS VARCHAR) AS end_cursor, least((c + 1) * {2 * PAGE}, n) - c * {2 * PAGE} AS rows_seen,
  least((c + 1) * {2 * PAGE}, n) - c * {2 * PAGE} AS rows_accepted FROM (SELECT count(*) AS n FROM nation), (SELECT range AS c FROM range(100)) WHERE c * {2 * PAGE} < n""",
)
def q52(spark: SparkSession, d: str) -> DataFrame:
    """One audit record per chunk of two pages."""
    ingest, log, _ = _setup(spark, _answers(_nations(spark, d)))
    sync_once(ingest, log)
    found = spark.read.json(f"{ingest.state.root}/incremental/chunk_audit")
    return found.select(F.expr(f"cast(start_cursor as long) div {2 * PAGE}").alias("chunk"), "start_cursor", "end_cursor", "rows_seen", "rows_accepted")


@query(
    "q53_page_events",
    f"""SELECT p + 1 AS page, least((p + 1) * {PAGE}, n) - p * {PAGE} AS rows_seen, (p + 1) * {PAGE} < n AS has_more FROM (SELECT count(*) AS n FROM nation), (SELECT range AS p FROM range(100)) WHERE p * {PAGE} < n""",
)
def q53(spark: SparkSession, d: str) -> DataFrame:
    ingest, log, events = _setup(spark, _answers(_nations(spark, d)))
    sync_once(ingest, log)
    pages = [v for n, v in events if n == "page_committed"]
    return _rows(spark, [(p["page"], p["rows_seen"], p["has_more"]) for p in pages], "page long, rows_seen long, has_more boolean")


@query("q54_loop_drains_the_log", f"SELECT *, CAST(0 AS BIGINT) AS sleeps FROM ({NATIONS})")
def q54(spark: SparkSession, d: str) -> DataFrame:
    """One page a run: the loop goes on without a pause while pages are left."""
    ingest, log, _ = _setup(spark, _answers(_nations(spark, d)), max_pages=1, merge_pages=1)
    slept: list[float] = []
    sync_loop(ingest, log, rounds=-(-len(_nations(spark, d)) // PAGE), sleep=slept.append)
    return _nation_rows(ingest).withColumn("sleeps", F.lit(len(slept)).cast("long"))


class _Service:
    """The service over HTTP on this machine; its first answers are errors, or no objects."""

    def __init__(self, answer: Callable[[str], dict[str, Any]], failures: int = 2) -> None:
        left = [failures]

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                body = answer(self.path)
                if left[0] > 0:
                    left[0] -= 1
                    body = ["no object"]
                data = json.dumps(body).encode()
                self.send_response(200 if left[0] != 1 else 503)
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            def log_message(self, *_: Any) -> None:
                """Nothing is printed."""

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def stop(self) -> None:
        self.server.shutdown()
        self.server.server_close()


@query("q55_stream_over_http", f"SELECT *, CAST((SELECT count(*) FROM nation) AS VARCHAR) AS cursor FROM ({NATIONS})")
def q55(spark: SparkSession, d: str) -> DataFrame:
    """The log read over HTTP by Structured Streaming, chunk by chunk, after answers that failed, past rows that none are accepted of."""
    rows = _nations(spark, d)
    # Pages of rows that nobody accepts stand between the others; their cursors count as any.
    plain = _answers(rows)

    def answer(url: str) -> dict[str, Any]:
        cursor = urllib.parse.parse_qs(urllib.parse.urlsplit(url).query).get("cursor", ["0"])[0]
        if cursor.endswith("-junk"):
            return plain(url.replace(cursor, cursor.removesuffix("-junk")))
        got = plain(url)
        if "schemas" not in got and cursor != "0":
            return {"values": [{"_id": "lost"}], "cursor": f"{cursor}-junk", "hasMore": True}
        return got

    service = _Service(answer)
    try:
        ingest, _, _ = _setup(spark, answer)
        sync_stream(ingest, {"url": service.url, "merge_pages": "1"}, f"{shared_dir(spark, 'checkpoint')}")
    finally:
        service.stop()
    return _nation_rows(ingest).withColumn("cursor", F.lit(CursorState(ingest.state).read()[0]))


@query(
    "q56_batch_scan_over_http",
    f"""SELECT 'nation' AS _table, CAST(n_nationkey AS VARCHAR) AS _id, CAST(n_nationkey + 1 AS BIGINT) AS _ts, n_regionkey = 0 AS _deleted, CAST(n_nationkey // {PAGE} + 1 AS BIGINT) AS page, CAST(n_nationkey AS BIGINT) AS seq FROM nation""",
)
def q56(spark: SparkSession, d: str) -> DataFrame:
    """All pages of the log as a batch source, over HTTP with retries."""
    service = _Service(_answers(_nations(spark, d)))
    try:
        register(spark)
        got = spark.read.format("pagedlog").options(url=service.url).load().select("_table", "_id", "_ts", "_deleted", F.col("__page").alias("page"), F.col("__seq").alias("seq"))
        found = got.collect()  # the service goes when this returns
    finally:
        service.stop()
    return _rows(spark, found, "_table string, _id string, _ts long, _deleted boolean, page long, seq long")


# -- state

@query(
    "q57_lease_outcomes",
    """SELECT * FROM (VALUES (1, 'a acquires', 'held'), (2, 'b acquires', 'refused'), (3, 'a renews', 'held'), (4, 'a verifies late', 'refused'), (5, 'b takes over', 'held'), (6, 'a renews', 'refused'), (7, 'a forces', 'held'), (8, 'b verifies', 'refused')) AS v(step, act, outcome)""",
)
def q57(spark: SparkSession, d: str) -> DataFrame:
    state, now = StateStore(spark, shared_dir(spark, "state")), [0.0]
    a, b = (Lease(state, "x", 10, lambda: now[0]) for _ in range(2))
    b.owner = "b"
    out = []
    for step, (act, at, do) in enumerate((("a acquires", 0, a.acquire), ("b acquires", 5, b.acquire), ("a renews", 6, a.heartbeat), ("a verifies late", 17, a.verify), ("b takes over", 17, b.acquire), ("a renews", 18, a.heartbeat), ("a forces", 19, lambda: a.acquire(force=True)), ("b verifies", 20, b.verify)), 1):
        now[0] = at
        try:
            do()
            out.append((step, act, "held"))
        except LeaseHeld:
            out.append((step, act, "refused"))
    return _rows(spark, out, "step int, act string, outcome string")


@query("q58_compare_and_swap", "SELECT n_nationkey AS step, n_nationkey % 3 <> 2 AS swapped FROM nation")
def q58(spark: SparkSession, d: str) -> DataFrame:
    """Every third writer has an old tag and loses."""
    state, out, tag, old = StateStore(spark, shared_dir(spark, "state")), [], None, None
    for k in range(table(spark, d, "nation").count()):
        try:
            new = state.swap("k", {"v": k}, tag if k % 3 != 2 else old)
            old, tag = tag, new
            out.append((k, True))
        except Conflict:
            out.append((k, False))
    return _rows(spark, out, "step int, swapped boolean")


# -- tables, layouts, maintenance

@query("q59_described_table", "SELECT * FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) AS v(place, name, kind)")
def q59(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark)
    store.overwrite("customer", table(spark, d, "customer"))
    return _rows(spark, [(i, n, k) for i, (n, k) in enumerate(store.describe("customer"))], "place int, name string, kind string")


@query("q60_table_lists", "SELECT * FROM (VALUES ('told', 'a'), ('told', 'b'), ('file', 'x'), ('file', 'z'), ('store', 'nation'), ('store', 'region')) AS v(source, table_name)")
def q60(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark)
    for t in ("region", "nation"):
        store.overwrite(t, table(spark, d, t))
    found = [("told", t) for t in table_list(store, "b, a,, a")] + [("file", t) for t in table_list(store, None, "# all\n\n z \nx\nz\n")] + [("store", t) for t in table_list(store)]
    return _rows(spark, found, "source string, table_name string")


@query("q61_deleted_keys", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'")
def q61(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark)
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("_id"), "c_custkey", "c_name")
    store.overwrite("customer", rows)
    store.delete_keys("customer", table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"), "c_custkey")
    return store.read("customer").select("c_custkey", "c_name")


@query("q62_versions_left", "SELECT * FROM (VALUES (3, 25, true), (4, 25, true), (5, 25, true)) AS v(version_number, n_rows, readable)")
def q62(spark: SparkSession, d: str) -> DataFrame:
    """Versions beyond the newest three go, and the data that only they named."""
    store = _store(spark)
    for _ in range(5):
        last = store.overwrite("nation", table(spark, d, "nation"))
    store.vacuum("nation", keep=3, older_than=0, now=last.created_at + 1)
    return _rows(spark, [(v, store.count("nation", v), store.read("nation", v).count() == 25) for v in store.versions("nation")], "version_number int, n_rows int, readable boolean")


@query(
    "q63_configured_layout",
    """SELECT * FROM (VALUES ('c_mktsegment', 'BITMAP', 'created'), ('c_name', 'BTREE', 'created'), ('gone', 'BTREE', 'missing column'), ('c_name', 'BTREE', 'extra'), ('c_mktsegment', 'BITMAP', 'extra'), ('', '', 'not applied'), ('', '', 'applied'), ('', '', 'unchanged')) AS v(name, kind, outcome)""",
)
def q63(spark: SparkSession, d: str) -> DataFrame:
    """A configuration that names an absent column is not taken as applied; one without it is, once."""
    store, state = _store(spark), StateStore(spark, shared_dir(spark, "state"))
    store.overwrite("customer", table(spark, d, "customer"))
    good = '[[indexes]]\ncolumn = "c_name"\n[[indexes]]\ncolumn = "c_mktsegment"\ntype = "bitmap"\n[[indexes]]\ncolumn = "c_name"\ntype = "BTREE"\n'
    first = apply_config(store, state, parse_config("customer", good + '[[indexes]]\ncolumn = "gone"\n'))
    system = {c for c, _ in jobs.DEFAULT_INDEXES}
    out = [(c, k, "created") for c, k in first["created"]] + [(c, "BTREE", why) for c, why in first["skipped"] if c not in system]
    out += [(c, k, "extra") for c, k in jobs.extra_indexes(store, "customer", [])]
    out += [("", "", "applied" if first["applied"] else "not applied")]
    plain = store.overwrite("keyed", event_log(spark, d).limit(10).withColumns({c: F.lit("x") for c in (*system, "c_name", "c_mktsegment")}))
    again = [apply_config(store, state, parse_config("keyed", good)) for _ in range(2)] if plain.rows else []
    out += [("", "", "applied" if a["applied"] else a["reason"]) for a in again]
    return _rows(spark, out, "name string, kind string, outcome string")


@query(
    "q64_maintenance_turns",
    """SELECT * FROM (VALUES (1, 'optimize_indices', 'a'), (2, 'compact_files', 'a'), (3, 'cleanup_old_versions', 'a'), (4, 'optimize_indices', 'b'), (5, 'compact_files', 'b'), (6, 'cleanup_old_versions', 'b'), (7, 'none', '')) AS v(step, act, table_name)""",
)
def q64(spark: SparkSession, d: str) -> DataFrame:
    """Idle passes inside the window, one unit of work each, until nothing is due."""
    store, state, done = _store(spark), StateStore(spark, shared_dir(spark, "state")), []
    for t in "ab":
        store.overwrite(t, table(spark, d, "region"))
    nine = 1_700_038_800.0  # 09:00 UTC
    for step in range(1, 8):
        worked = maintenance.idle_pass(store, state, maintenance.Plan(), {"rows_accepted": 0, "pages": 1}, clock=lambda: nine, run=lambda _, act, t, __: done.append((act, t)))
        if not worked:
            done.append(("none", ""))
    return _rows(spark, [(i + 1, a, t) for i, (a, t) in enumerate(done)], "step int, act string, table_name string")


@query("q65_optimised_after_merges", "SELECT * FROM (VALUES (1, true), (2, false), (3, true), (4, false)) AS v(step, worked)")
def q65(spark: SparkSession, d: str) -> DataFrame:
    """Tables that merges have touched are put in order again, and only those."""
    store, out = _store(spark), []
    rows = event_log(spark, d).where("_ts < 400").withColumn("__status", F.lit(1)).withColumn("__status_id", F.concat(F.lit("1#"), "_id")).withColumn("__id_ts", F.concat("_id", F.lit("#"), F.col("_ts").cast("string")))
    store.overwrite("log", rows)
    jobs.create_indexes(store, "log")
    for step in range(4):
        if step == 2:
            store.upsert("log", rows.where("_ts = 7").withColumn("value", F.lit(0.0)))
        out.append((step + 1, store.compact("log") is not None))
    return _rows(spark, out, "step int, worked boolean")


@query("q66_parallel_migrations", "SELECT 'customer' AS table_name, count(*) AS n_rows, true AS ok FROM customer UNION ALL SELECT 'part', count(*), true FROM part UNION ALL SELECT 'supplier', count(*), true FROM supplier UNION ALL SELECT 'wrong', 0, false")
def q66(spark: SparkSession, d: str) -> DataFrame:
    """Ordered migrations of three tables side by side; a failure does not stop the others."""
    store, keys = _store(spark), {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}

    def job(t: str) -> Callable[[], Any]:
        source = table(spark, d, t).select(F.col(keys[t]).cast("string").alias("_id"), F.col(keys[t]).alias("_ts"), F.lit(True).alias("_current"), F.lit(False).alias("_deleted"))
        return lambda: jobs.migrate_table(store, t, source, order_by="_ts")

    def wrong() -> None:
        raise ValueError("no such table")

    got = jobs.run_parallel(spark, {**{t: job(t) for t in keys}, "wrong": wrong}, 3)
    return _rows(spark, [(t, store.count(t) if r["ok"] else 0, r["ok"]) for t, r in got.items()], "table_name string, n_rows long, ok boolean")


# -- repair and text

_HIT = "coalesce(CASE WHEN json_valid(v) THEN json_type(CAST(v AS JSON)) = 'VARCHAR' ELSE false END, false)"


@query("q67_repair_applied", f"SELECT event_id, CASE WHEN {_HIT} THEN json_extract_string(v, '$') ELSE v END AS v, event_type, (SELECT count(*) FROM {_QUOTED_FROM} WHERE {_HIT}) AS candidates, true AS old_kept FROM {_QUOTED_FROM}")
def q67(spark: SparkSession, d: str) -> DataFrame:
    """A dry run counts and changes nothing; applying commits a version, and the one before stays."""
    store = _store(spark)
    store.overwrite("texts", _quoted(spark, d))
    dry = repair.repair(store, "texts", ["v"], limit=None)
    done = repair.repair(store, "texts", ["v"], apply=True)
    old = store.read("texts", done["restore_version"]).agg(repair.quoted_total(["v"])).first()[0]
    return store.read("texts").withColumn("candidates", F.lit(done["candidates"]).cast("long")).withColumn("old_kept", F.lit(dry["version"] == 1 and old == dry["candidates"] == done["candidates"]))


@query("q68_repairs_discovered", f"SELECT 'texts' AS table_name, 'v' AS name, count(*) AS quoted FROM {_QUOTED_FROM} WHERE {_HIT}")
def q68(spark: SparkSession, d: str) -> DataFrame:
    """Only text columns that the schema calls strings are looked at."""
    store = _store(spark)
    store.overwrite("texts", _quoted(spark, d))
    found = repair.discover(store, {"Texts": {"properties": {"v": STRING, "event_type": STRING, "event_id": STRING}}, "Other": {}}, limit=None)
    return _rows(spark, [(f["table"], c, n) for f in found for c, n in f["columns"].items()], "table_name string, name string, quoted long")


@query("q69_tight_literals", f"SELECT event_id, {_HIT} AND starts_with(v, '\"') AND ends_with(v, '\"') AS tight FROM {_QUOTED_FROM} WHERE v IS NOT NULL")
def q69(spark: SparkSession, d: str) -> DataFrame:
    return _quoted(spark, d).where("v is not null").select("event_id", is_quoted(F.col("v"), tight=True).alias("tight"))


@query(
    "q70_names_of_files_and_tables",
    r"""SELECT DISTINCT p_type || '/' || p_brand AS told, substr(regexp_replace(p_type || '/' || p_brand, '[^A-Za-z0-9._-]', '_', 'g'), 1, 80) AS stem,
  lower(regexp_replace(p_type || '/' || p_brand, '[^A-Za-z0-9]', '_', 'g')) AS physical FROM part""",
)
def q70(spark: SparkSession, d: str) -> DataFrame:
    told = [r[0] for r in table(spark, d, "part").select(F.concat_ws("/", "p_type", "p_brand")).distinct().collect()]  # a few hundred names
    return _rows(spark, [(t, file_stem(t), physical_name(t)) for t in told], "told string, stem string, physical string")


@query("q71_configuration_version", "SELECT r_name AS told, 'sha256:' || sha256('[[indexes]]' || chr(10) || 'column = \"' || lower(r_name) || '\"' || chr(10)) AS version_hash FROM region WHERE r_name NOT LIKE '% %'")
def q71(spark: SparkSession, d: str) -> DataFrame:
    names = [r[0] for r in table(spark, d, "region").where("r_name not like '% %'").select("r_name").collect()]
    return _rows(spark, [(n, parse_config("t", f'[[indexes]]\ncolumn = "{n.lower()}"\n').version) for n in names], "told string, version_hash string")


@query("q72_empty_column_takes_any_type", "SELECT c_custkey, CAST(NULL AS DOUBLE) AS note, true AS kept FROM customer")
def q72(spark: SparkSession, d: str) -> DataFrame:
    """A column without a value changes its type, as nothing can be lost."""
    store = _store(spark)
    rows = table(spark, d, "customer").select("c_custkey", F.lit(None).cast("string").alias("note"))
    store.overwrite("customer", rows, StructType([rows.schema["c_custkey"], StructField("note", StringType(), True)]))
    reconcile(store, "customer", {"properties": {"note": NUMBER}})
    return store.read("customer").select("c_custkey", "note", F.lit(store.count("customer") == store.count("customer", 1)).alias("kept"))


# -- lookups

@query("q73_label_table_lookup", "SELECT doc_id, lang FROM documents WHERE list_has_any(string_split(text, ' '), ['the', 'der'])")
def q73(spark: SparkSession, d: str) -> DataFrame:
    """Rows by labels through the table of labels beside the data."""
    store = _store(spark, 8)
    store.overwrite("documents", table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("_id"), "doc_id", "lang", F.split("text", " ").alias("labels")))
    jobs.create_indexes(store, "documents", [("labels", "LABEL_LIST")])
    store.compact("documents")
    return jobs.lookup_labels(store, "documents", "labels", ["the", "der"]).select("doc_id", "lang")


@query("q74_key_lookup", "SELECT _id, _ts, value FROM (SELECT CAST(user_id AS VARCHAR) AS _id, event_id AS _ts, value FROM events) WHERE _ts IN (1, 77, 400, 999)")
def q74(spark: SparkSession, d: str) -> DataFrame:
    """Versions by their keys: only the keys' buckets are read."""
    store, log = _store(spark, 8), event_log(spark, d)
    rows = log.withColumn("__id_ts", F.concat("_id", F.lit("#"), F.col("_ts").cast("string")))
    store.overwrite("log", rows)
    wanted = [r[0] for r in rows.where("_ts in (1, 77, 400, 999)").select("__id_ts").collect()]
    return jobs.lookup_keys(store, "log", [*wanted, "none#1"]).select("_id", "_ts", "value")
