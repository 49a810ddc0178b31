"""Batch jobs: snapshot migration, generated columns, dropping the legacy flag, layouts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.keys import GENERATED, ID_TS, require_inputs, with_generated
from palimpsest.functions.naming import quoted, require_identifier
from palimpsest.sources.store import Manifest, VersionedStore

INDEX_TYPES = ("BTREE", "BITMAP", "LABEL_LIST")
#: Layout of a table's generated columns.
DEFAULT_INDEXES = (("__id_ts", "BTREE"), ("__status_id", "BTREE"), ("__status", "BITMAP"))


class CountMismatch(RuntimeError):
    pass


def migration_query(source: DataFrame, where: str | None = None, order_by: str | None = None, limit: int | None = None) -> DataFrame:
    """Base columns in their order, without ``_current``, and the generated ones; filter, total order and limit as Spark SQL text.

    ``order_by``: a comma-separated list as after ORDER BY; nulls come last unless it says otherwise.
    """
    require_inputs(source)
    rows = source.where(F.expr(where)) if where else source
    base = [quoted(c) for c in rows.columns if c not in (*GENERATED, "_current")]
    rows = rows.select(*base, F.col("_current"))
    out = with_generated(rows)
    if order_by:
        # Jobs of other threads share the session, so a view's name is never used twice.
        view = f"__migration_{uuid.uuid4().hex}"
        parts = [p if "nulls" in p.lower() else f"{p} NULLS LAST" for p in _split(order_by)]
        out.createTempView(view)
        try:
            out = source.sparkSession.sql(f"SELECT * FROM {view} ORDER BY {', '.join(parts)}")
        finally:
            source.sparkSession.catalog.dropTempView(view)
    return (out.limit(limit) if limit is not None else out).drop("_current")


def _split(text: str) -> list[str]:
    """Cut at commas outside parentheses and quotes."""
    out, depth, quote, part = [], 0, "", ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        depth += (c == "(") - (c == ")") if not quote else 0
        if c == "," and not depth and not quote:
            out.append(part.strip())
            part = ""
        else:
            part += c
    return [*out, part.strip()]


def migrate_table(store: VersionedStore, table: str, source: DataFrame, mode: str = "overwrite", where: str | None = None, order_by: str | None = None, limit: int | None = None, verify: bool = True) -> dict[str, Any]:
    """Write the migration query as a new version and compare the rows it gave with the rows that arrived."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode: {mode}")
    seen = Observation()
    query = migration_query(source, where, order_by, limit).observe(seen, F.count(F.lit(1)).alias("rows"))
    before = store.count(table) if mode == "append" and store.exists(table) else 0
    if mode == "append" and store.exists(table):
        done = store.append(table, query)
    else:
        done = store.overwrite(table, query, operation="migrate")
    arrived = done.rows - before
    expected = seen.get["rows"] if verify else None
    if verify and arrived != expected:
        # Tasks that ran again are observed again; a recount decides.
        expected = migration_query(source, where, order_by, limit).count()
        if arrived != expected:
            raise CountMismatch(f"{table}: source {expected}, target {arrived}")
    create_indexes(store, table)
    return {"table": table, "source_rows": expected, "target_rows": arrived, "version": done.version}


def backfill_generated(store: VersionedStore, table: str, force: bool = False) -> Manifest | None:
    """Add (or with ``force`` renew) the generated columns; ``_current`` stays. None if there is nothing to do."""
    df = store.read(table)
    require_inputs(df)
    if not force and set(GENERATED) <= set(df.columns):
        return None
    rows = store.count(table)
    return store.overwrite(table, with_generated(df), operation="backfill", check=_rows_stay(table, rows))


def drop_legacy_current(store: VersionedStore, table: str) -> Manifest | None:
    """Drop ``_current`` once the generated columns are there; None if it is gone already."""
    df, schema = store.read(table), store.schema(table)
    if "_current" not in df.columns:
        return None
    if gone := [c for c in GENERATED if c not in df.columns]:
        raise ValueError(f"{table} lacks {', '.join(gone)}: backfill first")
    kept = type(schema)([f for f in schema if f.name != "_current"])
    return store.overwrite(table, df.drop("_current"), kept, "drop_current", _rows_stay(table, store.count(table)))


def _rows_stay(table: str, rows: int) -> Callable:
    def check(n: int, _: Any) -> None:
        if n != rows:
            raise CountMismatch(f"{table}: {rows} rows before, {n} after")

    return check


def create_indexes(store: VersionedStore, table: str, indexes: Sequence[tuple[str, str]] = DEFAULT_INDEXES) -> dict[str, list]:
    """Lay a table out for lookups by the given columns.

    BTREE columns order the rows inside each file, so that a scan skips row groups by their bounds, and have bloom filters; BITMAP columns have few values, for which
    Parquet dictionaries do; LABEL_LIST columns have a table of labels beside the data that tells the buckets which hold them. The layout is recorded in the
    manifest and applied by compaction.
    """
    have = store.manifest(table)
    done = {tuple(x) for x in have.layout.get("indexes", [])}
    created, skipped = [], []
    for column, kind in indexes:
        if kind not in INDEX_TYPES:
            raise ValueError(f"index type: {kind}")
        require_identifier(column)
        if column not in have.schema.names:
            skipped.append((column, "missing column"))
        elif (column, kind) in done:
            skipped.append((column, "exists"))
        else:
            created.append((column, kind))
    if created:
        every = [*done, *created]
        order = [c for c, k in every if k == "BITMAP"] + [c for c, k in every if k == "BTREE"]
        keyed = {"bloom": sorted({c for c, k in every if k == "BTREE"}), "labels": sorted({c for c, k in every if k == "LABEL_LIST"})}
        store.set_layout(table, {"indexes": sorted(every), "sort_by": sorted(set(order), key=order.index), **keyed})
    return {"created": created, "skipped": skipped}


def extra_indexes(store: VersionedStore, table: str, wanted: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Recorded layouts that nobody asked for; they are told, not dropped."""
    return sorted({tuple(x) for x in store.manifest(table).layout.get("indexes", [])} - set(wanted) - set(DEFAULT_INDEXES))


def label_lookup(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Rows whose array holds one of the labels."""
    return df.where(F.arrays_overlap(F.col(quoted(column)), F.array(*[F.lit(x) for x in labels])))


def lookup_labels(store: VersionedStore, table: str, column: str, labels: Sequence[str]) -> DataFrame:
    """Rows of a table whose array holds one of the labels; of buckets in order only those that the table of labels names are read."""
    return label_lookup(store.read_labelled(table, column, labels), column, labels)


def lookup_keys(store: VersionedStore, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows by their ``__id_ts``: the ids in front tell the buckets, the rest is a pushed filter."""
    ids = store.spark.createDataFrame([(k.rpartition("#")[0],) for k in keys], "_id string")
    return store.read_buckets(table, store.touched(table, ids)).where(F.col(ID_TS).isin(list(keys)))


def run_parallel(spark: SparkSession, jobs: dict[str, Callable[[], Any]], concurrency: int = 4, stop_on_failure: bool = False) -> dict[str, dict[str, Any]]:
    """One job per table on driver threads, whose Spark jobs share the cluster; after a failure pending ones may be left out."""
    out: dict[str, dict[str, Any]] = {}

    def one(name: str) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"table-{name}")
        return jobs[name]()

    waiting = list(jobs)
    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        running = {}
        while waiting or running:
            while waiting and len(running) < max(1, concurrency):
                name = waiting.pop(0)
                running[pool.submit(one, name)] = name
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for f in done:
                name = running.pop(f)
                error = f.exception()
                out[name] = {"ok": error is None, "error": str(error) if error else None, "result": None if error else f.result()}
                if error and stop_on_failure:
                    out |= {n: {"ok": False, "error": "not started", "result": None} for n in waiting}
                    waiting = []
    return out
