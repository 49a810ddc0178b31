"""The incremental merge: a batch of versions against the current rows of a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.functions.keys import GENERATED, ID_TS, with_generated
from palimpsest.functions.naming import quoted
from palimpsest.operators.versions import current_of, version_history
from palimpsest.plans.schema import SYSTEM, ColumnSpec, struct_of
from palimpsest.sources.store import Manifest, VersionedStore

#: Fields of a delta that a table may lack without harm.
DROPPABLE = frozenset({"_component"})


class MissingColumns(ValueError):
    """A batch has fields that the table does not know."""

    def __init__(self, table: str, columns: Iterable[str]) -> None:
        self.table, self.columns = table, tuple(sorted(columns))
        super().__init__(f"{table} lacks columns of the batch: {', '.join(self.columns)}")


def plan_merge(incoming: DataFrame, existing: DataFrame, seq: str | None = None) -> DataFrame:
    """The rows to upsert: each incoming version, and each current version that one of them displaces.

    ``existing``: current rows (other rows and ids do no harm to ids that are not in the batch). An incoming version becomes current
    if it is the latest of its id in the batch and not older than the existing current one; older ones join the history. A
    displaced version keeps its payload and loses its bit. Of equal ``(_id, _ts)`` the last arrival stays, and an incoming row
    before a displaced one. Both sides are dealt by ``_id`` once; windows do the rest, there is no join.
    """
    columns = [c for c in incoming.columns if c not in (*GENERATED, "_current", seq)]
    new = incoming.select(*[quoted(c) for c in columns], (F.col(quoted(seq)) if seq else F.lit(0)).cast("long").alias("__seq"), F.lit(1).alias("__new"))
    old_columns = [c for c in existing.columns if c not in (*GENERATED, "_current")]
    old = existing.select(*[quoted(c) for c in old_columns], F.lit(0).cast("long").alias("__seq"), F.lit(0).alias("__new"))
    rows = new.unionByName(old, allowMissingColumns=True).withColumn("_deleted", F.coalesce("_deleted", F.lit(False)))
    by_id = Window.partitionBy("_id")
    rows = rows.withColumn("__newest", F.max(F.when(F.col("__new") == 1, F.col("_ts"))).over(by_id)).withColumn("__stood", F.max(F.when(F.col("__new") == 0, F.col("_ts"))).over(by_id))
    takes = F.col("__newest").isNotNull() & (F.col("__stood").isNull() | (F.col("__newest") >= F.col("__stood")))
    # The incoming row of a key is kept rather than the displaced one, and the last arrival of those.
    payload = F.xxhash64(*[F.col(quoted(c)) for c in columns])
    order = Window.partitionBy("_id", "_ts").orderBy(F.desc("__new"), F.desc("__seq"), payload.desc())
    rows = rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") == 1)
    rows = rows.where((F.col("__new") == 1) | takes)
    current_ = (F.col("__new") == 1) & takes & (F.col("_ts") == F.col("__newest"))
    out = rows.withColumn("_current", current_).drop("__seq", "__new", "__newest", "__stood", "__n")
    return with_generated(out).drop("_current")


def fold(batches: Iterable[DataFrame], target: DataFrame | None = None, seq: str | None = None) -> DataFrame | None:
    """Batches merged one after another, without a store; for short folds and tests."""
    for batch in batches:
        if target is None:
            target = version_history(batch, seq)
            target = target.drop(seq) if seq else target
            continue
        existing = current_of(target, batch)
        rows = plan_merge(batch, existing, seq)
        kept = target.join(rows.select("_id", ID_TS), ["_id", ID_TS], "left_anti").select(*[quoted(c) for c in target.columns])
        target = kept.unionByName(rows, allowMissingColumns=True)
    return target


def demoted(rows: DataFrame, incoming: DataFrame) -> DataFrame:
    """Of merge rows those that the batch has displaced."""
    return rows.join(incoming.select("_id", "_ts").distinct(), ["_id", "_ts"], "left_anti")


def check_columns(table: str, have: Iterable[str], observed: Iterable[str]) -> list[str]:
    """Fields that may be dropped; fields that the table lacks raise."""
    unknown = set(observed) - set(have) - {"_current"}
    if lost := unknown - DROPPABLE:
        raise MissingColumns(table, lost)
    return sorted(unknown & DROPPABLE)


def null_counts(df: DataFrame, schema: StructType) -> DataFrame:
    """One row: the nulls of each required column."""
    required = [f.name for f in schema if not f.nullable]
    return df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in required]) if required else df.agg(F.count("*").alias("__rows"))


def with_null_guard(df: DataFrame, schema: StructType) -> DataFrame:
    """``df``, whose job fails as soon as a required column is null; no extra pass over the rows."""
    out = df
    for f in schema:
        if not f.nullable and f.name in df.columns:
            c = F.col(quoted(f.name))
            out = out.withColumn(f.name, F.when(c.isNull(), F.raise_error(F.lit(f"required column {f.name} is null")).cast(f.dataType)).otherwise(c))
    return out


def merge_into(store: VersionedStore, table: str, incoming: DataFrame, seq: str | None = None) -> Manifest:
    """Merge a batch into a table of the store: buckets without an id of the batch are not read or written."""
    schema = store.schema(table)
    check_columns(table, [*schema.names, *([seq] if seq else [])], incoming.columns)
    # The batch is read for its buckets, for its ids and for its rows.
    batch = incoming.drop(*[c for c in incoming.columns if c not in schema.names and c != seq]).persist()
    try:
        buckets = store.touched(table, batch)
        if not buckets:
            return store.manifest(table)
        existing = current_of(store.read_buckets(table, buckets), batch)
        rows = store.aligned(plan_merge(batch, existing, seq), schema)
        return store.upsert(table, with_null_guard(rows, schema), ID_TS, buckets)
    finally:
        batch.unpersist()


def empty_table_schema(app: Iterable[ColumnSpec] = ()) -> StructType:
    return struct_of([*SYSTEM, *app])

