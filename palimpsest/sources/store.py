"""Versioned tables: immutable Parquet files, and numbered manifests that say which of them make up a version.

A commit is the exclusive creation of the next manifest, so readers see whole versions, a table can be
overwritten from itself, and a failed job leaves nothing but files that no manifest names. Rows are dealt to buckets by a hash
of ``_id``: all versions of an id share a bucket, and an upsert rewrites the buckets that its batch touches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from palimpsest.functions.keys import ID_TS
from palimpsest.functions.naming import physical_name, quoted
from palimpsest.plans.schema import signature, widens
from palimpsest.sources.files import Files

BUCKET = "__bucket"


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: StructType
    entries: tuple[dict[str, Any], ...]
    rows: int
    buckets: int
    operation: str
    layout: dict[str, Any] = field(default_factory=dict)
    created_at: float = 0.0

    def dump(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue(), "entries": list(self.entries)})

    @staticmethod
    def load(d: dict[str, Any]) -> Manifest:
        return Manifest(**{**d, "schema": StructType.fromJson(d["schema"]), "entries": tuple(d["entries"])})


class VersionedStore:
    """Tables below one root."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16) -> None:
        self.spark, self.root, self.default_buckets = spark, root.rstrip("/"), buckets
        self.files = Files(spark)

    # -- manifests

    def _dir(self, table: str) -> str:
        return f"{self.root}/{physical_name(table)}"

    def versions(self, table: str) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self._dir(table)}/_versions") if n.endswith(".json")]

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def tables(self) -> list[str]:
        return [n for n in self.files.names(self.root) if self.versions(n)]

    def manifest(self, table: str, version: int | None = None) -> Manifest:
        """A version's manifest; without a number the newest that was written whole."""
        have = self.versions(table)
        if not have or version is not None and version not in have:
            raise LookupError(f"no table {table!r}" if not have else f"no version {version} of {table!r}")
        wanted = have if version is None else [version]
        _, found = self.files.newest_json(f"{self._dir(table)}/_versions", [f"{v:08d}.json" for v in wanted])
        if found is None:
            raise LookupError(f"no whole version of {table!r}")
        return Manifest.load(found)

    def _commit(self, table: str, base: Manifest | None, **changes: Any) -> Manifest:
        """The next version, above any that a dead writer left torn; any whole version after ``base`` is a conflict."""
        have = [v for v in self.versions(table) if v > (base.version if base else 0)]
        if have and self.manifest(table).version > (base.version if base else 0):
            raise CommitConflict(f"{table}: version {have[0]} is taken")
        version = max([base.version if base else 0, *have]) + 1
        made = replace(base, **changes) if base else Manifest(**{"version": 1, "entries": (), "rows": 0, **changes})
        made = replace(made, version=version, created_at=time.time())
        if not self.files.create(f"{self._dir(table)}/_versions/{version:08d}.json", made.dump()):
            raise CommitConflict(f"{table}: version {version} is taken")
        return made

    # -- reading

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A version of a table, the newest by default, with the columns and types of its manifest."""
        m = self.manifest(table, version)
        return self._rows(m, m.entries)

    def _rows(self, m: Manifest, entries: Sequence[dict[str, Any]]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], _nullable(m.schema))
        return self.spark.read.schema(_nullable(m.schema)).parquet(*[e["path"] for e in entries])

    def schema(self, table: str) -> StructType:
        return self.manifest(table).schema

    def describe(self, table: str) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in self.schema(table)]

    def count(self, table: str, version: int | None = None) -> int:
        """Rows, from the manifest alone."""
        return self.manifest(table, version).rows

    # -- writing

    def _bucket(self, schema: StructType, buckets: int) -> Column:
        return F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int") if "_id" in schema.names else F.lit(0)

    def _write(self, table: str, df: DataFrame, buckets: int) -> list[dict[str, Any]]:
        path = f"{self._dir(table)}/data/{uuid.uuid4().hex}"
        bucket = self._bucket(df.schema, buckets)
        # A bucket's rows meet in one task; AQE may split a bucket that is far larger than others.
        dealt = df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET) if "_id" in df.columns else df.withColumn(BUCKET, bucket)
        dealt.write.partitionBy(BUCKET).parquet(path)
        return self._entries(path)

    def _entries(self, path: str) -> list[dict[str, Any]]:
        """Buckets of a data folder and their rows, which the files' footers tell."""
        if not any(n.startswith(f"{BUCKET}=") for n in self.files.names(path)):
            return []
        rows = self.spark.read.schema(f"{BUCKET} int").parquet(path).groupBy(BUCKET).count().collect()
        return [{"path": f"{path}/{BUCKET}={b}", "bucket": b, "rows": n} for b, n in sorted(map(tuple, rows))]

    def create(self, table: str, schema: StructType, buckets: int | None = None, layout: dict[str, Any] | None = None) -> Manifest:
        """An empty table."""
        return self._commit(table, None, schema=schema, buckets=buckets or self.default_buckets, operation="create", layout=layout or {})

    def overwrite(self, table: str, df: DataFrame, schema: StructType | None = None, operation: str = "overwrite", check: Callable[[int, StructType], None] | None = None) -> Manifest:
        """A new version of exactly these rows; ``check`` sees their number and schema before the commit."""
        base = self.manifest(table) if self.exists(table) else None
        buckets = base.buckets if base else self.default_buckets
        schema = schema or df.schema
        entries = self._write(table, df.select(*[F.col(quoted(f.name)).cast(f.dataType) for f in schema]), buckets)
        rows = sum(e["rows"] for e in entries)
        if check:
            check(rows, schema)
        return self._commit(table, base, schema=schema, entries=tuple(entries), rows=rows, buckets=buckets, operation=operation)

    def append(self, table: str, df: DataFrame) -> Manifest:
        """The version's files and those of ``df``, whose columns must all be known; absent ones are null."""
        base = self.manifest(table)
        entries = self._write(table, self.aligned(df, base.schema), base.buckets)
        return self._commit(table, base, entries=(*base.entries, *entries), rows=base.rows + sum(e["rows"] for e in entries), operation="append")

    def aligned(self, df: DataFrame, schema: StructType) -> DataFrame:
        if extra := [c for c in df.columns if c not in schema.names]:
            raise ValueError(f"columns are not in the table: {', '.join(extra)}")
        return df.select(*[(F.col(quoted(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def touched(self, table: str, ids: DataFrame) -> set[int]:
        """Buckets of the ids; at most as many numbers as there are buckets come to the driver."""
        m = self.manifest(table)
        return {r[0] for r in ids.select(self._bucket(m.schema, m.buckets).alias("b")).distinct().collect()}

    def read_buckets(self, table: str, buckets: set[int]) -> DataFrame:
        m = self.manifest(table)
        return self._rows(m, [e for e in m.entries if e["bucket"] in buckets])

    def read_labelled(self, table: str, column: str, labels: Sequence[str]) -> DataFrame:
        """Rows of the entries that can hold a label in an array column: those whose table of labels says so, and those that have none."""
        m = self.manifest(table)
        told = {e["labels"][column] for e in m.entries if column in e.get("labels", {})}
        # At most as many numbers as there are buckets come to the driver.
        hit = {p: {r[0] for r in self.spark.read.parquet(p).where(F.col("label").isin(list(labels))).select(BUCKET).distinct().collect()} for p in told}
        return self._rows(m, [e for e in m.entries if column not in e.get("labels", {}) or e["bucket"] in hit[e["labels"][column]]])

    def upsert(self, table: str, rows: DataFrame, key: str = ID_TS, buckets: set[int] | None = None) -> Manifest:
        """Rows of ``rows`` replace those with an equal ``key`` and join the others; every column is replaced.

        Keys must be unique in ``rows``, and equal keys have equal ``_id``.
        """
        base = self.manifest(table)
        rows = self.aligned(rows, base.schema)
        hit = self.touched(table, rows) if buckets is None else buckets
        old = [e for e in base.entries if e["bucket"] in hit]
        if not old:  # nothing that could match
            return self.append(table, rows) if hit else base
        kept = self._rows(base, old).join(rows.select("_id", key), ["_id", key], "left_anti").select(*[quoted(c) for c in base.schema.names])
        entries = self._write(table, kept.unionByName(rows), base.buckets)
        rest = [e for e in base.entries if e["bucket"] not in hit]
        return self._commit(table, base, entries=(*rest, *entries), rows=sum(e["rows"] for e in [*rest, *entries]), operation="upsert")

    def delete_where(self, table: str, predicate: Column | str) -> Manifest:
        """A version without the rows for which the predicate is true; buckets without such a row keep their files."""
        p = F.expr(predicate) if isinstance(predicate, str) else predicate
        return self._delete(table, lambda rows: rows.where(p), lambda rows: rows.where(~F.coalesce(p, F.lit(False))))

    def delete_keys(self, table: str, keys: DataFrame, key: str = ID_TS) -> Manifest:
        """A version without the rows whose ``key`` is among those of ``keys``."""
        keys = keys.select(key).distinct()
        return self._delete(table, lambda rows: rows.join(keys, key, "left_semi"), lambda rows: rows.join(keys, key, "left_anti"))

    def _delete(self, table: str, gone: Callable[[DataFrame], DataFrame], left: Callable[[DataFrame], DataFrame]) -> Manifest:
        base = self.manifest(table)
        hit: set[int] = set()
        if base.entries:
            # The files' own folders tell the buckets: at most as many numbers as there are buckets come to the driver.
            bucket = F.regexp_extract("_metadata.file_path", f"{BUCKET}(?:=|%3D)([0-9]+)", 1).cast("int")
            hit = {r[0] for r in gone(self._rows(base, base.entries).withColumn(BUCKET, bucket)).select(BUCKET).distinct().collect()}
        old = [e for e in base.entries if e["bucket"] in hit]
        kept = left(self._rows(base, old)).select(*[quoted(c) for c in base.schema.names])
        entries = [e for e in base.entries if e["bucket"] not in hit] + (self._write(table, kept, base.buckets) if old else [])
        return self._commit(table, base, entries=tuple(entries), rows=sum(e["rows"] for e in entries), operation="delete")

    def recreate_empty(self, table: str, schema: StructType) -> Manifest:
        """An empty version; the older ones stay."""
        return self._commit(table, self.manifest(table), schema=schema, entries=(), rows=0, operation="recreate")

    # -- schema and layout: manifests alone

    def add_columns(self, table: str, fields: Sequence[StructField]) -> Manifest:
        """New columns, null in the rows that are there, whatever the field says."""
        base = self.manifest(table)
        new = [StructField(f.name, f.dataType, True, f.metadata) for f in fields if f.name not in base.schema.names]
        return self._commit(table, base, schema=StructType([*base.schema.fields, *new]), operation="add_columns") if new else base

    def widen_columns(self, table: str, kinds: dict[str, DataType]) -> Manifest:
        base = self.manifest(table)
        for name, kind in kinds.items():
            if not widens(base.schema[name].dataType, kind):
                raise ValueError(f"{name}: {base.schema[name].dataType.simpleString()} does not widen to {kind.simpleString()}")
        fields = [StructField(f.name, kinds.get(f.name, f.dataType), f.nullable, f.metadata) for f in base.schema]
        return self._commit(table, base, schema=StructType(fields), operation="widen_columns")

    def set_layout(self, table: str, layout: dict[str, Any]) -> Manifest:
        base = self.manifest(table)
        return self._commit(table, base, layout={**base.layout, **layout}, operation="layout")

    def same_schema(self, table: str, a: int, b: int) -> bool:
        return signature(self.manifest(table, a).schema) == signature(self.manifest(table, b).schema)

    # -- maintenance

    def restore(self, table: str, version: int) -> Manifest:
        """The old version once more, as the newest."""
        old, now = self.manifest(table, version), self.manifest(table)
        return self._commit(table, now, schema=old.schema, entries=old.entries, rows=old.rows, buckets=old.buckets, layout=old.layout, operation=f"restore {version}")

    def compact(self, table: str, sort_by: Sequence[str] = ()) -> Manifest | None:
        """One run of files per bucket, rows in order of ``sort_by``; None if it already is so."""
        base = self.manifest(table)
        wanted = list(sort_by) or base.layout.get("sort_by", [])
        runs = Counter(e["bucket"] for e in base.entries)
        # Each entry tells the order of its rows: what was merged or appended since is not in order.
        several = {e["bucket"] for e in base.entries if runs[e["bucket"]] > 1 or wanted and e.get("sorted_by", []) != wanted or set(base.layout.get("labels", [])) - set(e.get("labels", {}))}
        if not several:
            return None
        rows = self._rows(base, [e for e in base.entries if e["bucket"] in several])
        path = f"{self._dir(table)}/data/{uuid.uuid4().hex}"
        dealt = rows.withColumn(BUCKET, self._bucket(base.schema, base.buckets)).hint("rebalance", BUCKET)
        writer = dealt.sortWithinPartitions(BUCKET, *[quoted(c) for c in wanted]).write.partitionBy(BUCKET)
        for c in base.layout.get("bloom", []):
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(path)
        entries = [{**e, "sorted_by": wanted} for e in self._entries(path)]
        for c in base.layout.get("labels", []):
            # Beside the data: which buckets hold a label. It goes with the data's folder.
            labels = self.spark.read.parquet(path).select(BUCKET, F.explode(quoted(c)).alias("label")).distinct()
            labels.repartitionByRange("label").sortWithinPartitions("label").write.parquet(f"{path}/_labels/{c}")
            entries = [{**e, "labels": {**e.get("labels", {}), c: f"{path}/_labels/{c}"}} for e in entries]
        rest = [e for e in base.entries if e["bucket"] not in several]
        return self._commit(table, base, entries=(*rest, *entries), operation="compact")

    def vacuum(self, table: str, keep: int = 500, older_than: float = 259_200, now: float | None = None) -> list[int]:
        """Drop versions beyond the newest ``keep`` that are older than so many seconds, and the data that no version left names.

        That is the data of the versions dropped, and what failed jobs left so many seconds ago.
        """
        now = time.time() if now is None else now
        at = self._dir(table)
        known: dict[int, Manifest] = {}
        for v in self.versions(table):
            try:
                known[v] = self.manifest(table, v)
            except LookupError:  # torn: it names nothing
                self.files.delete(f"{at}/_versions/{v:08d}.json")
        have = list(known)
        gone = [v for v in have[:-keep] if now - known[v].created_at > older_than] if keep > 0 else []
        folders = lambda versions: {e["path"].rsplit("/", 2)[-2] for v in versions for e in known[v].entries}
        left = folders(set(have) - set(gone))
        dead = folders(gone) - left
        for d in set(self.files.names(f"{at}/data")) - left - dead:
            if self.files.age(f"{at}/data/{d}", now) > older_than:
                dead.add(d)
        for v in gone:
            self.files.delete(f"{at}/_versions/{v:08d}.json")
        for d in sorted(dead):
            self.files.delete(f"{at}/data/{d}")
        return gone


def _nullable(schema: StructType) -> StructType:
    """Parquet reads are nullable in every column; the manifest keeps what is required."""
    return StructType([StructField(f.name, f.dataType if not isinstance(f.dataType, ArrayType) else ArrayType(f.dataType.elementType, True), True) for f in schema])
