"""JSON strings that were stored with their quotes: discovery and repair."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from palimpsest.functions.jsontext import is_quoted, repaired
from palimpsest.functions.naming import physical_name, quoted
from palimpsest.plans.schema import JsonSchema, signature, table_specs
from palimpsest.sources.store import VersionedStore


class RepairRefused(ValueError):
    pass


def repaired_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the named columns repaired; the others and their order stay."""
    return df.select(*[repaired(F.col(quoted(c))).alias(c) if c in columns else F.col(quoted(c)) for c in df.columns])


def quoted_counts(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """One row: quoted values of each column, in one scan; ``limit`` looks at any so many rows."""
    rows = df.select(*[quoted(c) for c in columns])
    rows = rows.limit(limit) if limit else rows
    return rows.agg(*[F.count_if(is_quoted(F.col(quoted(c)))).alias(c) for c in columns])


def quoted_total(columns: Sequence[str]) -> Column:
    return F.coalesce(sum((F.count_if(is_quoted(F.col(quoted(c)))) for c in columns), F.lit(0)), F.lit(0))


def string_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, StringType)]


def check_columns(schema: StructType, columns: Sequence[str]) -> None:
    unknown = [c for c in columns if c not in schema.names]
    other = [c for c in columns if c in schema.names and c not in string_columns(schema)]
    if unknown or other or not columns:
        raise RepairRefused(f"cannot repair: unknown {unknown}, no text {other}, {len(columns)} columns")


def discover(store: VersionedStore, payload: dict[str, JsonSchema], tables: Sequence[str] = (), limit: int | None = 10_000) -> list[dict[str, Any]]:
    """Tables and columns with quoted values, where the JSON schema says string and the stored column is text."""
    sources = {physical_name(s): s for s in payload}
    out = []
    for table in tables or store.tables():
        source = sources.get(physical_name(table))
        if source is None or not store.exists(table):
            continue
        text = set(string_columns(store.schema(table)))
        columns = [s.name for s in table_specs(payload[source]) if s.kind == "string" and s.name in text and not s.name.startswith("_")]
        if not columns:
            continue
        counts = quoted_counts(store.read(table), columns, limit).first().asDict()
        checked = min(limit or store.count(table), store.count(table)) * len(columns)
        found = {c: n for c, n in counts.items() if n}
        out.append({"table": table, "columns": found, "checked": checked, "candidates": sum(found.values())})
    return out


def repair(store: VersionedStore, table: str, columns: Sequence[str], apply: bool = False, limit: int | None = 1_000) -> dict[str, Any]:
    """Count candidates, and with ``apply`` commit a repaired version; a failed check leaves the table as it was."""
    before = store.manifest(table)
    check_columns(before.schema, columns)
    rows = store.read(table)
    counted = (rows.limit(limit) if limit and not apply else rows).agg(quoted_total(columns).alias("n")).first()["n"]
    report = {"table": table, "columns": list(columns), "candidates": counted, "applied": False, "version": before.version}
    if not apply or not counted:
        return report

    def same(n: int, schema: StructType) -> None:
        if n != before.rows or signature(schema) != signature(before.schema):
            raise RepairRefused(f"{table}: rows or schema would change")

    done = store.overwrite(table, repaired_columns(rows, columns), before.schema, "repair", same)
    return report | {"applied": True, "version": done.version, "restore_version": before.version}
