"""Schema evolution of stored tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from palimpsest.functions.coerce import coerced
from palimpsest.functions.naming import physical_name, physical_names, quoted
from palimpsest.plans.schema import ColumnSpec, JsonSchema, compatible, struct_of, table_specs, widens
from palimpsest.sources.store import VersionedStore

POLICIES = ("fail", "create", "skip")


class UnknownTable(LookupError):
    pass


class SchemaDrift(ValueError):
    """Stored and wanted types differ in a way that is not allowed to be repaired."""


@dataclass
class Reconciled:
    table: str
    specs: list[ColumnSpec]
    actions: list[dict[str, Any]] = field(default_factory=list)
    skipped: bool = False


def coerce_columns(store: VersionedStore, table: str, wanted: dict[str, ColumnSpec]) -> dict[str, dict[str, int]]:
    """Rewrite columns to other kinds as a new version.

    Refuses if a column that has values would have none left. Counts of values before and after come from the same
    single aggregate for all columns; the guard on row counts is part of the commit.
    """
    df, schema, rows = store.read(table), store.schema(table), store.count(table)
    made = {c: coerced(F.col(quoted(c)), schema[c].dataType, s.kind, s.element) for c, s in wanted.items()}
    counts = df.agg(*[x for c, e in made.items() for x in (F.count(quoted(c)).alias(f"{c}/before"), F.count(e).alias(f"{c}/after"))]).first().asDict()
    stats = {c: {"before": counts[f"{c}/before"], "after": counts[f"{c}/after"], "newly_nulled": counts[f"{c}/before"] - counts[f"{c}/after"]} for c in made}
    for c, s in stats.items():
        if s["before"] and not s["after"]:
            raise SchemaDrift(f"{table}.{c}: no value can be read as {wanted[c].kind}")
    fields = [StructField(f.name, wanted[f.name].data_type(), f.nullable, f.metadata) if f.name in wanted else f for f in schema]
    out = df.select(*[(made[f.name] if f.name in made else F.col(quoted(f.name))).alias(f.name) for f in schema])

    def same(n: int, _: StructType) -> None:
        if n != rows:
            raise SchemaDrift(f"{table}: {n} rows after the rewrite, {rows} before")

    store.overwrite(table, out, StructType(fields), "coerce", same)
    return stats


def reconcile(store: VersionedStore, table: str, schema: JsonSchema | None, policy: str = "fail", coerce: bool = True, append_only: bool = False) -> Reconciled:
    """Bring a stored table to what its JSON schema asks for.

    New columns are added as nullable, numbers widen in place, drifted types are coerced (or raise if ``coerce`` is
    off), and nothing is dropped. A column that holds nothing but nulls takes any type without a rewrite of other columns' values.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {', '.join(POLICIES)}")
    known = store.exists(table)
    if schema is None or not known:
        if policy == "skip" or append_only:
            return Reconciled(table, [], skipped=True)
        if policy == "fail" or schema is None:
            raise UnknownTable(f"no {'schema' if schema is None else 'table'} for {table}")
    specs = table_specs(schema)
    out = Reconciled(table, specs)
    if not known:
        store.create(table, struct_of(specs))
        out.actions.append({"action": "create", "columns": len(specs)})
        return out
    have = store.schema(table)
    missing = [s for s in specs if s.name not in have.names]
    both = [s for s in specs if s.name in have.names]
    wider = {s.name: s.data_type() for s in both if widens(have[s.name].dataType, s.data_type())}
    drifted = {s.name: s for s in both if not compatible(have[s.name].dataType, s.data_type())}
    if append_only:
        wider, drifted = {}, {}
    if missing:
        store.add_columns(table, [StructField(s.name, s.data_type(), True) for s in missing])
        out.actions.append({"action": "add", "columns": [s.name for s in missing]})
    if wider:
        store.widen_columns(table, wider)
        out.actions.append({"action": "widen", "columns": sorted(wider)})
    if drifted:
        if not coerce:
            raise SchemaDrift(f"{table}: types differ in {', '.join(sorted(drifted))}")
        if store.count(table):
            stats = coerce_columns(store, table, drifted)
            out.actions.append({"action": "coerce", "columns": sorted(drifted), "stats": stats})
        else:
            fields = [StructField(f.name, drifted[f.name].data_type(), f.nullable) if f.name in drifted else f for f in store.schema(table)]
            store.recreate_empty(table, StructType(fields))
            out.actions.append({"action": "recreate", "columns": sorted(drifted)})
    return out


def reconcile_existing(store: VersionedStore, payload: dict[str, JsonSchema]) -> tuple[list[Reconciled], list[dict[str, str]]]:
    """Add what is new to every stored table that the payload knows; failures are collected, not raised."""
    by_name = physical_names(payload)
    done, failed = [], []
    for table in store.tables():
        if source := by_name.get(physical_name(table)):
            try:
                done.append(reconcile(store, table, payload[source], "skip", append_only=True))
            except Exception as e:  # one table must not stop the others
                failed.append({"table": table, "error": str(e)})
    return done, failed
