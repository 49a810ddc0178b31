"""Table configuration in TOML: which columns a table is laid out by."""

from __future__ import annotations

import hashlib
import time
import tomllib
from dataclasses import dataclass
from typing import Any

from palimpsest.functions.naming import physical_name, require_identifier
from palimpsest.operators.jobs import DEFAULT_INDEXES, INDEX_TYPES, create_indexes
from palimpsest.sources.files import Files
from palimpsest.sources.state import StateStore
from palimpsest.sources.store import VersionedStore


@dataclass(frozen=True)
class IndexSpec:
    column: str
    kind: str
    name: str | None = None


@dataclass(frozen=True)
class TableConfig:
    table: str
    version: str
    indexes: tuple[IndexSpec, ...]


def parse_config(table: str, text: str) -> TableConfig:
    """Index entries in their order, each once."""
    found: dict[tuple, IndexSpec] = {}
    for e in tomllib.loads(text).get("indexes", []):
        kind = str(e.get("type", "BTREE")).upper()
        if kind not in INDEX_TYPES:
            raise ValueError(f"{table}: index type {kind}")
        spec = IndexSpec(require_identifier(e["column"]), kind, e.get("name"))
        found.setdefault((spec.column, spec.kind, spec.name), spec)
    return TableConfig(table, f"sha256:{hashlib.sha256(text.encode()).hexdigest()}", tuple(found.values()))


def load_config(files: Files, folder: str, table: str) -> TableConfig | None:
    text = files.read(f"{folder.rstrip('/')}/{physical_name(table)}.toml")
    return None if text is None else parse_config(table, text)


def apply_config(store: VersionedStore, state: StateStore, config: TableConfig) -> dict[str, Any]:
    """Lay the table out as configured, unless this version is applied already.

    The version is recorded only if nothing but what was there before has been skipped.
    """
    key = f"table-config/{physical_name(config.table)}"
    applied, _ = state.get(key)
    if applied and applied["config_version"] == config.version:
        return {"table": config.table, "applied": False, "reason": "unchanged"}
    wanted = [*DEFAULT_INDEXES, *[(i.column, i.kind) for i in config.indexes]]
    got = create_indexes(store, config.table, list(dict.fromkeys(wanted)))
    whole = all(why == "exists" for _, why in got["skipped"])
    if whole:
        state.put(key, {"table": config.table, "config_version": config.version, "applied_at": time.time(), "indexes": wanted, **got})
    return {"table": config.table, "applied": whole, **got}


def table_list(store: VersionedStore, told: str | None = None, file_text: str | None = None) -> list[str]:
    """Tables from a comma-separated text, else from lines of a file (blank ones and ``#`` skipped), else all of the store."""
    if told:
        return sorted({t.strip() for t in told.split(",") if t.strip()})
    if file_text is not None:
        return sorted({t.strip() for t in file_text.splitlines() if t.strip() and not t.strip().startswith("#")})
    return store.tables()
