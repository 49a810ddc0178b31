"""Names of physical tables and columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SAFE = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def physical_name(source: str) -> str:
    """A table's name in storage: letters and digits of any script stay, all else becomes ``_``."""
    name = "".join(c if c.isalnum() else "_" for c in source).strip("_") or "table"
    return (f"t_{name}" if name[0].isdigit() else name).lower()


def physical_names(sources: Iterable[str]) -> dict[str, str]:
    """Physical to source name; two sources with one physical name raise."""
    out: dict[str, str] = {}
    for s in sources:
        if out.setdefault(p := physical_name(s), s) != s:
            raise ValueError(f"tables {out[p]!r} and {s!r} share the physical name {p!r}")
    return out


def physical_name_column(source: Column) -> Column:
    """``physical_name`` as an expression."""
    flat = F.regexp_replace(F.regexp_replace(source, r"[^\p{L}\p{N}]", "_"), r"^_+|_+$", "")
    named = F.when(flat == "", F.lit("table")).otherwise(flat)
    return F.lower(F.when(named.rlike(r"^\p{N}"), F.concat(F.lit("t_"), named)).otherwise(named))


def require_identifier(name: str) -> str:
    if not _SAFE.match(name):
        raise ValueError(f"unsafe column name: {name!r}")
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def file_stem(text: str) -> str:
    """Letters, digits, ``-``, ``_`` and ``.`` of a cursor or name, for a file name."""
    return "".join(c if c.isalnum() or c in "-_." else "_" for c in text)[:80] or "none"
