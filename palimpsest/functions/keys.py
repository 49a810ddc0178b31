"""Generated columns of a versioned row: its status bits and its two text keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CURRENT, DELETED = 1, 2
STATUS, STATUS_ID, ID_TS = "__status", "__status_id", "__id_ts"
GENERATED = (STATUS, STATUS_ID, ID_TS)
#: Input columns that the generated ones are made from.
INPUTS = ("_id", "_ts", "_current", "_deleted")


def status(current: Column, deleted: Column) -> Column:
    """Bit 0: the version is current; bit 1: it is a tombstone. Null counts as false."""
    bit = lambda flag, value: F.when(F.coalesce(flag, F.lit(False)), F.lit(value)).otherwise(F.lit(0))
    return (bit(current, CURRENT) + bit(deleted, DELETED)).cast("tinyint")


def status_id(status_: Column, id_: Column) -> Column:
    """Status and id joined by ``#``; null if either is."""
    return F.concat(status_.cast("string"), F.lit("#"), id_.cast("string"))


def id_ts(id_: Column, ts: Column) -> Column:
    """The merge key: id and version time joined by ``#``; null if either is."""
    return F.concat(id_.cast("string"), F.lit("#"), ts.cast("string"))


def with_generated(df: DataFrame, current: Column | None = None) -> DataFrame:
    """``df`` with the generated columns last; ``current`` stands in for a ``_current`` column."""
    made = status(F.col("_current") if current is None else current, F.col("_deleted"))
    base = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in GENERATED], made.alias(STATUS))
    return base.select("*", status_id(F.col(STATUS), F.col("_id")).alias(STATUS_ID), id_ts(F.col("_id"), F.col("_ts")).alias(ID_TS))


def is_current(column: str = STATUS) -> Column:
    return F.col(column).bitwiseAND(F.lit(CURRENT).cast("tinyint")) == CURRENT


def is_live(column: str = STATUS) -> Column:
    return F.col(column) == CURRENT


def is_tombstone(column: str = STATUS) -> Column:
    """A deleted version that still is the current one."""
    return F.col(column) == CURRENT + DELETED


def missing_inputs(columns: list[str]) -> list[str]:
    return sorted(set(INPUTS).difference(columns))


def require_inputs(df: DataFrame) -> None:
    if gone := missing_inputs(df.columns):
        raise ValueError(f"columns are missing for the generated ones: {', '.join(gone)}")
