"""Which version of a row is current: closed forms over a whole change log.

A log has ``_id, _ts, _deleted`` and payload columns. The current version of an id is the one with the largest ``_ts``; of rows
with equal ``(_id, _ts)`` the one that arrived last (largest ``seq``) counts, the others are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.keys import GENERATED, is_current, is_live, is_tombstone, with_generated
from palimpsest.functions.naming import quoted


def arrival(df: DataFrame, seq: str | None) -> list[Column]:
    """Last arrival first; without a sequence a hash of the row breaks ties, so that reruns agree."""
    rest = [F.col(quoted(c)) for c in df.columns if c != seq]
    return ([F.col(quoted(seq)).desc_nulls_last()] if seq else []) + [F.xxhash64(*rest).desc()]


def deduplicated(log: DataFrame, seq: str | None = None) -> DataFrame:
    """One row for each ``(_id, _ts)``, the last to arrive."""
    w = Window.partitionBy("_id", "_ts").orderBy(*arrival(log, seq))
    return log.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def version_history(log: DataFrame, seq: str | None = None) -> DataFrame:
    """Every version with its generated columns; one shuffle by ``_id`` serves both windows."""
    log = log.drop(*GENERATED, "_current").withColumn("_deleted", F.coalesce("_deleted", F.lit(False)))
    dealt = log.withColumn("__latest", F.max("_ts").over(Window.partitionBy("_id")))
    dealt = deduplicated(dealt, seq)
    current = F.coalesce(F.col("_ts") == F.col("__latest"), F.lit(False))
    return with_generated(dealt.withColumn("_current", current)).drop("__latest", "_current")


def latest(log: DataFrame, seq: str | None = None) -> DataFrame:
    """The current version of each id alone, by a partial aggregate before the shuffle."""
    rest = [c for c in log.columns if c not in ("_id", "_ts", *GENERATED, "_current")]
    keys = [F.col("_ts"), *([F.col(quoted(seq))] if seq else []), F.xxhash64(*[F.col(quoted(c)) for c in log.columns])]
    row = F.struct("_ts", *[F.col(quoted(c)) for c in rest])
    best = log.groupBy("_id").agg(F.max_by(row, F.struct(*keys)).alias("r"))
    flat = best.select("_id", *[F.col("r")[c].alias(c) for c in ("_ts", *rest)])
    flat = flat.withColumn("_deleted", F.coalesce("_deleted", F.lit(False)))
    return with_generated(flat, F.lit(True))


def current(table: DataFrame) -> DataFrame:
    return table.where(is_current())


def live(table: DataFrame) -> DataFrame:
    return table.where(is_live())


def tombstones(table: DataFrame) -> DataFrame:
    return table.where(is_tombstone())


def as_of(log: DataFrame, ts: int, seq: str | None = None) -> DataFrame:
    """The live rows at a version time: later versions do not count, deleted ids are absent."""
    return latest(log.where(F.col("_ts") <= ts), seq).where(is_live())


def probe_keys(ids: DataFrame) -> DataFrame:
    """The two ``__status_id`` values under which an id's current version can stand."""
    return ids.select(F.explode(F.array(F.lit(1), F.lit(3))).alias("s"), "_id").select(F.concat(F.col("s").cast("string"), F.lit("#"), F.col("_id").cast("string")).alias("__status_id")).distinct()


def current_of(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Current versions of the ids; Catalyst broadcasts the ids only while they are small."""
    return current(table).join(ids.select("_id").distinct(), "_id", "left_semi")


def key_lookup(table: DataFrame, keys: list[str], column: str = "__id_ts") -> DataFrame:
    """Rows by a literal list of keys, which reaches the scan as a pushed filter."""
    return table.where(F.col(quoted(column)).isin(keys))


def upserted(target: DataFrame, rows: DataFrame, key: str = "__id_ts") -> DataFrame:
    """``target`` with ``rows`` in place of those of equal key, as anti-join and union."""
    return target.join(rows.select(quoted(key)), key, "left_anti").select(*[quoted(c) for c in target.columns]).unionByName(rows, allowMissingColumns=True)
