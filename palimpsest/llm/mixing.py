r"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target in words (its weight's share of all words, held to ``passes`` times the
source's size, the excess going to the others by weight) and a schedule, a piecewise linear weight over training
time 0 to 1. The integral of the schedule, times the target, is the source's cumulative
demand. A source's documents stand in an order fixed by a hash, pass after pass; the copy whose middle
word is the k-th of that stream gets the time at which the demand reaches k, by inverting the integral. Copies
past the target are not taken. Documents are range-sorted by time.

The hash range is cut into cells of about a thousand documents, and these are gathered into runs of about a thousand cells; sums of runs and
of cells give each cell its offset, so no source is gathered in a task, however many rows it has. One row per source goes through one task for the targets.

Defined results: a null or empty text has size 0 and is never worth a word; null is a source of its own, the last;
repeated rows are documents of their own; equal hashes are ordered by doc_id, size and a hash of all columns; an empty table gives
no rows; other columns are kept by ``training_order`` (clashing names included) and ignored by ``op3``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import own_columns, table, written

WEIGHTS = (5.0, 2.0, 1.0)
PASSES = 3
#: Knots (time, weight) for the sources of each weight: the first fade out, the last fade in.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)
#: Documents in a cell, about, and cells in a run.
CELL, RUN = 1024, 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``source, source_size`` to ``source, source_size, kind`` (the weight's index) and ``target``.

    One row per source comes in. Sources in order of the level at which they fill up: all before the first that does
    not fill up at the level left for it are full, and this level holds for the rest.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("kind", F.col("rank") % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", passes * F.col("source_size").cast("double"))
    filling = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / after
    ranked = ranked.withColumn("level", level).withColumn("place", F.row_number().over(filling))
    open_ = F.col("most") / F.col("weight") > F.col("level")
    held = F.min_by(F.when(open_, F.col("level")), F.when(open_, F.col("place"))).over(everything)
    ranked = ranked.withColumn("held", held)
    target = F.when(F.col("held").isNull(), F.col("most")).otherwise(F.least("most", F.col("weight") * F.col("held")))
    return ranked.select("source", "source_size", "kind", target.alias("target"))


def invert(share: Column, kind: Column, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> Column:
    """The time at which the integral of the source's schedule has reached ``share`` of its whole."""
    out = None
    for k, knots in enumerate(schedules):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
        total, done, time = sum(areas), 0.0, None
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
            rest = (share - F.lit(done / total)) * F.lit(total)
            slope = (w1 - w0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
            step = rest / F.lit(w0) if slope == 0 else (root - F.lit(w0)) / F.lit(slope)
            here = F.lit(t0) + step
            done += area
            inside = share <= F.lit(done / total)
            time = F.when(inside, here) if time is None else time.when(inside, here)
        out = F.when(kind == k, time.otherwise(F.lit(1.0))) if out is None else out.when(kind == k, time.otherwise(F.lit(1.0)))
    return out


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """The columns of ``docs`` as c0, c1, ..., with what a plan needs of each row: named, source, size, hash, tie and cell."""
    cells = max(1, -(-docs.count() // CELL))
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    id_, source, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "source", "text"))
    hash_ = F.xxhash64(F.lit(seed), id_, text)
    return rows.select(
        "*",
        source.isNotNull().alias("named"),
        F.coalesce(source.cast("string"), F.lit("")).alias("source"),
        id_.alias("id"),
        word_count(text).alias("size"),
        hash_.alias("hash"),
        F.xxhash64(*rows.columns).alias("tie"),
        F.floor((hash_.cast("double") / 2.0**64 + 0.5) * cells).cast("long").alias("cell"),
    )


def _offsets(sums: DataFrame) -> DataFrame:
    """``source, named, cell`` and the words of the source's cells before it; two levels of sums, so that a task has a run of cells at most."""
    key = ["source", "named"]
    run = F.floor(F.col("cell") / RUN)
    before = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = sums.groupBy(*key, run.alias("run")).agg(F.sum("n").alias("n"))
    runs = runs.select(*key, "run", before(key, "run").alias("runs_before"))
    cells = sums.withColumn("run", run).withColumn("cells_before", before([*key, "run"], "cell"))
    return cells.join(runs, [*key, "run"]).select(*key, "cell", (F.col("runs_before") + F.col("cells_before")).alias("offset"))


def _plan(rows: DataFrame, weights: Sequence[float], passes: int) -> DataFrame:
    """Rows of ``_sized`` with source_size, kind, target and the times of the copies taken."""
    key = ["source", "named", "cell"]
    sums = written(rows.groupBy(*key).agg(F.sum("size").alias("n")), "cells")
    sizes = sums.groupBy(F.when(F.col("named"), F.col("source")).alias("source")).agg(F.sum("n").alias("source_size"))
    goals = written(targets(sizes, weights, passes), "targets")
    goals = goals.select(F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNotNull().alias("named"), "source_size", "kind", "target")
    offsets = written(_offsets(sums).join(goals, ["source", "named"]), "offsets")
    inside = Window.partitionBy(*key).orderBy("hash", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(offsets, key).withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("offset"))
    middle = F.col("before") + F.col("size") / 2
    at = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), lambda p: p * F.col("source_size") + middle)
    at = F.filter(at, lambda m: m < F.col("target"))
    return rows.withColumn("times", F.transform(at, lambda m: invert(m / F.col("target"), F.col("kind"))))


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = PASSES, seed: int = 17) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, times``, range-sorted by the first time; untaken documents come last."""
    names = ["doc_id", "source", "text"]
    # Texts are counted once; the rest is done on numbers.
    slim = written(_sized(own_columns(docs, *names), seed).drop("c2"), "sizes")
    planned = _plan(slim, weights, passes)
    out = planned.select(F.col("c0").alias("doc_id"), F.col("c1").alias("source"), "size", "source_size", "target", (F.col("size") * F.size("times")).alias("taken"), "times", "hash", "tie")
    return out.orderBy(F.get("times", F.lit(0)).asc_nulls_last(), "hash", "tie").drop("hash", "tie")


def training_order(docs: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = PASSES, seed: int = 17) -> DataFrame:
    """A whole row of ``docs`` per copy taken, range-sorted by its training time."""
    planned = _plan(_sized(docs, seed), weights, passes).withColumn("time", F.explode("times"))
    return planned.orderBy("time", "hash", "tie").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the mix SQL can tell: sizes and targets; what is taken hangs on hashes."""
    return op3_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


#: Sources fill up in order of the level at which they do; the first that does not sets the level of the rest.
MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
w AS (SELECT source, n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s),
f AS (SELECT *, 3.0 * n / w AS full_at FROM w),
r AS (SELECT a.full_at, (SELECT sum(n) FROM s) - coalesce(sum(3.0 * b.n) FILTER (b.full_at < a.full_at), 0) AS words, sum(b.w) FILTER (b.full_at >= a.full_at) AS weights
  FROM (SELECT DISTINCT full_at FROM f) AS a, f AS b GROUP BY a.full_at),
l AS (SELECT arg_min(words / weights, full_at) FILTER (full_at > words / weights) AS level FROM r)
SELECT doc_id, size, f.n AS source_size, round(CAST(CASE WHEN level IS NULL THEN 3.0 * f.n ELSE least(3.0 * f.n, f.w * level) END AS DOUBLE), 3) AS target
FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source, l
"""
