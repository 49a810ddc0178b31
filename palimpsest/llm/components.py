"""Connected components of links between integer nodes, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import delete_dir, new_dir


def _stored(links: DataFrame, path: str) -> DataFrame:
    links.write.parquet(path)
    return links.sparkSession.read.schema(links.schema).parquet(path)


def _mark(df: DataFrame) -> tuple:
    """Rows and an order-free digest of a set of links."""
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node that is reachable) for each node of ``links`` (``u, v``).

    Large and small stars alternate until the set of links stands still. Each round aggregates
    a minimum per node and joins it back, so a node with many links is never gathered in one
    row, and is written to the shared folder, from which the round before then goes. The pairs of a node meet in one task of a join up to the 256 MB
    from which on Spark splits them, some ten million pairs of numbers. Loops and repeated links may be there; an empty table gives no rows.
    """
    spark = links.sparkSession
    path = new_dir(spark, "links")
    edges = _stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), path)
    before = _mark(edges)
    while before[0]:
        # Large star: each larger neighbour goes to the smallest of the neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours go to the smallest of these.
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        last, path = path, new_dir(spark, "links")
        edges = _stored(small.where("u <> v").distinct(), path)
        delete_dir(spark, last)
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
