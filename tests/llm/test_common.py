"""Helpers: samples by hash, words of texts, runs of rows."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from palimpsest.llm.common import delete_dir, first_by_hash, scratch, spans, stored, words_of


def test_first_by_hash_is_the_smallest_however_rows_repeat(spark):
    plain = spark.range(30_000).select(F.col("id").alias("k"))
    heavy = plain.union(spark.range(200_000).select(F.lit(5).cast("long").alias("k"))).union(spark.createDataFrame([(None,)], "k long"))
    want = [r[0] for r in plain.orderBy(F.xxhash64("k"), "k").limit(400).collect()]
    for df in (plain, heavy, heavy.withColumn("extra", F.lit("x"))):
        assert [r[0] for r in first_by_hash(df, "k", 400).collect()] == want
    one = spark.range(200_000).select(F.lit(7).alias("k"))
    assert [r[0] for r in first_by_hash(one, "k", 400).collect()] == [7]
    assert first_by_hash(one.limit(0), "k", 400).collect() == []


def test_words_of():
    texts = ["", " ", None, "a  b\n\nc ", "\x0ba\x85b\x0c", "é\xa0x a", "a"]
    words, index, starts = words_of(pa.array(texts, pa.string()))
    got = [[words[i] for i in index[a:b]] for a, b in zip(starts, starts[1:], strict=False)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    words, index, starts = words_of(pa.array(["x", "", "y y"], pa.string()).slice(1))
    assert [[words[i] for i in index[a:b]] for a, b in zip(starts, starts[1:], strict=False)] == [[], ["y", "y"]]


def test_spans():
    assert list(spans(np.array([3, 3, 9, 1, 1, 0, 5]), 6)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    assert list(spans(np.array([], int), 6)) == []


def test_folders_go(spark):
    df, path = stored(spark.range(3), "gone")
    assert df.count() == 3
    delete_dir(spark, path)
    assert not spark.sparkContext._jvm.java.io.File(path.removeprefix("file://")).exists()


def test_scratch_folders_go_with_their_block(spark):
    there = lambda path: spark.sparkContext._jvm.java.io.File(path.removeprefix("file://")).exists()
    with scratch(spark) as keep:
        gone, kept = (stored(spark.range(3), n) for n in ("one", "two"))
        keep.append(kept[1])
        assert there(gone[1])
    assert not there(gone[1]) and there(kept[1]) and kept[0].count() == 3
    delete_dir(spark, kept[1])
