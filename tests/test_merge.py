import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from palimpsest.functions.keys import with_generated
from palimpsest.operators import merge, versions

LOG = "_id string, _ts long, _deleted boolean, value string"


def statuses(df):
    return {r["__id_ts"]: r["__status"] for r in df.collect()}


def test_generated_columns(spark):
    df = spark.createDataFrame([("a", 1, True, None), ("b", 2, None, True), ("c", 3, False, False), ("d", 4, True, True), (None, 5, True, False)], "_id string, _ts long, _current boolean, _deleted boolean")
    got = [(r["__status"], r["__status_id"], r["__id_ts"]) for r in with_generated(df).orderBy("_ts").collect()]
    assert got == [(1, "1#a", "a#1"), (2, "2#b", "b#2"), (0, "0#c", "c#3"), (3, "3#d", "d#4"), (1, None, None)]


def test_batch_displaces_current_and_tombstone_stays_current(spark):
    old = with_generated(spark.createDataFrame([("a", 150, False, "old")], LOG), F.lit(True))
    new = spark.createDataFrame([("a", 200, False, "x"), ("a", 300, True, "y"), ("b", 10, None, "z")], LOG)
    assert statuses(merge.plan_merge(new, old)) == {"a#150": 0, "a#200": 0, "a#300": 3, "b#10": 1}


def test_displaced_row_keeps_payload(spark):
    old = with_generated(spark.createDataFrame([("a", 150, None, "kept")], LOG), F.lit(True)).withColumn("extra", F.lit(7))
    row = merge.plan_merge(spark.createDataFrame([("a", 200, False, "x")], LOG), old).where("_ts = 150").first()
    assert (row["value"], row["extra"], row["_deleted"], row["__status"]) == ("kept", 7, False, 0)


def test_late_row_joins_history(spark):
    old = with_generated(spark.createDataFrame([("a", 150, False, "old")], LOG), F.lit(True))
    assert statuses(merge.plan_merge(spark.createDataFrame([("a", 100, False, "late")], LOG), old)) == {"a#100": 0}


def test_replay_is_idempotent(spark):
    old = with_generated(spark.createDataFrame([("a", 150, False, "old")], LOG), F.lit(True))
    rows = merge.plan_merge(spark.createDataFrame([("a", 150, False, "again")], LOG), old).collect()
    assert [(r["value"], r["__status"]) for r in rows] == [("again", 1)]


def test_duplicates_last_arrival_wins(spark):
    new = spark.createDataFrame([("a", 1, False, "first", 1), ("a", 1, False, "second", 2)], LOG + ", seq long")
    old = with_generated(spark.createDataFrame([], LOG), F.lit(True))
    assert [r["value"] for r in merge.plan_merge(new, old, "seq").collect()] == ["second"]


@pytest.mark.parametrize("seed", range(4))
def test_fold_equals_closed_form(spark, store, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abcdefg"), rng.randrange(12), rng.random() < 0.3, f"v{i}", i) for i in range(60)]
    log = spark.createDataFrame(rows, LOG + ", seq long")
    order = [F.col("seq") % 3 == i for i in range(3)]
    # Arrival order across batches is batch order, so the closed form's sequence is (batch, seq).
    whole = versions.version_history(log.withColumn("seq", F.col("seq") % 3 * 1000 + F.col("seq")), "seq").drop("seq")
    store.create("t", StructType([StructField("_id", StringType(), False), StructField("_ts", LongType(), False), *[f for f in whole.schema if f.name not in ("_id", "_ts")]]))
    for cond in order:
        merge.merge_into(store, "t", log.where(cond), "seq")
    key = lambda df: sorted(tuple(r[c] for c in sorted(whole.columns)) for r in df.collect())
    assert key(store.read("t")) == key(whole) == key(merge.fold([log.where(c) for c in order], seq="seq"))


def test_merge_touches_only_its_buckets(spark, store):
    log = spark.createDataFrame([(str(i), 1, False, "v") for i in range(40)], LOG)
    store.create("t", versions.version_history(log).schema)
    merge.merge_into(store, "t", log)
    before = {e["bucket"]: e["path"] for e in store.manifest("t").entries}
    merge.merge_into(store, "t", spark.createDataFrame([("7", 2, False, "w")], LOG))
    after = {e["bucket"]: e["path"] for e in store.manifest("t").entries}
    assert sum(before[b] != after[b] for b in before) == 1 and store.count("t") == 41


def test_empty_batch_and_unknown_columns(spark, store):
    log = spark.createDataFrame([("a", 1, False, "v")], LOG)
    store.create("t", versions.version_history(log).schema)
    version = store.manifest("t").version
    assert merge.merge_into(store, "t", log.limit(0)).version == version
    with pytest.raises(merge.MissingColumns, match="other"):
        merge.merge_into(store, "t", log.withColumn("other", F.lit(1)))
    assert merge.check_columns("t", ["_id"], ["_id", "_component"]) == ["_component"]


def test_required_columns_are_guarded(spark, store):
    schema = StructType([StructField("_id", StringType(), False), StructField("_ts", LongType(), False), StructField("value", StringType(), False)])
    full = versions.version_history(spark.createDataFrame([("a", 1, False, None)], LOG))
    assert merge.null_counts(full, schema).first().asDict() == {"_id": 0, "_ts": 0, "value": 1}
    with pytest.raises(Exception, match="value is null"):
        merge.with_null_guard(full, schema).collect()


def test_as_of_and_lookup(spark):
    log = spark.createDataFrame([("a", 1, False, "x"), ("a", 5, True, "y"), ("b", 2, False, "z")], LOG)
    assert statuses(versions.as_of(log, 4)) == {"a#1": 1, "b#2": 1}
    assert statuses(versions.as_of(log, 5)) == {"b#2": 1}
    h = versions.version_history(log)
    assert statuses(versions.current_of(h, log.where("_id = 'a'"))) == {"a#5": 3}
    assert sorted(r[0] for r in versions.probe_keys(log.where("_id = 'a'")).collect()) == ["1#a", "3#a"]
