import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from palimpsest.functions.keys import with_generated
from palimpsest.operators import jobs, repair
from palimpsest.sources import files
from palimpsest.sources.config import apply_config, parse_config, table_list
from palimpsest.sources.state import Conflict, CursorState, Lease, LeaseHeld
from palimpsest.sources.store import CommitConflict

LOG = "_id string, _ts long, _deleted boolean, value string"


@pytest.fixture
def rows(spark):
    return with_generated(spark.createDataFrame([(str(i), i, False, f"v{i}") for i in range(30)], LOG), F.lit(True))


def test_versions_and_restore(store, rows):
    first = store.overwrite("T", rows)
    store.delete_where("T", "_ts >= 10")
    assert store.count("T") == store.read("T").count() == 10 and store.read("T", 1).count() == 30
    back = store.restore("T", first.version)
    assert back.version == 3 and store.read("T").count() == 30 and store.same_schema("T", 1, 3)
    with pytest.raises(LookupError):
        store.read("T", 9)
    with pytest.raises(LookupError):
        store.read("nothing")


def test_upsert_replaces_and_adds(store, rows):
    store.overwrite("T", rows)
    new = rows.where("_ts < 3").withColumn("value", F.lit("new")).unionByName(with_generated(rows.limit(1).select("_id", F.lit(99).cast("long").alias("_ts"), "_deleted", F.lit("add").alias("value")), F.lit(False)))
    store.upsert("T", new)
    got = store.read("T")
    assert got.count() == 31 and got.where("value = 'new'").count() == 3 and got.where("value = 'add'").count() == 1


def test_append_to_empty_and_delete_keys(store, rows):
    store.create("T", rows.schema)
    assert store.read("T").count() == 0
    store.upsert("T", rows)
    store.delete_keys("T", rows.where("_ts = 4"))
    assert store.read("T").count() == 29
    with pytest.raises(ValueError, match="not in the table"):
        store.append("T", rows.withColumn("other", F.lit(1)))


def test_schema_changes_are_manifests_only(spark, store):
    store.overwrite("T", spark.createDataFrame([(1, "a")], "n int, s string"))
    paths = [e["path"] for e in store.manifest("T").entries]
    store.add_columns("T", [StructField("note", StringType(), False)])
    store.widen_columns("T", {"n": LongType()})
    assert [e["path"] for e in store.manifest("T").entries] == paths
    assert store.read("T").collect()[0].asDict() == {"n": 1, "s": "a", "note": None}
    with pytest.raises(ValueError):
        store.widen_columns("T", {"s": LongType()})
    assert store.describe("T")[0] == ("n", "bigint")


def test_two_writers_conflict(store, rows):
    store.overwrite("T", rows)
    base = store.manifest("T")
    store.set_layout("T", {"a": 1})
    with pytest.raises(CommitConflict):
        store._commit("T", base, operation="late")


def test_compact_and_vacuum(store, rows):
    store.create("T", rows.schema)
    for i in range(3):
        store.append("T", rows.where(F.col("_ts") % 3 == i))
    jobs.create_indexes(store, "T")
    assert store.compact("T") is not None and store.compact("T") is None
    buckets = [e["bucket"] for e in store.manifest("T").entries]
    assert len(buckets) == len(set(buckets)) and store.read("T").count() == 30
    gone = store.vacuum("T", keep=1, older_than=0, now=store.manifest("T").created_at + 10)
    assert gone == [1, 2, 3, 4, 5] and store.versions("T") == [6] and store.read("T").count() == 30
    assert store.vacuum("T", keep=1, older_than=10**9) == []


def test_migrate_backfill_drop(spark, store):
    src = spark.createDataFrame([("a", 1, True, False, "x"), ("b", 2, False, None, "y"), ("c", 3, None, True, None)], "_id string, _ts long, _current boolean, _deleted boolean, value string")
    got = jobs.migrate_table(store, "T", src, where="_ts > 1", order_by="value, _ts", limit=5)
    assert got["target_rows"] == 2 and store.read("T").columns == ["_id", "_ts", "_deleted", "value", "__status", "__status_id", "__id_ts"]
    assert jobs.migrate_table(store, "T", src, mode="append")["target_rows"] == 3 and store.count("T") == 5
    assert [r["_id"] for r in jobs.migration_query(src, order_by="value, _ts").collect()] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="_deleted"):
        jobs.migration_query(src.drop("_deleted"))
    store.overwrite("L", src)
    with pytest.raises(ValueError, match="backfill"):
        jobs.drop_legacy_current(store, "L")
    assert jobs.backfill_generated(store, "L") and jobs.backfill_generated(store, "L") is None
    assert store.read("L").columns[:5] == src.columns
    assert jobs.drop_legacy_current(store, "L") and "_current" not in store.read("L").columns
    assert jobs.drop_legacy_current(store, "L") is None


def test_repair(spark, store):
    store.overwrite("R", spark.createDataFrame([("a", '"q"', "1"), ("b", "plain", '"z"')], "_id string, recordId string, payload string"))
    with pytest.raises(repair.RepairRefused):
        repair.repair(store, "R", ["nope"])
    assert repair.repair(store, "R", ["recordId"]) == {"table": "R", "columns": ["recordId"], "candidates": 1, "applied": False, "version": 1}
    found = repair.discover(store, {"R": {"properties": {"recordId": {"type": "string"}, "payload": {"type": "object"}}}})
    assert found[0]["columns"] == {"recordId": 1} and found[0]["checked"] == 2
    assert repair.repair(store, "R", ["recordId"], apply=True)["applied"]
    assert sorted((r["recordId"], r["payload"]) for r in store.read("R").collect()) == [("plain", '"z"'), ("q", "1")]


def test_index_config(store, state, rows):
    store.overwrite("T", rows)
    text = '[[indexes]]\ncolumn = "value"\ntype = "btree"\n[[indexes]]\ncolumn = "value"\ntype = "BTREE"\n[[indexes]]\ncolumn = "gone"\ntype = "LABEL_LIST"\n'
    config = parse_config("T", text)
    assert [i.column for i in config.indexes] == ["value", "gone"] and config.version.startswith("sha256:")
    assert not apply_config(store, state, config)["applied"]
    good = parse_config("T", '[[indexes]]\ncolumn = "value"\n')
    assert apply_config(store, state, good)["applied"] and apply_config(store, state, good)["reason"] == "unchanged"
    assert jobs.extra_indexes(store, "T", []) == [("value", "BTREE")]
    with pytest.raises(ValueError):
        parse_config("T", '[[indexes]]\ncolumn = "v"\ntype = "HASH"\n')
    assert table_list(store, "b, a,") == ["a", "b"] and table_list(store, None, "# x\n\nz\n") == ["z"] and table_list(store) == ["t"]


def test_label_lookup(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, None)], "i int, l array<string>")
    assert [r["i"] for r in jobs.label_lookup(df, "l", ["b", "x"]).collect()] == [1]


def test_run_parallel(spark):
    def bad():
        raise ValueError("no")

    got = jobs.run_parallel(spark, {"a": lambda: spark.range(3).count(), "b": bad, "c": lambda: 1}, 1, stop_on_failure=True)
    assert got["a"]["result"] == 3 and got["b"]["error"] == "no" and got["c"]["error"] == "not started"
    assert jobs.run_parallel(spark, {"b": bad, "c": lambda: 1}, 2)["c"]["ok"]


def test_compare_and_swap(state):
    tag = state.swap("k", {"v": 1}, None)
    with pytest.raises(Conflict):
        state.swap("k", {"v": 2}, None)
    new = state.swap("k", {"v": 2}, tag)
    with pytest.raises(Conflict):
        state.swap("k", {"v": 3}, tag)
    assert state.get("k") == ({"v": 2}, new)
    state.delete("k")
    assert state.get("k")[0] is None and state.get("other") == (None, None)


def test_lease(state):
    now = [1000.0]
    a, b = Lease(state, "x", 10, lambda: now[0]), Lease(state, "x", 10, lambda: now[0])
    b.owner = "other"
    a.acquire()
    with pytest.raises(LeaseHeld):
        b.acquire()
    now[0] += 5
    a.heartbeat()
    assert a.verify()["created_at"] == 1000.0
    b.release()
    a.verify()
    now[0] += 11
    b.acquire()
    with pytest.raises(LeaseHeld):
        a.heartbeat()
    a.acquire(force=True)
    a.release()
    with b:
        b.verify()


def test_cursor_must_be_seeded(state):
    c = CursorState(state)
    with pytest.raises(RuntimeError, match="seed"):
        c.read()
    c.seed("0")
    cursor, tag = c.read()
    c.advance(cursor, "5", tag, "me", 1)
    with pytest.raises(Conflict):
        c.advance(cursor, "6", tag, "me", 1)
    assert c.read()[0] == "5"


def test_migrations_of_other_threads_keep_to_their_tables(spark):
    sources = {t: spark.createDataFrame([(t, 1, True, False)], "_id string, _ts long, _current boolean, _deleted boolean") for t in "ab"}

    def ids(t):
        return {r["_id"] for _ in range(15) for r in jobs.migration_query(sources[t], "_ts > 0", "_id", 5).collect()}

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(ids, "abab")) == [{"a"}, {"b"}, {"a"}, {"b"}]
    assert not [v for v in spark.catalog.listTables() if "__migration" in v.name]


def test_merged_buckets_are_put_in_order_again(store, rows):
    store.create("T", rows.schema)
    store.append("T", rows)
    jobs.create_indexes(store, "T")
    assert store.compact("T") is not None and store.compact("T") is None
    store.upsert("T", rows.where("_ts = 7").withColumn("value", F.lit("new")))
    done = store.compact("T")
    assert done is not None and {tuple(e["sorted_by"]) for e in done.entries} == {tuple(done.layout["sort_by"])}
    assert store.compact("T") is None and store.read("T").count() == 30


def test_deletes_leave_other_buckets_alone(store, rows):
    store.overwrite("T", rows)
    before = {e["bucket"]: e["path"] for e in store.manifest("T").entries}
    store.delete_where("T", "_id = '4' or value is null")
    after = {e["bucket"]: e["path"] for e in store.manifest("T").entries}
    assert sum(before[b] != p for b, p in after.items()) == 1 and store.count("T") == store.read("T").count() == 29
    store.delete_keys("T", rows.where("_ts in (4, 5)"))
    assert store.count("T") == store.read("T").count() == 28
    assert store.delete_where("T", "_ts > 1000").entries == store.manifest("T").entries and store.count("T") == 28
    store.delete_where("T", "true")
    assert store.count("T") == store.read("T").count() == 0


def test_vacuum_takes_what_failed_jobs_left(store, rows):
    store.overwrite("T", rows)
    rows.write.parquet(f"{store.root}/t/data/lost")
    now = store.manifest("T").created_at + 1000
    assert store.vacuum("T", older_than=10**6, now=now) == [] and "lost" in store.files.names(f"{store.root}/t/data")
    assert store.vacuum("T", older_than=500, now=now) == []
    assert "lost" not in store.files.names(f"{store.root}/t/data") and store.read("T").count() == 30


def test_torn_files_of_dead_writers_are_passed_over(store, state, rows, monkeypatch):
    monkeypatch.setattr(files, "TRIES", 1)
    store.overwrite("T", rows)
    tag = state.swap("k", {"v": 1}, None)
    store.files.create(f"{store.root}/t/_versions/00000002.json", '{"version": 2, "sch')
    state.files.create(f"{state.root}/k/000000000002.json", "")
    # Fresh ones may still be being written.
    for read in (lambda: store.read("T"), lambda: state.get("k")):
        with pytest.raises(ValueError):
            read()
    monkeypatch.setattr(files, "STALE", -1)
    assert store.read("T").count() == 30 and store.delete_where("T", "_ts < 5").version == 3 and store.read("T").count() == 25
    value, torn = state.get("k")
    assert value == {"v": 1} and torn != tag
    state.swap("k", {"v": 2}, torn)
    assert state.get("k")[0] == {"v": 2}
    assert store.vacuum("T") == [] and store.versions("T") == [1, 3]


def test_lease_expires_and_is_renewed(state):
    now = [0.0]
    a = Lease(state, "x", 0.3, lambda: now[0]).acquire()
    with a.kept():
        now[0] = 0.2
        time.sleep(0.5)
    now[0] = 0.4
    a.verify()
    now[0] = 0.6
    with pytest.raises(LeaseHeld, match="expired"):
        a.verify()


def test_labels_and_keys_read_only_their_buckets(spark, store):
    rows = with_generated(spark.range(200).select(F.col("id").cast("string").alias("_id"), F.lit(1).cast("long").alias("_ts"), F.lit(False).alias("_deleted"), F.when(F.col("id") % 50 == 0, F.array(F.concat(F.lit("l"), F.col("id").cast("string")), F.lit(None))).when(F.col("id") % 7 > 0, F.array(F.lit("all"))).alias("tags")), F.lit(True))
    store.overwrite("T", rows)
    jobs.create_indexes(store, "T", [*jobs.DEFAULT_INDEXES, ("tags", "LABEL_LIST")])
    found = lambda *labels: sorted(int(r["_id"]) for r in jobs.lookup_labels(store, "T", "tags", labels).collect())
    assert found("l50", "l100") == [50, 100]
    assert store.compact("T") is not None and store.compact("T") is None
    assert found("l50", "l100") == [50, 100] and found("nothing") == [] and len(found("all")) == rows.where("array_contains(tags, 'all')").count()
    assert len(store.read_labelled("T", "tags", ["l50"]).inputFiles()) < len(store.read("T").inputFiles())
    # What was merged since has no table of labels and is read.
    store.upsert("T", rows.where("_id = '3'").withColumn("tags", F.array(F.lit("new"))))
    assert found("new") == [3] and found("l50") == [50]
    assert store.compact("T") is not None and found("new") == [3] and store.compact("T") is None
    got = jobs.lookup_keys(store, "T", ["9#1", "150#1", "9#2", "none#1"])
    assert sorted(r["_id"] for r in got.collect()) == ["150", "9"] and len(got.inputFiles()) < len(store.read("T").inputFiles())
    assert sorted(r["_id"] for r in store.read("T").where("__id_ts = '9#1'").collect()) == ["9"]
    assert store.vacuum("T", keep=1, older_than=0, now=store.manifest("T").created_at + 10) and found("l50") == [50]
