import datetime
import json

import pytest

from palimpsest.sources.changelog import ChangeLog, Chunk, folder_transport, raw_row, register
from palimpsest.sources.state import CursorState, Lease, LeaseHeld
from palimpsest.streaming import ingest as ing
from palimpsest.streaming.ingest import Ingest, SchemaCache, Settings, sync_loop, sync_once, sync_stream
from palimpsest.streaming.maintenance import KEY, Plan, TouchedTables, idle_pass, in_window, next_due

STRING = {"type": "string"}
SCHEMAS = {"schemas": {"Work Items": {"properties": {"name": STRING, "n": {"type": "number"}}}, "B": {"properties": {"x": {"type": "boolean"}}}}}


def delta(table, id_, ts, **more):
    return {"_table": table, "_id": id_, "_ts": ts, **more}


PAGES = [
    {"from": "0", "cursor": "1", "hasMore": True, "values": [delta("Work Items", "a", 1, name="n1", n=1), delta("B", "b", 1, x=True), {"_id": "lost", "_ts": 1}, "junk"]},
    {"from": "1", "cursor": "2", "hasMore": True, "values": [delta("Work Items", "a", 3, name="n3", n=2.5), delta("Work Items", "c", 2, _deleted=True)]},
    {"from": "2", "cursor": "3", "hasMore": False, "values": [delta("Work Items", "a", 2, name="late"), delta("B", "b", 5, x=False)]},
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log/pages.json").write_text(json.dumps(PAGES))
    (tmp_path / "log/schemas.json").write_text(json.dumps(SCHEMAS))
    return str(tmp_path / "log")


@pytest.fixture
def setup(spark, store, state, folder):
    log = ChangeLog("http://x", transport=folder_transport(folder), sleep=lambda _: None)
    CursorState(state).seed("0")

    def make(**settings):
        events = []
        i = Ingest(spark, store, state, SchemaCache(state, log), Settings(**{"unknown_tables": "create", **settings}), lambda n, v: events.append((n, v)))
        return i, log, events

    return make


def live(store, table):
    return {r["__id_ts"]: r["__status"] for r in store.read(table).collect()}


WANT = {"a#1": 0, "a#2": 0, "a#3": 1, "c#2": 3}


@pytest.mark.parametrize(("settings", "chunks"), [({}, 3), ({"merge_pages": 10}, 1), ({"merge_pages": 10, "merge_rows": 3, "table_concurrency": 2}, 2)])
def test_sync_once(setup, store, state, settings, chunks):
    i, log, events = setup(**settings)
    stats = sync_once(i, log)
    assert stats["chunks"] == chunks and stats["rows_seen"] == 7 and stats["rows_accepted"] == 6 and stats["end_cursor"] == "3"
    assert live(store, "Work Items") == WANT and live(store, "B") == {"b#1": 0, "b#5": 1}
    committed = [v for n, v in events if n == "page_committed"]
    assert len(committed) == 3 and any("buffered" in v for v in committed) == (chunks < 3)
    audits = state.files.names(f"{state.root}/incremental/{'page' if chunks == 3 else 'chunk'}_audit")
    assert len(audits) == chunks
    row = store.read("Work Items").where("__id_ts = 'a#3'").first()
    assert (row["name"], row["n"], row["_cursor"], row["_table"]) == ("n3", 2.5, "2", "Work Items")


def test_page_cap_leaves_more(setup):
    i, log, _ = setup(max_pages=2)
    stats = sync_once(i, log)
    assert stats["pages"] == 2 and stats["has_more"] and stats["end_cursor"] == "2"


def test_failed_merge_keeps_the_cursor_and_replay_is_safe(setup, store, state, monkeypatch):
    i, log, _ = setup(merge_pages=10)
    whole = ing.merge_into

    def breaks(store_, table, *a):
        if table == "Work Items":
            raise OSError("disk")
        return whole(store_, table, *a)

    monkeypatch.setattr(ing, "merge_into", breaks)
    with pytest.raises(OSError):
        sync_once(i, log)
    # The other table was merged all the same; cursor and error record tell of the failure.
    assert live(store, "B") == {"b#1": 0, "b#5": 1} and CursorState(state).read()[0] == "0"
    assert state.get("incremental/last_error")[0]["error"] == "disk"
    monkeypatch.setattr(ing, "merge_into", whole)
    sync_once(i, log)
    assert live(store, "B") == {"b#1": 0, "b#5": 1} and live(store, "Work Items") == WANT
    assert state.get("incremental/last_error")[0] is None


def test_crash_between_merge_and_commit(setup, store, state, monkeypatch):
    i, log, _ = setup(merge_pages=10)
    monkeypatch.setattr(CursorState, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        sync_once(i, log)
    monkeypatch.undo()
    i, log, _ = setup.__call__(merge_pages=10)
    sync_once(i, log)
    assert live(store, "Work Items") == WANT


def test_unknown_field_refreshes_the_schema_once(setup, store, state, folder):
    i, log, events = setup(merge_pages=10)
    old = {"schemas": {"Work Items": {"properties": {"name": STRING}}, "B": SCHEMAS["schemas"]["B"]}}
    state.put("incremental/schema", {"fetched_at": 4e9, **old})
    sync_once(i, log)
    assert [n for n, _ in events].count("schema_refresh") == 1 and "n" in store.schema("Work Items").names


def test_lease_is_respected(setup, state):
    i, log, _ = setup()
    with Lease(state, "incremental"), pytest.raises(LeaseHeld):
        sync_once(i, log)
    slept = []
    with Lease(state, "incremental"):
        assert sync_loop(i, log, sleep_seconds=7, rounds=1, sleep=slept.append) == 1
    assert slept == [7]


def test_loop_drains_without_sleep(setup, state):
    i, log, _ = setup(max_pages=1)
    slept = []
    sync_loop(i, log, sleep_seconds=7, rounds=2, sleep=slept.append)
    assert slept == [] and CursorState(state).read()[0] == "2"


def test_stream_and_batch_source(spark, setup, store, state, folder, tmp_path):
    i, _, _ = setup()
    options = {"folder": folder, "merge_pages": "1", "cursor": "0"}
    register(spark)
    assert spark.read.format("pagedlog").options(**options).load().count() == 6
    assert sync_stream(i, options, f"file://{tmp_path}/checkpoint") == 3
    assert live(store, "Work Items") == WANT and CursorState(state).read()[0] == "3"


def test_stream_goes_on_past_pages_without_rows(setup, store, state, folder, tmp_path):
    junk = [{"_id": "lost"}, "junk"]
    pages = [{**PAGES[0]}, {"from": "1", "cursor": "2", "hasMore": True, "values": junk}, {"from": "2", "cursor": "3", "hasMore": True, "values": PAGES[2]["values"]}, {"from": "3", "cursor": "4", "hasMore": False, "values": []}]
    with open(f"{folder}/pages.json", "w") as f:
        json.dump(pages, f)
    i, _, events = setup()
    assert sync_stream(i, {"folder": folder, "merge_pages": "1"}, f"file://{tmp_path}/checkpoint") == 4
    assert CursorState(state).read()[0] == "4" and live(store, "B") == {"b#1": 0, "b#5": 1}
    assert [v["rows_accepted"] for n, v in events if n == "page_committed"] == [2, 0, 2, 0]
    assert len(state.files.names(f"{state.root}/incremental/page_audit")) == 4


def test_stream_respects_the_lease_and_the_cursor(setup, state, folder, tmp_path):
    i, log, _ = setup()
    options = {"folder": folder, "merge_pages": "1"}
    with Lease(state, "incremental"), pytest.raises(LeaseHeld):
        sync_stream(i, options, f"file://{tmp_path}/checkpoint")
    assert sync_stream(i, options, f"file://{tmp_path}/checkpoint", max_chunks=1) == 1 and CursorState(state).read()[0] == "1"
    CursorState(state).seed("0")
    with pytest.raises(Exception, match="checkpoint is at 1"):
        sync_stream(i, options, f"file://{tmp_path}/checkpoint")
    assert state.get("locks/incremental")[0] is None
    # A chunk that the cursor has passed is not merged again.
    CursorState(state).seed("2")
    assert sync_stream(i, options, f"file://{tmp_path}/checkpoint") == 2 and CursorState(state).read()[0] == "3"


def test_run_that_outlived_its_lease_keeps_the_cursor(setup, state, monkeypatch):
    i, log, _ = setup()
    monkeypatch.setattr(Lease, "verify", lambda self: (_ for _ in ()).throw(LeaseHeld("expired")))
    with pytest.raises(LeaseHeld, match="expired"):
        sync_once(i, log)
    assert CursorState(state).read()[0] == "0"


def test_truthy_tombstones_and_whole_times():
    deleted = lambda v: raw_row(delta("t", "a", 1, _deleted=v), "c", 1, 0)[3]
    assert [deleted(v) for v in (True, 1, "true", False, 0, "", None)] == [True, True, True, False, False, False, False]
    assert raw_row(delta("t", "a", 5.0), "c", 1, 0)[2] == 5
    with pytest.raises(ValueError, match="whole number"):
        raw_row(delta("t", "a", 5.5), "c", 1, 0)


def test_requests_are_retried():
    calls, slept = [], []

    def flaky(url, headers, timeout):
        calls.append((url, headers))
        if len(calls) < 3:
            raise OSError("down")
        return [] if len(calls) == 3 else {"values": [{"_id": 1}, 3], "cursor": "9", "hasMore": True}

    log = ChangeLog("http://x/", "k", "Key", transport=flaky, sleep=slept.append)
    assert log.page("0") == ([{"_id": 1}], "9", True)
    assert calls[0][1] == {"Authorization": "Key k"} and slept == [0.6, 1.1, 2.1]
    with pytest.raises(RuntimeError, match="stays"):
        log.page("9")
    broken = ChangeLog("http://x", transport=lambda *a: 1 / 0, sleep=lambda _: None)
    with pytest.raises(RuntimeError, match="4 tries"):
        broken.schemas()


def test_chunk_limits():
    c = Chunk("0", merge_pages=2, merge_rows=10)
    assert c.add([delta("t", "a", 1)], "1", True, 0) == 1 and not c.full()
    c.add([], "2", True, 1)
    assert c.full() and c.pages[1]["start_cursor"] == "1"
    assert Chunk("0").limits == (1, 5000, 100)


def test_window_and_turns():
    assert in_window(8, 7, 12) and not in_window(12, 7, 12) and in_window(23, 22, 3) and in_window(2, 22, 3) and in_window(5, 4, 4)
    noon = datetime.datetime(2024, 1, 8, 13, tzinfo=datetime.UTC).timestamp()
    action, table, moved = next_due({}, ["a", "b"], Plan(), noon)
    assert (action.name, table, moved["turn"], moved["turns"]) == ("optimize_indices", "a", 1, {"optimize_indices": 1})
    # Heavy actions wait for their window, so the turn goes back to the light one and its next table.
    assert next_due(moved, ["a", "b"], Plan(), noon)[:2] == (action, "b")
    morning = noon - 4 * 3600
    assert next_due(moved, ["a", "b"], Plan(), morning)[0].name == "compact_files"
    done = {"done": {"optimize_indices": {"a": noon, "b": noon}}}
    assert next_due(done, ["a", "b"], Plan(), noon + 10) is None


def test_idle_pass(spark, store, state):
    store.overwrite("t", spark.range(3))
    stats = {"rows_accepted": 0, "pages": 1}
    assert not idle_pass(store, state, Plan(), {"rows_accepted": 1, "pages": 1})

    def fails(*a):
        raise OSError("no")

    assert idle_pass(store, state, Plan(), stats, clock=lambda: 1e9, run=fails)
    assert idle_pass(store, state, Plan(), stats, clock=lambda: 1e9)
    have = state.get(KEY)[0]
    assert len(have["failures"]) == 1 and have["done"]["optimize_indices"] == {"t": 1e9}
    t = TouchedTables(pages=2, clock=lambda: 0)
    t.add({"t"}, {"pages": 2, "rows_accepted": 0})
    assert t.due() and t.optimize(store) == ["t"] and not t.due()
