"""What to do while the log is idle: index order, compaction, old versions."""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.sources.state import StateStore
from palimpsest.sources.store import VersionedStore

KEY = "incremental/maintenance_state"


@dataclass(frozen=True)
class Action:
    name: str
    cadence: float
    heavy: bool


@dataclass(frozen=True)
class Plan:
    """Cadences in seconds (0: never); heavy actions only inside the window of UTC hours."""

    optimize: float = 3_600
    compact: float = 86_400
    cleanup: float = 604_800
    window: tuple[int, int] = (7, 12)
    keep: int = 500
    older_than: float = 259_200
    most_rows: int = 0
    most_pages: int = 1

    def actions(self) -> list[Action]:
        return [Action("optimize_indices", self.optimize, False), Action("compact_files", self.compact, True), Action("cleanup_old_versions", self.cleanup, True)]


def in_window(hour: int, start: int, end: int) -> bool:
    """Hours from start up to end, past midnight if end is smaller; equal ends mean always."""
    return start == end or (start <= hour < end if start < end else hour >= start or hour < end)


def in_window_column(ts: Column, start: int, end: int) -> Column:
    hour = F.hour(ts)
    if start == end:
        return F.lit(True)
    return (hour >= start) & (hour < end) if start < end else (hour >= start) | (hour < end)


def is_idle(stats: dict[str, Any], plan: Plan) -> bool:
    return stats["rows_accepted"] <= plan.most_rows and stats["pages"] <= plan.most_pages


def next_due(state: dict[str, Any], tables: list[str], plan: Plan, now: float) -> tuple[Action, str, dict[str, Any]] | None:
    """Of all pairs of action and table that are due the one whose turn is next, and the state with both turns moved on; None if nothing is due.

    Actions take turns, and for each action the tables do. A pair is due once its action's cadence has passed since it was last done.
    """
    actions = plan.actions()
    hour = datetime.datetime.fromtimestamp(now, datetime.UTC).hour
    may = [a.cadence > 0 and (not a.heavy or in_window(hour, *plan.window)) for a in actions]
    turns, done = state.get("turns", {}), state.get("done", {})

    def wait(item: tuple[int, int]) -> tuple[int, int]:
        """How many actions, and then tables, go before."""
        i, j = item
        return (i - state.get("turn", 0)) % len(actions), (j - turns.get(actions[i].name, 0)) % len(tables)

    due = [(i, j) for i, a in enumerate(actions) if may[i] for j, t in enumerate(tables) if now - done.get(a.name, {}).get(t, 0) >= a.cadence]
    if not due:
        return None
    i, j = min(due, key=wait)
    return actions[i], tables[j], {**state, "turn": i + 1, "turns": {**turns, actions[i].name: j + 1}}


def run_action(store: VersionedStore, action: str, table: str, plan: Plan) -> Any:
    if action == "cleanup_old_versions":
        return store.vacuum(table, plan.keep, plan.older_than)
    done = store.compact(table)
    return done.version if done else None


def idle_pass(store: VersionedStore, state: StateStore, plan: Plan, stats: dict[str, Any], clock: Callable[[], float] = time.time, run: Callable[..., Any] = run_action) -> bool:
    """At most one unit of work; a failure is kept among the last 20 and leaves the pair due."""
    if not is_idle(stats, plan):
        return False
    have, tag = state.get(KEY)
    due = next_due(have or {}, store.tables(), plan, clock())
    if due is None:
        return False
    action, table, moved = due
    began = clock()
    record: dict[str, Any] = {"ts": began, "action": action.name, "table": table, "target": f"{store.root}/{table}"}
    try:
        record |= {"status": "ok", "result": run(store, action.name, table, plan)}
        done = moved.get("done", {})
        moved["done"] = {**done, action.name: {**done.get(action.name, {}), table: clock()}}
    except Exception as e:  # maintenance must not stop the loop
        record |= {"status": "failed", "error": str(e)[:500]}
        moved["failures"] = [*moved.get("failures", []), record][-20:]
    record["elapsed"] = clock() - began
    day = datetime.datetime.fromtimestamp(began, datetime.UTC).strftime("%Y/%m/%d")
    state.append_line(f"incremental/maintenance-audit/{day}/{int(began * 1000)}-{action.name}-{table}-{uuid.uuid4().hex[:8]}.jsonl", record)
    state.swap(KEY, moved, tag)
    return True


class TouchedTables:
    """Tables merged since the last optimisation; due by pages, rows or time, whichever comes first."""

    def __init__(self, pages: int = 50, rows: int = 5_000, seconds: float = 900, clock: Callable[[], float] = time.time) -> None:
        self.limits, self.clock = (pages, rows, seconds), clock
        self.tables: set[str] = set()
        self.pages = self.rows = 0
        self.since = clock()

    def add(self, tables: set[str], stats: dict[str, Any]) -> None:
        self.tables |= tables
        self.pages += stats["pages"]
        self.rows += stats["rows_accepted"]

    def due(self) -> bool:
        pages, rows, seconds = self.limits
        return bool(self.tables) and (self.pages >= pages or self.rows >= rows or self.clock() - self.since >= seconds)

    def optimize(self, store: VersionedStore) -> list[str]:
        done = sorted(self.tables)
        for t in done:
            store.compact(t)
        self.tables.clear()
        self.pages = self.rows = 0
        self.since = self.clock()
        return done
