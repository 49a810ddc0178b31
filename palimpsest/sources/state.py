"""Driver-side state: JSON values with compare-and-swap, the cursor, and leases."""

from __future__ import annotations

import json
import os
import socket
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession

from palimpsest.sources.files import Files

Json = dict[str, Any]


class Conflict(RuntimeError):
    """Someone else has written since the value was read."""


class StateStore:
    """JSON values by key. Each write is a new numbered file, whose exclusive creation is the swap."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 5) -> None:
        self.files, self.root, self.keep = Files(spark), root.rstrip("/"), keep

    def _tags(self, key: str) -> list[str]:
        return [n for n in self.files.names(f"{self.root}/{key}") if n.endswith(".json")]

    def get(self, key: str) -> tuple[Json | None, str | None]:
        """Value and tag; (None, tag) after a delete, (None, None) if it never was."""
        tags = self._tags(key)
        # A torn newest file still counts as the tag: the next swap goes above it.
        return self.files.newest_json(f"{self.root}/{key}", tags)[1], tags[-1] if tags else None

    def swap(self, key: str, value: Json | None, tag: str | None) -> str:
        """Write if the value still has ``tag`` (None: if there is none yet); returns the new tag."""
        tags = self._tags(key)
        if (tags[-1] if tags else None) != tag:
            raise Conflict(f"{key} has changed")
        new = f"{int(tag[:-5]) + 1 if tag else 1:012d}.json"
        if not self.files.create(f"{self.root}/{key}/{new}", json.dumps(value, sort_keys=True)):
            raise Conflict(f"{key} has changed")
        for old in tags[: -self.keep]:
            self.files.delete(f"{self.root}/{key}/{old}")
        return new

    def put(self, key: str, value: Json | None, tries: int = 8) -> str:
        """Write whatever is there."""
        for left in reversed(range(tries)):
            try:
                return self.swap(key, value, self.get(key)[1])
            except Conflict:
                if not left:
                    raise
        raise Conflict(key)

    def delete(self, key: str) -> None:
        if self.get(key)[0] is not None:
            self.put(key, None)

    def append_line(self, key: str, value: Json) -> None:
        """One audit record in a file of its own."""
        self.files.create(f"{self.root}/{key}", json.dumps(value, sort_keys=True) + "\n")


class LeaseHeld(RuntimeError):
    pass


class Lease:
    """One owner at a time for a name; taken over by compare-and-swap once its time has passed."""

    def __init__(self, state: StateStore, name: str, ttl: float = 300, clock: Callable[[], float] = time.time) -> None:
        self.state, self.key, self.name, self.ttl, self.clock = state, f"locks/{name}", name, ttl, clock
        self.owner = f"{socket.gethostname()}:{os.getpid()}:{int(clock() * 1000)}"

    def _value(self, created: float) -> Json:
        now = self.clock()
        return {"table": self.name, "owner": self.owner, "created_at": created, "updated_at": now, "expires_at": now + self.ttl}

    def acquire(self, force: bool = False) -> Lease:
        have, tag = self.state.get(self.key)
        if have and have["expires_at"] > self.clock() and not force:
            raise LeaseHeld(f"{self.name} is held by {have['owner']}")
        try:
            self.state.swap(self.key, self._value(self.clock()), tag)
        except Conflict:
            raise LeaseHeld(f"{self.name} was taken by another") from None
        return self

    def verify(self) -> Json:
        """The lease, if it is still held and its time has not passed."""
        have, _ = self.state.get(self.key)
        if not have or have["owner"] != self.owner:
            raise LeaseHeld(f"{self.name} is no longer held by {self.owner}")
        if have["expires_at"] <= self.clock():
            raise LeaseHeld(f"the lease of {self.owner} on {self.name} has expired")
        return have

    @contextmanager
    def kept(self) -> Iterator[None]:
        """Renewed on a thread of its own while the block runs; a renewal that fails is told by the next ``verify``."""
        over = threading.Event()

        def renew() -> None:
            while not over.wait(self.ttl / 3):
                try:
                    self.heartbeat()
                except Exception:  # taken, or the store is away: the lease runs out
                    return

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            over.set()
            thread.join()

    def heartbeat(self) -> None:
        have, tag = self.state.get(self.key)
        if not have or have["owner"] != self.owner:
            raise LeaseHeld(f"{self.name} is no longer held by {self.owner}")
        self.state.swap(self.key, self._value(have["created_at"]), tag)

    def release(self) -> None:
        """Only the owner's lease goes."""
        have, _ = self.state.get(self.key)
        if have and have["owner"] == self.owner:
            self.state.delete(self.key)

    def __enter__(self) -> Lease:
        return self.acquire()

    def __exit__(self, *_: object) -> None:
        self.release()


class CursorState:
    """The committed position of the change log; it must be seeded before the first run."""

    def __init__(self, state: StateStore, key: str = "incremental/cursor") -> None:
        self.state, self.key = state, key

    def seed(self, cursor: str) -> None:
        self.state.swap(self.key, {"cursor": cursor}, self.state.get(self.key)[1])

    def read(self) -> tuple[str, str]:
        value, tag = self.state.get(self.key)
        if not value or not value.get("cursor") or tag is None:
            raise RuntimeError(f"no cursor at {self.key}: seed it first")
        return value["cursor"], tag

    def advance(self, before: str, after: str, tag: str, owner: str, pages: int) -> str:
        value = {"cursor": after, "previous_cursor": before, "owner": owner, "pages_processed": pages, "updated_at": time.time()}
        return self.state.swap(self.key, value, tag)
