"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased, ASCII punctuation becomes a space and white space is collapsed. One rule holds for items of all lengths from ``LEAST`` characters on: a
text holds an item if it has, with at most ``EDITS`` edits a character, one of the item's windows. These are three quarters as long
as ``SHARE`` of the item, or as ``STRETCH`` characters if that is less, and stand so close that any stretch of that share or of so many characters holds a whole
window. Shorter items leave no room for edits and must stand in the text exactly, between word bounds.

A window of m characters that occurs with at most k edits shares at least m - q + 1 - k q of its character q-grams with its region, all on diagonals that
differ by k at most. So shared q-grams are counted in overlapping bands of diagonals, bands that reach the bound are retained, and a banded alignment
verifies them. Before hits are spread over windows, stretches of a text that cannot hold the smallest bound of any
window are left out, which loses nothing.

A benchmark of up to ``BLOCK`` characters is one broadcast, which each worker indexes once. A larger one is cut into such blocks; each meets all documents in a
pass of its own, which gives only the hashes of texts that hold something, and these are joined back at the end.

Defined results: null and empty texts match nothing; a null item text matches nothing, nor does one without letters or digits;
items with null ids are not listed but count in ``n_items``, once for each text; repeated items count
once by id; repeated documents are judged each; empty tables give no matches or no rows; all columns of the documents are kept, except that a column named
``item_ids`` or ``n_items`` is replaced; item ids keep their type.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from palimpsest.llm.common import own_columns, table, written

Q = 8
#: Share of an item, and characters of a longer one, that are surely found; characters below which items must stand exactly.
SHARE, STRETCH, LEAST = 0.8, 160, 40
#: Edits per character of a window that still count as a copy.
EDITS = 0.08
#: Characters of benchmark in an index, and positions of a text looked at together.
BLOCK, PIECE = 2_000_000, 1 << 20
_FLAT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalized(text: str) -> str:
    return b" ".join(text.lower().encode().translate(_FLAT).split()).decode()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_codes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit code of each q-gram; equal grams have equal codes, and an alignment settles the rest."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Codes of 1, 2, 4, ... characters double up; the bits of q choose which to append.
    wide, size, out, done = points.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if q & size:
            part = wide[done : done + n]
            out = part if out is None else (out * _MIX) ^ part
            done += size
        if 2 * size > q:
            return out * _MIX
        wide = (wide[:-size] * _MIX) ^ (wide[size:] + (wide[:-size] >> np.uint64(29)))
        size *= 2


@dataclass
class Pattern:
    item: Any
    text: str
    edits: int
    bound: int
    source: int  # number of the item among those of its block
    whole: bool = False  # must stand between word bounds


def patterns(items: list[tuple[Any, str | None]]) -> list[Pattern]:
    """The windows of all items, or a short item as a whole."""
    out = []
    for source, (item, text) in enumerate(items):
        t = normalized(text or "")
        if 0 < len(t) < LEAST:
            out.append(Pattern(item, t, 0, len(t) - Q + 1, source, True))
        elif t:
            sure = min(STRETCH, math.ceil(SHARE * len(t)))
            size = sure - sure // 4
            for s in sorted({*range(0, len(t) - size, sure // 4 + 1), len(t) - size}):
                k = int(size * EDITS)
                out.append(Pattern(item, t[s : s + size], k, size - Q + 1 - k * Q, source))
    return out


def banded_distance(pattern: np.ndarray, text: np.ndarray, first: int, last: int) -> int:
    """Fewest edits that turn the pattern into any stretch of ``text``, over diagonals (text minus pattern position) first to last."""
    width = last - first + 1
    offs = np.arange(width)
    padded = np.r_[np.full(width, 0xFFFFFFFF, np.uint32), text, np.full(width + len(pattern), 0xFFFFFFFF, np.uint32)]
    cost = np.zeros(width, np.int64)
    # A start before or after the text is as good as one at its ends: those characters are edits.
    for i, c in enumerate(pattern.tolist()):
        at = first + i + width
        window = padded[max(at, 0) : max(at, 0) + width] if 0 <= at <= len(padded) - width else np.full(width, 0xFFFFFFFF, np.uint32)
        step = cost + (window != c)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(step - offs) + offs
    return int(cost.min())


class PatternIndex:
    """Q-grams of a block of patterns, and the search of texts for them."""

    def __init__(self, found: list[Pattern]) -> None:
        self.patterns = found
        # Items of fewer characters than a q-gram: by the number of their words.
        self.short: dict[int, dict[str, list[int]]] = {}
        for i, p in enumerate(found):
            if len(p.text) < Q:
                self.short.setdefault(p.text.count(" ") + 1, {}).setdefault(p.text, []).append(i)
        codes = [gram_codes(code_points(p.text)) for p in found]
        code = np.concatenate(codes or [np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(found), dtype=np.int32), [len(c) for c in codes] or [0]) if found else np.zeros(0, np.int32)
        pos = np.concatenate([np.arange(len(c), dtype=np.int32) for c in codes] or [np.zeros(0, np.int32)])
        order = np.argsort(code, kind="stable")
        self.codes, self.start, self.count = np.unique(code[order], return_index=True, return_counts=True)
        self.owner, self.pos = owner[order], pos[order]
        bits = 16 + int(np.ceil(np.log2(max(1, len(self.codes) / 2048))))
        self.shift = np.uint64(64 - min(28, bits))
        self.maybe = np.zeros(1 << min(28, bits), bool)
        self.maybe[(self.codes >> self.shift).astype(np.int64)] = True
        # Patterns of like length share a bound and a reach: the smallest bound and the longest reach among them.
        self.classes = []
        kind = [(p.whole, len(p.text) // 40) for p in found]
        for c in sorted({x for x, p in zip(kind, found, strict=True) if len(p.text) >= Q}):
            some = [p for x, p in zip(kind, found, strict=True) if x == c and len(p.text) >= Q]
            inside = np.array([x == c for x in kind])[self.owner]
            has = np.add.reduceat(inside, self.start) > 0
            self.classes.append((min(p.bound for p in some), max(len(p.text) + 2 * p.edits for p in some), has))
        self.reach = max((r for _, r, _ in self.classes), default=0)
        self.edits = np.array([p.edits for p in found] or [0])
        self.bounds = np.array([p.bound for p in found] or [0])

    def search(self, text: str) -> list[int]:
        """Numbers of the patterns that the text holds."""
        flat = normalized(text)
        found: set[int] = set()
        words = flat.split(" ") if self.short else []
        for n, short in self.short.items():
            for gram in zip(*(words[i:] for i in range(n)), strict=False):
                found.update(short.get(" ".join(gram), ()))
        points = code_points(flat)
        # Pieces overlap by what the longest pattern reaches, and by the character before.
        for at in range(0, max(1, len(points) - Q + 1), PIECE) if len(self.codes) else ():
            end = at + PIECE + self.reach + Q
            found |= self._piece(points[max(0, at - 1) : end], found, (at == 0, end >= len(points)))
        return sorted(found)

    def _piece(self, points: np.ndarray, known: set[int], ends: tuple[bool, bool]) -> set[int]:
        """``ends``: whether the text begins and ends with the piece."""
        code = gram_codes(points)
        where = np.flatnonzero(self.maybe[(code >> self.shift).astype(np.int64)])
        if not len(where):
            return set()
        k = np.searchsorted(self.codes, code[where])
        hit = self.codes[np.minimum(k, len(self.codes) - 1)] == code[where]
        where, k = where[hit], k[hit]
        # A region needs ``bound`` positions that hit patterns of its class within ``reach``; others cannot be part of one.
        keep = np.zeros(len(where), bool)
        for bound, reach, has in self.classes:
            own = np.flatnonzero(has[k])
            at = where[own]
            dense = np.flatnonzero(at[bound - 1 :] - at[: max(0, len(at) - bound + 1)] <= reach)
            if len(dense):
                mark = np.zeros(len(own) + 1, np.int64)
                np.add.at(mark, dense, 1)
                np.add.at(mark, dense + bound, -1)
                keep[own[np.cumsum(mark[:-1]) > 0]] = True
        if not keep.any():
            return set()
        where, k = where[keep], k[keep]
        out: set[int] = set()
        # Whole runs of neighbouring hits are spread at a time, so memory stays bounded.
        run = np.r_[0, np.flatnonzero(np.diff(where) > self.reach) + 1, len(where)]
        for lo, hi in zip(run[:-1].tolist(), run[1:].tolist(), strict=True):
            for s in range(lo, hi, 4096):
                # A part goes on until it has the reach of its last position too.
                e = int(np.searchsorted(where, where[min(s + 4096, hi) - 1] + self.reach, side="right"))
                out |= self._bands(points, where[s : min(e, hi)], k[s : min(e, hi)], known | out, ends)
        return out

    def _bands(self, points: np.ndarray, where: np.ndarray, k: np.ndarray, known: set[int], ends: tuple[bool, bool]) -> set[int]:
        many = self.count[k]
        total = int(many.sum())
        entry = np.repeat(self.start[k], many) + np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        owner, diagonal = self.owner[entry], np.repeat(where, many) - self.pos[entry]
        span = 2 * self.edits[owner] + 1
        base = diagonal + (1 << 20)
        out: set[int] = set()
        # Bands of 2 spans, a span apart: diagonals that differ by k share a band.
        for half in range(2):
            band = (base + half * span) // (2 * span)
            key = owner.astype(np.int64) << 32 | band
            keys, n = np.unique(key, return_counts=True)
            own = keys >> 32
            for j in np.flatnonzero(n >= self.bounds[own]).tolist():
                p = int(own[j])
                if p in known or p in out:
                    continue
                # What the lemma counts are places of the pattern; a repetitive text can hit one many times.
                if len(np.unique(self.pos[entry[key == keys[j]]])) < self.bounds[p]:
                    continue
                s = 2 * int(self.edits[p]) + 1
                first = int(keys[j] & 0xFFFFFFFF) * 2 * s - half * s - (1 << 20)
                if self._verified(points, p, first, first + 2 * s - 1, ends):
                    out.add(p)
        return out

    def _verified(self, points: np.ndarray, p: int, first: int, last: int, ends: tuple[bool, bool]) -> bool:
        pattern, k = code_points(self.patterns[p].text), self.patterns[p].edits
        if self.patterns[p].whole:
            n = len(pattern)
            for s in range(max(0, first), min(last, len(points) - n) + 1):
                left = points[s - 1] == 32 if s else ends[0]
                right = points[s + n] == 32 if s + n < len(points) else ends[1]
                if left and right and (points[s : s + n] == pattern).all():
                    return True
            return False
        lo, hi = max(0, first - k), min(len(points), last + len(pattern) + k)
        region = points[lo:hi]
        if pattern.tobytes() in region.tobytes():
            return True
        return banded_distance(pattern, region, first - k - lo, last + k - lo) <= k


_indexes: dict[str, PatternIndex] = {}


def _index(shared: Broadcast) -> PatternIndex:
    """A worker's index of a block: one at a time, built once for all of the worker's tasks."""
    name, items = shared.value
    if name not in _indexes:
        _indexes.clear()
        _indexes[name] = PatternIndex(patterns(items))
    return _indexes[name]


def _blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[Any, str]]]:
    """The items, about ``block`` characters at a time."""
    items = own_columns(benchmark, "item_id", "text").where("text is not null").distinct()
    size = F.char_length("text") + 1
    total, longest = items.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    # Half-filled blocks on average; an item that alone is above a block cannot be split off by a hash.
    count = -(-2 * total // max(block, longest)) if total > block else 1
    for b in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b) if count > 1 else items
        got = [(r["item_id"], r["text"]) for r in part.collect()]
        if got or count == 1:
            yield sorted(got, key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1]))


def _held(index: PatternIndex, texts: list[str | None]) -> tuple[list[list], list[int]]:
    """Ids of the items that each text holds, and their number with those without an id."""
    ids, n = [], []
    for text in texts:
        found = {(index.patterns[p].item, None if index.patterns[p].item is not None else index.patterns[p].source) for p in index.search(text or "")}
        known = sorted(i for i, _ in found if i is not None)
        ids.append(known)
        n.append(len(found))
    return ids, n


def with_matches(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """All columns of ``docs``, with ``item_ids`` (sorted ids of the items it holds) and ``n_items``."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("item_ids", "n_items")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    kind = benchmark.schema["item_id"].dataType
    list_, id_list = pa.list_(to_arrow_type(kind)), f"array<{kind.simpleString()}>"
    shares = [spark.sparkContext.broadcast((uuid.uuid4().hex, items)) for items in _blocks(benchmark, block)]
    if len(shares) == 1:
        out = docs.select("*", F.lit(None).cast(id_list).alias("item_ids"), F.lit(0).cast("long").alias("n_items"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shares[0])
            for b in batches:
                ids, n = _held(index, b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, list_), pa.array(n, pa.int64())], [*names, "item_ids", "n_items"])

        return docs.mapInArrow(run, out.schema)
    # The texts' own hashes stand for them, so that a pass writes next to nothing.
    place = [F.xxhash64("text").alias("__a"), F.xxhash64(F.lit(1), "text").alias("__b")]
    hits = None
    for shared in shares:

        def search(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            index = _index(shared)
            for b in batches:
                ids, n = _held(index, b.column("text").to_pylist())
                some = pa.array([i for i, k in enumerate(n) if k], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("__a").take(some), b.column("__b").take(some), pa.array(ids, list_).take(some), pa.array(n, pa.int64()).take(some)], ["__a", "__b", "ids", "n"])

        found = written(docs.select("text", *place).mapInArrow(search, f"__a long, __b long, ids {id_list}, n long").distinct(), "leaks")
        hits = found if hits is None else hits.unionByName(found)
    # An id can stand in two blocks with two texts; rows without an id count by text.
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids"))))
    merged = hits.groupBy("__a", "__b").agg(ids.alias("item_ids"), F.sum(F.col("n") - F.size("ids")).alias("others"))
    merged = merged.select("__a", "__b", "item_ids", (F.size("item_ids") + F.col("others")).cast("long").alias("n_items"))
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    joined = docs.select(*own, *place).join(merged, ["__a", "__b"], "left")
    return joined.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.coalesce("item_ids", F.array().cast(id_list)).alias("item_ids"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, in its columns."""
    row = [F.col(f"`{c}`").alias(f"c{i}" if c != "text" else "text") for i, c in enumerate(docs.columns)]
    kept = with_matches(docs.select(*row), benchmark).where("n_items = 0")
    return kept.select(*[F.col(f"c{i}" if c != "text" else "text").alias(c) for i, c in enumerate(docs.columns)])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = own_columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "item_ids")
