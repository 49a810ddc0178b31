r"""SimHash near-dedup: fingerprints linked through BK-trees.

A document's words are ``[^\x20\x09-\x0D]+`` after A-Z are lower-cased; its features are the
XXH64 (seed 42) of its word shingles, repeats included. A fingerprint bit is 1 if it is set in
over half of them.

Two fingerprints within ``radius`` bits agree on at least one of any ``radius + 1`` disjoint blocks of bits. Each distinct
fingerprint goes to a shard for each of so many blocks, as wide as leaves about ``TREE`` members to a shard on average. A shard has a
BK-tree, whose children are keyed by the integer Hamming distance to the parent, and each of its members
searches it along the edges within the radius. A shard above ``SHARD`` members is dealt anew by blocks of the bits that its members need not share,
and so on, which ends as the bits do. The trees meet their queries in the shard's task instead of a driver's broadcast, which would have to carry
every fingerprint through the driver to every task.

Defined results: null and empty texts have no words, fingerprint zero and links like any other; a null doc_id
keeps its row and never names a component unless all ids of the component are null; repeated rows stay;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import delete_dir, join_classes, own_columns, stored, table, utf8, written
from palimpsest.llm.components import components

RADIUS = 2
WORDS = 3
#: Members of a shard on average, and up to which it keeps one tree.
TREE, SHARD = 512, 16384
#: Shingles hashed at a time, and pairs of query and node followed at a time.
PIECE, FRONT = 1 << 16, 1 << 18


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The SimHash of one text, unsigned."""
    w = text.lower().split()
    if not w:
        return 0
    if len(w) < words:
        return xxhash.xxh64_intdigest(b" ".join(w), seed=42)
    total, ones = len(w) - words + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, PIECE):
        part = w[at : at + PIECE + words - 1]
        h = np.array([digest(b" ".join(s), seed=42) for s in zip(*(part[i:] for i in range(words)), strict=False)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) of each document."""
    rows = own_columns(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in utf8(b.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, fp long")


class BKForest:
    """BK-trees of several shards, grown and searched level by level over arrays."""

    def __init__(self, shard: np.ndarray, key: np.ndarray) -> None:
        """shard: sorted; key: the distinct fingerprints of each shard, uint64."""
        self.key, n = key, len(key)
        first = np.r_[True, shard[1:] != shard[:-1]] if n else np.zeros(0, bool)
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, np.int64)
        node, wait = self.root.copy(), np.flatnonzero(~first)
        parents, edges, children = [], [], []
        while len(wait):
            d = np.bitwise_count(key[wait] ^ key[node[wait]]).astype(np.int64)
            slot = node[wait] * 65 + d
            # The first that waits at a free edge becomes its child; the others go down to it.
            slots, at, group = np.unique(slot, return_index=True, return_inverse=True)
            child = wait[at]
            parents.append(slots // 65)
            edges.append(slots % 65)
            children.append(child)
            node[wait] = child[group]
            wait = np.delete(wait, at)
        none = np.zeros(0, np.int64)
        slot = np.concatenate([p * 65 + e for p, e in zip(parents, edges, strict=True)] or [none])
        order = np.argsort(slot, kind="stable")
        self.slot, self.child = slot[order], np.concatenate(children or [none])[order]

    def within(self, x: np.uint64, radius: int) -> np.ndarray:
        """Of a forest of one tree the members within the radius of a fingerprint."""
        out, node = [], self.root[:1]
        while len(node):
            d = np.bitwise_count(self.key[node] ^ x).astype(np.int64)
            out.append(node[d <= radius])
            lo = np.searchsorted(self.slot, node * 65 + np.maximum(d - radius, 0))
            many = np.searchsorted(self.slot, node * 65 + np.minimum(d + radius, 64), side="right") - lo
            node = self.child[np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def pairs(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (member, member found) within the radius, in pieces; each member searches its shard's tree."""
        for at in range(0, len(self.key), FRONT):
            stack = [(q := np.arange(at, min(at + FRONT, len(self.key))), self.root[q])]
            while stack:
                q, node = stack.pop()
                d = np.bitwise_count(self.key[q] ^ self.key[node]).astype(np.int64)
                hit = (d <= radius) & (q != node)
                if hit.any():
                    yield q[hit], node[hit]
                lo = np.searchsorted(self.slot, node * 65 + np.maximum(d - radius, 0))
                hi = np.searchsorted(self.slot, node * 65 + np.minimum(d + radius, 64), side="right")
                many = hi - lo
                ends = np.cumsum(many)
                cuts = np.searchsorted(ends, np.arange(FRONT, (ends[-1] if len(ends) else 0) + FRONT, FRONT))
                start = 0
                for cut in np.minimum(cuts + 1, len(q)):
                    if cut > start and (total := int(many[start:cut].sum())):
                        ids = np.arange(total) - np.repeat(np.cumsum(many[start:cut]) - many[start:cut], many[start:cut])
                        stack.append((np.repeat(q[start:cut], many[start:cut]), self.child[np.repeat(lo[start:cut], many[start:cut]) + ids]))
                    start = max(start, cut)


def spanning_links(shard: np.ndarray, key: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (key, smallest key of its group) that join what the trees of these shards link: no link is lost, but no clique is written out."""
    forest = BKForest(shard, key)
    low = np.arange(len(key))
    order = np.argsort(key.view(np.int64), kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(key))

    def tops(x: np.ndarray) -> np.ndarray:
        while True:
            up = low[x]
            if (up == x).all():
                return x
            x = up

    for a, b in forest.pairs(radius):
        a, b = rank[a], rank[b]
        while len(a):
            a, b = tops(a), tops(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
    top = tops(np.arange(len(key)))
    far = np.flatnonzero(top != np.arange(len(key)))
    return key[order[far]], key[order[top[far]]]


def _shard_links(rows: DataFrame, radius: int) -> DataFrame:
    """``u, v`` links from rows ``shard, fp``; a shard is searched in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out(block: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            shard, fp = (np.concatenate([x[i] for x in block]) for i in range(2))
            u, v = spanning_links(shard, fp.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            shard, fp = b.column("shard").to_numpy(), b.column("fp").to_numpy()
            # Whole shards only: what the last shard of this batch has may go on in the next.
            start = np.flatnonzero(shard != shard[-1])
            cut = int(start[-1]) + 1 if len(start) else 0
            if cut and size + cut >= SHARD:
                yield out([*held, (shard[:cut], fp[:cut])])
                held, size = [], 0
                shard, fp = shard[cut:], fp[cut:]
            held.append((shard, fp))
            size += len(fp)
        if held:
            yield out(held)

    return rows.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(run, "u long, v long")


def blocks_of(free: int, width: int, count: int) -> list[int]:
    """``count`` disjoint masks of ``width`` of the bits ``free``."""
    bits = [i for i in range(64) if free >> i & 1]
    return [sum(1 << x for x in bits[i * width : (i + 1) * width]) for i in range(count)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD, tree: int = TREE) -> DataFrame:
    """Links between the distinct fingerprints ``fp`` of a table, spanning each near group; written, so that nothing is searched twice."""
    spark, count = distinct.sparkSession, radius + 1
    total = distinct.count()
    width, free = max(1, min(64 // count, round(math.log2(max(2, total / tree))))), 64
    rest = distinct.select("fp", F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("used"))
    masks, done, folders = [0], [], []
    while True:
        # What a fingerprint shares with its shard so far is its bits under ``used``; each way to get there has blocks of its own.
        ways = {m: blocks_of(~m & (1 << 64) - 1, width, count) for m in masks}
        block = None
        for m, found in ways.items():
            new = F.array(*[F.struct(F.xxhash64("shard", F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(b)).cast("long"))).alias("shard"), F.lit(_signed(m | b)).cast("long").alias("used")) for i, b in enumerate(found)])
            at = F.col("used") == F.lit(_signed(m)).cast("long")
            block = F.when(at, new) if block is None else block.when(at, new)
        dealt, path = stored(rest.select("fp", F.explode(block).alias("s")).select("fp", "s.shard", "s.used"), "shards")
        folders.append(path)
        sizes, path = stored(dealt.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard).select("shard"), "hot-shards")
        folders.append(path)
        free -= width
        # So few free bits cannot make more members than a tree may have.
        if 1 << free <= SHARD or sizes.isEmpty():
            done.append(dealt.select("shard", "fp"))
            break
        done.append(dealt.join(sizes, "shard", "left_anti").select("shard", "fp"))
        rest = dealt.join(sizes, "shard", "left_semi")
        masks = sorted({m | b for m, found in ways.items() for b in found})
        width = min(free // count, free - 1)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    found = written(_shard_links(out, radius), "near-links")
    delete_dir(spark, *folders)
    return found


def near_groups(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` of each document."""
    prints = written(fingerprints(docs, words), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", "n", F.coalesce("root", "fp").alias("root"))
    named = written(named, "near-classes")
    lowest = written(named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n")), "near-roots")
    classes = written(join_classes(named.withColumnRenamed("n", "rows"), lowest, "root").select("fp", "component_id", F.col("rows").alias("n")), "classes")
    return join_classes(prints, classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents without near copies by fingerprint: whole rows of the smallest doc_id of each group.

    Of rows that repeat this id, the first by text and then by a hash of the row stays. Rows without an id
    cannot be chosen by one: they stay, once for each text.
    """
    groups = near_groups(docs, words, radius)
    chosen = groups.where("component_id is not null").select(F.col("component_id").alias("doc_id")).distinct()
    row = [F.col(f"`{c}`") for c in docs.columns]
    first = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first(), F.xxhash64(*row))
    named = docs.join(chosen, "doc_id", "left_semi").withColumn("__rank", F.row_number().over(first)).where("__rank = 1")
    unnamed = docs.where("doc_id is null").dropDuplicates(["text"])
    return named.select(*row).unionByName(unnamed)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
