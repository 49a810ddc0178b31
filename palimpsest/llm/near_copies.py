r"""SimHash near-dedup at five-word shingles and a Jaccard similarity of 0.8 or more, for the pipeline's stage.

Words are those of ``simhash``; a text of fewer than ``WORDS`` words has one shingle, all of them. Texts of equal words are one
class. No block of bits of a 64-bit fingerprint is sure to stay equal at 0.8, where about ten bits differ, so classes are
dealt to shards by minima instead: a class goes to ``BANDS`` shards, each named by the minima of ``ROWS`` hash functions over its shingles; two
classes at 0.8 miss each other in all of them with a probability of 4e-4, and nearer ones with less. Shards of the same members are searched once. A shard has a BK-tree
of the SimHash fingerprints of its members, whose children are keyed by the integer Hamming distance to the parent;
a search follows only the edges within ``RADIUS`` bits, which two classes at 0.8 exceed about once in ten thousand times, and what it finds is held
against the whole sets of shingles. Links span what is linked in a shard, but no clique is written out; one row of each component stays.

A shard of over ``SHARD`` members or ``HELD`` shingles is dealt to parts of about that size, by a hash that differs from shard to shard, and about ``PIVOTS`` of its members go to all
parts: what is near to a common pivot is joined through it. Then the members of a split shard that are not in its largest component so far are held against all of its other parts, so any two members of a
shard have either met or are joined already, and no link within a shard is lost.

Defined results: null and empty texts are one class; rows without a doc_id join their class and stay only if no row of the component has
an id; of rows that repeat the smallest id in a component, the first by text and then by a hash of the row stays; unrelated rows of one id both
stay; an empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import delete_dir, spans, stored, words_of
from palimpsest.llm.components import components
from palimpsest.llm.simhash import BKForest

WORDS, LEAST = 5, 0.8
ROWS, BANDS = 5, 20
RADIUS = 21
SHARD, HELD, PIVOTS = 8192, 8_000_000, 128
#: Shingles whose minima are taken together, bytes of texts looked at together, and shingles of found members compared together.
PIECE, BLOCK, FOUND = 1 << 10, 4_000_000, 1 << 21
_ALL = (1 << 64) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS, _ODD = np.random.default_rng(5).integers(0, 1 << 64, (2, ROWS * BANDS), np.uint64)
_ODD |= np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """Of each text a key that texts of the same words share, and the sorted 64-bit hashes of its distinct shingles; none if it has no words."""
    texts = pc.ascii_lower(texts.fill_null(""))
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    for at, end in spans(size, BLOCK):
        names, index, starts = words_of(texts.slice(at, end - at))
        word = np.fromiter((xxhash.xxh64_intdigest(w, seed=42) for w in names), np.uint64, len(names))[index]
        # Shingles that start at each word; those that run over a text's end are not used.
        n = len(word) - words + 1
        whole = np.full(max(0, n), words, np.uint64)
        for i in range(words if n > 0 else 0):
            whole = mixed(whole * _MIX + word[i : i + n])
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if e - s >= words:
                found = np.unique(whole[s : e - words + 1])
            else:
                short = np.full(min(1, e - s), e - s, np.uint64)
                for i in range(s, e):
                    short = mixed(short * _MIX + word[i : i + 1])
                found = short
            yield xxhash.xxh3_64_intdigest(word[s:e].tobytes(), seed=42), found


def fingerprint(found: np.ndarray) -> int:
    """The SimHash of a set of shingles."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), 1 << 16):
        ones += np.unpackbits(found[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view(np.uint64)[0])


def shards(found: np.ndarray) -> np.ndarray:
    """A number for each band of a set of shingles."""
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), PIECE):
        np.minimum(low, ((found[at : at + PIECE, None] ^ _SEEDS) * _ODD).min(0), out=low)
    out = np.arange(BANDS, dtype=np.uint64)
    for part in low.reshape(BANDS, ROWS).T:
        out = mixed(out * _MIX + part)
    return out


def _shared(own: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many members of the sorted ``own`` each set has."""
    out, at = np.zeros(len(sets), np.int64), 0
    size = np.array([len(s) for s in sets])
    for at, end in spans(size, FOUND):
        codes = np.concatenate(sets[at:end])
        place = np.minimum(np.searchsorted(own, codes), len(own) - 1)
        out[at:end] = np.add.reduceat(own[place] == codes, np.r_[0, np.cumsum(size[at:end])[:-1]], dtype=np.int64)
    return out


def linked(sets: list[np.ndarray], prints: np.ndarray, least: float = LEAST, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs of places in ``sets`` (none empty) at ``least`` or above that span what is linked; ``prints``: their fingerprints, uint64."""
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:  # the tree is a root and an edge
        both = int(_shared(sets[0], sets[1:])[0]) if np.bitwise_count(prints[0] ^ prints[1]) <= radius else 0
        return [(0, 1)] if both and both >= least * (size.sum() - both) - 1e-9 else []
    keys, node = np.unique(prints, return_inverse=True)
    tree = BKForest(np.zeros(len(keys), np.int64), keys)
    order = np.argsort(node, kind="stable")
    first = np.r_[0, np.cumsum(np.bincount(node, minlength=len(keys)))]
    waiting, out = np.ones(len(sets), bool), []
    left = len(sets)
    for start in range(len(sets)):
        if not waiting[start]:
            continue
        waiting[start] = False
        left -= 1
        stack = [start]
        while stack and left:
            p = stack.pop()
            near = np.concatenate([order[first[x] : first[x + 1]] for x in tree.within(prints[p], radius).tolist()])
            near = near[waiting[near]]
            # Sets whose sizes are too far apart cannot reach ``least``.
            near = near[np.minimum(size[near], size[p]) >= least * np.maximum(size[near], size[p]) - 1e-9]
            if not len(near):
                continue
            both = _shared(sets[p], [sets[q] for q in near.tolist()])
            near = np.sort(near[both >= least * (size[near] + size[p] - both) - 1e-9])
            waiting[near] = False
            left -= len(near)
            out += [(p, q) for q in near.tolist()]
            stack += near.tolist()
    return out


def crossing(sets: list[np.ndarray], prints: np.ndarray, roots: np.ndarray, asked: Iterator[tuple[int, int, np.ndarray]], least: float = LEAST, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs of roots that join the components of ``asked`` (fingerprint, root, set) to those of ``sets`` (``prints``, ``roots``) that have a link to them.

    Components that a pair has joined are one from there on: the pairs span what is linked, and members of one component are not compared.
    """
    size = np.array([len(s) for s in sets])
    keys, node = np.unique(prints, return_inverse=True)
    tree = BKForest(np.zeros(len(keys), np.int64), keys)
    order = np.argsort(node, kind="stable")
    first = np.r_[0, np.cumsum(np.bincount(node, minlength=len(keys)))]
    roots, now, out = roots.copy(), {}, []
    for fp, root, own in asked:
        start = root
        while root in now:
            root = now[root]
        if root != start:
            now[start] = root
        near = np.concatenate([order[first[x] : first[x + 1]] for x in tree.within(np.uint64(fp), radius).tolist()] or [np.zeros(0, np.int64)])
        near = near[roots[near] != root]
        near = near[np.minimum(size[near], len(own)) >= least * np.maximum(size[near], len(own)) - 1e-9]
        if not len(near):
            continue
        both = _shared(own, [sets[q] for q in near.tolist()])
        for other in np.unique(roots[near[both >= least * (size[near] + len(own) - both) - 1e-9]]).tolist():
            out.append((root, other))
            now[other] = root
            roots[roots == other] = root
    return out


def _shard_links(members: DataFrame, least: float) -> DataFrame:
    """``u, v`` links from rows ``shard, part, key, fp, found``; a part of a shard is searched in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, prints, sets = None, [], [], []

        def out() -> Iterator[pa.RecordBatch]:
            if len(keys) > 1 and (pairs := linked(sets, np.array(prints, np.int64).view(np.uint64), least)):
                k, pairs_ = np.array(keys, np.int64), np.array(pairs, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k[pairs_[:, 0]]), pa.array(k[pairs_[:, 1]])], ["u", "v"])

        for b in batches:
            found = b.column("found")
            for i, (x, part, key, fp) in enumerate(zip(*(b.column(c).to_numpy().tolist() for c in ("shard", "part", "key", "fp")), strict=True)):
                if (x, part) != shard:
                    yield from out()
                    shard, keys, prints, sets = (x, part), [], [], []
                keys.append(key)
                prints.append(fp)
                # A copy: a view would keep the whole batch.
                sets.append(found[i].values.to_numpy().view(np.uint64).copy())
        yield from out()

    return members.repartition("shard", "part").sortWithinPartitions("shard", "part", "key").mapInArrow(run, "u long, v long")


def _cross_links(members: DataFrame, least: float) -> DataFrame:
    """``u, v`` links between roots from rows ``shard, part, lot, asks, root, fp, found``: rows that ask are held against those of their part and lot that do not, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                found = b.column("found")
                for i, row in enumerate(zip(*(b.column(c).to_pylist() for c in ("shard", "part", "lot", "asks", "root", "fp")), strict=True)):
                    yield (*row, found[i].values.to_numpy().view(np.uint64))

        for _, group in groupby(rows(), lambda r: r[:3]):
            prints, roots, sets, asked = [], [], [], iter(())
            for row in group:
                if row[3]:  # those that ask stand behind the others and are not kept
                    asked = chain([row], group)
                    break
                roots.append(row[4])
                prints.append(row[5])
                # A copy: a view would keep the whole batch.
                sets.append(row[6].copy())
            if sets and (pairs := crossing(sets, np.array(prints, np.int64).view(np.uint64), np.array(roots, np.int64), ((r[5] & _ALL, r[4], r[6]) for r in asked), least)):
                p = np.array(pairs, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["u", "v"])

    at = ("shard", "part", "lot")
    return members.repartition(*at).sortWithinPartitions(*at, "asks", "key").select(*at, "asks", "root", "fp", "found").mapInArrow(run, "u long, v long")


def keyed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` under the names c0, c1, ... and ``text``, with ``key``, ``fp``, ``size`` (shingles) and ``shards``."""
    names = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    out = rows.select("*", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("size"), F.array().cast("array<long>").alias("shards"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Without words there is nothing to be near to but the class itself.
            got = [(k, fingerprint(s), len(s), shards(s).view(np.int64) if len(s) else []) for k, s in shingles(b.column("text"))]
            numbers = [pa.array(np.array([g[i] for g in got], np.uint64).view(np.int64)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns, *numbers, pa.array([g[3] for g in got], pa.list_(pa.int64()))], [*names, "key", "fp", "size", "shards"])

    return rows.mapInArrow(run, out.schema)


def _sets(texts: DataFrame) -> DataFrame:
    """``key, fp, text`` to ``key, fp, found``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [s.view(np.int64) for _, s in shingles(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("fp"), pa.array(found, pa.list_(pa.int64()))], ["key", "fp", "found"])

    return texts.mapInArrow(run, "key long, fp long, found array<long>")


def class_components(rows: DataFrame, least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """``key, root`` of the classes of ``keyed`` rows that have links."""
    folders = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        df, path = stored(df, name)
        folders.append(path)
        return df

    classes = rows.groupBy("key").agg(F.first("shards").alias("shards"), F.first("size").alias("size"))
    dealt = kept(classes.select("key", "size", F.explode("shards").alias("shard")), "shards")
    shared = dealt.groupBy("shard").agg(F.count("*").alias("n"), F.ceil(F.greatest(F.count("*") / shard, F.sum("size") / HELD)).cast("int").alias("parts"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y")).where("n > 1")
    # Shards of the same members: one of them is enough.
    once = shared.groupBy("n", "x", "y", "parts").agg(F.min("shard").alias("shard")).select("shard", "n", "parts")
    parts = F.col("parts")
    hash_ = F.xxhash64("key", "shard")
    pivot = (hash_.cast("double") / 2.0**64 + 0.5) * F.col("n") < PIVOTS
    part = F.when(parts == 1, F.array(F.lit(0))).when(pivot, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("shard", "key"), parts).cast("int")))
    # How many parts of its shard a member does not stand in.
    others = parts - F.size(part)
    members = kept(dealt.join(once, "shard").select("shard", "key", others.alias("others"), F.explode(part).alias("part")), "shard-members")
    wanted = members.select("key").distinct()
    # Copies are put together before they travel.
    texts = rows.groupBy("key").agg(F.first("fp").alias("fp"), F.first("text").alias("text")).join(wanted, "key", "left_semi")
    sets = kept(_sets(texts), "shingles")
    links = _shard_links(members.join(sets, "key").select("shard", "part", "key", "fp", "found"), least)
    roots = components(links).select(F.col("node").alias("key"), "root")
    split = members.where("others > 0")
    if not split.isEmpty():
        roots = _joined_across(kept(split.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "split-members"), sets, roots, least, shard)
    delete_dir(rows.sparkSession, *folders)
    return roots


def _joined_across(split: DataFrame, sets: DataFrame, roots: DataFrame, least: float, shard: int) -> DataFrame:
    """``roots`` with the links between parts: ``split`` has the members ``shard, key, others, part, root`` that do not stand in all parts of their shard."""
    groups = split.groupBy("shard", "root").agg(F.count("*").alias("n"))
    largest = groups.groupBy("shard").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), (F.sum("n") - F.max("n")).alias("apart")).where("apart > 0")
    # Of two members that are not joined one at least is apart from the largest component. Those go to all parts but their own, dealt to lots so that none is above a shard's size.
    met = split.join(largest.withColumn("lots", F.ceil(F.col("apart") / shard).cast("int")), "shard")
    at = ["shard", "key", "root"]
    held = met.select(*at, "part", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.lit(False).alias("asks"))
    lot = F.pmod(F.xxhash64("key", "shard", F.lit(2)), "lots").cast("int")
    asks = met.where("root <> largest").select(*at, "part", F.explode(F.sequence(F.lit(0), F.col("others"))).alias("to"), lot.alias("lot"), F.lit(True).alias("asks"))
    asks = asks.where("part <> to").select(*at, F.col("to").alias("part"), "lot", "asks")
    more = components(_cross_links(held.unionByName(asks).join(sets, "key"), least))
    # Roots are the smallest keys of their components, so the smallest root is the smallest key.
    through = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("last")), "root", "left").select("key", F.coalesce("last", "root").alias("root"))
    return through.union(more.select(F.col("node").alias("key"), "root").join(roots, "key", "left_anti"))


def one_of_each(docs: DataFrame, least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """``docs`` without near copies: one whole row of each component."""
    rows, _ = stored(keyed(docs), "keyed")
    roots = class_components(rows, least, shard)
    names = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    id_ = names[docs.columns.index("doc_id")]
    first = Window.partitionBy("component").orderBy(F.col(id_).asc_nulls_last(), F.col("text").asc_nulls_first(), F.xxhash64(*names))
    named = rows.drop("shards", "fp", "size").join(roots, "key", "left").withColumn("component", F.coalesce("root", "key"))
    kept = named.withColumn("rank", F.row_number().over(first)).where("rank = 1")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
