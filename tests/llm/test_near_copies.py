"""Near copies of the pipeline against brute-force Jaccard."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_text_ops import edge_docs

from palimpsest.llm import near_copies


def slow_shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_kept(rows):
    """Smallest id of each component of texts at 0.8 or more."""
    sets = [slow_shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    while True:
        new = [min(label[j] for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)) for a in sets]
        if new == label:
            return sorted(rows[i][0] for i in set(label))
        label = new


def edited(seed=3, groups=60):
    """Texts of made-up words with copies that have one to many words replaced, and a line that many hold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choices(words, k=25))
    out = []
    for g in range(groups):
        w = rng.choices(words, k=rng.choice((8, 40, 90, 150, 400)))
        out.append(" ".join(w))
        for _ in range(4):
            c = list(w)
            for _ in range(rng.randint(0, 1 + len(c) // 30)):
                c[rng.randrange(len(c))] = rng.choice(words)
            out.append(" ".join(c) if g % 3 else line + " " + " ".join(c))
    return list(enumerate(out))


def test_edited_copies_go(spark):
    import corpus_pipeline

    rows = edited()
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.drop_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == slow_kept(rows)


def test_linked_spans_a_chain():
    base = near_copies.mixed(np.arange(300, dtype=np.uint64))
    sets = [np.sort(base[5 * i : 5 * i + 100]) for i in (3, 0, 2, 1, 40)]
    prints = np.array([near_copies.fingerprint(s) for s in sets], np.uint64)
    pairs = near_copies.linked(sets, prints)
    assert len(pairs) == 3 and {x for p in pairs for x in p} == {0, 1, 2, 3}
    # What the tree leaves out is not compared; what it finds must hold.
    assert near_copies.linked(sets, prints, radius=0) == []
    assert near_copies.linked(sets[:1] * 3, prints[[0, 0, 4]], radius=0) == [(0, 1)]


def groups_of(pairs, n):
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("seed", range(4))
def test_linked_against_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(near_copies, "FOUND", 300)
    rng = random.Random(seed)
    sets = []
    for _ in range(12):
        base = [rng.getrandbits(64) for _ in range(rng.choice((1, 7, 60, 200)))]
        for _ in range(rng.randint(1, 9)):
            sets.append(np.unique(np.array([x if rng.random() > 0.06 else rng.getrandbits(64) for x in base], np.uint64)))
    rng.shuffle(sets)
    prints = np.array([near_copies.fingerprint(s) for s in sets], np.uint64)
    plain = [set(s.tolist()) for s in sets]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(plain[i] & plain[j]) >= 4 * len(plain[i] | plain[j])]
    near = [(i, j) for i, j in near if int(prints[i] ^ prints[j]).bit_count() <= near_copies.RADIUS]
    assert groups_of(near_copies.linked(sets, prints), len(sets)) == groups_of(near, len(sets))


def one_text(text):
    return next(near_copies.shingles(pa.array([text])))


@pytest.mark.parametrize("n", [1, 4, 5, 6, 5000])
def test_shingles_are_distinct_and_ordered_words(n):
    w = [f"x{i}" for i in range(n)]
    key, found = one_text(" ".join(w))
    assert len(found) == max(1, n - 4) and one_text("\n ".join(w).upper() + "\t")[0] == key
    assert n < 2 or one_text(" ".join(w[::-1]))[1].tolist() != found.tolist()


def test_shingles_do_not_run_over_texts(monkeypatch):
    texts = ["a b c d e f", "", "a b", None, "a b c d e", "f a b c d e f", "a b c d e a b c d e"]
    together = list(near_copies.shingles(pa.array(texts)))
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    for t, (key, found), (again, same) in zip(texts, together, near_copies.shingles(pa.array(texts)), strict=True):
        assert len(found) == len(slow_shingles(t)) and found.tolist() == one_text(t or "")[1].tolist() == same.tolist() and key == again == one_text(t or "")[0]


def test_recall_at_the_bound(spark):
    """Pairs with a similarity of 0.8 to 0.85, each on its own: nearly all are found."""
    rng = random.Random(9)
    rows, pairs = [], 0
    while pairs < 150:
        w = [f"v{rng.randrange(10**6)}" for _ in range(rng.choice((60, 120, 300)))]
        c = list(w)
        for _ in range(max(1, len(c) // 50)):
            c[rng.randrange(len(c))] = f"v{rng.randrange(10**6)}"
        a, b = slow_shingles(" ".join(w)), slow_shingles(" ".join(c))
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            rows += [(2 * pairs, " ".join(w)), (2 * pairs + 1, " ".join(c))]
            pairs += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    missed = near_copies.one_of_each(docs).where("doc_id % 2 = 1").count()
    assert missed <= 1


def test_large_shards_are_split_and_still_joined(spark):
    """A group far above a shard's size, all near to each other, and others beside it."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        c = list(base)
        c[rng.randrange(200)] = f"own{i}"
        rows.append((i, " ".join(c)))
    rows += [(1000 + i, " ".join(f"z{i}x{j}" for j in range(30))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in near_copies.one_of_each(docs, shard=20).collect())
    assert kept == [0, *range(1000, 1020)]


def test_rows_without_an_id_and_repeated_ids(spark):
    docs = edge_docs(spark)
    kept = near_copies.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [1, 4, 5, 6]
    assert near_copies.one_of_each(docs.limit(0)).count() == 0
    two = spark.createDataFrame([(1, "a text of its own that is clean"), (1, "quite another one under the same id"), (None, "only rows without an id"), (None, "only  rows without an id")], "doc_id long, text string")
    assert sorted((r["doc_id"] or -1) for r in near_copies.one_of_each(two).collect()) == [-1, 1, 1]


def test_shards_of_long_texts_are_split_by_what_they_hold(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "HELD", 3000)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        c = list(base)
        c[rng.randrange(400)] = f"own{i}"
        rows.append((i, " ".join(c)))
    docs = spark.createDataFrame([*rows, (100, "a text of its own that none is like")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.one_of_each(docs).collect()) == [0, 100]


def in_one_shard(spark, texts):
    """Rows of texts that meet in one shard only, as ``class_components`` takes them."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return near_copies.keyed(docs).withColumn("shards", F.array(F.lit(7).cast("long"))).localCheckpoint()


def joined(rows, **how):
    """Sorted groups of the places of texts that a search joins."""
    root = {r["key"]: r["root"] for r in near_copies.class_components(rows, **how).collect()}
    groups = {}
    for r in rows.select("c0", "key").collect():
        groups.setdefault(root.get(r["key"], r["key"]), []).append(r["c0"])
    assert all(k == min(x for x in root if root[x] == k) for k in set(root.values()))
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


@pytest.mark.parametrize(("shard", "pivots", "held"), [(4, 0, 10**6), (20, 3, 10**6), (1000, 0, 900)])
def test_links_across_the_parts_of_a_shard_are_found(spark, monkeypatch, shard, pivots, held):
    """Pairs that have but each other, a group and a chain, dealt to parts of one shard without a pivot in most of them."""
    monkeypatch.setattr(near_copies, "PIVOTS", pivots)
    monkeypatch.setattr(near_copies, "HELD", held)
    rng = random.Random(6)
    texts = []
    for g in range(30):
        w = [f"g{g}w{i}" for i in range(60)]
        texts += [" ".join(w), " ".join([*w[:-1], "other"])]
    base = [f"b{i}" for i in range(100)]
    for i in range(25):
        c = list(base)
        c[rng.randrange(100)] = f"own{i}"
        texts.append(" ".join(c))
    chain = [f"c{i}" for i in range(160)]
    texts += [" ".join(chain[6 * i : 6 * i + 80]) for i in range(10)]
    sets = [slow_shingles(t) for t in texts]
    found = joined(in_one_shard(spark, texts), shard=shard)
    near = [(i, j) for i, a in enumerate(sets) for j in range(i) if 5 * len(a & sets[j]) >= 4 * len(a | sets[j])]
    label = groups_of(near, len(sets))
    want = sorted([i for i, x in enumerate(label) if x == g] for g in set(label))
    assert found == [g for g in want if len(g) > 1] and len(found) == 32


@pytest.mark.parametrize("seed", range(3))
def test_crossing_against_all_pairs(seed):
    rng = random.Random(seed)
    sets = []
    for _ in range(10):
        base = [rng.getrandbits(64) for _ in range(rng.choice((1, 7, 60, 200)))]
        for _ in range(rng.randint(1, 9)):
            sets.append(np.unique(np.array([x if rng.random() > 0.06 else rng.getrandbits(64) for x in base], np.uint64)))
    rng.shuffle(sets)
    prints = np.array([near_copies.fingerprint(s) for s in sets], np.uint64)
    half = len(sets) // 2
    roots = np.arange(len(sets), dtype=np.int64)
    roots[[1, 2, half + 1]] = 0  # a component that is known before
    asked = ((int(prints[i]), int(roots[i]), sets[i]) for i in range(half, len(sets)))
    got = near_copies.crossing(sets[:half], prints[:half], roots[:half], asked)
    plain = [set(s.tolist()) for s in sets]
    near = [(i, j) for i in range(half, len(sets)) for j in range(half) if 5 * len(plain[i] & plain[j]) >= 4 * len(plain[i] | plain[j])]
    near = [(i, j) for i, j in near if int(prints[i] ^ prints[j]).bit_count() <= near_copies.RADIUS]
    known = [(0, 1), (0, 2), (0, half + 1)]
    assert near and groups_of([*got, *known], len(sets)) == groups_of([*near, *known], len(sets))
    assert len(got) < len(sets)
