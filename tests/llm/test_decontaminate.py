"""Decontamination: one rule for all lengths, short items, blocks, ids of other types, brute force over a table."""

import random

import pytest
from pyspark.sql import functions as F
from test_text_ops import SF, edge_docs, slow_distance

from palimpsest.llm import decontaminate
from palimpsest.llm.common import table
from palimpsest.llm.decontaminate import EDITS, LEAST, PatternIndex, normalized, patterns


def item_of(rng, n):
    """A made-up text of n characters."""
    text = ""
    while len(text) < n + 1:
        text += "".join(rng.choices("abcdefghiklmnoprstuw", k=rng.randint(2, 9))) + " "
    return text[: n - 1] + "x"


def held(item, text):
    return bool(PatternIndex(patterns([(1, item)])).search(text))


@pytest.mark.parametrize("n", [40, 41, 60, 81, 120, 199, 200, 201, 202, 240, 500, 1500])
def test_every_stretch_of_the_share_is_found(n):
    rng = random.Random(n)
    item, noise = item_of(rng, n), item_of(rng, 300)
    sure = min(decontaminate.STRETCH, -(-n * 8 // 10))
    for at in {0, 1, 2, 7, n // 7, n // 3, n // 2, n - sure - 1, n - sure}:
        if 0 <= at <= n - sure:
            assert held(item, noise + " " + item[at : at + sure] + " " + noise), at
    # Half of the stretch, or another text, is not.
    assert not held(item, noise + " " + item[: sure // 2] + " " + noise) and not held(item, noise)


@pytest.mark.parametrize("n", [1, 2, 5, 7, 8, 9, 20, 39])
def test_short_items_stand_exactly_between_word_bounds(n):
    item = {1: "x", 2: "ab", 5: "a b c", 7: "is 2 +3"}.get(n) or item_of(random.Random(n), n)
    assert n >= 8 or len(item) == n
    other = item_of(random.Random(99), 60)
    for text in (item, f"{other} {item}", f"{item}. {other}", f"{other}, {item.upper()}! {other}", f"{other}\n{item}\n"):
        assert held(item, text), text
    for text in (f"{other}q{item} {other}", f"{item}q {other}", other, "", item[:-1]):
        assert not held(item, text), text


def test_short_items_at_the_cuts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 50)
    rng = random.Random(1)
    for gap in range(120):
        item, pad = "grumbling toads", "".join(rng.choices("abc", k=gap)) + " "
        assert held(item, pad + item + " " + item_of(rng, 90)) and not held(item, pad + "q" + item + " " + item_of(rng, 90))


def slow_hits(items, docs):
    """Every window of every item against every text by edit distance."""
    windows = [(i, p) for i, t in items for p in patterns([(i, t)])]
    out = set()
    for d, text in docs:
        flat = normalized(text or "")
        for i, p in windows:
            if (d, i) in out:
                continue
            if p.whole:
                found = f" {p.text} " in f" {flat} "
            else:
                found = p.text in flat or slow_distance(p.text, flat) <= p.edits
            if found:
                out.add((d, i))
    return out


def test_table_against_all_windows(spark):
    rng = random.Random(6)
    items = [(i, item_of(rng, rng.choice((3, 12, 38, 45, 70, 90, 210, 400)))) for i in range(14)]
    docs = []
    for d in range(50):
        text = list(rng.choice(items)[1])
        at = rng.randrange(len(text) // 3 + 1)
        text = text[at : at + rng.choice((len(text), len(text) * 3 // 4, len(text) // 2))]
        for _ in range(rng.randint(0, 1 + len(text) // 12)):
            text[rng.randrange(len(text))] = rng.choice("qzy ")
        docs.append((d, f"{item_of(rng, 40)} {''.join(text)} {item_of(rng, 40)}"))
    want = slow_hits(items, docs)
    assert 10 < len(want) < 200
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK, 200):
        got = decontaminate.with_matches(df, bench, block)
        assert {(r["doc_id"], i) for r in got.collect() for i in r["item_ids"]} == want
    assert all(p.edits == int(len(p.text) * EDITS) for _, t in items for p in patterns([(0, t)]) if len(normalized(t)) >= LEAST)


def test_ids_of_any_type_and_clashing_names(spark):
    docs = edge_docs(spark).withColumn("__a", F.lit("own")).withColumn("c0", F.lit(1)).withColumn("n", F.lit("mine"))
    item = "long words run on long words run on long words run on"
    bench = spark.createDataFrame([("b", item), ("a", "Some plain words stand here in a row and in a row"), ("a", "x"), (None, item), (None, "words run on long words run on long words run on long")], "item_id string, text string")
    for block in (decontaminate.BLOCK, 60):
        got = decontaminate.with_matches(docs, bench, block)
        assert sorted((r["doc_id"] or -1, tuple(r["item_ids"]), r["n_items"], r["__a"], r["c0"], r["n"]) for r in got.collect()) == [
            (-1, ("a",), 1, "own", 1, "mine"),
            (1, (), 0, "own", 1, "mine"),
            (2, (), 0, "own", 1, "mine"),
            (3, (), 0, "own", 1, "mine"),
            (4, ("a",), 1, "own", 1, "mine"),
            (4, ("a",), 1, "own", 1, "mine"),
            (5, ("b",), 3, "own", 1, "mine"),
            (6, ("a",), 1, "own", 1, "mine"),
        ]


def test_query_against_all_windows(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").where("length(text) < 3000").limit(25).collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    got = {(r["doc_id"], i) for r in decontaminate.op7_decontaminate(spark, SF).collect() for i in r["item_ids"]}
    ids = {d for d, _ in docs}
    plain = {(d, i) for d, t in docs for i, x in items if normalized(x) in normalized(t)}
    assert plain <= got
    assert {x for x in got if x[0] in ids} - plain <= slow_hits(items, [(d, t) for d, t in docs if any(d == x[0] for x in got)])
