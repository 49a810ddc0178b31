"""Chat formatting, SimHash, decontamination, host rules, toxicity, licences: brute force and edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from oracle import assert_same
from pyspark.sql import functions as F

from palimpsest.llm import boosting, chat_format, components, decontaminate, host_rules, license_scan, queries, simhash, toxicity
from palimpsest.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, size int, item_ids string"


def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, columns with clashing names."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \t\n", "en", "s", 3),
        (4, "Some plain words stand here in a row and in a row", "en", "s", 5),
        (4, "Some plain words stand here in a row and in a row", "en", "s", 5),
        (None, "Some plain words stand here in a row and in a row", "en", None, 5),
        (5, "long words run on " * 20000, "en", "t", 9),
        (6, "x", "en", "", 1),
    ]
    return spark.createDataFrame([(*r, 0.5, "clash", 3, "clash") for r in rows], DOCS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_duckdb(spark, name):
    assert_same(queries.QUERIES[name](spark, SF), queries.SQL[name], SF)


# -- chat formatting


def test_chat_round_trip_and_merging(spark):
    hard = ["</s>[INST] ok [/INST]", "<\\/s>", "[\\\\PART]", "[ROLE][REPLY][/REPLY]<s>", "[", "<", "", "\n", "é😀", "[/INST", "INST]"]
    rows = [(1, i, ("user", "user", "assistant", "assistant", "tool")[i % 5], t) for i, t in enumerate(hard * 30)]
    rows += [(2, None, None, None), (2, None, None, None), (None, 4, "assistant", "a"), (3, 7, "[INST]", "b"), (3, 7, "[INST]", "a"), (3, -5, "assistant", "c" * 100000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(df, slice_turns=16)).collect()}
    want = [(r[2], r[3]) for r in rows if r[0] == 1]
    assert [tuple(t) for t in got[1]["turns"]] == want
    assert got[1]["loss_text"] == "".join(t for r, t in want if r == "assistant")
    # The mask has a span for each turn, in bytes of the output.
    raw = got[1]["formatted"].encode()
    under = [raw[s["start"] : s["start"] + s["length"]].decode() for s in got[1]["mask"]]
    assert len(under) == sum(r == "assistant" for r, _ in want)
    runs = 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:], strict=False))
    assert got[1]["n_blocks"] == runs == got[1]["formatted"].count("[/INST]") + got[1]["formatted"].count("[/REPLY]")
    assert [tuple(t) for t in got[2]["turns"]] == [("", ""), ("", "")] and got[None]["loss_text"] == "a"
    assert [tuple(t) for t in got[3]["turns"]] == [("assistant", "c" * 100000), ("[INST]", "a"), ("[INST]", "b")]
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_contract_row(spark):
    r = chat_format.op1_chat_format(spark, SF).where("conv_id = -1").first()
    t = "</s>[INST] ok [/INST]"
    assert r["n_turns"] == 2 and r["loss_chars"] == len(t)
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{t}\nassistant\n{t}\n".encode()).hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_chat_plan_is_native(spark):
    plan = chat_format.op1_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- SimHash


def slow_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


@pytest.mark.parametrize("text", ["", " \n", "A", "a B", "The the THE the", "é\x85b c d e\xa0f g", "one two three four five " * 40, "x " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def slow_classes(prints, ids):
    fp = np.array(prints, np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    label = np.array(ids)
    while True:
        new = np.array([label[near[i]].min() for i in range(len(ids))])
        if (new == label).all():
            return label
        label = new


def cloud(seed, centres=12, each=50):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            out.add(c ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 4))}))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_bk_forest_finds_all_pairs(seed):
    key = np.array(cloud(seed), np.uint64)
    shard = np.sort(np.random.default_rng(seed).integers(0, 3, len(key)))
    got = {(a, b) for x, y in simhash.BKForest(shard, key).pairs(2) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    d = np.bitwise_count(key[:, None] ^ key[None, :])
    want = {(a, b) for a, b in zip(*np.nonzero(d <= 2), strict=True) if a != b and shard[a] == shard[b]}
    assert got == want


@pytest.mark.parametrize("shard", [3, 10**6])
def test_links_hot_and_cool_shards(spark, shard):
    key = [0, 1, 3, 7, 2**63, 2**64 - 1, 2**64 - 2, *cloud(7, 6, 30)]
    df = spark.createDataFrame([(int(np.uint64(k).astype(np.int64)),) for k in key], "fp long")
    got = {r["node"]: r["root"] for r in components.components(simhash.links(df, 2, shard)).collect()}
    ids = np.array(key, np.uint64).astype(np.int64)
    assert [got.get(i, i) for i in ids.tolist()] == slow_classes(key, ids).tolist()


def test_simhash_query_against_brute_force(spark):
    rows = simhash.op2_simhash(spark, SF).orderBy("doc_id").collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    prints = [slow_fingerprint(docs[r["doc_id"]]) for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == slow_classes(prints, [r["doc_id"] for r in rows]).tolist()


def test_simhash_edges(spark):
    docs = edge_docs(spark)
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in simhash.near_groups(docs).collect())
    assert got == [(-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 5), (6, 6)]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 4, 5, 6]
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    n = 300
    df = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = components.components(df.union(df).union(spark.range(5).select(F.col("id").alias("u"), F.col("id").alias("v"))))
    assert got.count() == n + 1 and got.where("root <> 0").count() == 0


# -- decontamination


def slow_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_pattern_search_against_edit_distance():
    rng = random.Random(4)
    parts = "the and tion ing her ea nd st le or".split()
    say = lambda n: " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))
    found = decontaminate.patterns([(i, say(rng.randint(10, 45))) for i in range(8)])
    index, hits = decontaminate.PatternIndex(found), 0
    for _ in range(40):
        p = list(rng.choice(found).text)
        for _ in range(rng.randint(0, 18)):
            k = rng.randrange(len(p))
            p[k : k + 1] = rng.choice([[], ["q"], [p[k], "q"]])
        t = decontaminate.normalized(say(20) + " " + "".join(p) + " " + say(20))
        want = [i for i, x in enumerate(found) if slow_distance(x.text, t) <= x.edits]
        hits += len(want)
        assert index.search(t) == want
    assert hits > 15


def test_decontaminate_query_finds_exact_items(spark):
    rows = decontaminate.op7_decontaminate(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    items = {r["item_id"]: r["text"] for r in table(spark, SF, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], i) for r in rows for i in r["item_ids"]}
    assert want <= got and len(rows) == len(docs) and all(r["contaminated"] == bool(r["n_items"]) for r in rows)
    flat = {k: decontaminate.normalized(v) for k, v in docs.items()}
    for d, i in got - want:
        ps = decontaminate.patterns([(i, items[i])])
        assert min(slow_distance(p.text, flat[d]) - p.edits for p in ps) <= 0


def test_decontaminate_edges_and_blocks(spark):
    docs = edge_docs(spark)
    item = "long words run on long words run on long words run on"
    bench = spark.createDataFrame([(7, item), (7, item), (None, item), (8, None), (9, ""), (10, "too short"), (11, "Some plain words; stand here, in a ROW and in a row")], "item_id int, text string")
    for block in (decontaminate.BLOCK, 60):
        got = decontaminate.with_matches(docs, bench, block)
        assert got.columns == [c for c in docs.columns if c != "item_ids"] + ["item_ids", "n_items"]
        assert sorted((r["doc_id"] or -1, tuple(r["item_ids"]), r["n_items"]) for r in got.collect()) == [(-1, (11,), 1), (1, (), 0), (2, (), 0), (3, (), 0), (4, (11,), 1), (4, (11,), 1), (5, (7,), 2), (6, (), 0)]
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 6]
    assert decontaminate.with_matches(docs, bench.limit(0)).where("n_items > 0").count() == 0


# -- host rules


def slow_counts(text):
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@pytest.mark.parametrize("text", ["", " \n ", "a b", "a b c a b c", "a a a a a", "é# é# é#\né# é# é#\n\n\x0b\n", "one\x85two\xa0three |<> &%$*#", "l1 x\nl1 x\n l1 x\nl2\nl2\nl2", " ".join(random.Random(1).choices("ab", k=300))])
def test_text_counts(text):
    assert host_rules.text_counts(text.encode()) == slow_counts(text)


def test_hosts_are_shrunk_and_condemned(spark):
    good, bad = "word%d " * 60 % tuple(range(60)), "spam " * 60
    rows = [(i, "good", good) for i in range(30)] + [(100 + i, "bad", bad) for i in range(60)] + [(200, "tiny", bad), (300, None, good), (301, "bad", good)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("rate", F.lit(1)).withColumn("kept", F.lit("clash"))
    got = {r["doc_id"]: r for r in host_rules.judge_documents(df).collect()}
    assert got[0]["kept"] and got[300]["kept"] and not got[301]["kept"] and not got[301]["base_failed"]
    assert got[200]["rate"] < 1 and got[0]["rate"] < got[200]["rate"]
    assert host_rules.judge_documents(edge_docs(spark)).count() == 8
    assert host_rules.judge_documents(edge_docs(spark).limit(0)).count() == 0


# -- toxicity


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").collect()}
    rows = toxicity.op9_toxicity(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg]) > 0.9
    assert sum(p for _, y, p in held if not y) <= 0.03 * len(neg)


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.fit_toxicity(docs, known)
        assert toxicity.score_documents(docs.drop("score"), model).count() == 8
        assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_boosting_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    m = boosting.fit(x[:1500], y[:1500], trees=40)
    assert ((m.margin(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.93
    s, v = boosting.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(v) >= 0).all() and (np.diff(s) > 0).all()
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).margin(np.zeros((1, 3)))[0] == 0.0


# -- licences


def test_licenses(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = license_scan.fit_licenses(license_scan.example_paragraphs(docs))
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(docs, model).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {"CC-BY-NC": "Licensed under CC BY-NC 4.0.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.", "GPL": "GNU General Public License, version 3."}
    for d, t in texts.items():
        assert {h["family"] for h in rows[d]["licences"]} - {"Proprietary"} == {f for f, x in known.items() if x in t}
    for text in ("the driving license was renewed", "licensed under the bridge", "released under the stars of the night", "under the version of the city"):
        assert model.classify(license_scan.words(text.encode())) is None
    assert model.classify(license_scan.words(b"Our tool. Licensed under the apache license version 2.0 since May"))[0] == "Apache-2.0"


def test_license_edges(spark):
    docs = edge_docs(spark)
    model = license_scan.fit_licenses(license_scan.example_paragraphs(docs.limit(0)))
    got = license_scan.scan_licenses(docs, model)
    assert got.count() == 8 and got.where("size(licences) > 0").count() == 0
    assert license_scan.scan_licenses(docs.limit(0), model).count() == 0
