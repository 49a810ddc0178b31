"""The corpus pipeline against brute force, stage by stage, and on edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontaminate import slow_hits
from test_near_copies import slow_kept
from test_output_ops import slow_targets
from test_text_ops import WORD, edge_docs
from test_toxicity import slow_features

from palimpsest.llm import mixing, toxicity
from palimpsest.llm.common import table, written
from palimpsest.llm.token_files import default_tokenizer

SF = "/root/testdata/sf0.001"


def slow_order(docs):
    """doc_ids of the copies that the mix takes, in training order; docs: doc_id, text, source, hash."""
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs}
    by = {}
    for r in docs:
        by[r["source"]] = by.get(r["source"], 0) + size[r["doc_id"]]
    goal = slow_targets(by)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None] * (None in by)
    out = []
    for k, source in enumerate(names):
        knots = mixing.SCHEDULES[k % 3]
        ts = np.linspace(0, 1, 200_001)
        w = np.interp(ts, *zip(*knots, strict=True))
        area = np.r_[0, np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(ts))]
        for p in range(mixing.PASSES):
            at = p * by[source]
            for r in sorted((r for r in docs if r["source"] == source), key=lambda r: r["hash"]):
                middle = at + size[r["doc_id"]] / 2
                at += size[r["doc_id"]]
                if middle < goal[source] * (1 - 1e-12):
                    out.append((float(np.interp(middle / goal[source] * area[-1], area, ts)), r["hash"], r["doc_id"]))
    return sorted(out)


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(written(stage(spark, steps[-1], SF), f"test-{name}"))
    assert all(s.columns == docs.columns for s in steps[:5])
    rows = {r["doc_id"]: r for r in docs.withColumn("hash", F.xxhash64(F.lit(17), "doc_id", "text")).collect()}
    ids = [[r["doc_id"] for r in s.select("doc_id").collect()] for s in steps]
    # Toxicity: the model's trees over the slow features.
    model = toxicity.fit_toxicity(docs, table(spark, SF, "labels"))
    score = model.score(np.array([slow_features(rows[d]["text"] or "", model.learnt) for d in sorted(rows)], float))
    assert sorted(ids[1]) == [d for d, s in zip(sorted(rows), score, strict=True) if s < 0.7]
    # Near copies: all pairs of shingle sets.
    assert sorted(ids[2]) == slow_kept([(d, rows[d]["text"]) for d in sorted(ids[1])])
    # Benchmark: every item that stands in a text goes, and what goes has a window within its edits.
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    gone = set(ids[2]) - set(ids[3])
    assert {d for d in ids[2] for _, x in items if x in (rows[d]["text"] or "")} <= gone
    assert {d for d, _ in slow_hits(items, [(d, rows[d]["text"]) for d in gone])} == gone
    # Mixing: copies, and their order; times that differ by less than the grid may change places.
    want = slow_order([rows[d] for d in ids[3]])
    assert sorted(ids[4]) == sorted(d for _, _, d in want)
    time = {}
    for t, _, d in want:
        time.setdefault(d, []).append(t)
    seen, last = {}, 0.0
    stored = spark.read.parquet(*steps[4].inputFiles()).select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    for r in stored:
        k = seen[r["doc_id"]] = seen.get(r["doc_id"], -1) + 1
        assert time[r["doc_id"]][k] >= last - 1e-4
        last = time[r["doc_id"]][k]
    # Token files: ids of whole texts in that order.
    plain = Tokenizer.from_file(default_tokenizer())
    got, at = steps[5].orderBy("start").collect(), 0
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in stored]
    for r in got:
        x = [*plain.encode(rows[r["doc_id"]]["text"] or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, got))


EDGE_COLUMNS = ["key", "shards", "rank", "component", "root", "hash", "times", "time", "cell", "n_items", "__part", "__row", "own_score"]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_edge_rows(spark, empty):
    import corpus_pipeline

    docs = edge_docs(spark).select("*", *[F.lit(f"own {c}").alias(c) for c in EDGE_COLUMNS])
    docs = docs.limit(0) if empty else docs
    # Rows (id or -1): 1 null text, 2 and 3 blank, 4 twice and once without an id, 5 very long, 6 one word.
    want = {"toxicity": [-1, 1, 2, 3, 4, 4, 5, 6], "near_dedup": [1, 4, 5, 6], "decontamination": [-1, 1, 2, 3, 4, 4, 5, 6]}
    for name, stage in corpus_pipeline.STAGES:
        got = written(stage(spark, docs, SF), f"edge-{name}")
        if name == "token_files":
            assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == (0 if empty else 8)
            continue
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in docs.schema]
        rows = got.collect()
        assert all(r[c] == f"own {c}" for r in rows for c in EDGE_COLUMNS) and all((r["size"], r["score"], r["fp"], r["item_ids"]) == (3, 0.5, "clash", "clash") for r in rows)
        if name in want:
            assert sorted(r["doc_id"] or -1 for r in rows) == ([] if empty else want[name])


def test_stages_one_after_another_on_edge_rows(spark):
    import corpus_pipeline

    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"chain-{name}")
    assert {r["doc_id"] for r in docs.collect()} <= {1, 4, 5, 6}
