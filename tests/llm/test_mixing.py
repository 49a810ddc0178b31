"""Mixing: clashing names, ties, prefix sums over runs of cells, one word count."""

import pytest
from pyspark.sql import functions as F
from test_text_ops import SF, edge_docs

from palimpsest.llm import mixing
from palimpsest.llm.common import table


def test_clashing_columns_come_back_as_they_were(spark):
    names = ["size", "hash", "cell", "named", "id", "tie", "times", "time", "target", "kind", "offset", "before", "c0", "c1", "n", "run", "source_size", "__hash", "__size"]
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("s").alias("source"), *[F.lit(f"own {n}").alias(n) for n in names if n != "id"], F.lit("own id").alias("id"))
    got = mixing.training_order(docs)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in docs.schema]
    rows = got.collect()
    assert rows and all(r[n] == f"own {n}" for r in rows for n in names)
    assert mixing.mix_documents(docs).count() == 200


def test_rows_that_differ_in_other_columns_alone_keep_one_order(spark):
    docs = spark.range(40).select(F.lit(1).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"), F.col("id").alias("extra"))
    seen = [[r["extra"] for r in mixing.training_order(docs.repartition(k)).collect()] for k in (1, 3, 7)]
    assert seen[0] == seen[1] == seen[2] and len(set(seen[0])) == 40


@pytest.mark.parametrize("cell", [3, 1024])
def test_offsets_do_not_depend_on_cells(spark, monkeypatch, cell):
    """Times are those of one sum over the whole source, however its hashes are cut."""
    monkeypatch.setattr(mixing, "CELL", cell)
    monkeypatch.setattr(mixing, "RUN", 4)
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: r for r in mixing.mix_documents(docs).collect()}
    rows = docs.select("doc_id", "source", F.xxhash64(F.lit(17), "doc_id", "text").alias("h")).collect()
    for source in {r["source"] for r in rows}:
        at, first = 0, []
        for r in sorted((r for r in rows if r["source"] == source), key=lambda r: r["h"]):
            g = got[r["doc_id"]]
            middle = at + g["size"] / 2
            taken = sum(p * g["source_size"] + middle < g["target"] for p in range(mixing.PASSES))
            assert g["taken"] == taken * g["size"] and len(g["times"]) == taken
            first += g["times"][:1]
            at += g["size"]
        assert at == got[next(r["doc_id"] for r in rows if r["source"] == source)]["source_size"]
        assert first == sorted(first)


def test_texts_are_counted_once(spark):
    plan = mixing.mix_documents(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "regexp_count" not in plan
