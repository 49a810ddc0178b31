"""Conversations whose turn numbers say nothing of their order."""

import time

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import chat_format


@pytest.mark.parametrize("n", [1, 2, 7, 300, 600])
def test_null_and_repeated_numbers_are_sliced_too(spark, n):
    role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
    text = F.format_string("%06d", F.col("id").cast("int"))
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    # Without numbers the order is that of role and text; numbered that way the result is the same.
    ranked = sorted(((r["role"], r["text"]) for r in turns.collect()))
    numbered = spark.createDataFrame([(1, i, role, text) for i, (role, text) in enumerate(ranked)], "conv_id int, turn long, role string, text string")
    want = chat_format.format_conversations(numbered, slice_turns=8).select("n_blocks", "formatted").first()
    for turn in (F.lit(None), F.lit(5)):
        for size in (2, 8, 256):
            got = chat_format.read_back(chat_format.format_conversations(turns.withColumn("turn", turn.cast("long")), slice_turns=size)).first()
            assert (got["n_blocks"], got["turns"]) == (want["n_blocks"], [r for r in got["turns"]]) and [(t["role"], t["text"]) for t in got["turns"]] == ranked


def test_many_turns_without_a_number_take_no_square_of_time(spark):
    def seconds(n, turn):
        turns = spark.range(n).select(F.lit(1).alias("conv_id"), turn.cast("long").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("text").alias("text"))
        began = time.time()
        assert chat_format.format_conversations(turns).first()["n_blocks"] in (2, n)
        return time.time() - began

    seconds(100, F.lit(None))
    assert seconds(16_000, F.lit(None)) < 3 + 4 * seconds(16_000, F.col("id"))


@pytest.mark.parametrize("size", [2, 3, 256])
def test_mask_is_spans_over_the_output(spark, size):
    rows = [(c, i, role, text) for c, turns in {1: [("user", "é😀"), ("assistant", "né[/REPLY]"), ("assistant", ""), ("user", "x"), ("assistant", "😀 </s> tail")], 2: [("user", "alone")], 3: [("assistant", f"t{i}") for i in range(40)]}.items() for i, (role, text) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")
    got = chat_format.read_back(chat_format.format_conversations(turns, slice_turns=size)).collect()
    for r in got:
        raw = r["formatted"].encode()
        own = [text for c, _, role, text in rows if c == r["conv_id"] and role == "assistant"]
        assert len(r["mask"]) == len(own) and r["loss_text"] == "".join(own)
        escaped = [raw[s["start"] : s["start"] + s["length"]].decode() for s in r["mask"]]
        assert [e.replace("<\\", "<").replace("[\\", "[") for e in escaped] == own
        assert all(a["start"] + a["length"] <= b["start"] for a, b in zip(r["mask"], r["mask"][1:], strict=False))
