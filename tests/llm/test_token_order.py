"""The pipeline's token files keep the order of the mix."""

from pyspark.sql import functions as F

from palimpsest.llm import mixing, token_files
from palimpsest.llm.common import written


def test_token_files_keep_the_training_order(spark):
    import corpus_pipeline

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"))
    mixed = mixing.training_order(docs)
    want = [r["doc_id"] for r in mixed.collect()]
    assert want != sorted(want)
    stored = written(mixed, "mixed")
    got = corpus_pipeline.write_tokens(spark, stored, "").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == want
    # What is sorted after it was read has the later order.
    again = token_files.token_digests(stored.orderBy(F.col("doc_id").desc()), ordered=True).orderBy("start").collect()
    assert [r["doc_id"] for r in again] == sorted(want, reverse=True)
    # A table that no file holds has the order of its plan.
    plain = token_files.token_digests(mixed, ordered=True).orderBy("start").collect()
    assert [r["doc_id"] for r in plain] == want
