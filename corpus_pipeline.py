"""The corpus pipeline: toxicity, near-dedup, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and gives rows of the same columns, whatever they are, besides doc_id, text and
source; the last gives one row per document of the token files. Defined results of all stages: an empty table stays empty; a row without a doc_id, text or
source is a row like any other; columns with names that a stage uses inside come back as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import decontaminate, mixing, near_copies, token_files, toxicity
from palimpsest.llm.common import delete_dir, scratch, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more as toxic go.

    The model learns from ``labels`` of documents that are here and not held out; without labels of both kinds nothing scores that high.
    Null and empty texts have the score of a text without words; repeated rows go or stay together.
    """
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more): the one of the smallest doc_id.

    Null and empty texts are one group; a row without an id stays only if no row of its group has one; of rows that tie, the first by text and a hash of the row stays.
    """
    return near_copies.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go; without items all stay.

    Null and empty texts hold nothing; repeated rows go or stay together; items without an id count like any other.
    """
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order, which the written files keep.

    Null is a source of its own; texts without words take part with size 0; rows that tie in time stand in an order that a hash of all columns fixes.
    """
    return mixing.training_order(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what the mix took, in training order, read back: one row per copy.

    A null or empty text has the end id alone; a null doc_id keeps its row; copies stand where the mix put them; columns but doc_id and text are left behind.
    """
    return token_files.token_digests(docs, ordered=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: SQL has no tokenizer, trees or seeded XXH64; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote goes once the next has read it, and what it wrote on the way at once."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs, path = stored(stage(spark, docs, sf_dir), f"stage-{name}")
            keep.append(path)
        if last:
            delete_dir(spark, last)
        last = path
    out = STAGES[-1][1](spark, docs, sf_dir)
    # The token files are written; they alone are read from here on.
    delete_dir(spark, last)
    return out
