r"""Quality rules with a verdict per host.

Counts of each text decide its own failures; failures are counted per host, a host's rate is
shrunk towards the mean of all hosts by a beta prior fitted to the hosts' rates (method of moments), and a host is condemned with all its documents if
its shrunk rate is above the prior's mean by ``FAR`` of the prior's standard deviations (a host in a hundred, were they normal) and above ``TIMES`` the
mean, so that hosts that differ by chance, or by little, stay; above ``MOST_FAILURES`` it is condemned whatever the others are like. Verdicts are joined back.

Counts: word_chars (code points in words ``[^\x20\x09-\x0D]+``), n_symbols (characters of ``[#*$%&|<>]``), n_dup_lines (lines with a word
that equal an earlier one), n_repeat_words (words in three-word windows that occur twice or more).

Defined results: a null or empty text has no words and fails the base; a null host is a host of its own; repeated rows
count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import join_classes, own_columns, table, utf8, written

LEAST_WORDS, MOST_REPEATED = 50, 50
#: A condemned host's distance from the prior's mean in standard deviations, and in multiples of the mean; a shrunk rate that always condemns.
FAR, TIMES, MOST_FAILURES = 2.326, 2.0, 0.8
_SYMBOLS = b"#*$%&|<>"
_NO_SYMBOLS = bytes(c for c in range(256) if c not in _SYMBOLS)
_CONTINUED = bytes(range(0x80, 0xC0))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five counts of one text, from its UTF-8 bytes."""
    words = text.split()
    chars = sum(map(len, words)) - (len(text) - len(text.translate(None, _CONTINUED)))
    symbols = len(text.translate(None, _NO_SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    n = len(words)
    repeated = 0
    if n > 3:
        code: dict[bytes, int] = {}
        ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
        pair = np.unique(ids[:-1] * len(code) + ids[1:], return_inverse=True)[1] if len(code) > 1 << 20 else ids[:-1] * len(code) + ids[1:]
        window = pair[:-1] * len(code) + ids[2:]
        order = np.argsort(window, kind="stable")
        same = window[order[1:]] == window[order[:-1]]
        again = np.zeros(n - 2, bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id, host`` and the counts of each document."""
    rows = own_columns(docs, "doc_id", host, "text").withColumnRenamed(host, "host")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = np.array([text_counts(t) for t in utf8(b.column("text"))], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("host"), *[pa.array(counts[:, i].copy()) for i in range(5)]], ["doc_id", "host", *_COUNTS])

    return rows.mapInArrow(run, kinds + "".join(f", {c} long" for c in _COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rule_failures() -> Column:
    """How many rules a document breaks: the base, too many symbols, too many repeated lines, odd word length."""
    symbols = 10 * F.col("n_symbols") > F.col("n_words")
    lines = 20 * F.col("n_dup_lines") > F.col("n_words")
    length = (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words"))
    return sum((x.cast("int") for x in (symbols, lines, length)), base_failed().cast("int"))


def host_verdicts(counted: DataFrame, far: float = FAR, times: float = TIMES, most_failures: float = MOST_FAILURES) -> DataFrame:
    """``host, n_docs, n_failed, rate`` (shrunk), ``bar`` and ``condemned`` of each host of a table with ``host, failures``."""
    hosts = written(counted.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if(F.col("failures") > 0).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    # One row of sums over hosts: the mean rate, and the variance of rates beyond what the counts' own chance gives.
    s = hosts.agg(F.count("*"), F.sum("n_docs"), F.sum("n_failed"), F.sum(rate), F.sum(rate * rate), F.sum(1 / F.col("n_docs"))).first()
    k, mean = s[0] or 0, (s[2] or 0) / (s[1] or 1)
    spread = max(0.0, (s[4] or 0.0) / k - ((s[3] or 0.0) / k) ** 2) if k else 0.0
    chance = mean * (1 - mean) * (s[5] or 0.0) / k if k else 0.0
    between = max(spread - chance, 1e-6)
    weight = max(1.0, mean * (1 - mean) / between - 1)
    bar = min(most_failures, max(mean + far * math.sqrt(mean * (1 - mean) / (weight + 1)), times * mean))
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("rate", shrunk).withColumn("bar", F.lit(bar)).withColumn("condemned", F.col("rate") > bar)


def judge_documents(docs: DataFrame, host: str = "source", far: float = FAR, times: float = TIMES, most_failures: float = MOST_FAILURES) -> DataFrame:
    """The counts of each document with ``base_failed``, ``failures``, its host's ``rate`` and ``kept``."""
    counted = written(document_counts(docs, host).withColumn("base_failed", base_failed()).withColumn("failures", rule_failures()), "counts")
    # A key that tells a null host from any other.
    key = F.when(F.col("host").isNotNull(), F.concat(F.lit("h"), F.col("host").cast("string"))).otherwise("").alias("key")
    verdicts = written(host_verdicts(counted, far, times, most_failures).select(key, F.col("n_docs").alias("n"), "rate", "condemned"), "verdicts")
    judged = join_classes(counted.select("*", key), verdicts, "key").drop("key")
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("condemned"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents")).select("doc_id", *_COUNTS, "base_failed", "kept")


OP8_SQL = r"""
WITH w AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
t AS (SELECT doc_id, i, a, lead(a) OVER d AS b, lead(a, 2) OVER d AS c FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM t WHERE c IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, range(3) AS x(k) WHERE g.n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(s.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN s USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
v AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 20 * n_dup_lines > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed FROM f),
h AS (SELECT source, count(*) AS n, count_if(failed) AS k FROM v GROUP BY source),
m AS (SELECT sum(k) / sum(n) AS mean, avg((k / n) * (k / n)) - avg(k / n) * avg(k / n) AS spread, avg(1 / n) AS chance FROM h),
p AS (SELECT mean, greatest(1.0, mean * (1 - mean) / greatest(greatest(0.0, spread) - mean * (1 - mean) * chance, 1e-6) - 1) AS weight FROM m),
b AS (SELECT source, (k + mean * weight) / (n + weight) > least(0.8, greatest(mean + 2.326 * sqrt(mean * (1 - mean) / (weight + 1)), 2 * mean)) AS condemned FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT condemned AS kept
FROM v JOIN b ON v.source IS NOT DISTINCT FROM b.source
"""
