"""The bar above which hosts are condemned, and its effect on the query's rows."""

import duckdb
import pytest
from oracle import assert_same, plain
from pyspark.sql import functions as F
from test_text_ops import SF

from palimpsest.llm import host_rules
from palimpsest.llm.common import table

GOOD = " ".join(f"word{i}" for i in range(60))


def hosts(spark, rates, docs=200):
    rows = [(h * docs + i, f"h{h}", GOOD if i >= rate * docs else "spam spam") for h, rate in enumerate(rates) for i in range(docs)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def condemned(df):
    got = host_rules.judge_documents(df).where("not base_failed and not kept").select("host").distinct()
    return sorted(r["host"] for r in got.collect())


@pytest.mark.parametrize(
    ("rates", "want"),
    [
        ([0.1] * 19 + [0.5], ["h19"]),
        # A host that stands out by chance, or by little, stays.
        ([0.1] * 10 + [0.12] * 10, []),
        ([0.1] * 19 + [0.17], []),
        ([0.1] * 17 + [0.5, 0.6, 0.7], ["h18", "h19"]),
        ([0.95, 0.95, 0.9], ["h0", "h1", "h2"]),
        ([0.0] * 5, []),
    ],
)
def test_outlying_hosts_are_condemned(spark, rates, want):
    assert condemned(hosts(spark, rates)) == want


def test_host_step_changes_the_query(spark, tmp_path):
    """With one bad host the query differs from the base rules alone, and the SQL follows it."""
    table(spark, SF, "documents").select("doc_id", "text", "source").union(hosts(spark, [0.9], 100).select(F.col("doc_id") + 10**6, "text", F.lit("bad"))).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = host_rules.op8_host_rules(spark, str(tmp_path))
    rows = df.collect()
    assert sum(not r["base_failed"] and not r["kept"] for r in rows) == 10
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = con.execute(host_rules.OP8_SQL)
    names = [c[0] for c in got.description]
    assert sorted(tuple(plain(r[c]) for c in names) for r in rows) == sorted(tuple(plain(x) for x in r) for r in got.fetchall())


def test_sample_tables_have_no_outlying_host(spark):
    """What the README says: no host of the sample tables fails so much more than the others."""
    for sf in ("sf0.001", "sf0.01"):
        rows = host_rules.op8_host_rules(spark, f"/root/testdata/{sf}").collect()
        assert all(r["kept"] != r["base_failed"] for r in rows)


def test_null_host_is_a_host(spark):
    df = hosts(spark, [0.1] * 19 + [0.5]).withColumn("source", F.when(F.col("source") != "h19", F.col("source")))
    got = host_rules.judge_documents(df.withColumn("key", F.lit("clash")).withColumn("n", F.lit("clash")))
    assert got.where("host is null and kept").count() == 0 and got.where("host is null").count() == 200
    assert got.where("host is not null and not base_failed and not kept").count() == 0


def test_query_equals_its_sql(spark):
    assert_same(host_rules.op8_host_rules(spark, SF), host_rules.OP8_SQL, SF)
