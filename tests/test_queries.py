import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import assert_same

from palimpsest.plans import operations  # noqa: F401
from palimpsest.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, name):
    assert_same(QUERIES[name](spark, SF), SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[-1] == "__id_ts"
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_pushed_filters(spark):
    """A key filter and the two columns it needs reach the scan."""
    from palimpsest.operators.versions import key_lookup
    from palimpsest.plans.queries import table

    plan = key_lookup(table(spark, SF, "customer").select("c_custkey", "c_name"), ["a", "b"], "c_name")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(c_name" in plan and "c_acctbal" not in plan


def test_a_log_above_the_page_limit_is_merged_whole(spark, tmp_path):
    """4,130 rows in pages of 40: more than one run takes."""
    for t in ("nation", "region"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    pq.write_table(pa.table({"s_suppkey": range(4100), "s_name": [f"Supplier {i}" for i in range(4100)]}), tmp_path / "supplier.parquet")
    name = "q50_tables_merged_in_parallel"
    assert_same(QUERIES[name](spark, str(tmp_path)), SQL[name], str(tmp_path))
