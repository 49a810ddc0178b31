"""Queries over the sample tables, one or more per operator, and the same in DuckDB's SQL."""

from __future__ import annotations

import urllib.parse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from palimpsest.functions import keys
from palimpsest.functions.coerce import coerced
from palimpsest.functions.jsontext import json_or_quoted
from palimpsest.functions.naming import physical_name_column
from palimpsest.functions.normalize import normalized
from palimpsest.operators import jobs, merge, repair, versions
from palimpsest.plans.schema import ColumnSpec, infer_kind, signature, struct_of, table_specs
from palimpsest.sources.changelog import ChangeLog, admission_counts
from palimpsest.sources.state import CursorState, StateStore
from palimpsest.sources.store import VersionedStore
from palimpsest.sources.workdir import shared_dir
from palimpsest.streaming.ingest import Ingest, SchemaCache, Settings, sync_once
from palimpsest.streaming.maintenance import in_window_column

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a change log: a user is a document, an event its version, an error deletes it."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("_id"), F.col("event_id").alias("_ts"), (F.col("event_type") == "error").alias("_deleted"), "event_type", "value", "props")


LOG = "(SELECT CAST(user_id AS VARCHAR) AS _id, event_id AS _ts, event_type = 'error' AS _deleted, event_type, value, props FROM events)"
STATUS = "CAST((CASE WHEN {c} THEN 1 ELSE 0 END) + (CASE WHEN _deleted THEN 2 ELSE 0 END) AS TINYINT)"


def _generated_sql(source: str, current: str, columns: str, where: str = "true") -> str:
    status = STATUS.format(c=current)
    return f"""SELECT {columns}, __status, CAST(__status AS VARCHAR) || '#' || _id AS __status_id, _id || '#' || CAST(_ts AS VARCHAR) AS __id_ts
FROM (SELECT *, {status} AS __status FROM {source}) WHERE {where}"""


COLUMNS = "_id, _ts, _deleted, event_type, value, props"
HISTORY = _generated_sql(f"(SELECT *, max(_ts) OVER (PARTITION BY _id) = _ts AS cur FROM {LOG})", "cur", COLUMNS)


@query("q01_generated_columns", _generated_sql(LOG, "_ts % 3 = 0", COLUMNS))
def q01(spark: SparkSession, d: str) -> DataFrame:
    return keys.with_generated(event_log(spark, d), F.col("_ts") % 3 == 0)


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    return event_log(spark, d).withColumn("_current", F.when(F.col("_ts") % 5 > 0, F.col("_ts") % 2 == 0))


@query(
    "q02_migrate_filtered_topk",
    _generated_sql(f"(SELECT *, _ts % 2 = 0 AND _ts % 5 > 0 AS cur FROM {LOG})", "cur", COLUMNS, "value > 10 AND event_type <> 'view'") + " ORDER BY value DESC NULLS LAST, _ts NULLS LAST LIMIT 500",
)
def q02(spark: SparkSession, d: str) -> DataFrame:
    return jobs.migration_query(_snapshot(spark, d), "value > 10 AND event_type <> 'view'", "value DESC, _ts", 500)


@query("q03_migrate_count_verify", "SELECT 'events' AS table_name, count(*) AS source_rows, count(*) AS target_rows, CAST(1 AS BIGINT) AS version_number FROM events WHERE value > 20")
def q03(spark: SparkSession, d: str) -> DataFrame:
    store = VersionedStore(spark, shared_dir(spark, "store"), buckets=8)
    got = jobs.migrate_table(store, "events", _snapshot(spark, d), where="value > 20")
    return spark.range(1).select(F.lit("events").alias("table_name"), *[F.lit(got[k]).cast("long").alias(n) for k, n in (("source_rows", "source_rows"), ("target_rows", "target_rows"), ("version", "version_number"))])


@query("q04_current_versions", f"SELECT * FROM ({HISTORY}) WHERE __status & 1 = 1")
def q04(spark: SparkSession, d: str) -> DataFrame:
    return versions.latest(event_log(spark, d))


@query("q05_live_rows", f"SELECT * FROM ({HISTORY}) WHERE __status = 1")
def q05(spark: SparkSession, d: str) -> DataFrame:
    return versions.live(versions.latest(event_log(spark, d)))


@query("q06_tombstones", f"SELECT * FROM ({HISTORY}) WHERE __status = 3")
def q06(spark: SparkSession, d: str) -> DataFrame:
    return versions.tombstones(versions.latest(event_log(spark, d)))


@query("q07_version_history", HISTORY)
def q07(spark: SparkSession, d: str) -> DataFrame:
    return versions.version_history(event_log(spark, d))


def _parts(log: DataFrame, n: int = 4) -> list[DataFrame]:
    """The log cut into ``n`` batches of version times."""
    most = log.agg(F.max("_ts")).first()[0] or 0
    step = most // n + 1
    return [log.where((F.col("_ts") >= i * step) & (F.col("_ts") < (i + 1) * step)) for i in range(n)]


def _fold(spark: SparkSession, batches: list[DataFrame], seq: str | None = None) -> DataFrame:
    """Batches merged one by one into a table of a store."""
    store = VersionedStore(spark, shared_dir(spark, "store"), buckets=8)
    columns = [f for f in batches[0].schema if f.name != seq]
    system = struct_of([s for s in table_specs({}) if s.name in (*keys.GENERATED, "_id", "_ts", "_deleted")])
    extra = [f for f in columns if f.name not in system.names]
    store.create("log", StructType([*system.fields, *[StructField(f.name, f.dataType, True) for f in extra]]))
    for b in batches:
        merge.merge_into(store, "log", b, seq)
    return store.read("log")


@query("q08_incremental_fold", HISTORY)
def q08(spark: SparkSession, d: str) -> DataFrame:
    return _fold(spark, _parts(event_log(spark, d)))


@query("q09_out_of_order_fold", HISTORY)
def q09(spark: SparkSession, d: str) -> DataFrame:
    return _fold(spark, _parts(event_log(spark, d))[::-1])


LINES = """(SELECT CAST(l_orderkey AS VARCHAR) AS _id, CAST(l_linenumber AS BIGINT) AS _ts, l_returnflag = 'R' AS _deleted, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey * 100000 + l_suppkey DESC) AS n FROM lineitem)"""


@query("q10_duplicate_key_fold", _generated_sql(f"(SELECT *, max(_ts) OVER (PARTITION BY _id) = _ts AS cur FROM {LINES} WHERE n = 1)", "cur", "_id, _ts, _deleted, l_partkey, l_suppkey, l_quantity, l_extendedprice"))
def q10(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    log = x.select(F.col("l_orderkey").cast("string").alias("_id"), F.col("l_linenumber").cast("long").alias("_ts"), (F.col("l_returnflag") == "R").alias("_deleted"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("seq"))
    # Duplicates meet within a batch only: arrival order is an order within the log.
    batches = [log.where(F.pmod(F.xxhash64("_id"), F.lit(2)) == i) for i in range(2)]
    return _fold(spark, batches, "seq")


_CUT = "(SELECT max(event_id) // 4 + 1 FROM events)"


@query(
    "q11_demoted_rows",
    _generated_sql(
        f"(SELECT * FROM (SELECT *, max(_ts) OVER (PARTITION BY _id) AS top FROM {LOG} WHERE _ts < 3 * {_CUT}) WHERE _ts = top AND _id IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_id >= 3 * {_CUT}))",
        "false",
        COLUMNS,
    ),
)
def q11(spark: SparkSession, d: str) -> DataFrame:
    parts = _parts(event_log(spark, d))
    target = versions.version_history(parts[0].union(parts[1]).union(parts[2]))
    rows = merge.plan_merge(parts[3], versions.current_of(target, parts[3]))
    return merge.demoted(rows, parts[3])


@query("q12_current_lookup", f"SELECT * FROM ({HISTORY}) WHERE __status & 1 = 1 AND _id IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase' AND value > 120)")
def q12(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d)
    return versions.current_of(versions.version_history(log), log.where("event_type = 'purchase' and value > 120")).select(*log.columns, *keys.GENERATED)


@query(
    "q13_upsert",
    f"""WITH h AS ({HISTORY}), u AS (SELECT * REPLACE (value + 1 AS value) FROM h WHERE event_type IN ('purchase', 'signup'))
SELECT * FROM h WHERE event_type <> 'signup' AND __id_ts NOT IN (SELECT __id_ts FROM u) UNION ALL SELECT * FROM u""",
)
def q13(spark: SparkSession, d: str) -> DataFrame:
    h = versions.version_history(event_log(spark, d))
    return versions.upserted(h.where("event_type <> 'signup'"), h.where("event_type in ('purchase', 'signup')").withColumn("value", F.col("value") + 1))


@query(
    "q14_admission_counts",
    """SELECT _table, count(*) AS rows_seen, CAST(count_if(_table IS NOT NULL AND _id IS NOT NULL AND _ts IS NOT NULL) AS BIGINT) AS rows_accepted FROM (
  SELECT nullif(event_type, 'view') AS _table, CASE WHEN value > 1 THEN user_id END AS _id, CASE WHEN value < 200 THEN event_id END AS _ts FROM events)
GROUP BY _table""",
)
def q14(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    value = F.col("value")
    return admission_counts(e.select(F.nullif("event_type", F.lit("view")).alias("_table"), F.when(value > 1, F.col("user_id")).alias("_id"), F.when(value < 200, F.col("event_id")).alias("_ts")))


def _multi(spark: SparkSession, d: str) -> DataFrame:
    parts = (("orders", "o_orderkey", F.col("o_orderstatus") == "F"), ("customer", "c_custkey", F.col("c_acctbal") < 0), ("part", "p_partkey", F.lit(False)))
    out = None
    for name, key, gone in parts:
        x = table(spark, d, name).select(F.lit(name).alias("_table"), F.col(key).cast("string").alias("_id"), F.col(key).alias("_ts"), gone.alias("_deleted"))
        out = x if out is None else out.unionByName(x)
    return out


MULTI = """(SELECT 'orders' AS _table, CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey AS _ts, o_orderstatus = 'F' AS _deleted FROM orders
  UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_custkey, c_acctbal < 0 FROM customer
  UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_partkey, false FROM part)"""


@query("q15_demux_counts", f"SELECT _table, count(*) AS n_rows, count(DISTINCT _id) AS n_ids, CAST(count_if(_deleted) AS BIGINT) AS n_deleted FROM {MULTI} GROUP BY _table")
def q15(spark: SparkSession, d: str) -> DataFrame:
    return _multi(spark, d).groupBy("_table").agg(F.count("*").alias("n_rows"), F.count_distinct("_id").alias("n_ids"), F.count_if("_deleted").alias("n_deleted"))


@query(
    "q16_page_chunks",
    """SELECT page // 3 AS chunk, count(DISTINCT page) AS pages, count(*) AS n_rows, min(event_id) AS first_seq, max(event_id) AS last_seq
FROM (SELECT event_id, event_id // 128 AS page FROM events) GROUP BY 1""",
)
def q16(spark: SparkSession, d: str) -> DataFrame:
    page = table(spark, d, "events").select("event_id", F.expr("event_id div 128").alias("page"))
    return page.groupBy(F.expr("page div 3").alias("chunk")).agg(F.count_distinct("page").alias("pages"), F.count("*").alias("n_rows"), F.min("event_id").alias("first_seq"), F.max("event_id").alias("last_seq"))


@query("q17_as_of_version", _generated_sql(f"(SELECT * FROM (SELECT *, max(_ts) OVER (PARTITION BY _id) AS top FROM {LOG} WHERE _ts <= 6000) WHERE _ts = top AND NOT _deleted)", "true", COLUMNS))
def q17(spark: SparkSession, d: str) -> DataFrame:
    return versions.as_of(event_log(spark, d), 6000)


@query(
    "q18_json_kind_infer",
    """SELECT * FROM (VALUES ('a', 'string', false, NULL), ('b', 'float64', true, NULL), ('c', 'array', false, 'int64'), ('d', 'json', false, NULL), ('e', 'bool', false, NULL), ('f', 'string', true, NULL), ('g', 'float64', false, NULL),
  ('h', 'bool', true, NULL), ('i', 'json', false, NULL)) AS v(field, kind, nullable, element)""",
)
def q18(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of fields as their JSON schemas tell them."""
    fields = {
        "a": {"type": "string"},
        "b": {"anyOf": [{"type": "null"}, {"type": "number"}]},
        "c": {"type": "array", "items": {"type": "integer"}},
        "d": {"anyOf": [{"type": "string"}, {"type": "object"}]},
        "e": {"const": True},
        "f": {"type": "null"},
        "g": {"oneOf": [{"type": "integer"}, {"type": "number"}]},
        "h": {"type": ["boolean", "null"]},
        "i": {},
    }
    rows = [(k, *infer_kind(v)) for k, v in fields.items()]
    return spark.createDataFrame(rows, "field string, kind string, nullable boolean, element string")


_DOC = """CASE event_id % 10 WHEN 0 THEN '{"x":"' || event_type || '"}' WHEN 1 THEN '{"x":' || CAST(event_id AS VARCHAR) || '}' WHEN 2 THEN '{"x":' || CAST(event_id AS VARCHAR) || '.5}'
  WHEN 3 THEN '{"x":' || CAST(event_id AS VARCHAR) || '.0}' WHEN 4 THEN '{"x":true}' WHEN 5 THEN '{"x":null}' WHEN 6 THEN '{"x":[1,2,' || CAST(event_id AS VARCHAR) || ']}'
  WHEN 7 THEN '{"x":{"b":1,"a":"' || event_type || '"}}' WHEN 8 THEN '{"y":1}' ELSE '{"x":"7"}' END"""


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.expr(_DOC.replace("VARCHAR", "STRING")).alias("doc"))


@query(
    "q19_strict_normalise",
    f"""SELECT event_id,
  CASE t WHEN 'VARCHAR' THEN json_extract_string(doc, '$.x') WHEN 'BOOLEAN' THEN 'True' WHEN 'NULL' THEN NULL ELSE CAST(x AS VARCHAR) END AS as_string,
  CASE t WHEN 'VARCHAR' THEN json_extract_string(doc, '$.x') WHEN 'NULL' THEN NULL ELSE CAST(x AS VARCHAR) END AS as_json,
  CASE WHEN t = 'UBIGINT' OR t = 'BIGINT' THEN CAST(CAST(x AS VARCHAR) AS BIGINT)
    WHEN t = 'DOUBLE' AND CAST(CAST(x AS VARCHAR) AS DOUBLE) = floor(CAST(CAST(x AS VARCHAR) AS DOUBLE)) THEN CAST(CAST(CAST(x AS VARCHAR) AS DOUBLE) AS BIGINT) END AS as_int,
  CASE WHEN t IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(CAST(x AS VARCHAR) AS DOUBLE) END AS as_float,
  CASE WHEN t = 'BOOLEAN' THEN CAST(x AS VARCHAR) = 'true' END AS as_bool,
  CASE WHEN t = 'ARRAY' THEN CAST(len(CAST(x AS BIGINT[])) AS INTEGER) END AS array_size
FROM (SELECT event_id, doc, json_extract(doc, '$.x') AS x, json_type(doc, '$.x') AS t FROM (SELECT event_id, {_DOC} AS doc FROM events))""",
)
def q19(spark: SparkSession, d: str) -> DataFrame:
    kinds = (("as_string", "string"), ("as_json", "json"), ("as_int", "int64"), ("as_float", "float64"), ("as_bool", "bool"))
    array = normalized(F.col("doc"), ColumnSpec("x", "array", element="int64"))
    return _docs(spark, d).select("event_id", *[normalized(F.col("doc"), ColumnSpec("x", k)).alias(n) for n, k in kinds], F.when(array.isNotNull(), F.size(array)).alias("array_size"))


_TEXT = """CASE event_id % 14 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN CAST(event_id AS VARCHAR) || '.9' WHEN 2 THEN '-' || CAST(event_id AS VARCHAR) || '.9' WHEN 3 THEN '1e3' WHEN 4 THEN '.5'
  WHEN 5 THEN 'Yes' WHEN 6 THEN ' f ' WHEN 7 THEN 'abc' WHEN 8 THEN '' WHEN 9 THEN '1d' WHEN 10 THEN '300' WHEN 11 THEN '0' WHEN 12 THEN '99999999999999999999' END"""
_NUM = r"regexp_full_match(s, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.expr(_TEXT.replace("VARCHAR", "STRING")).alias("s"))


@query(
    "q20_lenient_coerce",
    f"""SELECT event_id, CASE WHEN {_NUM} THEN TRY_CAST(trunc(TRY_CAST(s AS DOUBLE)) AS BIGINT) END AS as_int, CASE WHEN {_NUM} THEN TRY_CAST(trunc(TRY_CAST(s AS DOUBLE)) AS TINYINT) END AS as_int8,
  CASE WHEN {_NUM} THEN TRY_CAST(s AS DOUBLE) END AS as_float,
  CASE WHEN lower(trim(s)) IN ('true', 't', '1', 'yes') THEN true WHEN lower(trim(s)) IN ('false', 'f', '0', 'no') THEN false END AS as_bool
FROM (SELECT event_id, {_TEXT} AS s FROM events)""",
)
def q20(spark: SparkSession, d: str) -> DataFrame:
    kinds = (("as_int", "int64"), ("as_int8", "int8"), ("as_float", "float64"), ("as_bool", "bool"))
    return _texts(spark, d).select("event_id", *[coerced(F.col("s"), StringType(), k).alias(n) for n, k in kinds])


@query("q20b_coerce_counts", f"SELECT count(s) AS before, count(TRY_CAST(trunc(TRY_CAST(s AS DOUBLE)) AS BIGINT)) AS after FROM (SELECT CASE WHEN s <> '1d' THEN s END AS s0, s FROM (SELECT {_TEXT} AS s FROM events)) WHERE s0 IS NOT NULL OR s IS NULL OR s <> '1d'")
def q20b(spark: SparkSession, d: str) -> DataFrame:
    rows = _texts(spark, d).where("s is null or s <> '1d'")
    return rows.agg(F.count("s").alias("before"), F.count(coerced(F.col("s"), StringType(), "int64")).alias("after"))


_QUOTED = """CASE event_id % 8 WHEN 0 THEN '"' || event_type || '"' WHEN 1 THEN ' "a\\"b' || CAST(event_id AS VARCHAR) || '" ' WHEN 2 THEN '"' || event_type || '" junk' WHEN 3 THEN '"open'
  WHEN 4 THEN '"\\u00e9\\n' || event_type || '"' WHEN 5 THEN '17' WHEN 6 THEN NULL ELSE event_type END"""
_HIT = "coalesce(CASE WHEN json_valid(v) THEN json_type(CAST(v AS JSON)) = 'VARCHAR' ELSE false END, false)"


def _quoted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.expr(_QUOTED.replace("\\", "\\\\").replace("VARCHAR", "STRING")).alias("v"), "event_type")


_QUOTED_FROM = f"(SELECT event_id, {_QUOTED} AS v, event_type FROM events)"


@query("q21_quoted_json_count", f"SELECT CAST(count_if({_HIT}) AS BIGINT) AS v, CAST(0 AS BIGINT) AS event_type FROM {_QUOTED_FROM}")
def q21(spark: SparkSession, d: str) -> DataFrame:
    return repair.quoted_counts(_quoted(spark, d), ["v", "event_type"])


@query("q22_quoted_json_repair", f"SELECT event_id, CASE WHEN {_HIT} THEN json_extract_string(v, '$') ELSE v END AS v, event_type FROM {_QUOTED_FROM}")
def q22(spark: SparkSession, d: str) -> DataFrame:
    return repair.repaired_columns(_quoted(spark, d), ["v"])


#: Rows that the sampled report looks at; up to so many it is exact.
SAMPLED = 10_000_000


@query("q23_quoted_json_sampled", f"SELECT CAST(count_if({_HIT}) AS BIGINT) AS v FROM {_QUOTED_FROM}")
def q23(spark: SparkSession, d: str) -> DataFrame:
    """The sampled count, whose sample is any so many rows."""
    return repair.quoted_counts(_quoted(spark, d), ["v"], SAMPLED)


@query("q24_null_guard_counts", "SELECT CAST(count_if(event_type = 'error') AS BIGINT) AS _id, CAST(0 AS BIGINT) AS _ts FROM events")
def q24(spark: SparkSession, d: str) -> DataFrame:
    rows = event_log(spark, d).withColumn("_id", F.when(~F.col("_deleted"), F.col("_id")))
    return merge.null_counts(rows, StructType([StructField("_id", StringType(), False), StructField("_ts", LongType(), False), StructField("value", LongType(), True)]))


@query("q25_drop_current", _generated_sql(f"(SELECT *, _ts % 2 = 0 AND _ts % 5 > 0 AS cur FROM {LOG})", "cur", COLUMNS))
def q25(spark: SparkSession, d: str) -> DataFrame:
    """Backfill of the generated columns, then the legacy flag goes."""
    store = VersionedStore(spark, shared_dir(spark, "store"), buckets=8)
    store.overwrite("events", _snapshot(spark, d))
    jobs.backfill_generated(store, "events")
    jobs.drop_legacy_current(store, "events")
    return store.read("events")


@query("q26_schema_signature", "SELECT * FROM (VALUES ('event_id', 'bigint', true), ('ts', 'timestamp_ntz', true), ('user_id', 'bigint', true), ('event_type', 'string', true), ('value', 'double', true), ('props', 'string', true)) AS v(name, type, nullable)")
def q26(spark: SparkSession, d: str) -> DataFrame:
    rows = [(n, t, o) for n, t, o, _ in signature(table(spark, d, "events").schema)]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean")


@query("q27_add_column_null_fill", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS note FROM customer")
def q27(spark: SparkSession, d: str) -> DataFrame:
    store = VersionedStore(spark, shared_dir(spark, "store"))
    store.overwrite("customer", table(spark, d, "customer"))
    store.add_columns("customer", [StructField("note", StringType(), False)])
    return store.read("customer")


@query("q28_widen_int", "SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def q28(spark: SparkSession, d: str) -> DataFrame:
    store = VersionedStore(spark, shared_dir(spark, "store"))
    store.overwrite("nation", table(spark, d, "nation"))
    store.widen_columns("nation", {"n_regionkey": LongType()})
    return store.read("nation")


@query("q29_status_counts", f"SELECT __status, count(*) AS n_rows, count(DISTINCT _id) AS n_ids FROM ({HISTORY}) GROUP BY __status")
def q29(spark: SparkSession, d: str) -> DataFrame:
    h = versions.version_history(event_log(spark, d))
    return h.groupBy("__status").agg(F.count("*").alias("n_rows"), F.count_distinct("_id").alias("n_ids"))


@query("q30_label_list_lookup", "SELECT doc_id, lang FROM documents WHERE list_has_any(string_split(text, ' '), ['the', 'der'])")
def q30(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", F.split("text", " ").alias("labels"))
    return jobs.label_lookup(docs, "labels", ["the", "der"]).select("doc_id", "lang")


@query("q31_key_probe", f"SELECT * FROM ({HISTORY}) WHERE __id_ts IN (SELECT CAST(user_id AS VARCHAR) || '#' || CAST(event_id AS VARCHAR) FROM events WHERE event_id IN (1, 77, 400, 999)) OR __id_ts BETWEEN '10#' AND '10#9'")
def q31(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d)
    h = versions.version_history(log)
    wanted = log.where(F.col("_ts").isin(1, 77, 400, 999)).select(F.concat("_id", F.lit("#"), F.col("_ts").cast("string")).alias("__id_ts"))
    between = F.col("__id_ts").between("10#", "10#9")
    return h.join(wanted, "__id_ts", "left_semi").where(~between).unionByName(h.where(between)).select(*log.columns, *keys.GENERATED)


@query("q31b_probe_keys", "SELECT s || '#' || CAST(user_id AS VARCHAR) AS __status_id FROM (SELECT DISTINCT user_id FROM events), (VALUES ('1'), ('3')) AS v(s)")
def q31b(spark: SparkSession, d: str) -> DataFrame:
    return versions.probe_keys(event_log(spark, d).select("_id"))


@query(
    "q32_maintenance_due",
    """SELECT event_id, epoch_us(ts) // 1000000 % 604800 >= 3600 AS optimize_due, hour(ts) >= 7 AND hour(ts) < 12 AS in_window, hour(ts) >= 22 OR hour(ts) < 3 AS in_night FROM events""",
)
def q32(spark: SparkSession, d: str) -> DataFrame:
    ts: Column = F.col("ts").cast("timestamp")
    due = F.expr("unix_micros(cast(ts as timestamp)) div 1000000") % 604800 >= 3600
    return table(spark, d, "events").select("event_id", due.alias("optimize_due"), in_window_column(ts, 7, 12).alias("in_window"), in_window_column(ts, 22, 3).alias("in_night"))


@query("q33_stream_replay", HISTORY)
def q33(spark: SparkSession, d: str) -> DataFrame:
    """The log as a file stream, merged batch by batch; the last two batches are replayed."""
    log, root = event_log(spark, d), shared_dir(spark, "stream")
    for i, part in enumerate(_parts(log)):
        part.coalesce(1).write.parquet(f"{root}/in/{i}")
    store = VersionedStore(spark, f"{root}/store", buckets=8)
    system = struct_of([s for s in table_specs({}) if s.name in (*keys.GENERATED, "_id", "_ts", "_deleted")])
    store.create("log", StructType([*system.fields, *[StructField(f.name, f.dataType, True) for f in log.schema if f.name not in system.names]]))
    for run, pattern in enumerate(("*", "[23]")):
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/{pattern}")
        write = stream.writeStream.foreachBatch(lambda df, _: merge.merge_into(store, "log", df)).option("checkpointLocation", f"{root}/checkpoint{run}")
        write.trigger(availableNow=True).start().awaitTermination()
    return store.read("log")


@query("q34_restore_version", "SELECT r_regionkey, r_name FROM region")
def q34(spark: SparkSession, d: str) -> DataFrame:
    store = VersionedStore(spark, shared_dir(spark, "store"))
    first = store.overwrite("region", table(spark, d, "region"))
    store.delete_where("region", "r_regionkey > 1")
    store.restore("region", first.version)
    return store.read("region")


@query("q35_delete_where", "SELECT * FROM nation WHERE n_regionkey <> 2")
def q35(spark: SparkSession, d: str) -> DataFrame:
    store = VersionedStore(spark, shared_dir(spark, "store"))
    store.overwrite("nation", table(spark, d, "nation"))
    store.delete_where("nation", "n_regionkey = 2")
    return store.read("nation")


@query("q36_compacted", HISTORY)
def q36(spark: SparkSession, d: str) -> DataFrame:
    store = VersionedStore(spark, shared_dir(spark, "store"), buckets=8)
    h = versions.version_history(event_log(spark, d))
    store.create("log", h.schema)
    for i in range(3):
        store.append("log", h.where(F.col("_ts") % 3 == i))
    jobs.create_indexes(store, "log")
    store.compact("log")
    return store.read("log")


@query("q37_physical_names", r"""SELECT DISTINCT l_returnflag || ' ' || l_linestatus AS source_name, lower(l_returnflag || '_' || l_linestatus) AS physical_name FROM lineitem
UNION ALL SELECT DISTINCT '7 ' || c_mktsegment || '!', 't_7_' || lower(c_mktsegment) FROM customer""")
def q37(spark: SparkSession, d: str) -> DataFrame:
    flags = table(spark, d, "lineitem").select(F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("source_name")).distinct()
    segments = table(spark, d, "customer").select(F.concat(F.lit("7 "), "c_mktsegment", F.lit("!")).alias("source_name")).distinct()
    return flags.union(segments).select("source_name", physical_name_column(F.col("source_name")).alias("physical_name"))


@query("q38_conversation_versions", """SELECT CAST(conv_id AS VARCHAR) AS _id, max(turn) AS _ts, false AS _deleted, arg_max(role, turn) AS role, CAST(1 AS TINYINT) AS __status,
  '1#' || CAST(conv_id AS VARCHAR) AS __status_id, CAST(conv_id AS VARCHAR) || '#' || CAST(max(turn) AS VARCHAR) AS __id_ts FROM conversations GROUP BY conv_id""")
def q38(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    return versions.latest(c.select(F.col("conv_id").cast("string").alias("_id"), F.col("turn").alias("_ts"), F.lit(None).cast("boolean").alias("_deleted"), "role"))


@query("q39_incremental_sync", """SELECT CAST(n_nationkey AS VARCHAR) AS _id, CAST(n_nationkey + 1 AS BIGINT) AS _ts, n_regionkey = 0 AS _deleted, n_name AS name, CAST(n_regionkey AS BIGINT) AS region,
  CAST(CASE WHEN n_regionkey = 0 THEN 3 ELSE 1 END AS TINYINT) AS __status, CAST(CASE WHEN n_regionkey = 0 THEN 3 ELSE 1 END AS VARCHAR) || '#' || CAST(n_nationkey AS VARCHAR) AS __status_id,
  CAST(n_nationkey AS VARCHAR) || '#' || CAST(n_nationkey + 1 AS VARCHAR) AS __id_ts FROM nation""")
def q39(spark: SparkSession, d: str) -> DataFrame:
    """The dimension ``nation`` as a paged log of seven rows a page: lease, cursor, schema, chunks, merge."""
    rows = [{"_table": "nation", "_id": str(r["n_nationkey"]), "_ts": r["n_nationkey"] + 1, "_deleted": r["n_regionkey"] == 0, "name": r["n_name"], "region": r["n_regionkey"]} for r in table(spark, d, "nation").orderBy("n_nationkey").collect()]
    schema = {"schemas": {"nation": {"properties": {"name": {"type": "string"}, "region": {"type": "integer"}}}}}

    def transport(url: str, headers: dict[str, str], timeout: float) -> dict:
        parts = urllib.parse.urlsplit(url)
        if parts.path.endswith("schemas"):
            return schema
        at = int(urllib.parse.parse_qs(parts.query)["cursor"][0])
        return {"values": rows[at : at + 7], "cursor": str(min(at + 7, len(rows))), "hasMore": at + 7 < len(rows)}

    root = shared_dir(spark, "sync")
    store, state, log = VersionedStore(spark, f"{root}/store", buckets=4), StateStore(spark, f"{root}/state"), ChangeLog("http://localhost", transport=transport)
    CursorState(state).seed("0")
    sync_once(Ingest(spark, store, state, SchemaCache(state, log), Settings(merge_pages=2, unknown_tables="create"), lambda *_: None), log)
    return store.read("nation").select("_id", "_ts", "_deleted", "name", "region", *keys.GENERATED)


@query("q40_json_or_quoted", f"SELECT event_id, CASE WHEN v IS NULL OR json_valid(v) THEN v ELSE CAST(to_json(v) AS VARCHAR) END AS v FROM {_QUOTED_FROM}")
def q40(spark: SparkSession, d: str) -> DataFrame:
    return _quoted(spark, d).select("event_id", json_or_quoted(F.col("v")).alias("v"))
