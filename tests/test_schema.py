import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, StringType

from palimpsest.functions.coerce import coerced
from palimpsest.functions.jsontext import double_text, is_json, is_quoted, json_or_quoted, unquoted
from palimpsest.functions.naming import file_stem, physical_name, physical_names, require_identifier
from palimpsest.functions.normalize import ascii_json, normalized
from palimpsest.plans.reconcile import SchemaDrift, UnknownTable, reconcile, reconcile_existing
from palimpsest.plans.schema import ColumnSpec, compatible, expanded, infer_kind, struct_of, table_specs, widens

S, N, B, I, O = ({"type": t} for t in ("string", "number", "boolean", "integer", "object"))


@pytest.mark.parametrize(
    ("schema", "kind", "element"),
    [
        (S, "string", None),
        ({"anyOf": [S, N]}, "string", None),
        ({"anyOf": [S, O]}, "json", None),
        ({"anyOf": [I, N]}, "float64", None),
        ({"anyOf": [B, I]}, "int64", None),
        ({"oneOf": [{"anyOf": [B, {"type": "null"}]}, {"const": True}]}, "bool", None),
        ({"type": "array", "items": N}, "array", "float64"),
        ({"type": "array", "items": O}, "json", None),
        ({"type": "array", "items": {"anyOf": [S, {"type": "null"}]}}, "json", None),
        ({"type": "array"}, "json", None),
        ({"type": "object", "x-note": "record"}, "json", None),
        ({"x-vendor": "any"}, "json", None),
        ({}, "json", None),
        ({"type": "null"}, "string", None),
        ({"const": 3}, "int64", None),
        ({"const": 3.5}, "float64", None),
        ({"const": "a"}, "string", None),
        ({"type": ["integer", "null"]}, "int64", None),
        ({"type": ["string", "number"]}, "string", None),
    ],
)
def test_infer(schema, kind, element):
    got = infer_kind(schema)
    assert (got[0], got[2]) == (kind, element)


def test_null_alone_is_a_nullable_placeholder():
    assert infer_kind({"type": "null"}) == ("string", True, None)
    assert infer_kind({"anyOf": [S, {"type": "null"}]})[1] is True


def test_expand():
    v = {"type": "object", "value": {"b": {"fieldType": {"type": "union", "value": [{"type": "id"}, {"type": "bigint"}]}, "optional": True}, "a": {"fieldType": {"type": "array", "value": {"type": "number"}}}}}
    got = expanded(v)
    assert list(got["properties"]) == ["a", "b"] and got["required"] == ["a"]
    assert got["properties"]["a"] == {"type": "array", "items": {"type": "number"}}
    assert [m.get("type") for m in got["properties"]["b"]["anyOf"][1]["anyOf"]] == ["string", "integer"]
    assert expanded({"type": "literal", "value": 3}) == {"const": 3}


def test_specs_are_sorted_and_nullable():
    specs = table_specs({"type": "object", "properties": {"z": N, "completedAt": S, "_id": S, "_current": B, "bad": 3}, "required": ["completedAt"]})
    assert [s.name for s in specs[-2:]] == ["completedAt", "z"] and not specs[-2].required
    assert [f.name for f in struct_of(specs) if not f.nullable] == ["_id", "_ts", "_deleted", "__status", "__status_id", "__id_ts"]
    with pytest.raises(ValueError):
        ColumnSpec("x", "map").data_type()


def test_compatible_and_widening():
    assert compatible(LongType(), ByteType()) and compatible(FloatType(), DoubleType())
    assert not compatible(StringType(), DoubleType()) and not compatible(LongType(), DoubleType())
    assert widens(IntegerType(), LongType()) and not widens(LongType(), IntegerType()) and not widens(IntegerType(), DoubleType())


def test_names():
    assert [physical_name(x) for x in ("Record Work-Items", "_x", "!!", "9 lives", "Größe")] == ["record_work_items", "x", "table", "t_9_lives", "größe"]
    assert physical_names(["A b", "c"]) == {"a_b": "A b", "c": "c"}
    with pytest.raises(ValueError):
        physical_names(["A-b", "a_b"])
    with pytest.raises(ValueError):
        require_identifier("a; drop")
    assert file_stem("a/b:1") == "a_b_1"


DOCS = ['{"x":"t"}', '{"x":{"a":1,"b":[1,2]}}', '{"x":true}', '{"x":3}', '{"x":3.5}', '{"x":4.0}', '{"x":null}', "{}", '{"x":"7"}', '{"x":[1,2]}']


@pytest.mark.parametrize(
    ("kind", "want"),
    [
        ("string", ["t", '{"a":1,"b":[1,2]}', "True", "3", "3.5", "4.0", None, None, "7", "[1,2]"]),
        ("json", ["t", '{"a":1,"b":[1,2]}', "true", "3", "3.5", "4.0", None, None, "7", "[1,2]"]),
        ("int64", [None, None, None, 3, None, 4, None, None, None, None]),
        ("float64", [None, None, None, 3.0, 3.5, 4.0, None, None, None, None]),
        ("bool", [None, None, True, None, None, None, None, None, None, None]),
        ("array", [None] * 9 + [[1, 2]]),
    ],
)
def test_strict(spark, kind, want):
    df = spark.createDataFrame(list(enumerate(DOCS)), "i int, doc string")
    got = df.select("i", normalized(F.col("doc"), ColumnSpec("x", kind, element="int64")).alias("v")).orderBy("i").collect()
    assert [r["v"] for r in got] == want


TEXTS = ["42", "42.9", "-7.9", "1e3", ".5", "5.", "1d", "0x1p3", "abc", "", None, "300", "99999999999999999999", " 7 ", "nan", "TRUE", " f ", "yes", "n"]


@pytest.mark.parametrize(
    ("kind", "want"),
    [
        ("int64", [42, 42, -7, 1000, 0, 5, None, None, None, None, None, 300, None, 7, None, None, None, None, None]),
        ("int8", [42, 42, -7, None, 0, 5, None, None, None, None, None, None, None, 7, None, None, None, None, None]),
        ("bool", [None] * 15 + [True, False, True, None]),
    ],
)
def test_lenient_text(spark, kind, want):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, s string")
    assert [r["v"] for r in df.select("i", coerced(F.col("s"), StringType(), kind).alias("v")).orderBy("i").collect()] == want


def test_lenient_others(spark):
    df = spark.createDataFrame([(1.9, True, 10**10, 1e10, 1e16, 1.5e-5, [1])], "d double, b boolean, l long, e double, f double, g double, a array<int>")
    types = {f.name: f.dataType for f in df.schema}
    col = lambda c, k: coerced(F.col(c), types[c], k).alias(f"{c}_{k}")
    got = df.select(col("d", "int64"), col("b", "int64"), col("b", "string"), col("l", "int8"), col("l", "float64"), col("e", "string"), col("f", "string"), col("g", "string"), col("a", "json"), col("d", "bool")).first()
    assert list(got) == [1, None, "True", None, 1e10, "10000000000.0", "1e+16", "1.5e-05", "[1]", None]
    assert spark.range(1).select(double_text(F.lit(0.1)), double_text(F.lit(-12345678.5))).first()[:] == ("0.1", "-12345678.5")


def test_quoted_literals(spark):
    texts = ['"a"', ' "a\\"b" ', '"a" junk', '"open', '"\\u00e9\\n"', "17", None, '"\x01"', '"\\x"', '""', '"\\ud83d\\ude00"', '"\\ud800"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = df.select("i", F.when(is_quoted(F.col("s")), unquoted(F.col("s"))).alias("v"), is_quoted(F.col("s"), True).alias("tight")).orderBy("i").collect()
    assert [r["v"] for r in got] == ["a", 'a"b', None, None, "é\n", None, None, None, None, "", "😀", None]
    assert [r["tight"] for r in got][:2] == [True, False]


def test_ascii_json(spark):
    assert spark.range(1).select(ascii_json(F.lit('{"é":"😀a"}'))).first()[0] == '{"\\u00e9":"\\ud83d\\ude00a"}'


def make(spark, store, rows):
    df = spark.createDataFrame(rows, "_id string, claim string, note string")
    store.overwrite("Claims", df)


def test_drift_is_coerced(spark, store):
    make(spark, store, [("a", "42", "x"), ("b", "bad", "y"), ("c", None, None)])
    got = reconcile(store, "Claims", {"properties": {"claim": N, "note": S, "fresh": B}})
    assert [a["action"] for a in got.actions] == ["add", "coerce"]
    assert got.actions[1]["stats"]["claim"] == {"before": 2, "after": 1, "newly_nulled": 1}
    assert {r["_id"]: r["claim"] for r in store.read("Claims").collect()} == {"a": 42.0, "b": None, "c": None}
    assert store.schema("Claims")["fresh"].nullable


def test_drift_refuses_to_lose_everything(spark, store):
    make(spark, store, [("a", "xyz", "x"), ("b", "pqr", "y")])
    with pytest.raises(SchemaDrift):
        reconcile(store, "Claims", {"properties": {"claim": N}})
    with pytest.raises(SchemaDrift):
        reconcile(store, "Claims", {"properties": {"claim": N}}, coerce=False)
    assert store.read("Claims").count() == 2


def test_policies_and_collected_failures(spark, store):
    with pytest.raises(UnknownTable):
        reconcile(store, "new", {"properties": {}})
    assert reconcile(store, "new", {"properties": {}}, "skip").skipped
    assert reconcile(store, "new", {"properties": {"a": S}}, "create").actions[0]["action"] == "create"
    store.recreate_empty("new", struct_of([ColumnSpec("a", "int64")]))
    assert reconcile(store, "new", {"properties": {"a": S}}).actions[-1]["action"] == "recreate"
    make(spark, store, [("a", "1", "x")])
    done, failed = reconcile_existing(store, {"Claims": {"properties": {"extra": N}}, "new": {"properties": {"b": S}}})
    assert len(done) == 2 and not failed and "extra" in store.schema("Claims").names


def test_json_or_quoted(spark):
    texts = ["1", '{"a":[1]}', "null", '"x"', '"x" junk', "1,2", "1] [2", '1} {"a":2', "", " ", "plain", None, ' true ', 'say "hi"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = df.select("i", is_json(F.col("s")).alias("j"), json_or_quoted(F.col("s")).alias("q")).orderBy("i").collect()
    assert [r["j"] for r in got] == [True, True, True, True] + [False] * 8 + [True, False]
    assert got[4]["q"] == '"\\"x\\" junk"' and got[10]["q"] == '"plain"' and got[11]["q"] is None and got[13]["q"] == '"say \\"hi\\""'
