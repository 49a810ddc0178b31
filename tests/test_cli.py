import json

from palimpsest.cli import COMMANDS, main
from palimpsest.sources.store import VersionedStore


def test_commands(spark, tmp_path, capsys):
    root = f"file://{tmp_path}/store"
    src = f"{tmp_path}/src.parquet"
    spark.createDataFrame([("a", 1, True, False, '"q"'), ("b", 2, False, False, "p")], "_id string, _ts long, _current boolean, _deleted boolean, name string").write.parquet(src)
    run = lambda *a: main([a[0], "--store", root, "--buckets", "2", *a[1:]], spark)
    assert run("migrate-table", "--table", "T", "--source", src, "--where", "_ts > 0", "--order-by", "_ts DESC", "--max-rows", "5") == 0
    store = VersionedStore(spark, root)
    store.overwrite("legacy", spark.read.parquet(src))
    assert run("run-generated-parallel", "--tables", "legacy") == 0
    assert run("run-drop-current-parallel", "--tables", "legacy,missing") == 1
    assert "_current" not in store.read("legacy").columns
    assert run("create-indexes", "--tables", "legacy") == 0
    schema = tmp_path / "schemas.json"
    schema.write_text(json.dumps({"schemas": {"t": {"properties": {"name": {"type": "string"}}}}}))
    capsys.readouterr()
    assert run("discover-quoted-json-string-repairs", "--tables", "t", "--schema-json", f"file://{schema}") == 0
    assert '"candidates": 1' in capsys.readouterr().out
    assert run("repair-quoted-json-strings", "--tables", "t", "--columns", "name", "--apply") == 0
    assert run("repair-quoted-json-strings", "--tables", "t", "--columns", "nope") == 1
    assert sorted(r["name"] for r in store.read("T").collect()) == ["p", "q"]


def test_sync_commands(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "pages.json").write_text(json.dumps([{"from": "0", "cursor": "1", "hasMore": False, "values": [{"_table": "t", "_id": "a", "_ts": 1, "x": "y"}]}]))
    (folder / "schemas.json").write_text(json.dumps({"t": {"properties": {"x": {"type": "string"}}}}))
    args = ["--store", f"file://{tmp_path}/s", "--pages-folder", str(folder), "--unknown-tables", "create", "--seed-cursor", "0"]
    assert main(["incremental-once", *args], spark) == 0
    assert main(["incremental-loop", *args, "--rounds", "1", "--sleep-seconds", "0"], spark) == 0
    assert VersionedStore(spark, f"file://{tmp_path}/s").read("t").count() == 1
    assert len(COMMANDS) == 12
