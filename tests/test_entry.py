"""The entry module without the optional parts, and with one of their dependencies missing."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OPTIONAL = os.path.isdir(f"{ROOT}/palimpsest/llm") and os.path.isfile(f"{ROOT}/corpus_pipeline.py")


def told(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)}, timeout=120)


def copied(tmp_path, llm):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/palimpsest", tmp_path / "palimpsest", ignore=None if llm else shutil.ignore_patterns("llm"))
    if llm:
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)


def test_without_the_optional_parts(tmp_path):
    copied(tmp_path, False)
    (tmp_path / "palimpsest/llm/__pycache__").mkdir(parents=True)  # what a deletion can leave behind
    got = told(tmp_path, "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))")
    assert got.stdout.split()[1:] == ["False", "True"] and int(got.stdout.split()[0]) > 70, got.stderr


@pytest.mark.skipif(not OPTIONAL, reason="the optional parts are not here")
def test_missing_dependency_is_an_error(tmp_path):
    copied(tmp_path, True)
    got = told(tmp_path, "import sys; sys.modules['xxhash'] = None; import __spark_entry__")
    assert got.returncode and "xxhash" in got.stderr
    got = told(tmp_path, "import __spark_entry__ as e; print('pipeline' in e.queries())")
    assert got.stdout.split() == ["True"], got.stderr
