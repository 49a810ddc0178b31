"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}
_kept: set[str] = set()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; only in local mode, where that is unset, below a temporary folder."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="palimpsest-core-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        told = f"file://{_own[app]}"
    base = f"{told.rstrip('/')}/palimpsest/{spark.sparkContext.applicationId}-core"
    if base not in _kept:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)  # what is still there when the application ends
        _kept.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"
