"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern ``[^\x20\x09-\x0D]+``; ``bytes.split()`` splits on exactly these.
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Rows of one key up to which they are gathered to be joined.
HOT = 1000

_own: dict[str, str] = {}
_kept: set[str] = set()
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where that is unset, in local mode, a temporary folder takes its place.
    """
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="palimpsest-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's part of the shared folder; nothing is created there yet.

    What is still in that part when the application ends goes then, if its driver can still tell.
    """
    base = f"{shared_dir(spark)}/palimpsest/{spark.sparkContext.applicationId}"
    if base not in _kept:
        fs, at = _hadoop(spark, base)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _kept.add(base)
    _made.append(f"{base}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The folders that the block asks for go at its end, but for those that it puts into the list."""
    start, keep = len(_made), []
    try:
        yield keep
    finally:
        delete_dir(spark, *[p for p in _made[start:] if p not in keep])


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, and the folder, for who can tell when it may go."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    return stored(df, name)[0]


def _hadoop(spark: SparkSession, path: str) -> tuple:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete_dir(spark: SparkSession, *paths: str) -> None:
    """Remove folders of intermediate rows through Hadoop's file systems."""
    for path in paths:
        fs, at = _hadoop(spark, path)
        fs.delete(at, True)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else the table has."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """Of the distinct values of ``key`` (nulls do not count) the ``n`` of the smallest hash, fewer only if there are fewer; a table of that column.

    Of a larger table only the hashes below a bound are sorted that lets about twice ``n`` rows through, so what the tasks send to
    the last one does not grow with their number. The bound is raised until it lets ``n`` values through, however often some repeat.
    """
    hash_ = F.xxhash64(key)
    keys = df.where(F.col(key).isNotNull()).select(key)
    share = (2 * n + 1000) / max(1, df.count())
    while share < 1:
        some = keys.where(hash_.cast("double") / 2.0**64 + 0.5 < share).distinct()
        if some.count() >= n:
            return some.orderBy(hash_, key).limit(n)
        share *= 16
    return keys.distinct().orderBy(hash_, key).limit(n)


def join_classes(rows: DataFrame, classes: DataFrame, key: str, most: int = HOT, parts: int = 100_000) -> DataFrame:
    """``rows`` with the columns of ``classes``, which has one row for each ``key`` and the number ``n`` of rows that hold it.

    Keys that over ``most`` rows hold, and over one row in ``parts``, are fewer than ``parts``; they are broadcast, and their rows stay where they are.
    """
    total = classes.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(most, total // parts)
    loud = F.broadcast(classes.where(hot).drop("n"))
    near = rows.join(loud, key)
    rest = rows.join(F.broadcast(classes.where(hot).select(key)), key, "left_anti")
    return near.unionByName(rest.join(classes.where(~hot).drop("n"), key))


def spans(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring rows of at most ``most`` bytes together, given the bytes of each; a larger row is a run of its own."""
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, end
        at = end


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: the distinct ones, the number of each in their order, and where each text's start, with the end."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    coded = lists.values.dictionary_encode()
    index, starts = coded.indices.to_numpy(), lists.offsets.to_numpy()
    words = strings(coded.dictionary)
    if "" in words:  # what stands before a first gap or behind a last one
        filled = index != words.index("")
        starts = np.r_[0, np.cumsum(filled)][starts]
        index = index[filled]
    return words, index, starts


def strings(texts: pa.Array) -> list[str]:
    """Far faster than ``to_pylist``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
