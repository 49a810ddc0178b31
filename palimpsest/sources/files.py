"""Small files through Hadoop's file systems, so that any store Spark reaches will do."""

from __future__ import annotations

import json
import time
from typing import Any

from pyspark.sql import SparkSession

#: Times and pauses that a reader gives a writer which has created a file but not closed it yet.
TRIES, PAUSE = 20, 0.1
#: Seconds after which a file that still holds no whole value is what a dead writer left.
STALE = 60


class Files:
    """Reads, lists and exclusively creates files below any path that Spark can open."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def read(self, path: str) -> str | None:
        """A file's text, or None if there is no such file."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read_json(self, path: str) -> Any:
        """A file's JSON value; one that is still being written is waited for."""
        for left in reversed(range(TRIES)):
            text = self.read(path)
            if text is None:
                return None
            try:
                return json.loads(text)
            except ValueError:
                if not left:
                    raise
                time.sleep(PAUSE)
        return None

    def newest_json(self, folder: str, names: list[str]) -> tuple[str | None, Any]:
        """The last of the names whose file holds a whole value, and the value.

        A writer that died between creating and closing a file leaves it torn; such files are passed over
        once they are ``STALE`` seconds old, before that they raise.
        """
        for name in reversed(names):
            try:
                return name, self.read_json(f"{folder}/{name}")
            except ValueError:
                if self.age(f"{folder}/{name}") < STALE:
                    raise
        return None, None

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if the name is taken. As exclusive as the file system's own creation is."""
        fs, p = self._at(path)
        if fs.exists(p):
            return False
        fs.mkdirs(p.getParent())
        # Creation without overwriting decides who wins; a rename over a taken name would not on every store.
        try:
            stream = fs.create(p, False)
        except Exception as e:
            if fs.exists(p):
                return False
            raise e
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def age(self, path: str, now: float | None = None) -> float:
        """Seconds since a file or folder was last changed."""
        fs, p = self._at(path)
        return (time.time() if now is None else now) - int(fs.getFileStatus(p).getModificationTime()) / 1000
