"""Small files on whatever file system a path names, through Spark's own (local, HDFS, object stores).

State that executors must see later (landed lists, stream tables) goes through here,
so it never depends on the driver's disk. A path without a scheme is in the session's default file system.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Store:
    """Reads, writes and lists files by path. Usable from several threads."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple[Any, Any]:
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def read(self, path: str) -> bytes:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        """Writes beside and then renames, so readers see the old or the new file."""
        fs, p = self._at(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        fs.delete(p, False)
        if not fs.rename(beside, p):
            raise OSError(f"could not rename {beside.toString()} to {path}")

    def read_json(self, path: str) -> dict[str, Any]:
        """The document of a file; empty if there is none."""
        return json.loads(self.read(path)) if self.exists(path) else {}

    def write_json(self, path: str, document: dict[str, Any]) -> None:
        self.write(path, json.dumps(document, ensure_ascii=False, default=str).encode())

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it is absent."""
        fs, p = self._at(folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def full(self, path: str) -> str:
        """The path as Spark reports it for a file that it reads."""
        fs, p = self._at(path)
        return fs.makeQualified(p).toString()
