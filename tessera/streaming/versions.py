"""Versioned tables: new folders and a pointer, never an overwrite.

A table's current content is named by its newest version: a small JSON document under
``<path>/versions``, put there by one rename after everything it names has been written.  Readers see the
old version or the new one; a crash in between leaves the old one and some unnamed folders, which
:meth:`Versions.prune` removes.  One writer at a time is assumed, as a streaming query is.

Files are reached through the session's Hadoop file system, so any shared folder will do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

DIGITS = 12


class Versions:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def _numbers(self) -> list[int]:
        return [int(n[:DIGITS]) for n in self._names("versions") if n.endswith(".json") and n[0] != "."]

    def _read(self, number: int) -> dict:
        stream = self.fs.open(self._path(f"{self.path}/versions/{number:0{DIGITS}d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """Number and content of the newest version; (-1, {}) if there is none."""
        numbers = self._numbers()
        return (numbers[-1], self._read(numbers[-1])) if numbers else (-1, {})

    def folder(self, name: str) -> str:
        """A fresh folder for data of this table, relative to it."""
        return f"data/{name}-{uuid.uuid4().hex[:12]}"

    def full(self, folder: str) -> str:
        return f"{self.path}/{folder}"

    def publish(self, number: int, content: dict) -> int:
        """Make ``content`` the version after ``number``."""
        name = f"{number + 1:0{DIGITS}d}.json"
        draft = self._path(f"{self.path}/versions/.{name}-{uuid.uuid4().hex[:8]}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        final = self._path(f"{self.path}/versions/{name}")
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            raise RuntimeError(f"{self.path} has a version {number + 1} already: two writers?")
        return number + 1

    def prune(self, keep: int = 2) -> None:
        """Remove versions before the newest ``keep`` ones, and folders that none of those names.

        Readers that planned their scan on a version that old lose its files: keep as many versions as
        are published while the longest read runs.
        """
        numbers = self._numbers()
        kept = json.dumps([self._read(n) for n in numbers[-keep:]])
        for n in numbers[:-keep]:
            self.fs.delete(self._path(f"{self.path}/versions/{n:0{DIGITS}d}.json"), False)
        for name in self._names("data"):
            if f'"data/{name}"' not in kept:
                self.fs.delete(self._path(f"{self.path}/data/{name}"), True)
