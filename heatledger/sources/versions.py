"""Versions of a group of folders behind a pointer: a reader sees all of a change or nothing of it.

A change writes new folders first and creates the next pointer last, a small JSON file that names every folder of the version. A stop before
that leaves the earlier version as it was; what the stopped change wrote is named by no pointer and goes with the next clean-up.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Versions:
    """Pointers ``versions/<number>.json`` and folders ``data/<name>`` below ``root``, in whatever file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        """The numbers of all versions, in order."""
        return sorted(int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and n[:-5].isdigit())

    def content(self, number: int) -> dict:
        """What the pointer of a version says."""
        stream = self._fs.open(self._path(f"{self.root}/versions/{number}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """The newest version and its content; -1 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.content(numbers[-1])) if numbers else (-1, {})

    def fresh(self, name: str) -> str:
        """A folder that nothing uses yet, as its name below ``data``."""
        return f"{name}-{uuid.uuid4().hex}"

    def at(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def commit(self, number: int, content: dict) -> None:
        """Make ``content`` version ``number``; an error if another writer has made it already."""
        target, staged = (self._path(f"{self.root}/versions/{x}") for x in (f"{number}.json", f".{number}-{uuid.uuid4().hex}"))
        out = self._fs.create(staged, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        if self._fs.exists(target) or not self._fs.rename(staged, target):
            self._fs.delete(staged, False)
            raise FileExistsError(f"version {number} of {self.root} is there already")

    def clean(self, keep: int = 2) -> None:
        """Remove pointers but the newest ``keep`` and folders that none of these names (as a string anywhere in its content).

        Only a writer may call it, and only one writer at a time: a folder being written is named by no pointer yet.
        """
        numbers = self.numbers()
        named = "".join(json.dumps(self.content(n)) for n in numbers[-keep:])
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.root}/versions/{n}.json"), False)
        for name in self._names("data"):
            if name not in named:
                self._fs.delete(self._path(self.at(name)), True)
