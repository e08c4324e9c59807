"""Atomic commits of several output folders at once.

Work is written to a staging folder of its own name, then committed by one
file in ``_commits`` (written aside and renamed), then published: its part
files move into the output folders.  Before the commit nothing of it is in
an output folder; after it the rest of the moves is made up for by whoever
opens the folder next.  So a writer can be ended at any point and started
again: no row is lost and none is there twice.

A commit carries a small state (a JSON value) that the next writer starts
from.  Commits are numbered; two writers that commit the same number cannot
both succeed.  All files go through Hadoop's file system, so the folder may
be in any store that Spark writes to.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

#: Commit files kept; older ones are told by the later ones' state.
KEPT_COMMITS = 3


class Files:
    """The few calls made to Hadoop's file system."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._read = jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, src: str, dst: str) -> bool:
        return self._fs.rename(self._path(src), self._path(dst))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._read(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()


class CommitLog:
    """Commits of the folders ``tables`` (name -> path), kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str]):
        self.root, self.tables = root.rstrip("/"), {k: v.rstrip("/") for k, v in tables.items()}
        self.files = Files(spark, root)

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.root}/_commits") if n.endswith(".json") and n[:-5].isdigit()]

    def last(self) -> dict:
        """The last commit: its number, names of work by writer, state."""
        numbers = self._numbers()
        if not numbers:
            return {"number": 0, "done": {}, "state": None}
        return json.loads(self.files.read(f"{self.root}/_commits/{numbers[-1]:012d}.json"))

    @staticmethod
    def is_done(commit: dict, writer: str, step: int) -> bool:
        """A writer's steps are committed in rising order."""
        return commit["done"].get(writer, -1) >= step

    @staticmethod
    def name(writer: str, step: int) -> str:
        return f"{writer}-{step:012d}"

    def staging(self, writer: str, step: int, table: str = "") -> str:
        return f"{self.root}/_staging/{self.name(writer, step)}" + (f"/{table}" if table else "")

    def commit(self, after: dict, writer: str, step: int, state) -> dict:
        """Commit a step on top of the commit ``after``."""
        number = after["number"] + 1
        entry = {"number": number, "done": after["done"] | {writer: step}, "state": state}
        self.files.mkdirs(f"{self.root}/_commits")
        aside = f"{self.root}/_commits/_{number:012d}.{self.name(writer, step)}"
        self.files.write(aside, json.dumps(entry))
        final = f"{self.root}/_commits/{number:012d}.json"
        if self.files.exists(final) or not self.files.rename(aside, final):
            raise RuntimeError(f"another writer committed {final}")
        return entry

    def publish(self) -> None:
        """Move what is committed and still staged into the tables; remove
        staged work that never was committed, and old commit files."""
        done = self.last()["done"]
        for name in self.files.names(f"{self.root}/_staging"):
            writer, _, step = name.rpartition("-")
            if done.get(writer, -1) >= int(step):
                for table, path in self.tables.items():
                    staged = f"{self.root}/_staging/{name}/{table}"
                    for part in self.files.names(staged):
                        if part.startswith("part-"):
                            self._move(f"{staged}/{part}", path, f"{name}-{part}")
            self.files.delete(f"{self.root}/_staging/{name}")
        for number in self._numbers()[:-KEPT_COMMITS]:
            self.files.delete(f"{self.root}/_commits/{number:012d}.json")

    def _move(self, staged: str, folder: str, name: str) -> None:
        self.files.mkdirs(folder)
        if self.files.exists(f"{folder}/{name}"):  # a copy was made, its source was left
            self.files.delete(staged)
        elif not self.files.rename(staged, f"{folder}/{name}"):
            raise RuntimeError(f"cannot move {staged} to {folder}/{name}")
