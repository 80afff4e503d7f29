"""One pointer file that says which folders of plain Parquet make up a table.

The pointer is a small JSON file with a number in its name. It is written aside and renamed without
overwriting, so of two writers that start from the same state one is told so. That is safe where
such a rename is atomic (HDFS, local disks); an object store is not such a place. Data folders are
never overwritten, so a reader that follows the pointer sees the old state or the new one.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer moved the pointer first."""


class Pointer:
    """The pointer of the table under ``root``; files by Hadoop's interface, the only one that
    reaches all of Spark's file systems."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        path = self._hadoop.Path(self.root)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._options = spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 1)
        self._options[0] = self._hadoop.Options.Rename.NONE

    def _path(self, name: str):
        return self._files.makeQualified(self._hadoop.Path(f"{self.root}/{name}"))

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        found = self._files.listStatus(path) if self._files.exists(path) else []
        return sorted(s.getPath().getName() for s in found if s.getPath().getName()[0] != ".")

    def new_folder(self) -> str:
        """A data folder that no other try writes to."""
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def read(self) -> tuple[int, dict]:
        """Number and content; 0 and nothing before the first move."""
        names = self._names("pointer")
        if not names:
            return 0, {}
        stream = self._files.open(self._path(f"pointer/{names[-1]}"))
        try:
            return int(names[-1]), json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def move(self, number: int, content: dict) -> None:
        """Point to ``content``; :class:`CommitConflict` if ``number`` is taken."""
        aside, target = (self._path(f"pointer/{n}") for n in (f".{uuid.uuid4().hex}", f"{number:010d}"))
        stream = self._files.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(content).encode("utf-8")))
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(self._files.getUri(), self._files.getConf())
        try:
            context.rename(aside, target, self._options)
        except Py4JJavaError as error:
            self._files.delete(aside, False)
            if not self._files.exists(target):
                raise
            raise CommitConflict(f"{self.root} has moved to {number} before") from error

    def clean(self, grace_hours: float = 24.0) -> list[str]:
        """Remove data folders that the pointer doesn't name, and earlier pointers.

        What is younger than ``grace_hours`` stays, as a reader or a load may use it. Gives the
        names of the folders removed.
        """
        number, content = self.read()
        named, before = json.dumps(content), (time.time() - grace_hours * 3600) * 1000
        removed = []
        for name in self._names("data"):
            path = self._path(f"data/{name}")
            if name not in named and self._files.getFileStatus(path).getModificationTime() <= before:
                self._files.delete(path, True)
                removed.append(name)
        for name in self._names("pointer")[:-1]:
            if int(name) < number:
                self._files.delete(self._path(f"pointer/{name}"), False)
        return removed
