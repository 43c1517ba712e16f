"""Commits to stored tables that exactly one of several writers can make.

A commit is a file or folder that gets its final name by a rename which fails if the name is taken.
That is atomic on stores that keep all names in one place; local ones check before they rename.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


class Folder:
    """A folder of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    @property
    def _fs(self):
        return self._at().getFileSystem(self._conf)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name))) if self.exists(name) else []

    def age_seconds(self, name: str) -> float:
        return self._jvm.java.lang.System.currentTimeMillis() / 1000 - self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def rename_new(self, source: str, target: str) -> None:
        """Rename within the folder; ConcurrentWrite if the target is there already."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at().toUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(kind, 0)
        if self.exists(target):
            raise ConcurrentWrite(f"{self.path}/{target} was committed by another writer meanwhile")
        try:
            context.rename(self._at(source), self._at(target), none)
        except Exception as error:
            if self.exists(target):
                raise ConcurrentWrite(f"{self.path}/{target} was committed by another writer meanwhile") from error
            raise

    def read_json(self, name: str) -> dict:
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit_json(self, name: str, content: dict) -> None:
        """A new small file, complete or not there at all."""
        draft = f".{name}-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        try:
            self.rename_new(draft, name)
        except ConcurrentWrite:
            self.delete(draft)
            raise
