"""Stored tables without a table format: versioned folders behind a pointer, and partitioned change tables.

A job that reads a table and replaces it must not overwrite the parts it reads. Each write
therefore goes to a new version folder that gets its name once it is complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.sources.commits import Folder


class VersionedTable:
    """A Parquet table whose current version is the newest committed folder.

    A version is written under a draft name and committed by a rename that fails where another
    writer has taken its number; a draft is never read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._root = Folder(spark, self.path)

    def versions(self) -> list[str]:
        """Committed versions, oldest first; a folder without its success mark does not count."""
        return [n for n in self._root.names() if n.startswith("v") and self._root.exists(f"{n}/_SUCCESS")]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no committed version below {self.path}")
        return self.spark.read.parquet(f"{self.path}/{found[-1]}")

    def overwrite(self, df: DataFrame) -> DataFrame:
        """Write the next version and return it; readers of earlier versions are not disturbed."""
        found = self.versions()
        number = int(found[-1][1:].split("-")[0]) + 1 if found else 0
        target, draft = f"v{number:010d}", f".draft-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{draft}")
        self._root.rename_new(draft, target)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{target}")

    def vacuum(self, keep: int = 2, older_than_seconds: float = 24 * 3600) -> None:
        """Delete versions but the newest `keep`, and drafts left behind, unless they are younger than the age."""
        old = self.versions()[:-keep] + [n for n in self._root.names() if n.startswith(".draft-")]
        for name in old:
            if self._root.age_seconds(name) >= older_than_seconds:
                self._root.delete(name)

    def upsert(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Replace matched keys and add the rest; creates the table when there is none."""
        return self.overwrite(upsert_by_key(self.read(), source, keys) if self.exists() else source)


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose key the source does not bring, plus the source.

    Columns the source leaves out keep the target's value on matched rows; columns only the
    source has are added.
    """
    kept = [c for c in target.columns if c not in source.columns]
    if kept:
        source = source.join(target.select(*keys, *kept), list(keys), "left")
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True)


class ChangeTable:
    """Changes partitioned by effective date; writing a date again replaces only that date."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition

    def exists(self) -> bool:
        return Folder(self.spark, self.path).exists()

    def clear(self) -> None:
        """Remove all partitions."""
        if self.exists():
            Folder(self.spark, self.path).delete("")

    def write(self, df: DataFrame, first_load: bool = False) -> None:
        """``first_load`` replaces the whole table."""
        mode = "static" if first_load else "dynamic"
        df.hint("rebalance", self.partition).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(self.partition).parquet(self.path)

    def replace(self, df: DataFrame, value: str) -> None:
        """The rows of one partition, which may be none; nothing that `df` reads may lie in it."""
        df.drop(self.partition).hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/{self.partition}={value}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).withColumn(self.partition, F.col(self.partition).cast("date"))

    def read_one(self, value: str) -> DataFrame | None:
        """One partition, None where it was never written."""
        if not Folder(self.spark, self.path).exists(f"{self.partition}={value}"):
            return None
        part = self.spark.read.parquet(f"{self.path}/{self.partition}={value}")
        return part.withColumn(self.partition, F.lit(value).cast("date"))
