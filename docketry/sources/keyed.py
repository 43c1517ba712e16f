"""A stored table that is changed by key, without a table format.

Rows are dealt out to buckets by a hash of their key. A change writes new parts for the buckets that it
touches and leaves all others alone; a commit then names the parts of every bucket. Readers follow
the newest commit. A writer whose base was overtaken fails before anything of it can be seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.session import stage
from docketry.sources.commits import ConcurrentWrite, Folder
from docketry.sources.counted import Counted

BUCKET = "key_bucket"
__all__ = ["BUCKET", "ConcurrentWrite", "KeyedTable"]


class KeyedTable:
    """Rows by key, in a fixed number of buckets.

    The number of buckets is chosen when the table is created and then kept; choose it so that a
    bucket is a few hundred megabytes. Tags are small values that a commit carries along with the
    rows, such as the number of the micro-batch that it holds.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self._buckets = spark, path.rstrip("/"), list(keys), buckets
        self._root, self._commits = Folder(spark, self.path), Folder(spark, f"{self.path}/commits")

    def commits(self) -> list[str]:
        """Names of the commits, oldest first."""
        return [n for n in self._commits.names() if not n.startswith(".")]

    def head(self) -> dict | None:
        """The newest commit: number, schema, parts per bucket, tags."""
        names = self.commits()
        return self._commits.read_json(names[-1]) if names else None

    def exists(self) -> bool:
        return bool(self.commits())

    def rows(self) -> int:
        """Number of rows, as the commits have counted them."""
        return self.head()["rows"]

    def tags(self) -> dict:
        return (self.head() or {"tags": {}})["tags"]

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as of the newest commit, or some of its buckets."""
        head = self.head()
        if head is None:
            raise FileNotFoundError(f"no commit below {self.path}")
        return self._read(head, buckets)

    def _read(self, head: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(head["schema"])
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [f"{self.path}/data/{part}/{BUCKET}={b}" for b, part in head["parts"].items() if wanted is None or b in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, number: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(number)).cast("int")

    def _write(self, dealt: DataFrame) -> tuple[str, list[str], int]:
        """Parts of all buckets that occur in the column BUCKET, not visible yet, and their rows."""
        part, counted = uuid.uuid4().hex, Counted(dealt)
        counted.df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{part}")
        return part, [n.split("=")[1] for n in self._root.names(f"data/{part}") if n.startswith(f"{BUCKET}=")], counted.rows

    def _commit(self, base: dict | None, schema: T.StructType, parts: dict[str, str], rows: int, tags: dict | None) -> DataFrame:
        number = base["number"] + 1 if base else 0
        content = {
            "number": number, "buckets": base["buckets"] if base else self._buckets, "schema": json.loads(schema.json()),
            "parts": parts, "rows": rows, "tags": (base["tags"] if base else {}) | (tags or {}),
        }
        self._commits.commit_json(f"{number:010d}.json", content)
        return self._read(content)

    def overwrite(self, df: DataFrame, tags: dict | None = None) -> DataFrame:
        """Replace all rows; keys need not be unique or set."""
        base = self.head()
        part, found, rows = self._write(df.withColumn(BUCKET, self._bucket(base["buckets"] if base else self._buckets)))
        return self._commit(base, df.schema, {b: part for b in found}, rows, tags)

    def tag(self, tags: dict) -> None:
        """A commit that changes tags only."""
        base = self.head()
        if base is None:
            raise FileNotFoundError(f"no commit below {self.path}")
        self._commit(base, T.StructType.fromJson(base["schema"]), base["parts"], base["rows"], tags)

    def _aligned(self, source: DataFrame, schema: T.StructType) -> DataFrame:
        """Shared columns in the stored types, so that equal keys have equal hashes."""
        types = {f.name: f.dataType for f in schema}
        return source.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in source.columns])

    def touched(self, source: DataFrame) -> list[int]:
        """Buckets that the keys of a table fall into; at most all buckets there are."""
        head = self.head()
        keys = self._aligned(source, T.StructType.fromJson(head["schema"])).select(*self.keys)
        return sorted(r[0] for r in keys.select(self._bucket(head["buckets"])).distinct().collect())

    def upsert(self, source: DataFrame, update: Sequence[str] | None = None, gone: str | None = None, tags: dict | None = None) -> DataFrame:
        """Change matched keys, add the others, and return the table; the first upsert creates it.

        `update` names the columns that matched rows take from the source, by default all that it has;
        they keep the others. New rows take all. Columns that one side lacks are null there. Rows where the
        column `gone` is true remove their key. A key may occur once in the source; null parts of keys match each other.
        """
        base = self.head()
        if base is None:
            self._once(source)
            rows = source if gone is None else source.where(~F.coalesce(gone, F.lit(False))).drop(gone)
            return self.overwrite(rows, tags)
        schema = T.StructType.fromJson(base["schema"])
        kept = stage(self._aligned(source, schema), "upsert")
        self._once(kept)
        touched = sorted(r[0] for r in kept.select(self._bucket(base["buckets"])).distinct().collect())
        if not touched:
            return self._commit(base, schema, base["parts"], base["rows"], tags)
        before = Counted(self._read(base, touched))
        added = [f for f in kept.schema if f.name not in schema.names and f.name != gone]
        wide = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType) for f in added]])
        merged = self._merged(before.df, kept, wide, set(kept.columns if update is None else update), gone)
        part, found, written = self._write(merged.withColumn(BUCKET, self._bucket(base["buckets"])))
        rows = base["rows"] - before.rows + written
        parts = {b: p for b, p in base["parts"].items() if int(b) not in set(touched)} | {b: part for b in found}
        return self._commit(base, wide, parts, rows, tags)

    def _once(self, source: DataFrame) -> None:
        twice = source.groupBy(*self.keys).count().where("count > 1").first()
        if twice is not None:
            raise ValueError(f"the source holds a key more than once: {twice.asDict()}")

    def _merged(self, stored: DataFrame, source: DataFrame, schema: T.StructType, update: set[str], gone: str | None) -> DataFrame:
        old = stored.select(F.struct(*stored.columns).alias("t"))
        new = source.select(F.struct(*source.columns).alias("s"))
        on = F.lit(True)
        for k in self.keys:
            on = on & F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`"))
        both = old.join(new, on, "full")
        if gone:
            both = both.where(F.col("s").isNull() | ~F.coalesce(F.col(f"s.`{gone}`"), F.lit(False)))

        def value(c: str) -> Column:
            here, there = c in stored.columns, c in source.columns
            if not there:
                return F.col(f"t.`{c}`")
            if not here:
                return F.col(f"s.`{c}`")
            first, second = ("s", "t") if c in update or c in self.keys else ("t", "s")
            return F.when(F.col(first).isNotNull(), F.col(f"{first}.`{c}`")).otherwise(F.col(f"{second}.`{c}`"))

        return both.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def mirror(self, other: KeyedTable, change: Callable[[DataFrame], DataFrame]) -> None:
        """Hold what `change` makes of the rows of another table, bucket by bucket; only buckets whose part is new are written.

        A row keeps the bucket of its unchanged key, so `change` may hide the key.
        """
        theirs, base = other.head(), self.head()
        seen = base["tags"]["mirrored"] if base else {}
        fresh = [b for b, part in theirs["parts"].items() if seen.get(b) != part]
        changed = change(other._read(theirs, [int(b) for b in fresh]).withColumn(BUCKET, other._bucket(theirs["buckets"])))
        part, found, _ = self._write(changed) if fresh else ("", [], 0)
        parts = {b: p for b, p in (base["parts"] if base else {}).items() if b in theirs["parts"] and b not in fresh} | {b: part for b in found}
        rows = self._read({"schema": json.loads(changed.drop(BUCKET).schema.json()), "parts": parts}).count()
        self._commit(base, changed.drop(BUCKET).schema, parts, rows, {"mirrored": theirs["parts"]})

    def vacuum(self, keep: int = 2, older_than_seconds: float = 24 * 3600) -> int:
        """Delete commits but the newest `keep`, and parts that none of these names; gives the number of parts deleted.

        Parts and commits younger than the age stay: a writer may be about to commit them, a reader may be at work on them.
        """
        names = self.commits()
        stay = {p for n in names[-keep:] for p in self._commits.read_json(n)["parts"].values()}
        gone = 0
        for n in names[:-keep]:
            if self._commits.age_seconds(n) >= older_than_seconds:
                self._commits.delete(n)
        stay |= {p for n in self.commits() for p in self._commits.read_json(n)["parts"].values()}
        for part in self._root.names("data"):
            if part not in stay and self._root.age_seconds(f"data/{part}") >= older_than_seconds:
                self._root.delete(f"data/{part}")
                gone += 1
        return gone
