"""What the steps of a batch read and wrote, with their states.

Counts are observed while a step writes, so they cost no scan. Each entry is a row of its own: a step that
started and never ended is one that died.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
_SCHEMA = "step string, batch_date date, status string, source_rows long, target_rows long, message string, seq long"


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def enter(self, day: dt.date | str, status: str, steps: Iterable[tuple[str, int | None, int | None]], message: str | None = None) -> None:
        """One row per (step, source rows, target rows)."""
        seq = time.time_ns()
        day = dt.date.fromisoformat(str(day))
        rows = [(step, day, status, source, target, message, seq + k) for k, (step, source, target) in enumerate(steps)]
        self.spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """All entries; `seq` grows with time."""
        return self.spark.read.schema(_SCHEMA).parquet(self.path)
