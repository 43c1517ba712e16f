"""Functions for Spark's Python workers, which must be able to import this package."""

from __future__ import annotations

import ctypes
import io
import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Hand the package to the workers once per application, as spark-submit --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    # The driver reads this copy itself and serves it to the executors.
    path = pathlib.Path(tempfile.mkdtemp(prefix="docketry-")) / "docketry.zip"
    path.write_bytes(packed.getvalue())
    context.addPyFile(str(path))
    _sent.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`df.mapInArrow` for functions of this package; a worker gives back the memory that a task took, since it is kept for others."""
    send_package(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Hand memory that is free back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


#: A table of at most so many narrow rows is handed to every executor instead of shuffling the wide side.
SMALL_ROWS = 2_000_000


def if_small(narrow: DataFrame, rows: int | None = None) -> DataFrame:
    """`narrow` marked for broadcasting if its counted rows stay under the bound; else a shuffle joins it."""
    rows = narrow.count() if rows is None else rows
    return F.broadcast(narrow) if rows <= SMALL_ROWS else narrow.hint("merge")
