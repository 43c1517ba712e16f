"""Token ids as Parquet list columns, written in key order and read back selectively.

Documents are dealt out by ranges of their key and sorted, then encoded and written by Spark's own
Parquet writer, whose committer survives lost executors. Row groups and pages have set sizes, ids
are dictionary or delta encoded, and the writer adds page indexes, so that a reader that wants
some columns or a range of keys skips the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.llm.byte_bpe import encoder, ids_column
from docketry.llm.text_batches import pieces
from docketry.llm.workers import map_arrow


def encoded(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int | None = 0) -> DataFrame:
    """`key, n_tokens, tokens` for every row, in the order of the rows; a null text is an empty one.

    `tokenizer` is the path of a tokenizers file that workers can open. `end_id` closes each
    document and counts as a token; None leaves it out. Repeated keys and rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for rows, data, offsets in pieces(batches, text):
            ids, counts = encode(data, offsets, end_id)
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(counts), ids_column(ids, counts)], [key, "n_tokens", "tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(docs.select(key, text), run, f"`{key}` {kind}, n_tokens long, tokens array<int>")


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int | None = 0,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2000,
    order: tuple[str, ...] | None = None,
) -> None:
    """Write ids of all documents below `path`, in ascending order of `key` over the numbered parts.

    `order` names other columns of `docs` to write by; their values lead over the numbered parts.
    `encoding` is dictionary (falls back by itself where a dictionary doesn't pay) or delta.
    Rows with a null key come first; an empty table gives files without rows.
    """
    by = [key] if order is None else list(order)
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding}")
    ordered = docs.select(key, text, *[c for c in by if c not in (key, text)]).repartitionByRange(*by).sortWithinPartitions(*by)
    (
        encoded(ordered, tokenizer, key, text, end_id)
        .write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("compression", "zstd")
        .parquet(path)
    )


def file_place() -> Column:
    """The place of a row's file in the order of the numbered parts that a write left."""
    name = F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).cast("long")
    more = F.regexp_extract("_metadata.file_name", r"-c(\d+)\.", 1)
    return name * 1_000_000 + F.when(more == "", 0).otherwise(more.cast("long"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with `part` and `row`: their file's place in the order and their place in it."""
    return spark.read.parquet(path).select("*", file_place().alias("part"), F.col("_metadata.row_index").alias("row"))


def token_index(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """`key, start, n_tokens, ids_crc32` of every stored document, from the files.

    `start` counts the ids of all documents before it. The totals of the parts, one row a file,
    are read from the column of counts alone; only they are summed up in one place.
    """
    stored = read_tokens(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("tokens")
            where = np.asarray(ids.offsets)
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))
            crc = np.fromiter((zlib.crc32(values[a:b]) for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)), np.int64, len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("part"), batch.column("row"), pa.array(np.diff(where).astype(np.int64)), pa.array(crc)], [key, "part", "row", "n_tokens", "ids_crc32"])

    kind = spark.read.parquet(path).schema[key].dataType.simpleString()
    rows = map_arrow(stored.select(key, "part", "row", "tokens"), run, f"`{key}` {kind}, part long, row long, n_tokens long, ids_crc32 long")
    before = (Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("part_start"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row").rowsBetween(*before)), F.lit(0))
    return rows.withColumn("inside", inside).join(parts, "part").select(key, (F.col("part_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
