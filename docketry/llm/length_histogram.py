"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are counted per length before the shuffle. Sums over all longer lengths then give, for
any limit, how many documents and tokens reach it and what truncation would keep; no document is
touched again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.byte_bpe import encoder
from docketry.llm.text_batches import pieces
from docketry.llm.workers import map_arrow

#: Lengths are summed up in bands of so many, so that no task gets all distinct lengths.
BAND = 4096


def lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """`length` of every document in ids of the given file; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for _, data, offsets in pieces(batches, text):
            values, counts = np.unique(encode(data, offsets)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["length", "n_docs"])

    return map_arrow(docs.select(text), run, "length long, n_docs long")


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """One row per distinct length, with sums that answer any limit equal to it.

    `docs_from`, `tokens_from`: documents at least as long, and their tokens. `docs_to`: documents
    at most as long. `truncated_tokens`: all tokens if every document were cut at this length.
    `lost_tokens`: what that cuts off. An empty table has no rows.
    """
    counts = lengths(docs, tokenizer, text).groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    counts = counts.withColumn("band", F.floor(F.col("length") / BAND)).withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    later = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = counts.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    bands = bands.select(
        "band", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_later"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_later"), F.sum("d").over(Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)).alias("docs_before"),
        F.sum("t").over(Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)).alias("tokens_before"),
    )
    down = Window.partitionBy("band").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("band").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.select("*", F.sum("n_docs").over(down).alias("d"), F.sum("n_tokens").over(down).alias("t"), F.sum("n_docs").over(up).alias("du"), F.sum("n_tokens").over(up).alias("tu")).join(bands, "band")
    docs_from, tokens_from = F.col("d") + F.col("docs_later"), F.col("t") + F.col("tokens_later")
    tokens_to = F.col("tu") + F.coalesce("tokens_before", F.lit(0))
    cut = tokens_to - F.col("n_tokens") + F.col("length") * docs_from
    return rows.select(
        "length", "n_docs", "n_tokens", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), (F.col("du") + F.coalesce("docs_before", F.lit(0))).alias("docs_to"),
        cut.alias("truncated_tokens"), (tokens_from - F.col("length") * docs_from).alias("lost_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents longer than it, all tokens, and tokens kept and lost by cutting there."""
    asked = histogram.select(F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit"), "*")
    kept = F.least("length", "limit") * F.col("n_docs")
    return asked.groupBy("limit").agg(
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("n_longer"), F.sum("n_tokens").alias("n_tokens"), F.sum(kept).alias("kept_tokens"), (F.sum("n_tokens") - F.sum(kept)).alias("lost_tokens")
    )


def quantile_lengths(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share in (0, 1], the least length that at least this share of all documents doesn't exceed."""
    total = F.max("docs_to").over(Window.partitionBy("share"))
    asked = histogram.select(F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"), "length", "docs_to")
    return asked.withColumn("total", total).where("docs_to >= share * total").groupBy("share").agg(F.min("length").alias("length"))
