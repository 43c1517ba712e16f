"""Duplicate rows by one value, keeping the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def representatives(df: DataFrame, by: str, row: str, order: Sequence[str] = ()) -> DataFrame:
    """`row` of the first row of each value of ``by``, by ``order`` and then ``row``; rows without a value are left out.

    Only a digest of the value, the order and the row's name go through the shuffle, and each task
    sends on one of them per value, however long the value is or often it comes.
    """
    narrow = df.filter(F.col(by).isNotNull()).select(
        F.md5(F.col(by).cast("string")).alias("_digest"), F.xxhash64(by).alias("_more"), F.struct(*order, row).alias("_at")
    )
    return narrow.groupBy("_digest", "_more").agg(F.min("_at").alias("_at")).select(F.col(f"_at.{row}").alias(row))


def keep_first(df: DataFrame, by: str, row: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows that come first with their value of ``by``, and all rows without a value.

    ``row`` names each row; of rows with the same name and value all stay. The rows are fetched by name
    once the choice is made. Null parts of the order come first.
    """
    first = df.join(representatives(df, by, row, order), row, "left_semi")
    return first.filter(F.col(by).isNotNull()).unionByName(df.filter(F.col(by).isNull()))
