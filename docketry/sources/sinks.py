"""Sinks by path. Partitioned writes ask for a rebalance first: parts of even size, hot partitions split."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_daily(df: DataFrame, path: str, day_col: str = "dt") -> None:
    """One folder per day; writing a day again replaces it, so a rerun adds no copies."""
    balanced = df.hint("rebalance", day_col)
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)


def append_partitioned(df: DataFrame, path: str, partition: str = "hit_date") -> None:
    df.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
