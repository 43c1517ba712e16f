"""Run log, high-water marks and run dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.sources.keyed import KeyedTable

# --- fixed values: what a high-water mark starts from when no run is complete
WATERMARK_DEFAULTS = {
    "int": "0", "integer": "0", "timestamp": "1800-01-01 00:00:00", "ts": "1800-01-01 00:00:00",
    "date": "1800-01-01", "dt": "1800-01-01",
}
# --- fixed values: what the end of a run changes in its mark
MARK_UPDATES = ("WatermarkValue_start_ts", "WatermarkValue_end_ts", "Status", "RunTime", "Count", "LogOutput", "Error_Txt", "CreateTs")


def fold_run_log(writes: DataFrame, key: str = "id", at: str = "written_at", tie: str = "seq", error: str = "Error_Message") -> DataFrame:
    """State of each run after all its writes.

    The first write opens the run with Success = false; each later one sets it to whether
    it brings no error. Other columns keep the last value that was written.
    """
    when = F.struct(F.col(at), F.col(tie))
    rest = [c for c in writes.columns if c not in (key, at, tie)]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in rest]
    folded = writes.groupBy(key).agg(
        F.min(at).alias("Created_Date"),
        F.count(F.lit(1)).alias("_writes"),
        F.max_by(F.col(error).isNull(), when).alias("_clean"),
        *last,
    )
    return folded.withColumn("Success", (F.col("_writes") > 1) & F.col("_clean")).drop("_writes", "_clean")


def watermark_default(kind: str, default: str | None = None) -> str:
    """Start value for a column type that has no complete run yet."""
    return default if default is not None else WATERMARK_DEFAULTS.get(kind.lower(), "")


def watermark_value(
    marks: DataFrame, kind: str, default: str | None = None, status: str = "Status", end: str = "WatermarkValue_end_ts"
) -> DataFrame:
    """One row: newest end value among complete runs, or the default of the type."""
    complete = marks.filter(F.lower(status) == "complete")
    return complete.agg(F.coalesce(F.max(end), F.lit(watermark_default(kind, default))).alias("watermark_start"))


def watermark_row(
    run: DataFrame, start: Column, end: Column, error: Column, count: Column
) -> DataFrame:
    """Status row of a run: complete, or error when a message is present."""
    status = F.when(F.coalesce(error, F.lit("")) != "", "error").otherwise("complete")
    return run.select(
        "pipelinerunid", start.alias("WatermarkValue_start_ts"), end.alias("WatermarkValue_end_ts"),
        status.alias("Status"), count.alias("Count"),
    )


def finish_marks(marks: KeyedTable, final: DataFrame) -> DataFrame:
    """Enter how runs ended: a run that is known keeps its names, one that isn't comes with all columns."""
    return marks.upsert(final, update=MARK_UPDATES)


def incremental_read(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows with start < column <= end."""
    return df.filter((F.col(column) > start) & (F.col(column) <= end))


def run_dates(log: DataFrame, frequency: str, today: dt.date | str, limit: int = 2) -> DataFrame:
    """One row: first and last day of the next run.

    It starts after the last successful day, or retries the last day when none succeeded.
    Weekly runs end a week after the last logged day; daily ones end yesterday, but at
    most ``limit`` days after their start.
    """
    good = F.max(F.when(F.col("Success"), F.col("Date")))
    last = log.agg(F.max("Date").alias("last_date"), good.alias("good_date"))
    base = F.coalesce(F.col("good_date"), F.date_sub("last_date", 1))
    start = F.date_add(base, 1)
    yesterday = F.date_sub(F.lit(str(today)).cast("date"), 1)
    daily = F.when(F.datediff(yesterday, base) > limit, F.date_add(start, limit)).otherwise(yesterday)
    end = F.date_add("last_date", 7) if frequency.lower() == "weekly" else daily
    return last.select(start.alias("start_date"), end.alias("end_date"))


def date_range(bounds: DataFrame, start: str = "start_date", end: str = "end_date", into: str = "Date") -> DataFrame:
    """Every day of a range, both ends included."""
    return bounds.select(F.explode(F.sequence(start, end)).alias(into))
