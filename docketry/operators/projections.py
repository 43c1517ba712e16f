"""Column-level operators: names, filters, defaults, conditionals, audit columns."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import fixed_values as V


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select by ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def normalize_names(df: DataFrame) -> DataFrame:
    r"""Drop / \ [ ] ( ) . from column names, blanks become underscores, lower case."""
    return df.toDF(*[re.sub(r"[/\\\[\]().]", "", c).strip().replace(" ", "_").lower() for c in df.columns])


def strict_name(name: str) -> str:
    r"""Drop , ; { } ( ) newline tab = from a name, then every other non-word sign becomes _."""
    return re.sub(r"[^\w]", "_", re.sub(r"[,;{}()\n\t=]", "", name))


def strict_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[strict_name(c) for c in df.columns])


def keep_equal(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Rows where every named column has the wanted value."""
    for name, value in wanted.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def day_and_day_before(df: DataFrame, created: str, day: dt.date | str) -> DataFrame:
    """Rows created on the day or the day before, as a range that reaches the scan."""
    d = F.lit(str(day)).cast("date")
    at = F.col(created)
    return df.filter((at >= F.date_sub(d, 1)) & (at < F.date_add(d, 1)))


def drop_phrase(df: DataFrame, text: str, phrase: str) -> DataFrame:
    """Drop rows whose text has the phrase, whatever its case; rows without text stay."""
    return df.filter(~F.coalesce(F.lower(text).contains(phrase.lower()), F.lit(False)))


def keep_phrase(df: DataFrame, text: str, phrase: str) -> DataFrame:
    return df.filter(F.lower(text).contains(phrase.lower()))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def rewrite_where(df: DataFrame, target: str, when: Column, cases: Sequence[tuple[Column, object]]) -> DataFrame:
    """First matching case replaces the target, on rows where ``when`` holds."""
    value = F.col(target)
    for condition, replacement in reversed(cases):
        value = F.when(condition, F.lit(replacement)).otherwise(value)
    return df.withColumn(target, F.when(when, value).otherwise(F.col(target)))


def add_audit(
    df: DataFrame, eff: dt.date | str, run_ts: str, batch_id: int, op: str | None = None, end: str | None = None
) -> DataFrame:
    """Operation, effective date, end date, run time and batch id."""
    columns = {} if op is None else {V.OPS: F.lit(op)}
    columns[V.EFF] = F.lit(str(eff)).cast("date")
    if end is not None:
        columns[V.END] = F.lit(end).cast("date")
    return df.withColumns(columns | run_stamp(run_ts, batch_id))


def run_stamp(run_ts: str, batch_id: int) -> dict[str, Column]:
    return {V.RUN: F.lit(run_ts).cast("timestamp_ntz"), V.BATCH: F.lit(batch_id).cast("int")}


def strip_prefix(key: Column, prefix_pattern: str = r"\d{4}-\d{2}-\d{2}_") -> Column:
    """Key without its leading date."""
    return F.regexp_replace(key, f"^{prefix_pattern}", "")


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, nulls), counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*cells)))
