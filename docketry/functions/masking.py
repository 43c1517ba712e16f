"""Column masking as native expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hide(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "[a-zA-Z]", "X"), "[0-9]", "n")


def mask_full(column: Column) -> Column:
    """Letters become X, digits become n."""
    return _hide(column.cast("string"))


def mask_show_first(column: Column, n: int) -> Column:
    """The first n characters stay, the rest is masked."""
    text = column.cast("string")
    return F.concat(F.substring(text, 1, n), _hide(F.substring(text, F.lit(n + 1), F.length(text))))


def mask_month(column: Column, dtype: T.DataType) -> Column:
    """Dates and timestamps go to the first of their month."""
    if isinstance(dtype, T.DateType):
        return F.trunc(column, "MM")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("month", column).cast(dtype)
    raise ValueError(f"datemask does not apply to {dtype.simpleString()}")


def apply_masks(df: DataFrame, plan: str) -> DataFrame:
    """Apply ``strategy:column,...``; names in any case, unknown strategies and columns are errors."""
    fields = {f.name.upper(): f for f in df.schema}
    masked: dict[str, Column] = {}
    for item in plan.split(","):
        strategy, _, wanted = item.strip().partition(":")
        field = fields.get(wanted.strip().upper())
        if field is None:
            raise ValueError(f"mask plan names an unknown column: {item}")
        column, shown = F.col(f"`{field.name}`"), re.fullmatch(r"mask_show_first_(\d+)", strategy)
        if strategy == "mask":
            masked[field.name] = mask_full(column)
        elif strategy == "datemask":
            masked[field.name] = mask_month(column, field.dataType)
        elif shown:
            masked[field.name] = mask_show_first(column, int(shown.group(1)))
        else:
            raise ValueError(f"unknown masking strategy: {strategy}")
    return df.select(*[masked.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])
