"""Survey responses of two platforms in one shape."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.operators.cdc import newest_per_key
from docketry.operators.projections import keep_equal, rename_map


def project_a(df: DataFrame, wanted: Mapping[str, object], names: Mapping[str, str]) -> DataFrame:
    """Platform A: filter by status, unit and language, rename, distinct."""
    return rename_map(keep_equal(df, wanted), names).distinct()


def latest_b(
    df: DataFrame, wanted: Mapping[str, object], names: Mapping[str, str], key: str = "responseid",
    touched: str = "last_touched", ties: Sequence[str] = (),
) -> DataFrame:
    """Platform B: newest version of each response, then as platform A."""
    newest = newest_per_key(df, [key], F.desc(touched), *[F.desc(t) for t in ties])
    return project_a(newest, wanted, names)


def unify(parts: Mapping[str, DataFrame], source_col: str = "NPS_Source") -> DataFrame:
    """Union by name with a source tag; columns a platform lacks become typed nulls."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(source_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def mature(
    df: DataFrame, start: dt.date | str, end: dt.date | str, as_of: dt.date | str, call_date: str = "NPS_Call_Date",
    days: int = 21,
) -> DataFrame:
    """Responses to calls of the range that are more than ``days`` old on a given day."""
    d = F.col(call_date).cast("timestamp_ntz").cast("date")
    lo, hi, today = (F.lit(str(x)).cast("date") for x in (start, end, as_of))
    return df.withColumn(call_date, d).filter(
        F.col(call_date).between(lo, hi) & (F.datediff(today, F.col(call_date)) > days)
    )
