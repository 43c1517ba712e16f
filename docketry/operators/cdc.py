"""Change data capture: landing snapshots to Changes, History (SCD2) and Current.

A table's key has at most one change per batch date, so every window below holds at most
as many rows per key as there are batches; a hot key cannot grow past that.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.fixed_values import BATCH, EFF, END, OPEN_END, OPS, RUN
from docketry.operators.projections import add_audit, run_stamp

AUDIT = (OPS, EFF, RUN, BATCH, END)
Keys = Sequence[str]


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in AUDIT]


def row_hash(columns: Sequence[str]) -> Column:
    """md5 over trimmed, upper-cased values; a separator keeps columns apart, a sign before every value keeps nulls apart from texts."""
    texts = [F.coalesce(F.concat(F.lit("="), F.trim(F.upper(F.col(c).cast("string")))), F.lit("*")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *texts))


def _has_key(keys: Keys) -> Column:
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def duplicate_keys(landing: DataFrame, keys: Keys) -> DataFrame:
    """Keys that a landing snapshot holds more than once, with their count."""
    return landing.filter(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def newest_per_key(df: DataFrame, keys: Keys, *order: Column) -> DataFrame:
    """One row per key, the first by the order.

    The rank filter reaches the scan side of the shuffle: each task sends on one row per
    key, however often the key occurs there.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def batch_plan(
    landing: DataFrame, batches: DataFrame, first_run: bool, has_key: bool = True, mode: str = "cdc", batch: str = "batch_date"
) -> DataFrame:
    """Rows and action per listed batch: load, diff, restamp, truncate-load or skip."""
    counts = landing.groupBy(batch).agg(F.count(F.lit(1)).alias("landing_rows"))
    bounds = batches.agg(F.struct(F.min(batch).alias("first"), F.max(batch).alias("last")).alias("b")).scalar()
    listed = batches.select(batch).distinct().join(counts, batch, "left")
    rows = F.coalesce("landing_rows", F.lit(0))
    action = (
        F.when(F.lit(first_run) & (F.col(batch) == F.col("_b.first")), "initial_load")
        .when((rows > 0) | F.lit(mode == "cdc"), "diff" if has_key else "truncate_load")
        .when(F.col(batch) == F.col("_b.last"), "restamp_current")
        .otherwise("skip")
    )
    return listed.withColumn("_b", bounds).select(batch, rows.alias("landing_rows"), action.alias("action"))


def initial_load(
    landing: DataFrame, keys: Keys, eff: dt.date | str, run_ts: str, batch_id: int,
    load: str = "cdc", table: str = "dimension",
) -> dict[str, DataFrame | None]:
    """Changes, History and Current of a first run.

    Without a key only Current is written; transaction tables have no History; incremental
    transaction tables carry no operation column.
    """
    op = None if not keys or (load, table) == ("delta", "transaction") else "I"
    full = add_audit(landing, eff, run_ts, batch_id, op=op, end=OPEN_END)
    return {
        "changes": full.drop(END) if keys else None,
        "history": full if keys and table != "transaction" else None,
        "current": full.drop(OPS, END),
    }


def latest_before(changes: DataFrame, keys: Keys, day: dt.date | str) -> DataFrame:
    """State that a batch is compared with: newest change before its date, deletes left out."""
    earlier = changes.filter(F.col(EFF) < F.lit(str(day)).cast("date"))
    newest = newest_per_key(earlier, keys, F.desc(EFF))
    return newest.filter(F.col(OPS) != "D") if OPS in changes.columns else newest


def merge_same_day(landing: DataFrame, changes: DataFrame, keys: Keys, day: dt.date | str) -> DataFrame:
    """Incremental landing plus what the same day already brought, landing first."""
    same_day = changes.filter(F.col(EFF) == F.lit(str(day)).cast("date")).select(*data_columns(changes))
    return landing.unionByName(same_day.join(landing, list(keys), "left_anti"))


def diff(
    landing: DataFrame, changes: DataFrame, keys: Keys, day: dt.date | str, run_ts: str, batch_id: int,
    load: str = "cdc", table: str = "dimension",
) -> DataFrame:
    """Changes of one batch.

    One full outer join of the landing snapshot with the latest state gives inserts,
    updates and, for full snapshots, deletes. Rows with a null key part match nothing and
    bring no change.
    """
    if (load, table) == ("delta", "transaction"):
        return add_audit(merge_same_day(landing, changes, keys, day), day, run_ts, batch_id)
    if load == "delta":
        landing = merge_same_day(landing, changes, keys, day)
    return diff_state(landing, latest_before(changes, keys, day).select(*data_columns(changes)), keys, day, run_ts, batch_id, load)


def diff_state(landing: DataFrame, state: DataFrame, keys: Keys, day: dt.date | str, run_ts: str, batch_id: int, load: str = "cdc") -> DataFrame:
    """Changes that lead from a state, its live rows without audit columns, to a landing."""
    columns = state.columns
    rest = [c for c in columns if c not in keys]
    new = landing.filter(_has_key(keys)).select(*keys, F.struct(row_hash(columns).alias("h"), *rest).alias("_new"))
    old = state.filter(_has_key(keys)).select(*keys, F.struct(row_hash(columns).alias("h"), *rest).alias("_old"))
    op = (
        F.when(F.col("_old").isNull(), "I")
        .when(F.col("_new").isNull(), "D")
        .when(F.col("_new.h") != F.col("_old.h"), "U")
    )
    joined = new.join(old, list(keys), "full" if load == "cdc" else "left").withColumn(OPS, op)
    values = [F.when(F.col(OPS) == "D", F.col("_old")[c]).otherwise(F.col("_new")[c]).alias(c) for c in rest]
    changed = joined.filter(F.col(OPS).isNotNull()).select(*keys, *values, OPS)
    return changed.select(*columns, OPS).withColumns({EFF: F.lit(str(day)).cast("date")} | run_stamp(run_ts, batch_id))


def diff_all(
    landings: DataFrame, batches: DataFrame, keys: Keys, run_ts: str, batch_id: int, batch: str = "batch_date"
) -> DataFrame:
    """Changes of a whole series of full snapshots, stacked with their batch date, in one shuffle.

    A key's snapshots are compared with its previous one. Where the next snapshot of a key
    is not the next batch, the key was deleted in that batch. The batch list is a small
    dimension: one row per batch.
    """
    columns = [c for c in landings.columns if c != batch]
    order = Window.orderBy(batch)
    listed = batches.select(batch).distinct().select(
        batch, F.row_number().over(order).alias("_no"), F.lead(batch).over(order).alias("_next")
    )
    w = Window.partitionBy(*keys).orderBy("_no")
    placed = (
        landings.filter(_has_key(keys))
        .join(listed, batch)
        .withColumn("_h", row_hash(columns))
        .withColumns(
            {"_before": F.lag("_no").over(w), "_hash_before": F.lag("_h").over(w), "_after": F.lead("_no").over(w)}
        )
    )
    upsert = F.when(
        F.col("_before").isNull() | (F.col("_before") < F.col("_no") - 1), "I"
    ).when(F.col("_hash_before") != F.col("_h"), "U")
    gone = F.col("_next").isNotNull() & (F.col("_after").isNull() | (F.col("_after") > F.col("_no") + 1))
    events = F.array_compact(
        F.array(
            F.when(upsert.isNotNull(), F.struct(upsert.alias("op"), F.col(batch).alias("eff"))),
            F.when(gone, F.struct(F.lit("D").alias("op"), F.col("_next").alias("eff"))),
        )
    )
    return (
        placed.withColumn("_event", F.explode(events))
        .select(*columns, F.col("_event.op").alias(OPS), F.col("_event.eff").cast("date").alias(EFF))
        .withColumns(run_stamp(run_ts, batch_id))
    )


def reject_late(changes: DataFrame, day: dt.date | str) -> None:
    """Raise when the batch is older than the newest change; the same date is a rerun."""
    newest = changes.agg(F.max(EFF)).first()[0]
    if newest is not None and str(day) < str(newest):
        raise ValueError(f"batch {day} is older than the newest change of {newest}")


def late_batches(batches: DataFrame, changes: DataFrame, batch: str = "batch_date") -> DataFrame:
    """Each batch with the newest change date and whether it must be rejected."""
    newest = changes.agg(F.max(EFF).alias("m")).scalar()
    listed = batches.select(batch).distinct().withColumn("max_eff", newest)
    return listed.withColumn("rejected", F.coalesce(F.col(batch) < F.col("max_eff"), F.lit(False)))


def current(changes: DataFrame, keys: Keys, run_ts: str, batch_id: int) -> DataFrame:
    """Latest row per key, restamped; deleted keys are left out."""
    newest = newest_per_key(changes, keys, F.desc(EFF))
    if OPS in changes.columns:
        newest = newest.filter(F.col(OPS) != "D").drop(OPS)
    return restamp(newest, run_ts, batch_id)


def restamp(df: DataFrame, run_ts: str, batch_id: int) -> DataFrame:
    """Refresh run time and batch id only."""
    return df.withColumns(run_stamp(run_ts, batch_id))


def history(changes: DataFrame, keys: Keys) -> DataFrame:
    """SCD2 in closed form: a row ends the day before its key's next change; deletes open nothing."""
    w = Window.partitionBy(*keys).orderBy(EFF)
    end = F.coalesce(F.date_sub(F.lead(EFF).over(w), 1), F.lit(OPEN_END).cast("date"))
    return changes.withColumn(END, end).filter(F.col(OPS) != "D")


def roll_back(hist: DataFrame, day: dt.date | str) -> DataFrame:
    """History as it was before the batch of a day: later rows go, rows it closed open again."""
    d = F.lit(str(day)).cast("date")
    reopened = F.when(F.col(END) >= F.date_sub(d, 1), F.lit(OPEN_END).cast("date")).otherwise(F.col(END))
    return hist.filter(F.col(EFF) < d).withColumn(END, reopened)


def apply_day(hist: DataFrame, day_changes: DataFrame, keys: Keys) -> DataFrame:
    """History plus the changes of one day: touched open rows close, inserts and updates open."""
    marks = day_changes.filter(F.col(OPS).isin("U", "D")).select(*keys, F.col(EFF).alias("_closed_by"))
    open_end = F.lit(OPEN_END).cast("date")
    touched = hist.join(marks, list(keys), "left").withColumn(
        END,
        F.when((F.col(END) == open_end) & F.col("_closed_by").isNotNull(), F.date_sub("_closed_by", 1)).otherwise(
            F.col(END)
        ),
    )
    opened = day_changes.filter(F.col(OPS) != "D").withColumn(END, open_end)
    return touched.drop("_closed_by").unionByName(opened)


def as_of(hist: DataFrame, day: dt.date | str) -> DataFrame:
    """Rows in force on a day."""
    d = F.lit(str(day)).cast("date")
    return hist.filter((F.col(EFF) <= d) & (F.col(END) >= d))
