"""Landing batches to stored Changes, History and Current tables.

History is stored in two parts: the rows in force, by key, and the closed ones, by the day that they
end. A batch is compared with the rows in force and writes what it changes: its day of Changes, the
rows that it closes, and the buckets of the keys that it touches. Current is the rows in force
with the stamps of the last run, which the table's commit carries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import masking
from docketry.functions.fixed_values import EFF, END, OPEN_END, OPS
from docketry.operators import cdc
from docketry.plans.journal import FAILED, STARTED, SUCCESS, Journal
from docketry.session import scratch_dir, stage
from docketry.sources.counted import Counted
from docketry.sources.keyed import KeyedTable
from docketry.sources.tables import ChangeTable, VersionedTable


@dataclass
class View:
    """A table that is read through a function."""

    read: Callable[[], DataFrame]


class ChangeFlow:
    """The stored tables of one source table and the steps of a batch.

    ``load`` is cdc (full snapshots) or delta (increments), ``table`` is dimension or
    transaction, ``keys`` may be empty. Masked copies are written where a plan is given.
    A landing that holds a key twice is an error, unless ``newest_by`` names the column by
    which the newest copy is kept. ``buckets`` is that of the rows in force. Tables without a key, and transactions,
    have no History; their Current is replaced as a whole.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], load: str = "cdc", table: str = "dimension",
        mask_plan: str = "", newest_by: str | None = None, buckets: int = 16,
    ):
        self.spark, self.keys, self.load, self.table, self.mask_plan = spark, list(keys), load, table, mask_plan
        self.newest_by = newest_by
        self.changes_table, self.masked_changes = ChangeTable(spark, f"{root}/changes", EFF), ChangeTable(spark, f"{root}/masked/changes", EFF)
        self.history_table, self.masked_history = (KeyedTable(spark, f"{root}/{m}history", self.keys, buckets) for m in ("", "masked/"))
        self.closed_table, self.masked_closed = (ChangeTable(spark, f"{root}/{m}closed", END) for m in ("", "masked/"))
        self._whole, self._masked_whole = VersionedTable(spark, f"{root}/current"), VersionedTable(spark, f"{root}/masked/current")
        self.masked_current = View(lambda: self._current(self.masked_history, self._masked_whole))
        self.journal = Journal(spark, f"{root}/journal")

    @property
    def has_history(self) -> bool:
        return bool(self.keys) and self.table != "transaction"

    def exists(self) -> bool:
        return self.history_table.exists() if self.has_history else self._whole.exists()

    def changes(self) -> DataFrame:
        return self.changes_table.read()

    def history(self) -> DataFrame:
        return self._history(self.history_table, self.closed_table)

    def current(self) -> DataFrame:
        return self._current(self.history_table, self._whole)

    def _history(self, in_force: KeyedTable, closed: ChangeTable) -> DataFrame:
        rows = in_force.read()
        return rows.unionByName(closed.read().select(*rows.columns)) if closed.exists() else rows

    def _current(self, in_force: KeyedTable, whole: VersionedTable) -> DataFrame:
        if not self.has_history:
            return whole.read()
        tags = self.history_table.tags()
        return cdc.restamp(in_force.read().drop(OPS, END), tags["run_ts"], tags["batch_id"])

    def _mask(self, df: DataFrame) -> DataFrame:
        return masking.apply_masks(df, self.mask_plan)

    def _put_whole(self, df: DataFrame) -> None:
        stored = self._whole.overwrite(df)
        if self.mask_plan:
            self._masked_whole.overwrite(self._mask(stored))

    def _put_changes(self, df: DataFrame, day: str, first_load: bool) -> dict[str, int]:
        """Rows written, plain and masked."""
        counted = Counted(df)
        if first_load:
            self.changes_table.write(counted.df, True)
        else:
            self.changes_table.replace(counted.df, day)
        rows = {"": counted.rows}
        if self.mask_plan:
            masked = Counted(self._mask(self.changes_table.read_one(day)))
            self.masked_changes.replace(masked.df, day)
            rows["-MASK"] = masked.rows
        return rows

    def _put_closed(self, df: DataFrame, day_before: str) -> dict[str, int]:
        """Closed rows of the whole table by the day that they end, which the next commit carries."""
        counted = Counted(df)
        self.closed_table.replace(counted.df, day_before)
        if self.mask_plan:
            self.masked_closed.replace(self._mask(self.closed_table.read_one(day_before)), day_before)
        return self.history_table.tags()["closed"] | {day_before: counted.rows}

    def _mirror(self) -> None:
        if self.mask_plan:
            self.masked_history.mirror(self.history_table, self._mask)

    def _one_per_key(self, landing: DataFrame) -> DataFrame:
        if self.newest_by:
            return cdc.newest_per_key(landing, self.keys, F.desc(self.newest_by))
        twice = cdc.duplicate_keys(landing, self.keys).first()
        if twice is not None:
            raise ValueError(f"landing holds a key more than once: {twice.asDict()}")
        return landing

    def _journaled(self, day: str, run: Callable[[], dict[str, tuple[int, int]]]) -> None:
        """Enter what starts, and how it ends: the rows of each step, or the error."""
        steps = ["Changes", "History", "Current"] if self.has_history else ["Changes", "Current"] if self.keys else ["Current"]
        names = [s + m for s in steps for m in (["", "-MASK"] if self.mask_plan else [""])]
        self.journal.enter(day, STARTED, [(n, None, None) for n in names])
        try:
            rows = run()
        except Exception as error:
            self.journal.enter(day, FAILED, [(n, 0, 0) for n in names], f"{type(error).__name__}: {error}"[:500])
            raise
        self.journal.enter(day, SUCCESS, [(n, *rows[n]) for n in names])

    def _told(self, source: int, changes: dict[str, int]) -> dict[str, tuple[int, int]]:
        """Source and target rows of each step, from counts that the writes have left."""
        out = {f"Changes{m}": (source, n) for m, n in changes.items()}
        for m in ["", "-MASK"] if self.mask_plan else [""]:
            if self.has_history:
                in_force = self.masked_history if m else self.history_table
                out[f"History{m}"] = (source, in_force.rows() + sum(self.history_table.tags()["closed"].values()))
                out[f"Current{m}"] = (source, in_force.rows())
            else:
                out[f"Current{m}"] = (source, (self._masked_whole if m else self._whole).read().count())
        return out

    def first_load(self, landing: DataFrame, day: str, run_ts: str, batch_id: int, tags: dict | None = None) -> None:
        """Replace all tables by what one landing gives."""

        def run() -> dict[str, tuple[int, int]]:
            source = Counted(landing)
            rows = stage(self._one_per_key(source.df) if self.keys else source.df, "landing")
            for old in (self.changes_table, self.closed_table, self.masked_changes, self.masked_closed):
                old.clear()
            loaded = cdc.initial_load(rows, self.keys, day, run_ts, batch_id, self.load, self.table)
            written = self._put_changes(loaded["changes"], day, first_load=True) if loaded["changes"] is not None else {}
            if self.has_history:
                self.history_table.overwrite(loaded["history"], {"day": day, "run_ts": run_ts, "batch_id": batch_id, "closed": {}} | (tags or {}))
                self._mirror()
            else:
                self._put_whole(loaded["current"])
            return self._told(source.rows, written)

        self._journaled(day, run)

    def _before(self, day: str, landing: DataFrame) -> tuple[DataFrame, bool]:
        """Rows in force before a day, and whether the day was applied before.

        A rerun leaves out what the day opened and takes back what it closed. An increment reads only
        the buckets that its keys fall into.
        """
        rerun = self.history_table.tags()["day"] == day
        buckets = self.history_table.touched(landing) if self.load == "delta" and not rerun else None
        rows = self.history_table.read(buckets)
        if not rerun:
            return rows, False
        earlier = rows.filter(F.col(EFF) < F.lit(day).cast("date"))
        closed = self.closed_table.read_one(_day_before(day))
        if closed is None:
            return earlier, True
        reopened = closed.select(*rows.columns).withColumn(END, F.lit(OPEN_END).cast("date"))
        return stage(earlier.unionByName(reopened), "before"), True

    def batch(self, landing: DataFrame, day: str, run_ts: str, batch_id: int, last: bool = True, tags: dict | None = None) -> None:
        """Apply one batch; the same day again replaces what it brought before.

        Changes are written first, then the closed rows, and the commit of the rows in force last: a batch
        that dies in between is simply run again. ``last`` is kept for callers that name the last batch; Current
        always follows.
        """
        if not self.keys:
            return self.first_load(landing, day, run_ts, batch_id, tags)
        newest = self.history_table.tags()["day"] if self.has_history else None
        if newest is not None and day < newest:
            raise ValueError(f"batch {day} is older than the newest change of {newest}")
        if not self.has_history:
            cdc.reject_late(self.changes(), day)
        self._journaled(day, lambda: self._apply(landing, day, run_ts, batch_id, tags))

    def _apply(self, landing: DataFrame, day: str, run_ts: str, batch_id: int, tags: dict | None) -> dict[str, tuple[int, int]]:
        source = Counted(landing)
        landing = stage(self._one_per_key(source.df), "landing")
        earlier = self.changes_table.read_one(day)
        earlier = stage(earlier, "earlier") if earlier is not None else None  # its folder is about to be written anew
        if not self.has_history:
            changes = stage(cdc.diff(landing, self.changes(), self.keys, day, run_ts, batch_id, self.load, self.table), "changes")
            written = self._put_changes(changes, day, False)
            self._put_whole(cdc.current(self.changes(), self.keys, run_ts, batch_id))
            return self._told(source.rows, written)
        if self.load == "delta" and earlier is not None:
            landing = cdc.merge_same_day(landing, earlier, self.keys, day)
        before, rerun = self._before(day, landing)
        state = before.select(*cdc.data_columns(before))
        changes = stage(cdc.diff_state(landing, state, self.keys, day, run_ts, batch_id, self.load), "changes")
        written = self._put_changes(changes, day, False)
        marks = changes.filter(F.col(OPS).isin("U", "D")).select(*self.keys)
        closed = self._put_closed(stage(before.join(marks, self.keys, "left_semi").drop(END), "closed"), _day_before(day))
        opened = changes.withColumn(END, F.lit(OPEN_END).cast("date")).withColumn("_gone", F.col(OPS) == "D")
        if rerun:  # keys that the day touched before and doesn't now go back to what they were
            undone = self.history_table.read().filter(F.col(EFF) == F.lit(day).cast("date")).select(*self.keys)
            undone = undone.unionByName(earlier.select(*self.keys)).distinct().join(changes.select(*self.keys), self.keys, "left_anti")
            opened = opened.unionByName(undone.join(before, self.keys, "left").withColumn("_gone", F.col(EFF).isNull()).select(*opened.columns))
        self.history_table.upsert(opened, gone="_gone", tags={"day": day, "run_ts": run_ts, "batch_id": batch_id, "closed": closed} | (tags or {}))
        self._mirror()
        return self._told(source.rows, written)

    def refresh(self, run_ts: str, batch_id: int) -> None:
        """An increment without rows: Current is only restamped."""
        if self.has_history:
            self.history_table.tag({"run_ts": run_ts, "batch_id": batch_id})
        else:
            self._put_whole(cdc.restamp(self.current(), run_ts, batch_id))


def _day_before(day: str) -> str:
    return str(dt.date.fromisoformat(day) - dt.timedelta(days=1))


def load_batches(
    spark: SparkSession, landings: DataFrame, keys: Sequence[str], run_ts: str, batch_id: int,
    root: str | None = None, **options: str,
) -> ChangeFlow:
    """Run every batch of a stacked landing table in date order.

    The landing is staged by batch, so each step reads its own partition; only the list of
    batch dates comes to the driver.
    """
    root = root or scratch_dir(spark, "change-flow")
    landings.write.partitionBy("batch_date").parquet(f"{root}/landing")
    landed = spark.read.parquet(f"{root}/landing").withColumn("batch_date", F.col("batch_date").cast("date"))
    days = [str(r[0]) for r in landed.select("batch_date").distinct().orderBy("batch_date").collect()]
    flow = ChangeFlow(spark, root, keys, **options)
    for i, day in enumerate(days):
        one = landed.filter(F.col("batch_date") == F.lit(day).cast("date")).drop("batch_date")
        if i == 0:
            flow.first_load(one, day, run_ts, batch_id)
        else:
            flow.batch(one, day, run_ts, batch_id, last=i == len(days) - 1)
    return flow
