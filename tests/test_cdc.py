from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docketry.functions.fixed_values import EFF, END, OPS
from docketry.operators import cdc
from docketry.plans.change_flow import ChangeFlow, load_batches
from docketry.session import scratch_dir
from docketry.sources.tables import VersionedTable

DAYS = ["2024-01-01", "2024-01-02", "2024-01-05", "2024-01-06"]
STAMP = ("2024-02-01 00:00:00", 1)


def snapshots(seed=3):
    rng = random.Random(seed)
    return {d: {k: rng.choice("abc") for k in range(12) if rng.random() < 0.7} for d in DAYS}


def stacked(spark, data):
    rows = [(d, k, v) for d, snap in data.items() for k, v in snap.items()]
    return spark.createDataFrame(rows, "batch_date string, k int, v string").withColumn("batch_date", F.to_date("batch_date"))


def changes_by_hand(data):
    out, before = set(), {}
    for day, snap in data.items():
        for k in snap.keys() | before.keys():
            if k not in before:
                out.add((k, snap[k], "I", day))
            elif k not in snap:
                out.add((k, before[k], "D", day))
            elif snap[k] != before[k]:
                out.add((k, snap[k], "U", day))
        before = snap
    return out


def rows(df):
    return {(r.k, r.v, r[OPS], str(r[EFF])) for r in df.collect()}


def test_series_equals_hand_made_changes(spark):
    data = snapshots()
    landing = stacked(spark, data)
    assert rows(cdc.diff_all(landing, landing, ["k"], *STAMP)) == changes_by_hand(data)


def test_stored_flow_keeps_the_invariants_and_reruns_change_nothing(spark):
    data = snapshots()
    flow = load_batches(spark, stacked(spark, data), ["k"], *STAMP, mask_plan="mask:v")
    assert rows(flow.changes()) == changes_by_hand(data)
    hist = flow.history().collect()
    open_keys = [r.k for r in hist if str(r[END]) == "9999-12-31"]
    assert len(open_keys) == len(set(open_keys))
    for day, snap in data.items():
        in_force = {(r.k, r.v) for r in cdc.as_of(flow.history(), day).collect()}
        assert in_force == set(snap.items())
    assert {(r.k, r.v) for r in flow.current().collect()} == set(data[DAYS[-1]].items())
    assert {r.v for r in flow.masked_current.read().collect()} == {"X"}

    before = (rows(flow.changes()), sorted(map(repr, hist)))
    last = stacked(spark, {DAYS[-1]: data[DAYS[-1]]}).drop("batch_date")
    flow.batch(last, DAYS[-1], *STAMP)
    assert (rows(flow.changes()), sorted(map(repr, flow.history().collect()))) == before
    with pytest.raises(ValueError, match="older than"):
        flow.batch(last, DAYS[0], *STAMP)


def test_day_by_day_equals_closed_form(spark):
    landing = stacked(spark, snapshots(8))
    changes = cdc.diff_all(landing, landing, ["k"], *STAMP)
    hist = changes.filter(F.lit(False)).withColumn(END, F.lit(None).cast("date"))
    for day in DAYS:
        hist = cdc.apply_day(hist, changes.filter(F.col(EFF) == F.lit(day).cast("date")), ["k"])
    same = lambda df: sorted(map(repr, df.select("k", "v", OPS, EFF, END).collect()))
    assert same(hist) == same(cdc.history(changes, ["k"]))


def test_null_keys_bring_no_change_and_case_is_no_difference(spark):
    first = spark.createDataFrame([(1, "a "), (None, "x")], "k int, v string")
    changes = cdc.initial_load(first, ["k"], "2024-01-01", *STAMP)["changes"]
    landing = spark.createDataFrame([(1, "A"), (None, "y"), (2, None)], "k int, v string")
    assert rows(cdc.diff(landing, changes, ["k"], "2024-01-02", *STAMP)) == {(2, None, "I", "2024-01-02")}


def test_row_hash_keeps_columns_apart(spark):
    df = spark.sql("SELECT 'ab' AS a, 'c' AS b UNION ALL SELECT 'a', 'bc'")
    assert df.select(cdc.row_hash(["a", "b"]).alias("h")).distinct().count() == 2


def test_duplicate_keys_fail_or_keep_the_newest(spark):
    landing = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, at int")
    with pytest.raises(ValueError, match="more than once"):
        ChangeFlow(spark, scratch_dir(spark, "dup"), ["k"]).first_load(landing, "2024-01-01", *STAMP)
    flow = ChangeFlow(spark, scratch_dir(spark, "dup"), ["k"], newest_by="at")
    flow.first_load(landing, "2024-01-01", *STAMP)
    assert [r.v for r in flow.current().collect()] == ["new"]


def test_delta_modes(spark):
    root = scratch_dir(spark, "delta")
    flow = ChangeFlow(spark, root, ["k"], load="delta")
    part = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    flow.first_load(part((1, "a"), (2, "b")), "2024-01-01", *STAMP)
    flow.batch(part((2, "c")), "2024-01-02", *STAMP)
    flow.batch(part((3, "d")), "2024-01-02", *STAMP)  # a second delivery on the same day adds to the first
    assert {(r.k, r.v) for r in flow.current().collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert "D" not in {r[OPS] for r in flow.changes().collect()}
    flow.refresh("2024-02-02 00:00:00", 9)
    assert {r.DL_ETL_BATCH_ID for r in flow.current().collect()} == {9}

    moves = ChangeFlow(spark, f"{root}/t", ["k"], load="delta", table="transaction")
    moves.first_load(part((1, "a")), "2024-01-01", *STAMP)
    moves.batch(part((1, "b")), "2024-01-03", *STAMP)
    assert OPS not in moves.changes().columns and not moves.history_table.exists()
    assert [(r.k, r.v) for r in moves.current().collect()] == [(1, "b")]


def test_newest_per_key_ranks_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = cdc.newest_per_key(df, ["k"], F.desc("v"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_versioned_table_ignores_unfinished_versions(spark):
    import os

    stored = VersionedTable(spark, scratch_dir(spark, "versions"))
    assert not stored.exists()
    stored.overwrite(spark.range(3).toDF("id"))
    os.makedirs(f"{stored.path.removeprefix('file:')}/v0000000009-deadbeef")
    assert stored.read().count() == 3
    stored.upsert(spark.createDataFrame([(2, "x"), (7, "y")], "id long, note string"), ["id"])
    assert sorted((r.id, r.note) for r in stored.read().collect()) == [(0, None), (1, None), (2, "x"), (7, "y")]
