"""Tables changed by key: what a change writes, who wins, what is kept."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from docketry.functions.fixed_values import EFF, END
from docketry.plans.change_flow import ChangeFlow, load_batches
from docketry.sources.commits import ConcurrentWrite
from docketry.sources.keyed import KeyedTable
from docketry.sources.tables import VersionedTable
from docketry.streaming import jobs

STAMP = ("2024-02-01 00:00:00", 1)


def pairs(spark, *rows, names="k int, v string"):
    return spark.createDataFrame(list(rows), names)


def test_an_upsert_of_one_key_writes_one_bucket(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=8)
    table.overwrite(spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v")))
    before = table.head()["parts"]
    table.upsert(spark.range(7, 8).select(F.col("id").alias("k"), F.lit("new").alias("v")))  # a long key meets a stored int
    after = table.head()["parts"]
    changed = [b for b in after if after[b] != before[b]]
    assert len(before) == 8 and len(changed) == 1 and table.touched(pairs(spark, (7, ""))) == [int(changed[0])]
    assert os.listdir(f"{tmp_path}/t/data/{after[changed[0]]}").count(f"key_bucket={changed[0]}") == 1
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 200 and rows[7] == "new" and rows[8] == "old" and table.rows() == 200


def test_two_writers_leave_one_winner_and_one_error(spark, tmp_path):
    one, two = (KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=2) for _ in range(2))
    one.overwrite(pairs(spark, (1, "a")))
    stale = one.head()
    two.upsert(pairs(spark, (2, "two")))
    one.head = lambda: stale  # it looked before the other committed
    with pytest.raises(ConcurrentWrite):
        one.upsert(pairs(spark, (2, "one"), (3, "one")))
    assert {(r.k, r.v) for r in two.read().collect()} == {(1, "a"), (2, "two")}

    first, second = (VersionedTable(spark, f"{tmp_path}/v") for _ in range(2))
    first.overwrite(pairs(spark, (1, "a")))
    seen = first.versions()
    second.overwrite(pairs(spark, (2, "two")))
    first.versions = lambda: seen
    with pytest.raises(ConcurrentWrite):
        first.overwrite(pairs(spark, (3, "one")))
    assert [r.v for r in second.read().collect()] == ["two"]


def test_matched_rows_keep_what_is_not_updated(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=4)
    table.upsert(pairs(spark, (1, "a", "n1"), (None, "b", "n2"), (3, None, None), names="k int, v string, name string"))
    table.upsert(pairs(spark, (1, None, "x", 5), (None, "B", "x", 6), (4, "d", "n4", 7), names="k int, v string, name string, extra int"), update=["v", "extra"])
    assert {(r.k, r.v, r.name, r.extra) for r in table.read().collect()} == {(1, None, "n1", 5), (None, "B", "n2", 6), (3, None, None, None), (4, "d", "n4", 7)}
    table.upsert(pairs(spark, (1, True), (4, False), (9, True), names="k int, gone boolean"), gone="gone")
    assert {r.k for r in table.read().collect()} == {None, 3, 4} and table.rows() == 3
    with pytest.raises(ValueError, match="more than once"):
        table.upsert(pairs(spark, (5, "a"), (5, "b")))
    table.upsert(pairs(spark, names="k int, v string"))
    assert table.rows() == 3


def test_retention_keeps_what_the_last_commits_name(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=4)
    for n in range(5):
        table.upsert(pairs(spark, *[(k, f"{n}") for k in range(n, n + 3)]))
    want = {(r.k, r.v) for r in table.read().collect()}
    assert table.vacuum(keep=1) == 0  # all too young
    assert table.vacuum(keep=1, older_than_seconds=-1) > 0
    assert len(table.commits()) == 1 and {(r.k, r.v) for r in table.read().collect()} == want
    assert {p for p in os.listdir(f"{tmp_path}/t/data") if not p.startswith(".")} == set(table.head()["parts"].values())


def test_a_repeated_micro_batch_does_nothing(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=4)
    step = jobs.latest_per_key_step(table, ["v"], "s")
    for number, rows in enumerate([[(1, "b"), (2, "a"), (1, "a")], [(1, "a"), (3, "c"), (2, "z")]]):
        step(pairs(spark, *rows), number)
    commits = table.commits()
    step(pairs(spark, (9, "x")), 1)
    assert table.commits() == commits
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, "b"), (2, "z"), (3, "c")}
    jobs.latest_per_key_step(table, ["v"], "another")(pairs(spark, (9, "x")), 0)
    assert table.rows() == 4


def landing(spark, day, **values):
    return spark.createDataFrame([(day, k, v) for k, v in values.items()], "batch_date string, k string, v string").withColumn("batch_date", F.to_date("batch_date"))


DAYS = {"2024-01-01": {"a": "1", "b": "1", "c": "1"}, "2024-01-02": {"a": "2", "b": "1", "d": "1"}, "2024-01-04": {"a": "2", "c": "3", "d": "2"}}


def rows_of(flow):
    return sorted((r.k, r.v, str(r[EFF]), str(r[END])) for r in flow.history().collect())


def test_days_that_wait_together_give_what_days_apart_give(spark, tmp_path):
    stacked = None
    for day, values in DAYS.items():
        one = landing(spark, day, **values)
        stacked = one if stacked is None else stacked.unionByName(one)
    apart = load_batches(spark, stacked, ["k"], *STAMP, root=f"{tmp_path}/apart")
    want = rows_of(apart)
    assert len(want) == 7 and any(r[3] == "2024-01-03" for r in want)

    root = f"{tmp_path}/together"
    stacked.coalesce(1).write.parquet(f"{root}/in")
    flow = ChangeFlow(spark, f"{root}/tables", ["k"])
    for stream in ("one", "two"):  # a new checkpoint over existing tables brings nothing new
        step = jobs.change_batches_step(flow, root, *STAMP, stream)
        jobs.run_batches(jobs.file_stream(spark, f"{root}/in", stacked.schema), step, f"{root}/checkpoint-{stream}")
        assert rows_of(flow) == want
    assert len(os.listdir(f"{root}/late")) == 2  # the earlier days of the second stream
    head = flow.history_table.head()
    step(stacked, 0)  # a repeated micro-batch
    assert flow.history_table.head() == head and rows_of(flow) == want
    # A later micro-batch with more rows of the newest day: the day is compared as a whole again.
    step(landing(spark, "2024-01-04", e="9"), 1)
    assert rows_of(flow) == sorted([*want, ("e", "9", "2024-01-04", "9999-12-31")])


def test_a_batch_writes_its_changes_and_touched_buckets_only(spark, tmp_path):
    keys = [f"k{i}" for i in range(400)]
    flow = ChangeFlow(spark, f"{tmp_path}/f", ["k"], buckets=16, mask_plan="mask:v")
    flow.first_load(landing(spark, "2024-01-01", **dict.fromkeys(keys, "a1")).drop("batch_date"), "2024-01-01", *STAMP)
    plain, masked = flow.history_table.head()["parts"], flow.masked_history.head()["parts"]
    flow.batch(landing(spark, "2024-01-02", **(dict.fromkeys(keys[1:], "a1") | {"k7": "b2"})).drop("batch_date"), "2024-01-02", *STAMP)
    for before, table in ((plain, flow.history_table), (masked, flow.masked_history)):
        assert 1 <= sum(before[b] != p for b, p in table.head()["parts"].items()) <= 2
    assert sorted((r.k, r.v, str(r[END])) for r in flow.closed_table.read().collect()) == [("k0", "a1", "2024-01-01"), ("k7", "a1", "2024-01-01")]
    assert {r.v for r in flow.masked_history.read().collect()} == {"Xn"} and flow.masked_current.read().count() == 399
    # The day again with other rows: what it did before is undone.
    flow.batch(landing(spark, "2024-01-02", **dict.fromkeys(keys, "a1")).drop("batch_date"), "2024-01-02", *STAMP)
    assert flow.closed_table.read().count() == 0 and flow.history_table.rows() == 400 and flow.changes().filter(F.col(EFF) == "2024-01-02").count() == 0
    assert {r.v for r in flow.history().collect()} == {"a1"}


def test_journal_of_a_flow(spark, tmp_path):
    flow = ChangeFlow(spark, f"{tmp_path}/f", ["k"], buckets=2, mask_plan="mask:v")
    flow.first_load(landing(spark, "2024-01-01", a="1", b="1").drop("batch_date"), "2024-01-01", *STAMP)
    flow.batch(landing(spark, "2024-01-02", a="2", c="1").drop("batch_date"), "2024-01-02", *STAMP)
    with pytest.raises(ValueError, match="more than once"):
        flow.batch(pairs(spark, ("a", "1"), ("a", "2"), names="k string, v string"), "2024-01-03", *STAMP)
    entries = flow.journal.read().orderBy("seq").collect()
    done = {(str(r.batch_date)[-2:], r.step): (r.source_rows, r.target_rows) for r in entries if r.status == "SUCCESS"}
    assert done["02", "Changes"] == done["02", "Changes-MASK"] == (2, 3)
    assert done["02", "History"] == (2, 4) and done["02", "Current"] == (2, 2)
    assert {r.step for r in entries if r.status == "FAILED"} == {s + m for s in ("Changes", "History", "Current") for m in ("", "-MASK")}
    assert all("more than once" in r.message for r in entries if r.status == "FAILED")
    assert sum(r.status == "STARTED" for r in entries) == 18
