"""Inputs that come in several folders, batches or hands at once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketry.sources import readers, tables
from docketry.streaming import jobs


def test_every_folder_of_a_table_is_read(spark, tmp_path):
    for month, rows in (("2024-01", "1\t2024-01-01 00:00:00\n2\t2024-01-02 00:00:00\n"), ("2024-02", "3\t2024-02-01 00:00:00\n4\t2024-02-02 00:00:00\n")):
        folder = tmp_path / month
        folder.mkdir()
        (folder / "hit_data.tsv").write_text(rows)
        (folder / "column_headers.tsv").write_text("id\tdate_time\n")
        (folder / "browser.tsv").write_text(f"{month}\tx\n")
    loaded = readers.dispatch(spark, str(tmp_path))
    assert loaded["hit_data"].count() == 4
    assert loaded["browser"].count() == 2


def test_a_late_row_in_a_later_batch_is_rejected(spark, tmp_path):
    step = jobs.late_gate_step(f"{tmp_path}/ok", f"{tmp_path}/late", "day", 21)
    for number, day in enumerate([dt.date(2024, 3, 1), dt.date(2023, 1, 1), dt.date(2024, 2, 20)]):
        step(spark.createDataFrame([(number, day)], "id int, day date"), number)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/ok").collect()) == [0, 2]
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/late").collect()] == [1]


def test_a_second_writer_is_told(spark, tmp_path):
    table = tables.VersionedTable(spark, f"{tmp_path}/t")
    table.overwrite(spark.range(1))
    other = tables.VersionedTable(spark, f"{tmp_path}/t")
    seen = table.versions()
    other.overwrite(spark.range(2))
    table.versions = lambda calls=iter([seen]): next(calls, None) or tables.VersionedTable.versions(table)
    with pytest.raises(RuntimeError):
        table.overwrite(spark.range(3))


def test_change_partitions_keep_their_parallelism(spark, tmp_path):
    table = tables.ChangeTable(spark, f"{tmp_path}/c", "d")
    df = spark.range(0, 100, 1, 16).withColumn("d", F.lit("2024-01-01").cast("date"))
    table.write(df, first_load=True)
    table.write(df.limit(10))
    assert table.read().count() == 10
