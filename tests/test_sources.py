from __future__ import annotations

from pyspark.sql import functions as F

from rows import values
from docketry.operators import calls, runlog, surveys
from docketry.sources import readers, sinks


def test_clickstream_files_by_name(spark, tmp_path):
    day = tmp_path / "2024" / "01"
    day.mkdir(parents=True)
    (day / "column_headers.tsv").write_text("hit(id)\tdate_time\tpage-name\n")
    (day / "hit_data.tsv").write_text("1\t2024-01-02 03:04:05\thome\n2\tbroken\tcart\n")
    (day / "browser.tsv").write_text("7\tFox\n")
    loaded = readers.dispatch(spark, str(tmp_path))
    assert set(loaded) == {"hit_data", "browser"}
    hits = loaded["hit_data"].orderBy("hitid").collect()
    assert [(r.hitid, r.page_name, str(r.hit_date)) for r in hits] == [("1", "home", "2024-01-02"), ("2", "cart", "None")]
    assert loaded["browser"].columns == ["browserid", "browser"] and loaded["browser"].first().browser == "Fox"


def test_json_lines_drop_blanks_and_repeats(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text(',{"k":1}\n\n,\n,{"k":1}\n')
    (tmp_path / "y.txt").write_text(',{"k":2}\n')
    assert sorted(r.json_value for r in readers.read_json_lines(spark, str(tmp_path)).collect()) == ['{"k":1}', '{"k":2}']


def test_missing_days_give_a_typed_empty_table(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "20240102"))
    read = lambda a, b: readers.read_date_folders(spark, str(tmp_path), a, b, "id bigint")
    assert read("2024-01-01", "2024-01-09").count() == 2
    none = read("2024-02-01", "2024-02-02")
    assert none.count() == 0 and none.dtypes == [("id", "bigint")]


def test_documents_and_binary_files(spark, tmp_path):
    for name in ("a.jpg", "b.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"123")
    listed = readers.document_ids(readers.list_files(spark, str(tmp_path)), F.lit("2024-01-02"))
    assert sorted(r.obj_id for r in listed.collect()) == ["2024-01-02_a.jpg", "2024-01-02_b.pdf"]
    assert [bytes(r.content) for r in readers.read_binary(spark, str(tmp_path), "*.jpg").collect()] == [b"123"]


def test_manifest(spark, tmp_path):
    (tmp_path / "b.xml").write_text(
        '<batch><transaction transactionid="t1"><page batchsequence="1"><image filename="a.tif" side="front"/><image filename="" side="back"/></page>'
        '<page batchsequence="2"><image filename="c.tif" side="front"/></page></transaction></batch>'
    )
    manifest = readers.read_manifest(spark, str(tmp_path))
    assert sorted(r.filename for r in readers.manifest_images(manifest).collect()) == ["a.tif", "c.tif"]
    row = readers.manifest_json(manifest).first()
    assert (row.total_pages, row.total_images) == (2, 2) and '"batch_sequence":"2"' in row.manifest


def test_daily_rerun_replaces(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, date'2024-01-01' AS dt UNION ALL SELECT 2, date'2024-01-02'")
    for part in (df, df.filter("id = 2")):
        sinks.write_daily(part, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_extract_map_of_nested_missing_and_broken_lines(spark):
    df = spark.createDataFrame([('{"A":{"b":1},"L":[{"x":2}]}',), ('{"A":null}',), ("{broken",)], "json_value string")
    got = calls.extract_map(df, {"b": ["A", "b"], "whole": ["L", ""], "none": ["Q", "z"]}).collect()
    assert [tuple(r) for r in got] == [("1", '[{"x":2}]', None), (None, None, None), (None, None, None)]


def test_dialogue_chunks_keep_the_order(spark):
    rows = [(c, t, "A" if t % 2 else "B", f"w{t}") for c in (1, 2) for t in range(25)]
    df = spark.createDataFrame(rows, "c int, t int, r string, x string").orderBy(F.rand(1))
    want = " ".join(f"{'A' if t % 2 else 'B'}: w{t}" for t in range(25))
    got = calls.dialogue_from_turns(df, "c", "t", "r", "x", chunk=4)
    assert {r.Dialogue_Text for r in got.collect()} == {want}


def test_cases_of_a_range_equal_day_by_day(spark):
    rows = [(f"c{i % 3}", f"2024-01-0{1 + i % 6} 10:00:00", i) for i in range(24)]
    df = spark.createDataFrame(rows, "Id string, at string, n int").withColumn("CreatedDate", F.col("at").cast("timestamp_ntz"))
    names = {"case": "Id", "n": "n"}
    ranged = calls.case_latest_range(df, "2024-01-02", "2024-01-05", names, modified="n")
    for day in ("2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"):
        one = calls.case_latest(df, day, names, modified="n")
        assert sorted(map(tuple, one.collect())) == sorted((r.case, r.n) for r in ranged.filter(F.col("call_day") == day).collect())


def test_survey_union_types_missing_columns(spark):
    a = spark.sql("SELECT 'x' AS id, 'c1' AS contact")
    b = spark.sql("SELECT 'y' AS id")
    got = surveys.unify({"A": a, "B": b})
    assert values(got, "id", "contact", "NPS_Source") == [("x", "c1", "A"), ("y", None, "B")]


def test_run_log_states(spark):
    rows = [("r1", 1, None), ("r2", 1, None), ("r2", 2, None), ("r3", 1, None), ("r3", 2, "bad"), ("r4", 1, None), ("r4", 2, "bad"), ("r4", 3, None)]
    df = spark.createDataFrame([(i, n, n, e) for i, n, e in rows], "id string, written_at int, seq int, Error_Message string")
    assert values(runlog.fold_run_log(df), "Success") == [False, True, False, True]


def test_watermark_defaults(spark):
    none = spark.createDataFrame([], "Status string, WatermarkValue_end_ts string")
    assert runlog.watermark_value(none, "ts").first()[0] == "1800-01-01 00:00:00"
    assert runlog.watermark_value(none, "int").first()[0] == "0"
    assert runlog.watermark_value(none, "int", default="5").first()[0] == "5"
    assert runlog.watermark_value(none, "text").first()[0] == ""
