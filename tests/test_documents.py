from __future__ import annotations

import json

from pyspark.sql import functions as F

from rows import values
from docketry.operators import documents, scoring
from docketry.functions import masking
from docketry.operators import projections


def test_handwritten_share(spark):
    rows = [(0, [([(0, 15)],)], "x" * 21), (1, [([(0, 4), (5, 6)],)], "y" * 21), (2, None, "text"), (3, [([(0, 3)],)], "")]
    df = spark.createDataFrame(rows, f"id int, styles {documents.STYLES_TYPE}, content string")
    share = documents.handwritten_share(F.col("styles"), F.col("content"))
    assert values(df.withColumn("s", share), "s") == [0.714, 0.476, 0.0, 0.0]


def test_ocr_json_last_duplicate_wins_and_errors_are_null(spark):
    good = {"response": {"content": "a b\na", "pages": [{"words": [{"content": "a", "confidence": 0.1}, {"content": "b", "confidence": 0.2}]},
                                                         {"words": [{"content": "a", "confidence": 0.9}]}], "styles": []}}
    df = spark.createDataFrame([(0, json.dumps(good)), (1, json.dumps({"response": None}))], "id int, j string")
    got = values(documents.read_ocr_json(df, "j"), "content", "word_confidence", "styles")
    assert got == [("a b a", {"a": 0.9, "b": 0.2}, []), (None, None, None)]


def test_stamps(spark):
    docs = spark.createDataFrame([(0, "d_a-1.jpg", "plain"), (1, "d_b.jpg", "from ShopX"), (2, "d_c.jpg", "plain"), (3, "d_a-1.jpg", None)], "id int, obj_id string, content string")
    stamped = spark.createDataFrame([("da1.jpg",), ("db.jpg",)], "obj_id string")
    got = documents.flag_stamps(docs, stamped, excluded_terms=["shopx"])
    assert values(got, "has_stamp") == [True, False, False, False]


def test_caller_terms_extend_the_lists(spark):
    text = "northwind form: plan contract number plan member name birthday spouse dependants patient information"
    df = spark.createDataFrame([(0, text)], "id int, content string")
    assert values(documents.label_v2(df), "page_label") == ["other_doc"]
    assert values(documents.label_v2(df, insurer_form_terms=["northwind"]), "page_label") == ["claim_page_one"]
    alt = spark.createDataFrame([(0, "guild member basic personal information patient information page 1 of 2 plan number")], "id int, content string")
    got = documents.classify_v2(alt, alt_form_terms=["guild"])
    assert values(got, "doc_class") == [("claim_page_one", 0.8)]


def test_unicode_words_survive_cleaning(spark):
    df = spark.createDataFrame([(0, "Café d'Été, no. 5")], "id int, content string")
    assert values(df.withColumn("x", documents.label_clean(F.col("content"))), "x") == ["café dété no 5"]


def test_receipt_count_takes_the_first_of_equal_counts(spark):
    df = spark.createDataFrame([(0, "din din pays pays total jan 5 2023"), (1, ""), (2, "total total total din pays")], "id int, content string")
    assert values(documents.count_receipts(df), "receipt_count") == [2, 0, 1]


def test_masks(spark):
    df = spark.sql("SELECT 'Ab-12' AS name, date'2024-05-17' AS d, timestamp'2024-05-17 10:00:00' AS ts, cast(NULL AS string) AS gone, 4512 AS num")
    masked = masking.apply_masks(df, "mask_show_first_1:NAME,datemask:d,datemask:TS,mask:gone,mask:num")
    row = masked.first()
    assert (row.name, str(row.d), str(row.ts), row.gone, row.num) == ("AX-nn", "2024-05-01", "2024-05-01 00:00:00", None, "nnnn")
    for plan in ("datemask:name", "mask:nothing", "mask_first_2:name"):
        try:
            masking.apply_masks(df, plan)
        except ValueError:
            continue
        raise AssertionError(plan)


def test_column_names():
    assert projections.strict_name("a,b;{c}(d)\n\t=e f") == "abcde_f"


def test_risk_level_keeps_the_zero_edge_and_can_be_bounded(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 2 else 0.0) for i in range(100)], "id int, risk_score double")
    levels = lambda **kw: set(values(scoring.risk_level(df, **kw).filter("risk_score = 0"), "risk_level"))
    assert levels() == {"Should Investigate"}
    assert levels(min_score=0.1) == {"Not Suspicious"}
