from __future__ import annotations

from docketry.functions.sql_predicates import register_predicates
from docketry.operators import duplicates, fields


def test_first_of_each_value_and_all_nulls(spark):
    rows = [(1, "a", 5), (2, "a", 3), (3, None, 1), (4, None, 1), (5, "b", None), (6, "b", 0), (7, "", 1), (8, "", 1), (7, "", 1)]
    df = spark.createDataFrame(rows, "id int, text string, at int")
    kept = lambda *order: sorted((r.id, r.text) for r in duplicates.keep_first(df, "text", "id", order).collect())
    assert kept("at") == [(2, "a"), (3, None), (4, None), (5, "b"), (7, ""), (7, "")]
    assert kept() == [(1, "a"), (3, None), (4, None), (5, "b"), (7, ""), (7, "")]
    assert duplicates.keep_first(df.limit(0), "text", "id").collect() == []


def test_the_choice_moves_no_text(spark):
    df = spark.createDataFrame([(1, "a", 5)], "id int, text string, at int")
    lines = duplicates.representatives(df, "text", "id", ["at"])._jdf.queryExecution().executedPlan().toString().split("\n")
    sent = [lines[k + 1] for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert sent and all("partial_min" in line and "text" not in line for line in sent)


def test_predicates_in_sql_equal_the_columns_and_plan_without_python(spark):
    names = register_predicates(spark)
    tokens = [None, "", "7", "77", "1212121212", "a-1234", "x4321", "00000000", "5678", "12345", "9", "1111"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = spark.sql(f"SELECT t, {', '.join(f'{n}(t) AS {n}' for n in names)} FROM {{df}}", df=df)
    want = df.select("t", *[f("t").alias(n) for n, f in zip(names, (lambda c: fields.is_single_digit(df[c]), lambda c: fields.has_repeated_group(df[c]), lambda c: fields.has_consecutive_digits(df[c]), lambda c: fields.made_up_number(df[c])), strict=True)])
    assert got.collect() == want.collect()
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
