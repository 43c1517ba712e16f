"""Compare two ways to run the same work: native expressions against row-at-a-time Python
functions, and SCD2 history in closed form against a loop over days. Prints one JSON line.

    python benchmarks/styles.py [SF_DIR]
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

ROOT = pathlib.Path(__file__).resolve().parents[1]
PATHS = [str(ROOT), str(ROOT / "tests")]
sys.path[:0] = PATHS
os.environ["PYTHONPATH"] = os.pathsep.join(PATHS)  # the row functions are imported by the Python workers

import plain_rules as plain  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from docketry.catalog.base import claim_docs  # noqa: E402
from docketry.catalog.cdc import BATCH_ID, KEYS, RUN_TS  # noqa: E402
from docketry.functions import fixed_values as V  # noqa: E402
from docketry.functions.fixed_values import EFF, END  # noqa: E402
from docketry.operators import cdc, fields  # noqa: E402
from docketry.session import local_session, stage, table  # noqa: E402


def timed(make, runs: int = 3) -> float:
    spent = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        spent.append(time.perf_counter() - start)
    return round(sorted(spent[1:])[runs // 2], 3)


def row_functions(docs):
    text = F.lower("content")
    udf = lambda f, t: F.udf(f, t, useArrow=False)(text)
    return docs.select(
        "doc_id",
        udf(plain.paid_by_cash, T.BooleanType()).alias("paid_by_cash"),
        udf(lambda t: plain.token_after(t, V.INVOICE_KEYWORDS, "date"), T.StringType()).alias("possible_invoice_nbr"),
        udf(plain.amount, T.DoubleType()).alias("payment_amount"),
        udf(plain.bad_address, T.BooleanType()).alias("has_invalid_addr"),
        udf(plain.dates, T.ArrayType(T.DateType())).alias("treatment_dates"),
        udf(plain.phone_in, T.StringType()).alias("phone_nbr"),
    )


def native(docs):
    df = docs
    for rule in (fields.paid_by_cash, fields.invoice_number, fields.payment_amount, fields.invalid_address, fields.treatment_dates, fields.phone):
        df = rule(df)
    return df.drop("content")


def day_loop(changes, days):
    hist = changes.filter(F.lit(False)).withColumn(END, F.lit(None).cast("date"))
    for day in days:
        hist = cdc.apply_day(hist, changes.filter(F.col(EFF) == F.lit(day).cast("date")), KEYS)
    return hist


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, "styles")
    spark.sparkContext.setLogLevel("ERROR")
    docs = stage(claim_docs(spark, sf).select("doc_id", "content"), "style-docs")
    orders = table(spark, sf, "orders")
    landing = orders.groupBy(F.trunc("o_orderdate", "quarter").alias("batch_date"), F.col("o_custkey").alias("client")).agg(
        F.max("o_orderpriority").alias("priority"), F.max("o_orderstatus").alias("status")
    )
    changes = stage(cdc.diff_all(landing, landing, KEYS, RUN_TS, BATCH_ID), "style-changes")
    days = [str(r[0]) for r in changes.select(EFF).distinct().orderBy(EFF).collect()]
    result = {
        "documents": docs.count(), "native_rules": timed(lambda: native(docs)), "row_functions": timed(lambda: row_functions(docs)),
        "change_rows": changes.count(), "batches": len(days), "history_closed_form": timed(lambda: cdc.history(changes, KEYS)),
        "history_day_loop": timed(lambda: day_loop(changes, days), runs=1), "sf": sf,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
