"""Queries for projections, filters, predicates and conditionals."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import CLAIM_CTE, claim_docs, query
from docketry.catalog.fields import SQL_AMOUNT
from docketry.operators import documents, duplicates, fields, projections, scoring
from docketry.session import table

RENAMES = {"order_id": "o_orderkey", "client": "o_custkey", "amount": "o_totalprice", "placed": "o_orderdate"}


@query(
    "project_rename_map",
    "SELECT o_orderkey AS order_id, o_custkey AS client, o_totalprice AS amount, cast(o_orderdate AS date) AS placed FROM orders",
)
def project_rename_map(spark, sf):
    return projections.rename_map(table(spark, sf, "orders"), RENAMES).withColumn("placed", F.to_date("placed"))


@query("project_ordered", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer")
def project_ordered(spark, sf):
    return projections.ordered(table(spark, sf, "customer"), ["c_mktsegment", "c_custkey", "c_acctbal"])


@query(
    "normalize_column_names",
    "SELECT p_partkey AS part_key, p_brand AS brand_name, p_retailprice AS retail_price_usd FROM part",
)
def normalize_column_names(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return projections.normalize_names(part.toDF("Part/ Key", "Brand.[] Name", "Retail Price (USD)"))


@query("clean_column_names_strict", "SELECT s_suppkey AS supp_key, s_name AS s_namex, s_acctbal AS acct_bal_ FROM supplier")
def clean_column_names_strict(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return projections.strict_names(supplier.toDF("supp-key", "s_name;{x}", "acct bal?"))


@query(
    "filter_isin",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_isin(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query(
    "filter_equal_triplet",
    "SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND source = 'src1'",
)
def filter_equal_triplet(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return projections.keep_equal(docs, {"lang": "en", "source": "src1"})


@query(
    "filter_between_dates",
    "SELECT event_id, event_type FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-09' AND DATE '2024-01-10'",
)
def filter_between_dates(spark, sf):
    return projections.day_and_day_before(table(spark, sf, "events"), "ts", "2024-01-10").select("event_id", "event_type")


@query(
    "filter_text_exclude",
    "SELECT doc_id FROM documents WHERE NOT coalesce(contains(lower(text), 'the'), false)",
)
def filter_text_exclude(spark, sf):
    return projections.drop_phrase(table(spark, sf, "documents"), "text", "THE").select("doc_id")


@query("filter_like_substring", "SELECT doc_id FROM documents WHERE lower(text) LIKE '%license%'")
def filter_like_substring(spark, sf):
    return projections.keep_phrase(table(spark, sf, "documents"), "text", "license").select("doc_id")


@query(
    "filter_null_content",
    "SELECT o_orderkey AS doc_id FROM orders LEFT JOIN documents ON doc_id = o_orderkey WHERE text IS NULL",
)
def filter_null_content(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    joined = orders.join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "left")
    return joined.filter(F.col("text").isNull()).select("doc_id")


@query(
    "fill_defaults",
    """SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
       coalesce(CASE WHEN quality = 1 THEN source END, 'No data found') AS checked_source
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def fill_defaults(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left").withColumn(
        "checked_source", F.when(F.col("quality") == 1, F.col("source"))
    )
    filled = projections.fill_defaults(joined, {"quality": 0, "toxic": 0, "checked_source": "No data found"})
    return filled.select("doc_id", "quality", "toxic", "checked_source")


@query(
    "cast_flags_to_int",
    CLAIM_CTE
    + """ SELECT doc_id, cast(has_stamp AS int) AS has_stamp,
          cast(handwritten_percentage > 0.3 AS int) AS above_handwritten_threshold FROM docs""",
)
def cast_flags_to_int(spark, sf):
    flags = ["has_stamp", "above_handwritten_threshold"]
    docs = fields.above_handwritten(claim_docs(spark, sf))
    return scoring.flags_to_int(docs, flags).select("doc_id", *flags)


@query(
    "conditional_rewrite",
    CLAIM_CTE
    + f""", paid AS (SELECT doc_id, has_stamp, {SQL_AMOUNT} AS amt FROM docs)
      SELECT doc_id, CASE WHEN NOT has_stamp THEN amt WHEN amt IS NULL THEN 500.0 WHEN amt <= 100 THEN 800.0
        WHEN amt > 100 AND amt < 300 THEN 900.0 ELSE amt END AS payment_amount FROM paid""",
)
def conditional_rewrite(spark, sf):
    a = F.col("payment_amount")
    cases = [(a.isNull(), 500.0), (a <= 100, 800.0), ((a > 100) & (a < 300), 900.0)]
    docs = fields.payment_amount(claim_docs(spark, sf))
    return projections.rewrite_where(docs, "payment_amount", F.col("has_stamp"), cases).select("doc_id", "payment_amount")


@query(
    "add_audit_columns",
    """SELECT c_custkey, 'I' AS "DL_ETL_OPS_IND", DATE '2024-03-01' AS "DL_ETL_EFF_DT", DATE '9999-12-31' AS "DL_ETL_END_DT",
       TIMESTAMP '2024-03-02 01:00:00' AS "DL_ETL_RUN_DT", 7 AS "DL_ETL_BATCH_ID" FROM customer""",
)
def add_audit_columns(spark, sf):
    keys = table(spark, sf, "customer").select("c_custkey")
    return projections.add_audit(keys, "2024-03-01", "2024-03-02 01:00:00", 7, op="I", end="9999-12-31")


@query(
    "strip_key_prefix",
    "SELECT o_orderkey, 'scan_' || cast(o_orderkey AS varchar) || '.tif' AS file_name FROM orders",
)
def strip_key_prefix(spark, sf):
    key = F.concat(F.to_date("o_orderdate").cast("string"), F.lit("_scan_"), F.col("o_orderkey").cast("string"), F.lit(".tif"))
    return table(spark, sf, "orders").select("o_orderkey", projections.strip_prefix(key).alias("file_name"))


_PROFILED = ["payment_amount", "register_num", "phone_nbr"]


@query(
    "null_profile",
    CLAIM_CTE
    + f""", f AS (SELECT {SQL_AMOUNT} AS payment_amount, quality, toxic
        FROM docs LEFT JOIN labels USING (doc_id))
      SELECT 'payment_amount' AS column_name, count(*) FILTER (payment_amount IS NULL) AS nulls FROM f
      UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM f
      UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM f""",
)
def null_profile(spark, sf):
    docs = fields.payment_amount(claim_docs(spark, sf)).join(table(spark, sf, "labels"), "doc_id", "left")
    return projections.null_profile(docs.select("payment_amount", "quality", "toxic"))


@query(
    "drop_duplicate_content",
    "SELECT doc_id, text, source FROM documents QUALIFY text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY n_chars, doc_id) = 1",
)
def drop_duplicate_content(spark, sf):
    docs = table(spark, sf, "documents")
    return duplicates.keep_first(docs, "text", "doc_id", ["n_chars"]).select("doc_id", "text", "source")


@query(
    "drop_duplicate_number",
    CLAIM_CTE
    + r""", numbered AS (SELECT doc_id, member_id, batch_date, nullif(regexp_extract(t, '(invoice number|invoice num|invoice #|invoice#)[\s:]*([a-z-]*[0-9][^\s]*)', 2), '') AS number FROM docs)
      SELECT * FROM numbered QUALIFY number IS NULL OR row_number() OVER (PARTITION BY number ORDER BY batch_date, doc_id) = 1""",
)
def drop_duplicate_number(spark, sf):
    """Of the claims with the same invoice number the earliest stays; claims without one all stay."""
    numbered = fields.invoice_pattern(claim_docs(spark, sf)).select("doc_id", "member_id", "batch_date", F.col("invoice_pattern_nbr").alias("number"))
    return duplicates.keep_first(numbered, "number", "doc_id", ["batch_date"])
