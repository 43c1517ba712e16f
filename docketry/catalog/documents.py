"""Queries for document text, stamps and page labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import CLAIM_CTE, VISIT_CTE, claim_docs, query, sql_hits, visit_docs
from docketry.catalog.fields import SQL_EMAIL_RE, sql_dates
from docketry.functions import fixed_values as V
from docketry.functions.text import explode_once
from docketry.operators import documents
from docketry.session import table, text_table

ANY = lambda text, words: f"({sql_hits(text, words)} > 0)"


@query("doc_flatten_newlines", "SELECT doc_id, replace(text, chr(10), ' ') AS content FROM documents")
def doc_flatten_newlines(spark, sf):
    docs = text_table(spark, sf, "documents")
    return docs.select("doc_id", documents.flatten_newlines(F.col("text")).alias("content"))


SQL_CLEAN = r"regexp_replace(regexp_replace(t, '[^\w\s]', '', 'g'), ' +', ' ', 'g')"


@query("doc_label_clean", CLAIM_CTE + f" SELECT doc_id, {SQL_CLEAN} AS content FROM docs")
def doc_label_clean(spark, sf):
    return claim_docs(spark, sf).select("doc_id", documents.label_clean(F.col("content")).alias("content"))


def ocr_records(spark, sf):
    """OCR results as JSON, written from the claim documents: words with a confidence, two style spans.

    Pages of one kind stand for error responses.
    """
    words = F.transform(
        F.split("content", " "),
        lambda w, i: F.struct(w.alias("content"), (((F.length(w) * 7 + i) % 100) / 100).alias("confidence")),
    )
    response = F.struct(
        F.col("content"),
        F.array(F.struct(words.alias("words"))).alias("pages"),
        F.array(
            F.struct(
                F.array(
                    F.struct(F.lit(0).alias("offset"), (F.col("doc_id") % 40).cast("int").alias("length")),
                    F.struct(F.lit(50).alias("offset"), (F.col("doc_id") % 17).cast("int").alias("length")),
                ).alias("spans")
            )
        ).alias("styles"),
    )
    failed = F.col("content").contains("explanation of benefits")
    return claim_docs(spark, sf).select(
        "doc_id", F.to_json(F.struct(F.when(~failed, response).alias("response")), {"ignoreNullFields": "false"}).alias("fr_result")
    )


@query(
    "doc_json_content",
    CLAIM_CTE
    + """ SELECT doc_id, CASE WHEN NOT contains(content, 'explanation of benefits') THEN content END AS content,
      CASE WHEN NOT contains(content, 'explanation of benefits') THEN len(list_distinct(string_split(content, ' '))) END AS distinct_words,
      CASE WHEN NOT contains(content, 'explanation of benefits') THEN 2 END AS spans FROM docs""",
)
def doc_json_content(spark, sf):
    read = documents.read_ocr_json(ocr_records(spark, sf), "fr_result")
    return read.select(
        "doc_id", "content",
        F.when(F.col("word_confidence").isNotNull(), F.size("word_confidence")).alias("distinct_words"),
        F.when(F.col("styles").isNotNull(), F.size(F.col("styles")[0]["spans"])).alias("spans"),
    )


@query(
    "doc_word_confidence",
    CLAIM_CTE
    + """, w AS (SELECT doc_id, unnest(string_split(content, ' ')) AS word, generate_subscripts(string_split(content, ' '), 1) - 1 AS pos
        FROM docs WHERE NOT contains(content, 'explanation of benefits'))
      SELECT doc_id, word, arg_max(((len(word) * 7 + pos) % 100) / 100, pos) AS confidence FROM w GROUP BY doc_id, word""",
)
def doc_word_confidence(spark, sf):
    read = documents.read_ocr_json(ocr_records(spark, sf), "fr_result")
    pairs = F.map_entries("word_confidence")
    words = read.select("doc_id", explode_once(pairs).alias("e")).filter("e IS NOT NULL")
    return words.select("doc_id", F.col("e.key").alias("word"), F.col("e.value").alias("confidence"))


@query(
    "doc_first_words",
    CLAIM_CTE
    + r""", w AS (SELECT doc_id, list_transform(string_split(content, ' '), lambda x: regexp_replace(lower(x), '[^\w\s]', '', 'g')) AS ws FROM docs),
      d AS (SELECT doc_id, list_filter(ws, lambda x, i: list_position(ws, x) = i) AS ws FROM w)
      SELECT doc_id, array_to_string(ws[1:5], ' ') AS first_words FROM d""",
)
def doc_first_words(spark, sf):
    docs = claim_docs(spark, sf)
    return docs.select("doc_id", F.array_join(documents.first_words(F.split("content", " ")), " ").alias("first_words"))


@query(
    "doc_handwritten_share",
    CLAIM_CTE
    + """ SELECT doc_id, CASE WHEN contains(content, 'explanation of benefits') THEN 0.0
        ELSE round(cast(doc_id % 40 + doc_id % 17 AS double) / len(content), 3) END AS handwritten_percentage FROM docs""",
)
def doc_handwritten_share(spark, sf):
    read = documents.read_ocr_json(ocr_records(spark, sf), "fr_result")
    share = documents.handwritten_share(F.col("styles"), F.col("content"))
    return read.select("doc_id", share.alias("handwritten_percentage"))


def _stamp_inputs(spark, sf):
    """Documents by object id, and the stamped scans as another system spells their names."""
    docs = claim_docs(spark, sf).withColumn(
        "obj_id", F.concat(F.col("batch_date").cast("string"), F.lit("_scan-"), F.col("doc_id").cast("string"))
    )
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    stamped = urgent.select(
        F.concat(F.translate(F.to_date("o_orderdate").cast("string"), "-", ""), F.lit("scan"), F.col("o_orderkey").cast("string")).alias("obj_id")
    )
    return docs, stamped


@query(
    "doc_has_stamp",
    CLAIM_CTE
    + """ SELECT d.doc_id, o_orderpriority = '1-URGENT' AND NOT contains(t, 'shop') AS has_stamp
      FROM docs d JOIN orders o ON d.doc_id = o.o_orderkey""",
)
def doc_has_stamp(spark, sf):
    docs, stamped = _stamp_inputs(spark, sf)
    return documents.flag_stamps(docs.drop("has_stamp"), stamped, excluded_terms=("shop",)).select("doc_id", "has_stamp")


@query(
    "doc_stamp_override",
    CLAIM_CTE
    + """ SELECT d.doc_id, has_stamp OR coalesce(l.toxic = 1, false) AS has_stamp
      FROM docs d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def doc_stamp_override(spark, sf):
    confirmed = table(spark, sf, "labels").filter("toxic = 1")
    return documents.override_stamps(claim_docs(spark, sf), confirmed, "doc_id").select("doc_id", "has_stamp")


@query(
    "doc_stamp_exclusion",
    CLAIM_CTE + " SELECT doc_id, has_stamp AND NOT contains(t, 'pharmacy') AS has_stamp FROM docs",
)
def doc_stamp_exclusion(spark, sf):
    flag = documents.exclude_stamps(F.col("has_stamp"), F.col("content"), ["pharmacy"])
    return claim_docs(spark, sf).select("doc_id", flag.alias("has_stamp"))


@query(
    "doc_sort_v1",
    CLAIM_CTE
    + f""", c AS (SELECT doc_id, {SQL_CLEAN} AS x FROM docs)
      SELECT doc_id, CASE WHEN {ANY('x', V.CLAIM_FORM_PHRASES)} AND {ANY('x', V.CLAIM_ONE_MARKS)} THEN 'claim_page_one'
        WHEN {sql_hits('x', V.CLAIM_TWO_MARKS)} >= 2 THEN 'claim_page_two'
        WHEN {ANY('x', V.DRUG_MARKS)} AND (contains(x, ' din') OR contains(x, ' rx')) THEN 'drug_receipt'
        WHEN {ANY('x', V.THERAPY_WORDS)} AND {ANY('x', V.BILLING_WORDS)} THEN 'paramedical_invoice'
        WHEN {ANY('x', V.RECEIPT_WORDS)} AND contains(x, 'date') AND NOT contains(x, 'claim') THEN 'other_receipt'
        ELSE 'other_doc' END AS page_label FROM c""",
)
def doc_sort_v1(spark, sf):
    return documents.label_v1(claim_docs(spark, sf)).select("doc_id", "page_label")


@query(
    "doc_sort_simple",
    CLAIM_CTE
    + f""" SELECT doc_id, CASE WHEN contains(t, 'claim page one') THEN 'claim_page_one'
        WHEN contains(t, 'claim page two') THEN 'claim_page_two' WHEN {ANY('t', V.DRUG_MARKS)} THEN 'drug_receipt'
        WHEN {ANY('t', V.THERAPY_WORDS)} THEN 'paramedical_invoice' WHEN {ANY('t', V.RECEIPT_WORDS)} THEN 'other_receipt'
        ELSE 'other_doc' END AS page_label FROM docs""",
)
def doc_sort_simple(spark, sf):
    return documents.label_simple(claim_docs(spark, sf)).select("doc_id", "page_label")


SQL_LABEL_V2 = f"""CASE WHEN {ANY('x', V.CLAIM_FORM_PHRASES_SHORT)} AND {sql_hits('x', V.CLAIM_ONE_FIELDS)} > 5 THEN 'claim_page_one'
        WHEN {sql_hits('x', V.CLAIM_TWO_FIELDS)} >= 2 THEN 'claim_page_two'
        WHEN {ANY('x', V.THERAPY_WORDS)} AND {ANY('x', V.BILLING_WORDS)} THEN 'paramedical_invoice'
        WHEN {ANY('x', V.RECEIPT_WORDS)} AND {ANY('x', V.RECEIPT_DETAIL_WORDS)} AND NOT {ANY('x', V.RECEIPT_EXCLUSIONS)} THEN 'other_receipt'
        WHEN contains(x, '{V.OFFICIAL_RECEIPT}') OR ({sql_hits('x', V.DRUG_WORDS)} > 3 AND NOT contains(x, 'claim')
          AND regexp_matches(t, '[0-9][.][0-9][0-9]')) THEN 'drug_receipt'
        ELSE 'other_doc' END"""
SQL_X = r"regexp_replace(t, '[^\w\s]', '', 'g') AS x"


@query("doc_sort_v2", CLAIM_CTE + f", c AS (SELECT doc_id, t, {SQL_X} FROM docs) SELECT doc_id, {SQL_LABEL_V2} AS page_label FROM c")
def doc_sort_v2(spark, sf):
    return documents.label_v2(claim_docs(spark, sf)).select("doc_id", "page_label")


SQL_SPACED = r"regexp_replace(regexp_replace(t, '[^\w\s]', ' ', 'g'), ' +', ' ', 'g')"


@query(
    "doc_class_v1",
    CLAIM_CTE
    + f""", c AS (SELECT doc_id, {SQL_SPACED} AS x FROM docs),
      n AS (SELECT doc_id, x, {sql_hits('x', V.CLAIM_ONE_FIELDS)} AS one, {sql_hits('x', V.CLAIM_TWO_FIELDS)} AS two,
        {sql_hits('x', V.DRUG_WORDS)} AS drug, {ANY('x', V.CLAIM_FORM_PHRASES_SHORT)} AS form, contains(x, 'claim') AS claim FROM c),
      v AS (SELECT doc_id, CASE WHEN form AND one > 5 THEN ['claim_page_one', CASE WHEN one >= 10 THEN '1.0' ELSE '0.' || one END]
        WHEN two > 5 THEN ['claim_page_two', '1.0'] WHEN two > 2 THEN ['claim_page_two', '0.' || (4 + two)]
        WHEN contains(x, '{V.OFFICIAL_RECEIPT}') OR (drug > 6 AND NOT claim) THEN ['drug_receipt', '1.0']
        WHEN drug > 3 AND NOT claim THEN ['drug_receipt', '0.' || (50 + 15 * (drug - 3))]
        WHEN {ANY('x', V.RECEIPT_WORDS)} AND contains(x, 'date') AND NOT claim THEN ['other_receipt', '1.0']
        ELSE ['other_doc', '1.0'] END AS r FROM n)
      SELECT doc_id, r[1] AS label, cast(r[2] AS double) AS confidence FROM v""",
)
def doc_class_v1(spark, sf):
    return documents.classify_v1(claim_docs(spark, sf)).select("doc_id", "doc_class.label", "doc_class.confidence")


SQL_KEEP_DOT = r"regexp_replace(regexp_replace(t, '[^\w\s\.]', ' ', 'g'), ' +', ' ', 'g')"


@query(
    "doc_class_v2",
    VISIT_CTE
    + rf""", c AS (SELECT doc_id, t, {SQL_KEEP_DOT} AS x FROM docs),
      n AS (SELECT doc_id, t, x, {sql_hits('t', V.CLAIM_ONE_FIELDS_WIDE)} AS one, {sql_hits('t', V.CLAIM_TWO_FIELDS)} AS two,
        {sql_hits('x', V.DRUG_WORDS_WIDE)} AS drug, {ANY('x', V.CLAIM_FORM_PHRASES_SHORT)} AS form,
        {ANY('x', V.DRUG_GATE_WORDS)} AND NOT contains(x, 'customer copy') AS gate,
        regexp_matches(t, '[0-9][.][0-9][0-9]') AS amount,
        regexp_matches(x, '[(]?\d{{3}}[)|\-|\s|\.]\s?\d{{3}}[\-|\s|\.]\d{{4}}') AS phone,
        regexp_matches(t, '{SQL_EMAIL_RE}') AS email, len({sql_dates('t', wide=True)}) > 0 AS dated,
        {ANY('x', V.AMOUNT_WORDS)} AS paid, {ANY('x', V.HEALTH_RECEIPT_WORDS)} AS receiptish,
        {ANY('x', V.REFERRAL_WORDS)} AS therapy FROM c),
      v AS (SELECT doc_id, CASE WHEN form AND one > 5 THEN ['claim_page_one', CASE WHEN one >= 10 THEN '1.0' ELSE '0.' || one END]
        WHEN two > 5 THEN ['claim_page_two', '1.0'] WHEN two > 2 THEN ['claim_page_two', '0.' || (4 + two)]
        WHEN gate AND (contains(x, '{V.OFFICIAL_RECEIPT}') OR (drug > 6 AND NOT contains(x, 'claim') AND amount)) THEN ['drug_receipt', '1.0']
        WHEN gate AND drug > 4 AND NOT contains(x, 'claim') AND amount THEN ['drug_receipt', '0.' || (5 + 2 * (drug - 4))]
        WHEN paid AND amount AND contains(x, 'invoice') THEN ['health_receipt', CASE WHEN dated AND email THEN '1.0' WHEN dated OR email THEN '0.7' ELSE '0.6' END]
        WHEN paid AND amount AND receiptish AND (dated OR phone OR email) AND NOT contains(x, 'customer copy')
          AND NOT {ANY('x', V.HEALTH_DRUG_EXCLUSIONS)} AND NOT contains(x, ' claim ') THEN ['health_receipt', '1.0']
        WHEN paid AND amount AND receiptish AND NOT contains(x, ' claim ') THEN ['other_receipt', '1.0']
        WHEN therapy AND {ANY('x', V.RECEIPT_WORDS)} AND contains(t, '$') THEN ['health_receipt', '0.7']
        WHEN therapy AND contains(t, 'dr.') THEN ['physician_referral', '1.0']
        ELSE ['supporting_doc', '1.0'] END AS r FROM n)
      SELECT doc_id, r[1] AS label, cast(r[2] AS double) AS confidence FROM v""",
)
def doc_class_v2(spark, sf):
    return documents.classify_v2(visit_docs(spark, sf)).select("doc_id", "doc_class.label", "doc_class.confidence")


@query(
    "doc_receipt_count",
    VISIT_CTE
    + rf""", c AS (SELECT doc_id, {SQL_SPACED} AS x FROM docs),
      n AS (SELECT doc_id, len(string_split(x, 'din')) - 1 AS a,
        len(list_filter(list_distinct(regexp_extract_all(x, '\w{{3,4}}\s\d+\s?20\d{{2}}')), lambda d: try_strptime(d, '%b %d %Y') IS NOT NULL))
        + len(list_filter(list_distinct(regexp_extract_all(x, '\d+\s\w{{3,4}}\s20\d{{2}}')), lambda d: try_strptime(d, '%d %b %Y') IS NOT NULL)) AS b,
        len(string_split(x, 'pays')) - 1 + len(string_split(x, 'no charge')) - 1 AS c, len(string_split(x, 'total')) - 1 AS d FROM c),
      l AS (SELECT doc_id, [a, b, c, d] AS vs FROM n),
      m AS (SELECT doc_id, vs, list_transform(vs, lambda v: len(list_filter(vs, lambda w: w = v))) AS ks FROM l)
      SELECT doc_id, cast(vs[list_position(ks, list_max(ks))] AS int) AS receipt_count FROM m""",
)
def doc_receipt_count(spark, sf):
    return documents.count_receipts(visit_docs(spark, sf)).select("doc_id", "receipt_count")
