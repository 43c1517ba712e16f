"""Queries for field extraction and fraud rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import CLAIM_CTE, VISIT_CTE, claim_docs, query, sql_hits, visit_docs
from docketry.functions import fixed_values as V
from docketry.functions.sql_predicates import register_predicates
from docketry.operators import fields
from docketry.session import text_table

POSTAL_RE = V.POSTAL_IN_WINDOW.replace("\\d", "[0-9]")
SQL_PAY = sql_hits("t", V.PAYMENT_WORDS)


@query(
    "rule_paid_by_cash",
    CLAIM_CTE
    + f""" SELECT doc_id, strpos(t,'cash') > 0 AND (strpos(t,'cashier') = 0 OR strpos(t,'cash') <> strpos(t,'cashier'))
      AND {SQL_PAY} < 2 AS paid_by_cash FROM docs""",
)
def rule_paid_by_cash(spark, sf):
    return fields.paid_by_cash(claim_docs(spark, sf)).select("doc_id", "paid_by_cash")


@query(
    "rule_paid_by_cash_v2",
    CLAIM_CTE
    + f" SELECT doc_id, t LIKE '%cash%' AND t NOT LIKE '%cashier%' AND {SQL_PAY} < 2 AS paid_by_cash FROM docs",
)
def rule_paid_by_cash_v2(spark, sf):
    return fields.paid_by_cash_strict(claim_docs(spark, sf)).select("doc_id", "paid_by_cash")


@query("rule_no_dollar_symbol", "SELECT doc_id, strpos(text, '$') = 0 AS no_dollar_symbol FROM documents")
def rule_no_dollar_symbol(spark, sf):
    return fields.no_dollar_symbol(text_table(spark, sf, "documents"), "text").select("doc_id", "no_dollar_symbol")


@query(
    "rule_above_handwritten",
    CLAIM_CTE + " SELECT doc_id, handwritten_percentage > 0.3 AS above_handwritten_threshold FROM docs",
)
def rule_above_handwritten(spark, sf):
    return fields.above_handwritten(claim_docs(spark, sf), 0.3).select("doc_id", "above_handwritten_threshold")


def _first_token(text: str, keyword: str, cut: bool) -> str:
    window = f"substr({text}, strpos({text}, '{keyword}'), 25)"
    if cut:
        window = f"string_split({window}, 'date')[1]"
    token = f"list_filter(string_split({window}, ' '), lambda x: regexp_matches(x, '[0-9]'))[1]"
    return f"CASE WHEN strpos({text}, '{keyword}') > 0 THEN {token} END"


SQL_INVOICE = "coalesce(" + ", ".join(_first_token("t", k, True) for k in V.INVOICE_KEYWORDS) + ")"
SQL_SINGLE = "regexp_matches(tok, '^[0-9]$')"
SQL_REPEAT = """len(list_filter(range(1, 26), lambda s: len(list_filter(range(1, 7), lambda g:
   regexp_matches(substr(tok, s, g), '^[1-9]+$') AND len(substr(tok, s, g)) = g
   AND substr(tok, s, 4 * g) = repeat(substr(tok, s, g), 4))) > 0)) > 0"""
SQL_RISING = "len(list_filter(regexp_extract_all(tok, '[0-9]{4}'), lambda x: contains('0123456789', x))) > 0"
TOKEN_CTE = CLAIM_CTE + f", toks AS (SELECT doc_id, {SQL_INVOICE} AS tok FROM docs)"


@query(
    "rule_invoice_number",
    TOKEN_CTE
    + f""" SELECT doc_id, tok AS possible_invoice_nbr,
       coalesce({SQL_SINGLE} OR {SQL_REPEAT} OR {SQL_RISING}, false) AS invalid_invoice_nbr FROM toks""",
)
def rule_invoice_number(spark, sf):
    return fields.invoice_number(claim_docs(spark, sf)).select(
        "doc_id", "possible_invoice_nbr", "invalid_invoice_nbr"
    )


def _token_pred(name, column, predicate, sql):
    @query(name, TOKEN_CTE + f" SELECT doc_id, tok AS possible_invoice_nbr, {sql} AS {column} FROM toks")
    def run(spark, sf):
        found = fields.invoice_number(claim_docs(spark, sf))
        return found.select("doc_id", "possible_invoice_nbr", predicate(F.col("possible_invoice_nbr")).alias(column))


_token_pred("pred_single_digit", "single_digit", fields.is_single_digit, SQL_SINGLE)
_token_pred(
    "pred_repeated_group", "repeated_group", fields.has_repeated_group,
    f"CASE WHEN tok IS NOT NULL THEN {SQL_REPEAT} END",
)
_token_pred("pred_consecutive", "consecutive", fields.has_consecutive_digits, SQL_RISING)


@query(
    "sql_predicates",
    TOKEN_CTE
    + f""" SELECT doc_id, tok AS possible_invoice_nbr, {SQL_SINGLE} AS single_digit, CASE WHEN tok IS NOT NULL THEN {SQL_REPEAT} END AS repeated_group, {SQL_RISING} AS consecutive
      FROM toks WHERE coalesce({SQL_SINGLE} OR {SQL_REPEAT} OR {SQL_RISING}, false) OR doc_id % 2 = 0""",
)
def sql_predicates(spark, sf):
    """The predicates called by name in SQL text."""
    register_predicates(spark)
    found = fields.invoice_number(claim_docs(spark, sf))
    return spark.sql(
        """SELECT doc_id, possible_invoice_nbr, single_digit(possible_invoice_nbr) AS single_digit, repeated_group(possible_invoice_nbr) AS repeated_group,
           consecutive_digits(possible_invoice_nbr) AS consecutive FROM {found} WHERE made_up_number(possible_invoice_nbr) OR doc_id % 2 = 0""",
        found=found,
    )


@query(
    "invoice_pattern_extract",
    CLAIM_CTE
    + r""" SELECT doc_id, nullif(regexp_extract(t,
       '(invoice number|invoice num|invoice #|invoice#)[\s:]*([a-z-]*[0-9][^\s]*)', 2), '') AS invoice_pattern_nbr FROM docs""",
)
def invoice_pattern_extract(spark, sf):
    return fields.invoice_pattern(claim_docs(spark, sf)).select("doc_id", "invoice_pattern_nbr")


def _sql_amount(text: str) -> str:
    def top(pattern):
        return (
            f"list_max(list_transform(regexp_extract_all({text}, '{pattern}'), "
            "lambda x: try_cast(replace(replace(x, '$', ''), ',', '') AS double)))"
        )

    return (
        f"CASE WHEN regexp_matches({text}, '{V.DOLLAR_AMOUNT}') THEN {top(V.DOLLAR_AMOUNT)} "
        f"ELSE {top(V.BARE_AMOUNT)} END"
    )


SQL_AMOUNT = _sql_amount("t")


@query("rule_payment_amount", CLAIM_CTE + f" SELECT doc_id, {SQL_AMOUNT} AS payment_amount FROM docs")
def rule_payment_amount(spark, sf):
    return fields.payment_amount(claim_docs(spark, sf)).select("doc_id", "payment_amount")


@query(
    "rule_payment_amount_prose",
    f"SELECT doc_id, {_sql_amount('lower(text)')} AS payment_amount FROM documents",
)
def rule_payment_amount_prose(spark, sf):
    return fields.payment_amount(text_table(spark, sf, "documents"), "text").select("doc_id", "payment_amount")


SQL_REGISTER = "coalesce(" + ", ".join(_first_token("r", k, False) for k in V.REGISTER_KEYWORDS) + ")"


@query(
    "rule_register_number",
    CLAIM_CTE
    + f""", cleaned AS (SELECT doc_id, translate(t, '.,:', '   ') AS r FROM docs)
      SELECT doc_id, replace({SQL_REGISTER}, '#', '') AS register_num FROM cleaned""",
)
def rule_register_number(spark, sf):
    return fields.register_number(claim_docs(spark, sf)).select("doc_id", "register_num")


_ROADS, _PROVINCES = "|".join(V.ROAD_WORDS), "|".join(V.PROVINCE_WORDS)
SQL_STRICT = rf"""(
   len(list_filter(range(1, len(a) + 1), lambda i: substr(a, i, 7) = 'address' AND NOT (
      regexp_matches(substr(a, i, 80), '{POSTAL_RE}')
      AND regexp_matches(substr(a, i, 80), '{_ROADS}') AND regexp_matches(substr(a, i, 80), '{_PROVINCES}')))) > 0
   OR len(list_filter(list_transform(
        list_filter(range(1, len(a) + 1), lambda i: regexp_matches(substr(a, i, 9), '^\s[a-z](\d|i|o)[a-z]\s?(\d|i|o)[a-z](\d|i|o)\s')),
        lambda i: CASE WHEN substr(a, i + 4, 1) = ' ' THEN i + 8 ELSE i + 7 END),
      lambda e: NOT (regexp_matches(CASE WHEN e > 80 AND e + 5 < len(a) THEN substr(a, e - 79, 85) ELSE substr(a, 1, e + 1) END, '{_ROADS}')
       AND regexp_matches(CASE WHEN e > 80 AND e + 5 < len(a) THEN substr(a, e - 79, 85) ELSE substr(a, 1, e + 1) END, '{_PROVINCES}')))) > 0)"""


@query(
    "rule_address_strict",
    CLAIM_CTE
    + f""", plain AS (SELECT doc_id, replace(t, 'email address', ' ') AS a FROM docs)
      SELECT doc_id, {SQL_STRICT} AS has_invalid_addr FROM plain""",
)
def rule_address_strict(spark, sf):
    return fields.invalid_address(claim_docs(spark, sf)).select("doc_id", "has_invalid_addr")


@query(
    "rule_address_simple",
    CLAIM_CTE + f" SELECT doc_id, NOT regexp_matches(t, '{POSTAL_RE}') AS has_invalid_addr FROM docs",
)
def rule_address_simple(spark, sf):
    return fields.invalid_address_simple(claim_docs(spark, sf)).select("doc_id", "has_invalid_addr")


def sql_dates(text: str, wide: bool = False) -> str:
    """List of distinct dates in a text, as DuckDB sees them."""
    word, num, sep = (r"\w{3,9}", r"\d{1,2}", "[/|-]") if wide else (r"\w{3,4}", r"\d{2}", "/")
    two = r"\d{2}"
    layouts = [
        (rf"{word}[\s|-]\d+[,|/]?[\s|-]?20\d{{2}}", "%b %d %Y"),
        (rf"\d+[\s|-]{word}[\s|-]20\d{{2}}", "%d %b %Y"),
        (rf"{num}{sep}{num}{sep}20\d{{2}}", "%m %d %Y"),
        (rf"20\d{{2}}{sep}{two}{sep}{two}", "%Y %m %d"),
    ]
    clean = r"trim(regexp_replace(regexp_replace(x, '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    parts = [
        f"list_transform(regexp_extract_all({text}, '{p}'), lambda x: try_strptime({clean}, '{f}')::DATE)"
        for p, f in layouts
    ]
    short = rf"regexp_extract_all({text}, '\d{{2}}-{word}-\d{{2}}\s')"
    parts.append(
        f"list_transform({short}, lambda x: try_strptime(regexp_replace({clean}, '(\\d\\d)$', '20\\1'), '%d %b %Y')::DATE)"
    )
    return f"list_sort(list_distinct(list_filter(flatten([{', '.join(parts)}]), lambda d: d IS NOT NULL)))"


def sql_date_text(dates: str) -> str:
    return f"array_to_string(list_transform({dates}, lambda d: cast(d AS varchar)), ',')"


@query("extract_dates", VISIT_CTE + f" SELECT doc_id, {sql_date_text(sql_dates('t'))} AS treatment_dates FROM docs")
def extract_dates(spark, sf):
    found = fields.treatment_dates(visit_docs(spark, sf))
    return found.select("doc_id", F.array_join(F.col("treatment_dates").cast("array<string>"), ",").alias("treatment_dates"))


@query(
    "rule_bulk_treatment",
    VISIT_CTE
    + f""", found AS (SELECT doc_id, len({sql_dates('t')}) AS n FROM docs)
      SELECT doc_id, cast(n AS int) AS treatment_num, n > 2 AND n < 10 AS has_bulk_treatment FROM found""",
)
def rule_bulk_treatment(spark, sf):
    found = fields.bulk_treatment(visit_docs(spark, sf))
    return found.select("doc_id", F.size("treatment_dates").alias("treatment_num"), "has_bulk_treatment")


def sql_phone(text: str) -> str:
    return rf"nullif(regexp_replace(regexp_extract({text}, '[(]?\d{{3}}[)|\-|\s|\.]\s?\d{{3}}[\-|\s|\.]\d{{4}}'), '[^\w\s]| ', '', 'g'), '')"


@query("extract_phone", CLAIM_CTE + f" SELECT doc_id, {sql_phone('t')} AS phone_nbr FROM docs")
def extract_phone(spark, sf):
    return fields.phone(claim_docs(spark, sf)).select("doc_id", "phone_nbr")


@query("extract_phone_prose", f"SELECT doc_id, {sql_phone('lower(text)')} AS phone_nbr FROM documents")
def extract_phone_prose(spark, sf):
    return fields.phone(text_table(spark, sf, "documents"), "text").select("doc_id", "phone_nbr")


def _sql_fax(keyword: str) -> str:
    at = f"strpos(t, '{keyword}')"
    window = f"CASE WHEN {at} - 1 + 30 < len(t) THEN substr(t, {at}, 30) ELSE substr(t, {at}, len(t) - {at}) END"
    return f"CASE WHEN {at} > 0 THEN {sql_phone(window)} END"


@query(
    "extract_fax",
    CLAIM_CTE + f" SELECT doc_id, coalesce({', '.join(_sql_fax(k) for k in V.FAX_KEYWORDS)}) AS fax_nbr FROM docs",
)
def extract_fax(spark, sf):
    return fields.fax(claim_docs(spark, sf)).select("doc_id", "fax_nbr")


SQL_EMAIL_RE = r"([A-Za-z0-9]+[-_])*[A-Za-z0-9]+@[A-Za-z0-9\s-]+(\.\s*[A-Z|a-z]{2,})+"


@query("extract_email", CLAIM_CTE + f" SELECT doc_id, nullif(regexp_extract(t, '{SQL_EMAIL_RE}'), '') AS email_nbr FROM docs")
def extract_email(spark, sf):
    return fields.email(claim_docs(spark, sf)).select("doc_id", "email_nbr")


@query(
    "extract_email_prose",
    f"SELECT doc_id, nullif(regexp_extract(lower(text), '{SQL_EMAIL_RE}'), '') AS email_nbr FROM documents",
)
def extract_email_prose(spark, sf):
    return fields.email(text_table(spark, sf, "documents"), "text").select("doc_id", "email_nbr")
