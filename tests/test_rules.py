"""Field rules against small worked cases, and against plain-Python versions on random texts."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from rows import values
from plain_rules import amount, bad_address, dates, email_in, fax_in, made_up, paid_by_cash, phone_in, token_after
from docketry.catalog.base import claim_docs
from docketry.functions import fixed_values as V
from docketry.operators import documents, fields, scoring

PIECES = [
    "cash ", "cashier ", "visa ", "paid ", "$", "12.50 ", "1,234.56 ", "$3,000.00", "invoice # ", "invoice number ", "invoice# 76190 ",
    "77777 ", "a1234b ", "7 ", "date ", "reg # 5#8 ", "register no:58293 ", "address ", "email address ", "main street ", "ontario ", "m5v 2t6 ",
    " k1a0b6 ", "fax: ", "f: ", "416-555-0100 ", "(905) 555 0101", "jo_x@site.ca ", "a@b c. d ", "jan 5 2023 ", "sept 9, 2023 ", "3 feb 2024 ",
    "07/15/2023 ", "02/30/2023 ", "2023/01/09 ", "05-mar-24 ", "word ", "ab ", "\n", ". ", "dr ", "xjan 5 2023 ", "é ", "x" * 30 + " ",
]


def random_texts(n=400):
    rng = random.Random(11)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def random_docs(spark):
    rows = [(i, t) for i, t in enumerate(random_texts())]
    return spark.createDataFrame(rows, "id int, content string").cache()


@pytest.mark.parametrize(
    "rule, column, plain",
    [
        (fields.paid_by_cash, "paid_by_cash", paid_by_cash),
        (fields.invoice_number, "possible_invoice_nbr", lambda t: token_after(t, V.INVOICE_KEYWORDS, "date")),
        (fields.invoice_number, "invalid_invoice_nbr", lambda t: made_up(token_after(t, V.INVOICE_KEYWORDS, "date"))),
        (fields.payment_amount, "payment_amount", amount),
        (fields.invalid_address, "has_invalid_addr", bad_address),
        (fields.treatment_dates, "treatment_dates", dates),
        (fields.phone, "phone_nbr", phone_in),
        (fields.fax, "fax_nbr", fax_in),
        (fields.email, "email_nbr", email_in),
    ],
)
def test_rule_equals_plain_python(random_docs, rule, column, plain):
    got = values(rule(random_docs), column)
    want = [plain(t.lower()) for t in random_texts()]
    assert got == want


def test_register_equals_plain_python(random_docs):
    got = values(fields.register_number(random_docs), "register_num")
    want = [token_after(re.sub("[.,:]", " ", t.lower()), V.REGISTER_KEYWORDS) for t in random_texts()]
    assert got == [w and w.replace("#", "") for w in want]


def case(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


def test_worked_cases(spark):
    cash = case(spark, "paid with cash of 2000.00", "paid with credit card", "paid with debit card")
    assert values(fields.paid_by_cash(cash), "paid_by_cash") == [True, False, False]
    assert values(fields.paid_by_cash_strict(cash), "paid_by_cash") == [True, False, False]
    assert values(fields.no_dollar_symbol(case(spark, "total $3000.00", "3000.00", "none")), "no_dollar_symbol") == [False, True, True]
    assert values(fields.register_number(case(spark, "register no:58293", "x", "y")), "register_num") == ["58293", None, None]
    assert values(fields.payment_amount(case(spark, "$2500.00", "none", "$0.00 and 9.99")), "payment_amount") == [2500.0, None, 0.0]
    invoice = fields.invoice_number(case(spark, "invoice# 76190", "invoice # 1234"))
    assert values(invoice, "possible_invoice_nbr", "invalid_invoice_nbr") == [("76190", False), ("1234", True)]
    share = spark.createDataFrame([(0, 30.32), (1, 10.2), (2, 27.9)], "id int, handwritten_percentage double")
    assert values(fields.above_handwritten(share, 15), "above_handwritten_threshold") == [True, False, True]


def test_null_text_gives_no_finding(spark):
    docs = spark.createDataFrame([(0, None)], "id int, content string")
    assert values(fields.payment_amount(docs), "payment_amount") == [None]
    assert values(fields.invoice_number(docs), "possible_invoice_nbr", "invalid_invoice_nbr") == [(None, False)]
    assert values(documents.label_v2(docs), "page_label") == ["other_doc"]


def test_filter_on_a_flag_keeps_the_plan_small(spark, sf):
    """A pushed-down filter must not write the lowered text out once per keyword."""
    flagged = documents.label_v2(spark.read.text(sf).select(F.col("value").alias("content"))).filter("page_label = 'other_doc'")
    assert flagged._jdf.queryExecution().optimizedPlan().toString().count("lower(") <= 3


def test_claim_document_counts(spark):
    """Counts known from an independent run over the 15 000 claim documents."""
    docs = claim_docs(spark, "/root/testdata/sf0.01")
    df = docs
    for rule in (fields.paid_by_cash, fields.no_dollar_symbol, fields.invoice_number, fields.payment_amount, fields.invalid_address,
                 fields.register_number, fields.phone, fields.fax, fields.email):
        df = rule(df)
    df = scoring.payment_bands(df)
    row = df.agg(
        F.count_if("paid_by_cash").alias("cash"), F.count_if("no_dollar_symbol").alias("dollar"),
        F.count_if("invalid_invoice_nbr").alias("invalid"), F.count("possible_invoice_nbr").alias("numbered"),
        F.count_if(F.col("payment_amount").isNull()).alias("unpaid"), F.count_if("payment_above_200").alias("b200"),
        F.count_if("payment_above_400").alias("b400"), F.count_if("payment_above_500").alias("b500"),
        F.count_if("has_invalid_addr").alias("addr"), F.count("register_num").alias("reg"), F.count("phone_nbr").alias("phone"),
        F.count("fax_nbr").alias("fax"),
    ).first().asDict()
    assert row == {
        "cash": 6000, "dollar": 7500, "invalid": 6437, "numbered": 6437 + 4277, "unpaid": 3750, "b200": 9576, "b400": 7830, "b500": 6984,
        "addr": 5500, "reg": 3750, "phone": 3334, "fax": 3334,
    }
    labels = {r.page_label: r["count"] for r in documents.label_v2(docs).groupBy("page_label").count().collect()}
    assert labels == {
        "other_receipt": 7929, "paramedical_invoice": 3000, "claim_page_one": 1500, "claim_page_two": 1500, "other_doc": 857,
        "drug_receipt": 214,
    }


def test_codes_near_the_ends_and_in_the_middle(spark):
    code, place = " m5v 2t6 ", "12 main street toronto ontario"
    cases = {
        f"{place}{code}": False,
        f"{code}{place}": True,  # the place comes after all that is looked at
        f"{place}{code}{'x' * 90}": False,
        f"{place}{'x' * 90}{code}{'x' * 90}": True,  # too far before
        f"{'x' * 90}{place}{code}{'x' * 90}": False,
        f"{'x' * 90}{place}{'x' * 90}{code}": False,  # at the end everything before counts
        f"{'x' * 90}{code}{place}": True,
        "address unknown": True,
        f"address {place}{code}": False,
        "email address jo@site.ca": False,
        "": False,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "id int, content string")
    got = {r.id: r.has_invalid_addr for r in fields.invalid_address(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values()) == [bad_address(t) for t in cases]
