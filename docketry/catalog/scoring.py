"""Queries for features, scores, levels and their profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import CLAIM_CTE, claim_docs, query
from docketry.catalog.documents import SQL_LABEL_V2, SQL_X
from docketry.catalog.fields import (
    SQL_AMOUNT, SQL_INVOICE, SQL_PAY, SQL_REPEAT, SQL_RISING, SQL_SINGLE, SQL_STRICT, sql_dates,
)
from docketry.functions import fixed_values as V
from docketry.operators import fields, scoring
from docketry.plans import claim_risk
from docketry.session import text_table

# Rule flags of every claim document, and the 0/1 features made of them.
FLAG_CTE = (
    CLAIM_CTE
    + f""", parts AS (SELECT *, replace(t, 'email address', ' ') AS a, {SQL_INVOICE} AS tok, {SQL_AMOUNT} AS payment_amount,
        len({sql_dates('t')}) AS n_dates, {SQL_X} FROM docs),
      flags AS (SELECT doc_id, member_id, payment_amount, {SQL_LABEL_V2} AS page_label, cast(has_stamp AS int) AS has_stamp,
        cast(strpos(t,'cash') > 0 AND strpos(t,'cash') <> strpos(t,'cashier') AND {SQL_PAY} < 2 AS int) AS paid_by_cash,
        cast(strpos(content, '$') = 0 AS int) AS no_dollar_symbol,
        cast(handwritten_percentage > 0.3 AS int) AS above_handwritten_threshold,
        cast(coalesce({SQL_SINGLE} OR {SQL_REPEAT} OR {SQL_RISING}, false) AS int) AS invalid_invoice_nbr,
        cast(handwritten_percentage <= 0.3 AND {SQL_STRICT} AS int) AS invalid_addr,
        cast(n_dates > 2 AND n_dates < 10 AS int) AS has_bulk_treatment,
        cast(coalesce(payment_amount > 200, false) AS int) AS payment_above_200,
        cast(coalesce(payment_amount > 400, false) AS int) AS payment_above_400,
        cast(coalesce(payment_amount > 500, false) AS int) AS payment_above_500 FROM parts)"""
)
_CROSSED = ", ".join(
    f"{f} * {b} AS \"{f}&payment_above\", cast({f} = 1 AND {b} = 0 AS int) AS \"{f}&payment_below\""
    for f, b in V.FLAG_BANDS.items()
)
FEATURE_CTE = FLAG_CTE + f", feats AS (SELECT doc_id, page_label, payment_amount, has_bulk_treatment, {_CROSSED} FROM flags)"


def _sql_score(weights):
    return "round(" + " + ".join(f'"{n}" * cast({w} AS double)' for n, w in weights.items()) + ", 6)"


SCORE_CTE = (
    FEATURE_CTE
    + f""", scores AS (SELECT *, {_sql_score(V.SCORE_WEIGHTS)} AS risk_score FROM feats
        WHERE page_label IN ('paramedical_invoice', 'other_receipt')),
      levels AS (SELECT *, CASE WHEN risk_score >= (SELECT quantile_cont(risk_score, 0.99) FROM scores) THEN 'Must Investigate'
        WHEN risk_score >= (SELECT quantile_cont(risk_score, 0.95) FROM scores) THEN 'Should Investigate'
        ELSE 'Not Suspicious' END AS risk_level FROM scores)"""
)
FEATURE_LIST = ", ".join(f'"{n}"' for n in claim_risk.FEATURES)


@query(
    "feat_payment_bands",
    CLAIM_CTE
    + f""", paid AS (SELECT doc_id, {SQL_AMOUNT} AS amt FROM docs)
      SELECT doc_id, coalesce(amt > 200, false) AS payment_above_200, coalesce(amt > 400, false) AS payment_above_400,
        coalesce(amt > 500, false) AS payment_above_500 FROM paid""",
)
def feat_payment_bands(spark, sf):
    banded = scoring.payment_bands(fields.payment_amount(claim_docs(spark, sf)))
    return banded.select("doc_id", *claim_risk.BAND_FLAGS)


@query(
    "minimum_slice_band_counts",
    """WITH p AS (SELECT strpos(text, '$') = 0 AS no_dollar_symbol, CASE WHEN regexp_matches(lower(text), '[$][\\d{1,3},?]*\\d{1,3}\\.\\d{2}')
        THEN list_max(list_transform(regexp_extract_all(lower(text), '[$][\\d{1,3},?]*\\d{1,3}\\.\\d{2}'), lambda x: try_cast(replace(replace(x, '$', ''), ',', '') AS double)))
        ELSE list_max(list_transform(regexp_extract_all(lower(text), '[\\d{1,3},?]*\\d{1,3}\\.\\d{2}'), lambda x: try_cast(replace(x, ',', '') AS double))) END AS amt FROM documents)
      SELECT no_dollar_symbol, coalesce(amt > 200, false) AS payment_above_200, coalesce(amt > 500, false) AS payment_above_500, count(*) AS n
      FROM p GROUP BY ALL""",
)
def minimum_slice_band_counts(spark, sf):
    docs = text_table(spark, sf, "documents").select(F.col("text").alias("content"))
    banded = scoring.payment_bands(fields.payment_amount(fields.no_dollar_symbol(docs)), bands=(200, 500))
    return banded.groupBy("no_dollar_symbol", "payment_above_200", "payment_above_500").agg(F.count(F.lit(1)).alias("n"))


@query("feat_invalid_addr_gate", FLAG_CTE + " SELECT doc_id, invalid_addr = 1 AS invalid_addr FROM flags")
def feat_invalid_addr_gate(spark, sf):
    return scoring.gate_address(fields.invalid_address(claim_docs(spark, sf))).select("doc_id", "invalid_addr")


@query("feat_interactions", FEATURE_CTE + f" SELECT doc_id, {FEATURE_LIST} FROM feats")
def feat_interactions(spark, sf):
    return claim_risk.features(claim_docs(spark, sf)).drop("payment_amount")


@query(
    "score_weighted",
    FEATURE_CTE
    + f""" SELECT doc_id, {_sql_score(V.SCORE_WEIGHTS)} AS risk_score,
        {_sql_score(V.SCORE_WEIGHTS | V.BULK_WEIGHT)} AS risk_score_13 FROM feats""",
)
def score_weighted(spark, sf):
    feats = claim_risk.features(claim_docs(spark, sf))
    both = scoring.weighted_score(scoring.weighted_score(feats), V.SCORE_WEIGHTS | V.BULK_WEIGHT, into="risk_score_13")
    return both.select("doc_id", "risk_score", "risk_score_13")


@query("risk_level", SCORE_CTE + " SELECT doc_id, risk_score, risk_level FROM levels")
def risk_level(spark, sf):
    return claim_risk.scored(claim_docs(spark, sf)).select("doc_id", "risk_score", "risk_level")


@query(
    "rank_top_n",
    SCORE_CTE + " SELECT doc_id, payment_amount, risk_score, risk_level FROM levels ORDER BY risk_score DESC, doc_id LIMIT 50",
)
def rank_top_n(spark, sf):
    return claim_risk.top_risks(claim_docs(spark, sf))


@query(
    "filter_high_payment",
    SCORE_CTE + " SELECT doc_id, payment_amount, risk_score FROM scores WHERE payment_amount > 300",
)
def filter_high_payment(spark, sf):
    scored = claim_risk.scored(claim_docs(spark, sf))
    return scoring.high_payment(scored).select("doc_id", "payment_amount", "risk_score")


@query(
    "flag_profile",
    FLAG_CTE
    + ", f AS (UNPIVOT (SELECT "
    + ", ".join(claim_risk.BASE_FLAGS)
    + " FROM flags) ON COLUMNS(*) INTO NAME flag VALUE value) SELECT flag, value, count(*) AS n FROM f GROUP BY flag, value",
)
def flag_profile(spark, sf):
    flags = scoring.flags_to_int(claim_risk.rule_flags(claim_docs(spark, sf)), claim_risk.BASE_FLAGS)
    return scoring.flag_profile(flags, claim_risk.BASE_FLAGS)


@query("risk_level_profile", SCORE_CTE + " SELECT risk_level, count(*) AS n FROM levels GROUP BY risk_level")
def risk_level_profile(spark, sf):
    return claim_risk.scored(claim_docs(spark, sf)).groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flag_correlation",
    FLAG_CTE
    + " "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS flag_a, '{b}' AS flag_b, CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN round(corr({a}, {b}), 6) END AS corr FROM flags"
        for a in claim_risk.BASE_FLAGS
        for b in claim_risk.BASE_FLAGS
    ),
)
def flag_correlation(spark, sf):
    flags = scoring.flags_to_int(claim_risk.rule_flags(claim_docs(spark, sf)), claim_risk.BASE_FLAGS)
    return scoring.flag_correlation(flags, claim_risk.BASE_FLAGS)


@query(
    "rules_true_count",
    FLAG_CTE
    + """, c AS (SELECT doc_id, has_stamp + paid_by_cash + no_dollar_symbol + above_handwritten_threshold + invalid_invoice_nbr
        + invalid_addr + has_bulk_treatment AS true_count FROM flags)
      SELECT doc_id, true_count FROM c WHERE true_count > 2""",
)
def rules_true_count(spark, sf):
    flags = claim_risk.rule_flags(claim_docs(spark, sf))
    return fields.true_count(flags, claim_risk.BASE_FLAGS).filter("true_count > 2").select("doc_id", "true_count")
