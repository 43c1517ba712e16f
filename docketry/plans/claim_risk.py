"""Claim documents to a ranked risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions import fixed_values as V
from docketry.operators import documents, fields, scoring
from docketry.session import stage

SCORED_LABELS = ["paramedical_invoice", "other_receipt"]
BASE_FLAGS = [
    "has_stamp", "paid_by_cash", "no_dollar_symbol", "above_handwritten_threshold",
    "invalid_invoice_nbr", "invalid_addr", "has_bulk_treatment",
]
BAND_FLAGS = ["payment_above_200", "payment_above_400", "payment_above_500"]
FEATURES = list(V.SCORE_WEIGHTS) + ["has_bulk_treatment"]


def rule_flags(docs: DataFrame, key: str = "doc_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """Key, amount and every rule flag; the text is dropped before anything downstream."""
    df = docs
    for rule in (
        fields.paid_by_cash, fields.no_dollar_symbol, fields.above_handwritten, fields.invoice_number,
        fields.payment_amount, fields.invalid_address, fields.bulk_treatment,
    ):
        df = rule(df)
    df = scoring.gate_address(scoring.payment_bands(df))
    return df.select(key, *extra, "payment_amount", *BASE_FLAGS, *BAND_FLAGS)


def features(docs: DataFrame, key: str = "doc_id", extra: tuple[str, ...] = ()) -> DataFrame:
    flags = scoring.flags_to_int(rule_flags(docs, key, extra), BASE_FLAGS + BAND_FLAGS)
    return scoring.interactions(flags, keep=(key, *extra, "payment_amount", "has_bulk_treatment"))


def scored(docs: DataFrame, key: str = "doc_id", labels: list[str] | None = None) -> DataFrame:
    """Receipts and invoices with their score and level.

    The quantiles and the ranking both read the scores. The scored flags are staged as a
    narrow table, so that the documents are read and parsed once.
    """
    labelled = documents.label_v2(docs).filter(F.col("page_label").isin(labels or SCORED_LABELS))
    return scoring.risk_level(stage(scoring.weighted_score(features(labelled, key)), "scored"))


def top_risks(docs: DataFrame, key: str = "doc_id", n: int = 50) -> DataFrame:
    ranked = scoring.rank_top_n(scored(docs, key), "risk_score", key, n)
    return ranked.select(key, "payment_amount", "risk_score", "risk_level")
