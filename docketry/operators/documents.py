"""Document text: OCR records, handwriting share, stamps and page labels.

Every operator adds columns to the document table; the text never leaves the row, so
nothing here shuffles except the stamp join on file name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import fixed_values as V
from docketry.functions.dates import date_matches, dates_in
from docketry.functions.text import any_word, bind, mode_first, occurrences, strip_punctuation, word_hits

STYLES_TYPE = "array<struct<spans:array<struct<offset:int,length:int>>>>"
OCR_SCHEMA = (
    "response struct<content:string,"
    "pages:array<struct<words:array<struct<content:string,confidence:double>>>>,"
    f"styles:{STYLES_TYPE}>"
)


def flatten_newlines(content: Column) -> Column:
    return F.replace(content, F.lit("\n"), F.lit(" "))


def label_clean(content: Column) -> Column:
    """Lower case, punctuation dropped, blanks collapsed."""
    return strip_punctuation(F.lower(content))


def last_confidence(words: Column) -> Column:
    """Word list to map word -> confidence; of repeated words the last one counts.

    Sorting by (word, position) makes this linear-log in the page, and needs no session
    setting for duplicate map keys.
    """
    placed = F.array_sort(
        F.transform(words, lambda w, i: F.struct(w["content"].alias("w"), i.alias("i"), w["confidence"].alias("c")))
    )
    kept = bind(placed, lambda a: F.filter(a, lambda x, i: F.coalesce(F.get(a, i + 1)["w"] != x["w"], F.lit(True))))
    return F.map_from_entries(F.transform(kept, lambda x: F.struct(x["w"], x["c"])))


def read_ocr_json(df: DataFrame, json_col: str) -> DataFrame:
    """OCR result JSON -> content, word_confidence, styles; null for an error response."""
    parsed = df.withColumn("_ocr", F.from_json(F.col(json_col), OCR_SCHEMA)["response"])
    return parsed.withColumns(
        {
            "content": flatten_newlines(F.col("_ocr.content")),
            "word_confidence": last_confidence(
                F.flatten(F.transform(F.col("_ocr.pages"), lambda p: p["words"]))
            ),
            "styles": F.col("_ocr.styles"),
        }
    ).drop("_ocr")


def first_words(words: Column, n: int = 5) -> Column:
    """First n distinct words, lower case without punctuation."""
    plain = F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"(?U)[^\w\s]", ""))
    return F.slice(F.array_distinct(plain), 1, n)


def handwritten_share(styles: Column, content: Column) -> Column:
    """Share of the text that style spans cover, 3 decimals; 0 without styles or text."""
    spans = F.flatten(F.transform(styles, lambda s: s["spans"]))
    covered = F.aggregate(spans, F.lit(0).cast("bigint"), lambda acc, s: acc + s["length"])
    return F.coalesce(
        F.when(F.length(content) > 0, F.round(covered / F.length(content), 3)), F.lit(0.0)
    )


def stamp_key(name: Column) -> Column:
    return F.translate(name, "-_", "")


def flag_stamps(
    docs: DataFrame, stamped: DataFrame, name_col: str = "obj_id", excluded_terms: Sequence[str] = ()
) -> DataFrame:
    """has_stamp: the file is in the stamped list and its text names no excluded merchant.

    The list is joined, not shipped in a closure; whether it is broadcast is left to the
    optimizer, which knows its size.
    """
    names = stamped.select(stamp_key(F.col(name_col)).alias("_stamp_key")).distinct().withColumn("_hit", F.lit(True))
    joined = docs.withColumn("_stamp_key", stamp_key(F.col(name_col))).join(names, "_stamp_key", "left")
    flagged = joined.withColumn(
        "has_stamp",
        F.coalesce(F.col("_hit"), F.lit(False))
        & F.col("content").isNotNull()
        & ~F.coalesce(any_word(F.lower("content"), excluded_terms), F.lit(False)),
    )
    return flagged.drop("_stamp_key", "_hit")


def override_stamps(docs: DataFrame, confirmed: DataFrame, key: str) -> DataFrame:
    """has_stamp is true for every confirmed key, and unchanged otherwise."""
    marks = confirmed.select(key).distinct().withColumn("_confirmed", F.lit(True))
    return (
        docs.join(marks, key, "left")
        .withColumn("has_stamp", F.coalesce("_confirmed", "has_stamp"))
        .drop("_confirmed")
    )


def exclude_stamps(has_stamp: Column, content: Column, excluded_terms: Sequence[str]) -> Column:
    """has_stamp is false where the text names an excluded merchant."""
    return F.when(any_word(F.lower(content), excluded_terms), F.lit(False)).otherwise(has_stamp)


def label_simple(df: DataFrame, content: str = "content", into: str = "page_label") -> DataFrame:
    """One keyword list per label, first match wins."""

    def label(t: Column) -> Column:
        return (
            F.when(t.contains("claim page one"), "claim_page_one")
            .when(t.contains("claim page two"), "claim_page_two")
            .when(any_word(t, V.DRUG_MARKS), "drug_receipt")
            .when(any_word(t, V.THERAPY_WORDS), "paramedical_invoice")
            .when(any_word(t, V.RECEIPT_WORDS), "other_receipt")
            .otherwise("other_doc")
        )

    return df.withColumn(into, bind(F.lower(content), label))


def label_v1(
    df: DataFrame,
    content: str = "content",
    into: str = "page_label",
    drug_store_terms: Sequence[str] = (),
    insurer_terms: Sequence[str] = (),
) -> DataFrame:
    """Seven-way cascade on cleaned text."""

    def label(t: Column) -> Column:
        form = any_word(t, [*V.CLAIM_FORM_PHRASES, *insurer_terms])
        store_receipt = any_word(t, drug_store_terms) & any_word(t, ["prescription receipt", "patient pays"])
        return (
            F.when(form & any_word(t, V.CLAIM_ONE_MARKS), "claim_page_one")
            .when(word_hits(t, V.CLAIM_TWO_MARKS) >= 2, "claim_page_two")
            .when(store_receipt, "drug_receipt")
            .when(any_word(t, V.DRUG_MARKS) & any_word(t, [" din", " rx"]), "drug_receipt")
            .when(any_word(t, V.THERAPY_WORDS) & any_word(t, V.BILLING_WORDS), "paramedical_invoice")
            .when(any_word(t, V.RECEIPT_WORDS) & t.contains("date") & ~t.contains("claim"), "other_receipt")
            .otherwise("other_doc")
        )

    return df.withColumn(into, bind(label_clean(F.col(content)), label))


def label_v2(
    df: DataFrame,
    content: str = "content",
    into: str = "page_label",
    insurer_terms: Sequence[str] = (),
    insurer_form_terms: Sequence[str] = (),
    alt_form_terms: Sequence[str] = (),
) -> DataFrame:
    """Keyword-count cascade; null text is an other_doc.

    A claim form with too few fields falls through. The amount of a drug receipt is looked
    for in the text that still has its punctuation.
    """

    def label(raw: Column, t: Column) -> Column:
        form = any_word(t, [*V.CLAIM_FORM_PHRASES_SHORT, *insurer_form_terms])
        page_one = F.when(form, word_hits(t, [*V.CLAIM_ONE_FIELDS, *insurer_terms]) > 5).otherwise(
            any_word(t, alt_form_terms) & (word_hits(t, V.ALT_FORM_FIELDS) > 3)
        )
        receipt = any_word(t, V.RECEIPT_WORDS) & any_word(t, V.RECEIPT_DETAIL_WORDS)
        drug = t.contains(V.OFFICIAL_RECEIPT) | (
            (word_hits(t, V.DRUG_WORDS) > 3) & ~t.contains("claim") & raw.rlike(V.ANY_AMOUNT)
        )
        return (
            F.when(page_one, "claim_page_one")
            .when(word_hits(t, [*V.CLAIM_TWO_FIELDS, *insurer_form_terms]) >= 2, "claim_page_two")
            .when(any_word(t, V.THERAPY_WORDS) & any_word(t, V.BILLING_WORDS), "paramedical_invoice")
            .when(receipt & ~any_word(t, V.RECEIPT_EXCLUSIONS), "other_receipt")
            .when(drug, "drug_receipt")
            .otherwise("other_doc")
        )

    plain = lambda raw: F.regexp_replace(raw, r"(?U)[^\w\s]", "")
    found = bind(F.lower(content), lambda raw: bind(plain(raw), lambda t: label(raw, t)))
    return df.withColumn(into, found)


def _verdict(label: str, confidence: Column | float) -> Column:
    c = confidence if isinstance(confidence, Column) else F.lit(float(confidence))
    return F.struct(F.lit(label).alias("label"), c.cast("double").alias("confidence"))


def _page_one(fields: Column) -> Column:
    return F.least(fields, F.lit(10)) / F.lit(10.0)


def _page_two(marks: Column) -> Column:
    return F.when(marks > 5, F.lit(1.0)).otherwise((marks + 4) / F.lit(10.0))


def classify_v1(
    df: DataFrame,
    content: str = "content",
    into: str = "doc_class",
    insurer_terms: Sequence[str] = (),
    insurer_form_terms: Sequence[str] = (),
) -> DataFrame:
    """struct<label, confidence> over five classes."""

    def evidence(t: Column) -> Column:
        return F.struct(
            any_word(t, [*V.CLAIM_FORM_PHRASES_SHORT, *insurer_form_terms]).alias("form"),
            word_hits(t, [*V.CLAIM_ONE_FIELDS, *insurer_terms]).alias("one"),
            word_hits(t, [*V.CLAIM_TWO_FIELDS, *insurer_form_terms]).alias("two"),
            word_hits(t, V.DRUG_WORDS).alias("drug"),
            t.contains("claim").alias("claim"),
            t.contains(V.OFFICIAL_RECEIPT).alias("official"),
            (any_word(t, V.RECEIPT_WORDS) & t.contains("date")).alias("receipt"),
        )

    def verdict(e: Column) -> Column:
        return (
            F.when(e["form"] & (e["one"] > 5), _verdict("claim_page_one", _page_one(e["one"])))
            .when(e["two"] > 2, _verdict("claim_page_two", _page_two(e["two"])))
            .when(e["official"] | ((e["drug"] > 6) & ~e["claim"]), _verdict("drug_receipt", 1))
            .when((e["drug"] > 3) & ~e["claim"], _verdict("drug_receipt", (e["drug"] * 15 + 5) / F.lit(100.0)))
            .when(e["receipt"] & ~e["claim"], _verdict("other_receipt", 1))
            .otherwise(_verdict("other_doc", 1))
        )

    text = strip_punctuation(F.lower(content), by=" ")
    return df.withColumn(into, bind(bind(text, evidence), verdict))


def classify_v2(
    df: DataFrame,
    content: str = "content",
    into: str = "doc_class",
    insurer_terms: Sequence[str] = (),
    insurer_form_terms: Sequence[str] = (),
    alt_form_terms: Sequence[str] = (),
) -> DataFrame:
    """struct<label, confidence> over seven classes, with contact, date and amount evidence."""

    def evidence(raw: Column, t: Column) -> Column:
        return F.struct(
            any_word(t, [*V.CLAIM_FORM_PHRASES_SHORT, *insurer_form_terms]).alias("form"),
            word_hits(raw, [*V.CLAIM_ONE_FIELDS_WIDE, *insurer_terms]).alias("one"),
            F.when(any_word(t, alt_form_terms), word_hits(t, V.ALT_FORM_FIELDS)).otherwise(0).alias("alt"),
            word_hits(raw, [*V.CLAIM_TWO_FIELDS, *insurer_form_terms]).alias("two"),
            word_hits(t, V.DRUG_WORDS_WIDE).alias("drug"),
            (any_word(t, V.DRUG_GATE_WORDS) & ~t.contains("customer copy")).alias("drug_gate"),
            (any_word(t, V.AMOUNT_WORDS) & raw.rlike(V.ANY_AMOUNT)).alias("paid"),
            raw.rlike(V.ANY_AMOUNT).alias("amount"),
            t.rlike(V.PHONE_PATTERN).alias("phone"),
            (raw.contains("@") & raw.rlike(V.EMAIL_PATTERN)).alias("email"),
            (F.size(dates_in(raw, V.DATE_FORMATS_WIDE)) > 0).alias("date"),
            any_word(t, V.HEALTH_RECEIPT_WORDS).alias("receiptish"),
            any_word(t, V.REFERRAL_WORDS).alias("therapy"),
        )

    def verdict(raw: Column, t: Column, e: Column) -> Column:
        drug_plain = e["drug_gate"] & ~t.contains("claim") & e["amount"]
        no_claim = ~t.contains(" claim ")
        known = F.when(e["date"] & e["email"], 1.0).when(e["date"] | e["email"], 0.7).otherwise(0.6)
        health = (
            e["receiptish"]
            & (e["date"] | e["phone"] | e["email"])
            & ~t.contains("customer copy")
            & ~any_word(t, V.HEALTH_DRUG_EXCLUSIONS)
            & no_claim
        )
        therapy_bill = e["therapy"] & any_word(t, V.RECEIPT_WORDS) & raw.contains("$")
        return (
            F.when(e["form"] & (e["one"] > 5), _verdict("claim_page_one", _page_one(e["one"])))
            .when(e["alt"] >= 3, _verdict("claim_page_one", F.least(e["alt"] / F.lit(5.0), F.lit(1.0))))
            .when(e["two"] > 2, _verdict("claim_page_two", _page_two(e["two"])))
            .when(e["drug_gate"] & t.contains(V.OFFICIAL_RECEIPT), _verdict("drug_receipt", 1))
            .when(drug_plain & (e["drug"] > 6), _verdict("drug_receipt", 1))
            .when(drug_plain & (e["drug"] > 4), _verdict("drug_receipt", (e["drug"] * 2 - 3) / F.lit(10.0)))
            .when(e["paid"] & t.contains("invoice"), _verdict("health_receipt", known))
            .when(e["paid"] & health, _verdict("health_receipt", 1))
            .when(e["paid"] & e["receiptish"] & no_claim, _verdict("other_receipt", 1))
            .when(therapy_bill, _verdict("health_receipt", 0.7))
            .when(e["therapy"] & raw.contains("dr."), _verdict("physician_referral", 1))
            .otherwise(_verdict("supporting_doc", 1))
        )

    def classify(raw: Column) -> Column:
        text = strip_punctuation(raw, by=" ", keep=r"\.")
        return bind(text, lambda t: bind(evidence(raw, t), lambda e: verdict(raw, t, e)))

    return df.withColumn(into, bind(F.lower(flatten_newlines(F.col(content))), classify))


def count_receipts(df: DataFrame, content: str = "content", into: str = "receipt_count") -> DataFrame:
    """How many receipts a page holds: the most frequent of four word and date counts."""

    def counts(t: Column) -> Column:
        return F.array(
            occurrences(t, "din"),
            date_matches(t, V.DATE_FORMATS[:2]),
            occurrences(t, "pays") + occurrences(t, "no charge"),
            occurrences(t, "total"),
        )

    text = strip_punctuation(F.lower(content), by=" ")
    return df.withColumn(into, bind(bind(text, counts), lambda a: mode_first([a[i] for i in range(4)])))
