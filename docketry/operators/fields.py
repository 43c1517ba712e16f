"""Typed fields and fraud flags out of document text, as native column expressions.

Each operator takes the document table and returns it with its result columns; the input
text is never changed. The lower-cased text is bound once per rule, so that a chain of
keyword tests does not lower it again, even after a filter on the flag is pushed down.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import fixed_values as V
from docketry.functions.dates import dates_in
from docketry.functions.text import any_of, bind, digits_of, first_digit_token, first_match, window_after, word_hits


def paid_by_cash(df: DataFrame, content: str = "content") -> DataFrame:
    """The first "cash" is not the start of the first "cashier", and no second payment word."""

    def flag(t: Column) -> Column:
        at_cashier = F.instr(t, "cash") == F.instr(t, "cashier")
        return t.contains("cash") & ~at_cashier & (word_hits(t, V.PAYMENT_WORDS) < 2)

    return df.withColumn("paid_by_cash", bind(F.lower(content), flag))


def paid_by_cash_strict(df: DataFrame, content: str = "content") -> DataFrame:
    """As paid_by_cash, but any "cashier" rules the document out."""

    def flag(t: Column) -> Column:
        return t.contains("cash") & ~t.contains("cashier") & (word_hits(t, V.PAYMENT_WORDS) < 2)

    return df.withColumn("paid_by_cash", bind(F.lower(content), flag))


def no_dollar_symbol(df: DataFrame, content: str = "content") -> DataFrame:
    return df.withColumn("no_dollar_symbol", ~F.col(content).contains("$"))


def above_handwritten(df: DataFrame, threshold: float = 0.3, share: str = "handwritten_percentage") -> DataFrame:
    return df.withColumn(
        "above_handwritten_threshold", F.coalesce(F.col(share) > threshold, F.lit(False))
    )


def is_single_digit(token: Column) -> Column:
    return token.rlike("^[0-9]$")


def has_repeated_group(token: Column) -> Column:
    """A group of non-zero digits written four or more times in a row."""
    return token.rlike(r"([1-9]+)\1\1\1+")


def has_consecutive_digits(token: Column) -> Column:
    """Cut into non-overlapping four-digit chunks, one of them counts upwards."""
    chunks = F.regexp_extract_all(token, F.lit("[0-9]{4}"), F.lit(0))
    return F.exists(chunks, lambda c: F.lit("0123456789").contains(c))


def made_up_number(token: Column) -> Column:
    """Single digit, repeated group or digits that count upwards; false without a token."""
    return bind(
        token,
        lambda x: F.coalesce(is_single_digit(x) | has_repeated_group(x) | has_consecutive_digits(x), F.lit(False)),
    )


def invoice_token(content: Column) -> Column:
    """First token with a digit in the window of the first invoice keyword that has one."""

    def found(t: Column) -> Column:
        windows = [F.substring_index(window_after(t, k, V.KEYWORD_WINDOW), "date", 1) for k in V.INVOICE_KEYWORDS]
        return F.when(t.contains("invoice"), F.coalesce(*[first_digit_token(w) for w in windows]))

    return bind(F.lower(content), found)


def invoice_number(df: DataFrame, content: str = "content") -> DataFrame:
    """possible_invoice_nbr after an invoice keyword, and whether it is made up."""
    return df.withColumn("possible_invoice_nbr", invoice_token(F.col(content))).withColumn(
        "invalid_invoice_nbr", made_up_number(F.col("possible_invoice_nbr"))
    )


def invoice_pattern(df: DataFrame, content: str = "content") -> DataFrame:
    """Alternative: the first token with a digit right after an invoice keyword, by one pattern."""
    pattern = r"(?:invoice number|invoice num|invoice #|invoice#)[\s:]*([a-z-]*[0-9][^\s]*)"
    return df.withColumn(
        "invoice_pattern_nbr", F.nullif(F.regexp_extract(F.lower(content), pattern, 1), F.lit(""))
    )


def _largest(amounts: Column) -> Column:
    return F.array_max(F.transform(amounts, lambda a: F.translate(a, "$,", "").try_cast("double")))


def payment_amount(df: DataFrame, content: str = "content") -> DataFrame:
    """Largest amount with a dollar sign; without any, the largest bare amount; else null."""

    def amount(t: Column) -> Column:
        bare = F.regexp_extract_all(t, F.lit(V.BARE_AMOUNT), F.lit(0))
        dollars = F.when(t.contains("$"), F.regexp_extract_all(t, F.lit(V.DOLLAR_AMOUNT), F.lit(0)))
        found = bind(dollars, lambda d: F.when(F.size(d) > 0, _largest(d)).otherwise(_largest(bare)))
        return F.when(t.contains("."), found)

    return df.withColumn("payment_amount", bind(F.lower(content), amount))


def register_number(df: DataFrame, content: str = "content") -> DataFrame:
    """Token with a digit after the first register keyword that has one, without '#'."""

    def found(t: Column) -> Column:
        tokens = [first_digit_token(window_after(t, k, V.KEYWORD_WINDOW)) for k in V.REGISTER_KEYWORDS]
        return F.when(t.contains("reg"), F.coalesce(*tokens))

    token = bind(F.regexp_replace(F.lower(content), "[.,:]", " "), found)
    return df.withColumn("register_num", F.translate(token, "#", ""))


def _bad_address(t: Column) -> Column:
    roads, provinces = any_of(V.ROAD_WORDS), any_of(V.PROVINCE_WORDS)
    placed = lambda w: w.rlike(roads) & w.rlike(provinces)
    # The look-ahead keeps the rest of a window free for the next "address" in it.
    windows = F.regexp_extract_all(t, F.lit(rf"(?s)address(?=(.{{0,{V.ADDRESS_WINDOW - 7}}}))"), F.lit(1))
    good = lambda w: w.rlike(V.POSTAL_IN_WINDOW) & placed(w)
    bad_window = F.exists(windows, lambda rest: ~bind(F.concat(F.lit("address"), rest), good))

    # Ends of the stand-alone postal codes, from the lengths of the gaps before each code.
    codes = F.regexp_extract_all(t, F.lit(V.POSTAL_STANDALONE), F.lit(0))
    steps = F.zip_with(F.split(t, V.POSTAL_STANDALONE), codes, lambda gap, code: F.length(gap) + F.length(code))
    n = F.length(t)

    def check(state: Column, step: Column) -> Column:
        end = state["end"] + step
        around = F.when(
            (end > V.ADDRESS_WINDOW) & (end + 5 < n),
            F.substring(t, end - V.ADDRESS_WINDOW + 1, F.lit(V.ADDRESS_WINDOW + 5)),
        ).otherwise(F.substring(t, F.lit(1), end + 1))
        return F.struct(end.alias("end"), (state["bad"] | ~placed(around)).alias("bad"))

    start = F.struct(F.lit(0).alias("end"), F.lit(False).alias("bad"))
    # The text after the last code has no code of its own: its step is null and is left out.
    bad_code = F.aggregate(F.array_compact(steps), start, check)["bad"]
    return bad_window | (t.rlike(V.POSTAL_STANDALONE) & bad_code)


def invalid_address(df: DataFrame, content: str = "content") -> DataFrame:
    """Strict address test.

    Every window that starts at "address" must hold a postal code, a road word and a
    province word; every stand-alone postal code must have a road and a province word in
    the window around it. Windows stay inside the row: nothing is exploded.
    """
    text = F.replace(F.lower(content), F.lit("email address"), F.lit(" "))
    return df.withColumn("has_invalid_addr", bind(text, _bad_address))


def invalid_address_simple(df: DataFrame, content: str = "content") -> DataFrame:
    """No postal code anywhere."""
    return df.withColumn("has_invalid_addr", ~F.lower(content).rlike(V.POSTAL_IN_WINDOW))


def treatment_dates(df: DataFrame, content: str = "content") -> DataFrame:
    return df.withColumn("treatment_dates", dates_in(F.lower(content)))


def bulk_treatment(df: DataFrame, content: str = "content") -> DataFrame:
    """More than two and fewer than ten distinct dates."""
    flag = bind(F.size("treatment_dates"), lambda n: (n > 2) & (n < 10))
    return treatment_dates(df, content).withColumn("has_bulk_treatment", flag)


def phone(df: DataFrame, content: str = "content") -> DataFrame:
    return df.withColumn("phone_nbr", digits_of(first_match(F.lower(content), V.PHONE_PATTERN)))


def fax(df: DataFrame, content: str = "content") -> DataFrame:
    """Phone pattern in the window after the first fax keyword that has one.

    At the end of the text the window stops one character short.
    """

    def after(t: Column, keyword: str) -> Column:
        at, n = F.instr(t, keyword), F.length(t)
        size = F.when(at + (V.FAX_WINDOW - 1) < n, F.lit(V.FAX_WINDOW)).otherwise(n - at)
        window = F.when(at > 0, F.substring(t, at, size))
        return digits_of(first_match(window, V.PHONE_PATTERN))

    found = bind(F.lower(content), lambda t: F.coalesce(*[after(t, k) for k in V.FAX_KEYWORDS]))
    return df.withColumn("fax_nbr", found)


def email(df: DataFrame, content: str = "content") -> DataFrame:
    """First e-mail address; only texts with an at sign reach the pattern."""
    found = bind(
        F.lower(content),
        lambda t: F.when(t.contains("@"), first_match(t, V.EMAIL_PATTERN)),
    )
    return df.withColumn("email_nbr", found)


def true_count(df: DataFrame, flags: list[str], into: str = "true_count") -> DataFrame:
    """How many of the flags are true."""
    return df.withColumn(
        into, reduce(lambda a, b: a + b, [F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags])
    )
