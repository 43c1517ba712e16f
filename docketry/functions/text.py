"""Column helpers for keyword, window and occurrence tests."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    A staging column would be lost as soon as a filter on the result is pushed below it:
    the optimizer then writes the staged expression out at every place that reads it. A
    lambda variable stays one evaluation wherever the expression ends up.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def explode_once(array: Column | str) -> Column:
    """Explode a computed array without computing it twice.

    For a plain explode the optimizer adds a test that the array is not empty and pushes it
    down to where the array is made. The outer form has no such test; the caller drops the
    null rows it gives for empty arrays.
    """
    return F.explode_outer(array)


def any_word(text: Column, words: Iterable[str]) -> Column:
    """True where the text contains one of the words."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words], F.lit(False))


def word_hits(text: Column, words: Iterable[str]) -> Column:
    """How many of the words occur in the text (each counted once)."""
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words], F.lit(0))


def any_of(words: Iterable[str]) -> str:
    """A pattern that finds any of the words; cheaper than a contains chain inside lambdas."""
    return "|".join(re.escape(w).replace(r"\ ", " ") for w in words)


def occurrences(text: Column, word: str) -> Column:
    """Number of non-overlapping occurrences of a fixed word."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))
    return (removed / F.lit(len(word))).cast("int")


def window_after(text: Column, keyword: str, width: int) -> Column:
    """``width`` characters from the first occurrence of the keyword, null without one."""
    return F.when(text.contains(keyword), F.substring(text, F.instr(text, keyword), F.lit(width)))


def first_digit_token(text: Column) -> Column:
    """First space-separated token with a digit, null without one."""
    return F.get(F.regexp_extract_all(text, F.lit("([^ ]*[0-9][^ ]*)"), F.lit(1)), F.lit(0))


def first_match(text: Column, pattern: str) -> Column:
    """First match of a pattern, null without one."""
    return bind(F.regexp_extract(text, pattern, 0), lambda m: F.when(m != "", m))


def strip_punctuation(text: Column, by: str = "", keep: str = "") -> Column:
    """Replace all but letters, digits, underscores and white space, then collapse blanks."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?U)[^\w\s{keep}]", by), " +", " ")


def digits_of(match: Column) -> Column:
    """Drop punctuation and blanks from a phone-like match."""
    return F.regexp_replace(match, r"[^\w\s]| ", "")


def mode_first(values: list[Column]) -> Column:
    """Most frequent of a few values in one row; among equals the one that comes first."""
    counts = [reduce(lambda a, b: a + b, [(v == w).cast("int") for w in values]) for v in values]
    top = F.greatest(*counts)
    return F.coalesce(*[F.when(c == top, v) for c, v in zip(counts, values)])


def hash_bucket(key: Column, buckets: int) -> Column:
    """Stable bucket of a key that any engine with md5 can repeat."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(buckets)
