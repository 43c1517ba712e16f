"""Date strings inside free text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.fixed_values import DATE_FORMATS
from docketry.functions.text import any_word, bind

# --- fixed values: month names that the layouts can read
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"

# A date with a month name has one of these right before or after its digits. The look-ahead
# spares most letters the twelve comparisons.
_MONTH = f"(?=[adfjmnos])(?:{MONTHS})"
NEAR_MONTH = rf"{_MONTH}(?U:[\s|-])\d|\d(?U:[\s|-]){_MONTH}"


# --- fixed values: shape a date must have for its layout; days have at most two digits
SHAPES = {
    "MMM d yyyy": r"^[a-z]{3} \d{1,2} \d{4}$",
    "d MMM yyyy": r"^\d{1,2} [a-z]{3} \d{4}$",
    "M d yyyy": r"^\d{1,2} \d{1,2} \d{4}$",
    "yyyy M d": r"^\d{4} \d{1,2} \d{1,2}$",
}


def parse_match(match: Column, layout: str) -> Column:
    """Read one matched date in lower case; null where it is no calendar date."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(match, r"(?U)[^\w\s]", " "), r"\s+", " "))
    if layout.endswith(" yy"):
        clean = F.regexp_replace(clean, r"(\d{2})$", "20$1")
        layout = layout + "yy"
    return bind(clean, lambda c: F.when(c.rlike(SHAPES[layout]), F.try_to_date(c, layout)))


def _reader(layout: str) -> Callable[[Column], Column]:
    return lambda match: parse_match(match, layout)


def matches(text: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _named(layout: str) -> bool:
    return "MMM" in layout


def _found(text: Column, pattern: str, layout: str) -> Column:
    return F.array_compact(F.transform(matches(text, pattern), _reader(layout)))


def _where_month(text: Column, found: Column, otherwise: Column) -> Column:
    """Search for month names only in texts that have one next to a digit."""
    return F.when(any_word(text, MONTHS.split("|")) & text.rlike(NEAR_MONTH), found).otherwise(otherwise)


def dates_in(text: Column, formats: list[tuple[str, str]] = DATE_FORMATS) -> Column:
    """Sorted distinct dates written in the text in any of the formats."""

    def found(t: Column) -> Column:
        named = F.concat(*[_found(t, p, f) for p, f in formats if _named(f)])
        plain = F.concat(*[_found(t, p, f) for p, f in formats if not _named(f)])
        return F.array_sort(F.array_distinct(F.concat(plain, _where_month(t, named, F.array().cast("array<date>")))))

    return bind(text, found)


def date_matches(text: Column, formats: list[tuple[str, str]]) -> Column:
    """Distinct parseable date strings of layouts with a month name, counted per format."""
    count = reduce(lambda a, b: a + b, [F.size(_found(text, p, f)) for p, f in formats])
    return _where_month(text, count, F.lit(0))
