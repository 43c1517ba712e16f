"""Business calendar: Sundays and holidays by date arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def _weekday_from(date: Column, name: str) -> Column:
    """The date itself or the next one with that weekday."""
    return F.next_day(F.date_sub(date, 1), name)


def _weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def easter(year: Column) -> Column:
    """Easter Sunday in the Gregorian calendar, in whole-number arithmetic (Gauss, as corrected)."""
    div = lambda a, b: F.floor(a / b).cast("int")
    golden, century = year % 19, div(year, 100)
    moon = (century - div(century, 4) - div(8 * century + 13, 25) + 19 * golden + 15) % 30
    full = moon - div(moon, 28) * (1 - div(moon, 28) * div(F.lit(29), moon + 1) * div(21 - golden, 11))
    weekday = (year + div(year, 4) + full + 2 - century + div(century, 4)) % 7
    return F.date_add(_day(year, 3, 28), full - weekday)


def holidays(year: Column) -> Column:
    """Array of {Date, Name} of one year."""
    new_year, canada, christmas, boxing = _day(year, 1, 1), _day(year, 7, 1), _day(year, 12, 25), _day(year, 12, 26)
    monday = lambda d: _weekday_from(d, "MON")
    days = {
        "New Year's Day": F.when(_weekend(new_year), monday(new_year)).otherwise(new_year),
        "Family Day": F.date_add(monday(_day(year, 2, 1)), 14),
        "Good Friday": F.date_sub(easter(year), 2),
        "Easter Monday": F.date_add(easter(year), 1),
        "Victoria Day": F.date_sub(F.next_day(_day(year, 5, 24), "MON"), 7),
        "Canada Day": F.when(_weekend(canada), monday(canada)).otherwise(canada),
        "Civic Day": monday(_day(year, 8, 1)),
        "Labour Day": monday(_day(year, 9, 1)),
        "Thanksgiving": F.date_add(monday(_day(year, 10, 1)), 7),
        "Christmas": F.when(_weekend(christmas), F.date_add(christmas, 2)).otherwise(christmas),
        "Boxing Day": F.when(_weekend(boxing), F.date_add(boxing, 2)).otherwise(boxing),
    }
    return F.array(*[F.struct(d.alias("Date"), F.lit(n).alias("Name")) for n, d in days.items()])


def business_calendar(years: DataFrame, year: str = "year") -> DataFrame:
    """(Date, Name) of every Sunday and holiday of the years."""
    y = F.col(year)
    first_sunday = _weekday_from(_day(y, 1, 1), "SUN")
    sundays = F.transform(
        F.sequence(first_sunday, _day(y, 12, 31), F.expr("interval 7 days")),
        lambda d: F.struct(d.alias("Date"), F.lit("Sunday").alias("Name")),
    )
    listed = years.select(y).distinct().select(F.explode(F.concat(sundays, holidays(y))).alias("d"))
    return listed.select("d.*")


def exclude_non_business(dates: DataFrame, calendar: DataFrame, date: str = "Date") -> DataFrame:
    """Dates that are in no calendar of their year."""
    return dates.join(calendar.select(F.col("Date").alias(date)), date, "left_anti")
