"""Partial publication dates, which stay strings: YYYY, YYYY-MM or YYYY-MM-DD."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months by their first three letters, and the years looked for in free text.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
YEAR = r"\b(1[5-9]\d\d|20\d\d)\b"


def month_number(value: Column) -> Column:
    """'01'..'12' for 1..12 in digits or a month's first three letters; null otherwise (seasons, too)."""
    number = F.when(value.rlike(r"^\d{1,9}$"), value.try_cast("int"))
    named = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(f"{i:02d}"))])
    return F.when(number.between(1, 12), F.lpad(number.cast("string"), 2, "0")).otherwise(named[F.lower(F.substring(value, 1, 3))])


def partial_date(year: Column, month: Column, day: Column, free_text: Column) -> Column:
    """From the parts of a record; without a year, from the first year and the first month in the free text.

    A day counts only with a month and is not checked against it; a year that is not four digits makes no date.
    """
    found = F.regexp_extract(free_text, YEAR, 1)
    guessed = F.get(F.filter(F.transform(F.split(free_text, r"[\s/-]+"), month_number), lambda m: m.isNotNull()), F.lit(0))
    y = F.when(year.isNotNull(), year).when(found != "", found)
    m = F.when(year.isNotNull(), month_number(month)).otherwise(guessed)
    d = F.when(year.isNotNull() & day.rlike(r"^\d{1,2}$"), F.lpad(day, 2, "0"))
    return F.when(y.rlike(r"^\d{4}$"), F.concat_ws("-", y, m, F.when(m.isNotNull(), d)))


def utc_stamp(ts: Column) -> Column:
    """Seconds and Z; the session's time zone is UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
