"""Dates in free form: month names, day and month in either order where only one can be meant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_date

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
NAMES = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec"
DAY, YEAR = r"(\d{1,2})(?:st|nd|rd|th)?", r"(\d{4})"
#: Forms with a month's name, and which groups are day, month and year.
NAMED = (
    (rf"(?i)(?<![\w/.-]){DAY}[\s./-]*(?:of\s+)?({NAMES})\.?,?[\s./-]+{YEAR}(?!\d)", (1, 2, 3)),
    (rf"(?i)(?<![\w])({NAMES})\.?[\s./-]*{DAY},?[\s./-]+{YEAR}(?![\d:])", (2, 1, 3)),
    (rf"(?i)(?<![\w]){YEAR}[\s,./-]+({NAMES})\.?[\s./-]*{DAY}(?![\w:])", (3, 2, 1)),
    # as ctime writes it, with a time between
    (rf"(?i)(?<![\w])({NAMES})\s+{DAY}\s+\d{{1,2}}:\d{{2}}(?::\d{{2}})?\s+(?:[A-Z]{{1,5}}\s+)?{YEAR}(?!\d)", (2, 1, 3)),
)
YEAR_FIRST = r"(?<![\d/.-])(\d{4})[/](\d{1,2})[/](\d{1,2})(?![\d/])"
YEAR_LAST = r"(?<![\d/.-])(\d{1,2})([/.-])(\d{1,2})\2(\d{4})(?![\d/.-])"


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-M-d")


def free_date(col: Column) -> Column:
    """yyyy-MM-dd of a date in free form, as it is written (a time and its zone are not looked at); null if there is none.

    Forms: ``2 Jan 2024``, ``January 2nd, 2024``, ``2024 Jan 2``, with dots, dashes or slashes between, also after a
    weekday or around a time; ``2024/1/2``; ``13/2/2024`` and ``2/13/2024``, where one number can be no month. Where either could
    be the month (``1/2/2024``) and in two-digit years nothing is guessed. Impossible dates are null.
    """
    found = []
    for pattern, groups in NAMED:
        day, name, year = (F.regexp_extract(col, pattern, g) for g in groups)
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3))).cast("string")
        found.append(F.when(name != "", _day(year, month, day)))
    found.append(F.when(col.rlike(YEAR_FIRST), _day(*[F.regexp_extract(col, YEAR_FIRST, g) for g in (1, 2, 3)])))
    a, b, year = (F.regexp_extract(col, YEAR_LAST, g) for g in (1, 3, 4))
    x, y = a.try_cast("int"), b.try_cast("int")
    found.append(F.when(x > 12, _day(year, b, a)).when((y > 12) | (x == y), _day(year, a, b)))
    return F.date_format(F.coalesce(*found), "yyyy-MM-dd")


def any_date(col: Column) -> Column:
    """A date in one of the forms of ``clean_date``, else in free form."""
    return F.coalesce(clean_date(col), free_date(col))
