"""Date parsing and date-part helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._util import as_col

# Slash dates are month-first, dash dates day-first; one- or two-digit fields.
MIXED_DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d-M-yyyy")


#: Month names; any beginning of three letters or more counts.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
DAY, MONTH, YEAR = r"(\d{1,2})(?:st|nd|rd|th)?", r"([a-z]{3,9})\.?", r"(\d{4}|'?\d{2})"
#: Written dates: pattern, then which of its groups are year, month and day (0: the first of the month).
WRITTEN_DATES = [
    (rf"^{WEEKDAY}{MONTH}\s*{DAY}\s*,?\s+{YEAR}$", 3, 1, 2),  # Jan 5 2016, January 5th, '16
    (rf"^{WEEKDAY}{DAY}\s*(?:-|\s+of\s+|\s)\s*{MONTH}\s*(?:-|,|\s)\s*{YEAR}$", 3, 2, 1),  # 5 January 2016, 5-Jan-16
    (rf"^{MONTH}\s*,?\s+(\d{{4}})$", 2, 1, 0),  # January 2016
    (r"^(\d{4})\s*[/. ]\s*(\d{1,2})\s*[/. ]\s*(\d{1,2})$", 1, 2, 3),  # 2016/1/5
    (r"^(\d{1,2})\s*/\s*(\d{1,2})\s*/\s*(\d{2})$", 3, 1, 2),  # 1/5/16
]


def _month_number(text: Column) -> Column:
    """1 to 12 for a month's name or its beginning, else NULL; digits stay."""
    named = {name[:n]: k for k, name in enumerate(MONTHS, 1) for n in range(3, len(name) + 1)}
    digits = {f"{k:0{n}}": k for k in range(1, 13) for n in (1, 2)}
    table = F.create_map(*[F.lit(x) for pair in {**named, **digits}.items() for x in pair])  # folded to one constant
    return F.try_element_at(table, text)


def _written_date(t: Column, pattern: str, year: int, month: int, day: int) -> Column:
    part = lambda k: F.regexp_extract(t, pattern, k)
    y = F.ltrim(part(year), F.lit("'")).try_cast("int")
    # two digits: 69 to 99 are of the last century
    y = F.when(F.length(part(year)) == 4, y).when(y >= 69, y + 1900).otherwise(y + 2000)
    d = part(day).try_cast("int") if day else F.lit(1)
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), _month_number(part(month)).cast("string"), d.cast("string"))
    return F.when(t.rlike(pattern), F.try_to_date(text, "yyyy-M-d"))


def parse_mixed_date(c: Column | str, formats=MIXED_DATE_FORMATS) -> Column:
    """first successful parse among ``formats``, then Spark's default date
    cast, then written forms (``WRITTEN_DATES``: month names, ordinals, weekdays,
    two-digit years; slashes are month-first).  Case and surrounding blanks do
    not matter; what is no date becomes NULL, never an error, also under ANSI
    mode.  Expressions only, and the written forms run only where the plain ones fail."""
    t = F.trim(as_col(c).cast("string"))
    low = F.lower(t)
    # a format is tried only where its separator comes far enough into the text: a failed parse is dear
    at = {f: re.match(r"([a-zA-Z]+)([-/])", f) for f in formats}
    attempts = [F.when(F.locate(m[2], t, 2) > m[1].count("y"), F.try_to_date(t, f)) if (m := at[f]) else F.try_to_date(t, f) for f in formats]
    attempts.append(F.try_to_date(t))
    # in a lambda, the long way of the few written dates stays out of the generated code: a method
    # with all of it is too long for the JVM to compile, and every row pays
    written = F.transform(F.array(low), lambda x: F.coalesce(*[_written_date(x, *form) for form in WRITTEN_DATES]))[0]
    return F.coalesce(*attempts, written)


def date_key(d: Column | str) -> Column:
    """YYYYMMDD as int."""
    return F.date_format(as_col(d), "yyyyMMdd").cast("int")


def iso_day_of_week(d: Column | str) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7."""
    return (F.weekday(as_col(d)) + 1).cast("int")


def is_weekend(d: Column | str) -> Column:
    return F.weekday(as_col(d)) >= 5


def month_name(d: Column | str, pad: bool = True) -> Column:
    """full month name; ``pad`` blank-pads to 9 characters like the
    warehouse's ``to_char(d, 'Month')``."""
    name = F.date_format(as_col(d), "MMMM")
    return F.rpad(name, 9, " ") if pad else name


def month_start(d: Column | str) -> Column:
    """first day of the month."""
    return F.trunc(as_col(d), "month")


def decade(year: Column | str) -> Column:
    """floor(year / 10) * 10."""
    return (F.floor(as_col(year) / 10) * 10).cast("int")


def epoch_to_timestamp(seconds: Column | str, zero_is_null: bool = True) -> Column:
    """epoch seconds -> timestamp (UTC); 0/NULL -> NULL by default."""
    s = as_col(seconds).cast("bigint")
    if zero_is_null:
        s = F.when(s != 0, s)
    return F.timestamp_seconds(s)
