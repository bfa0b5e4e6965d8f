"""Statement dates and report periods, parsed without exceptions or Python.

Every parse puts the text in the order `year-month-day` and casts that: a failed
`try_cast` to date costs a scan of ten characters, while a failed formatter in
`try_to_timestamp` raises inside the JVM for each row and pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and the short forms in use.
_MONTH_NAMES = (
    "jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|"
    "aug|august|sep|sept|september|oct|october|nov|november|dec|december"
)
_MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"

# The month in which each quarter ends.
_QUARTER_END = {"qt1": 3, "qt2": 6, "qt3": 9, "qt4": 12}

# Day, month and four-digit year run together, and a time of day after a date.
_DAY_MONTH_YEAR = (
    r"^(3[0-1]|[1-2][0-9]|0[1-9]|[1-9])(1[0-2]|0[1-9]|[1-9])((?!0000)[0-9]{4})$"
)
_TIME_SUFFIX = r"[ t]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[ap]m)?( ?(z|[+-]\d{2}:?\d{2}))?$"

# The two most common separated forms.
_ISO = r"^(?!0000)\d{4}-\d{2}-\d{2}$"
_YEAR_LAST = r"^\d{1,2}([-/])\d{1,2}\1(?!0000)\d{4}$"

# Between fields that have been put in the order year, month, day; not ASCII, so it is
# not in the text to begin with.
_MARK = "§"
_NAME = rf"(?=(?:{_MONTH_NAMES})[-/])([a-z]{{3}})[a-z]*"
_DAY = r"(\d{1,2})"
_YEAR_END = r"(\d{4}|\d{2})"

# Rewrites of the other forms to year§month§day, applied in turn; at most one of the
# first four matches.
_REWRITES = [
    (rf"^{_DAY}([-/]){_NAME}\2{_YEAR_END}$", "$4§$3§$1"),
    (rf"^{_NAME}([-/]){_DAY}\2{_YEAR_END}$", "$4§$1§$3"),
    (rf"^(\d{{4}})([-/]){_NAME}\2{_DAY}$", "$1§$3§$4"),
    (rf"^{_DAY}([-/]){_DAY}\2{_YEAR_END}$", "$4§$1§$3"),
    # A number above twelve in the month's place is the day.
    (r"§(1[3-9]|[2-9]\d)§(\d{1,2})$", "§$2§$1"),
    # Two-digit years from 70 on belong to the 1900s.
    (r"^([7-9]\d)§", "19$1§"),
    (r"^([0-6]\d)§", "20$1§"),
]
_ORDERED = r"^(?!0000)\d{4}([-/§])\d{1,2}\1\d{1,2}$"

_PERIOD = rf"(?:^|_)((?:qt[1-4]|0?[1-9]|1[0-2]|{_MONTH_NAMES})_(?!0000)\d{{4}})$"


def _month_numbers(c: Column, before: str, after: str) -> Column:
    """Replace three-letter month names between two marks by numbers."""
    for month in range(12):
        name = _MONTH_STARTS[3 * month : 3 * month + 3]
        c = F.replace(c, F.lit(before + name + after), F.lit(f"{before}{month + 1}{after}"))
    return c


def _rare_date(c: Column) -> Column:
    """The less common forms. The rewrites are nested one in the other, so the text is
    referred to once however many there are, and the generated code stays small."""
    text = F.regexp_replace(F.lower(c), _TIME_SUFFIX, "")
    for pattern, order in _REWRITES:
        text = F.regexp_replace(text, pattern, order)
    ordered = F.regexp_extract(_month_numbers(text, _MARK, _MARK), _ORDERED, 0)
    return F.translate(ordered, "/" + _MARK, "--").try_cast("date")


def _year_last_date(c: Column) -> Column:
    """Month, day and year, or day, month and year where that is no date."""
    text = F.translate(c, "/", "-")
    first = F.substring_index(text, "-", 1)
    second = F.substring_index(F.substring_index(text, "-", 2), "-", -1)
    year = F.substring_index(text, "-", -1)
    return F.coalesce(
        F.concat_ws("-", year, first, second).try_cast("date"),
        F.concat_ws("-", year, second, first).try_cast("date"),
    )


def any_date(c: Column) -> Column:
    """A date in one of the forms statements use; null where it is none of them.

    Without `/` and `-` the text must be day, month and four-digit year run together.
    With them it is three fields: year first, or month first when that is a valid date
    and day first otherwise. Month names are allowed; a time of day is ignored.
    """
    return (
        F.when(F.coalesce(c, F.lit("")) == "", F.lit(None).cast("date"))
        .when(c.rlike(_ISO), c.try_cast("date"))
        .when(c.rlike(_YEAR_LAST), _year_last_date(c))
        .when(
            c.rlike(_DAY_MONTH_YEAR),
            F.regexp_replace(c, _DAY_MONTH_YEAR, "$3-$2-$1").try_cast("date"),
        )
        .when(c.rlike("[-/]"), _rare_date(c))
    )


def report_date(file_name: Column) -> Column:
    """Last day of the period a file name ends in: `x_Apr_2016.csv`, `x_QT1_2016.csv`."""
    period = F.regexp_extract(F.lower(F.substring_index(file_name, ".csv", 1)), _PERIOD, 1)
    period = _month_numbers(F.regexp_replace(period, "^([a-z]{3})[a-z]*_", "$1_"), "", "_")
    for quarter, month in _QUARTER_END.items():
        period = F.replace(period, F.lit(quarter), F.lit(str(month)))
    return F.last_day(F.regexp_replace(period, r"^(\d+)_(\d+)$", "$2-$1-1").try_cast("date"))


def iso_text(c: Column) -> Column:
    """A date as `yyyy-MM-dd` text."""
    return c.cast("string")
