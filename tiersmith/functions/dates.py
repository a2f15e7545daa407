"""Date column functions: ANSI-safe mixed-format parsing, trailing windows,
partition keys.  All return ``Column`` expressions evaluated inside the JVM."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text layouts, tried in this order (day first, then
# month first).  Single pattern letters accept padded and unpadded fields.
DAY_FIRST_FORMATS = ("d/M/yyyy", "M/d/yyyy")
# The other layouts, by the names of their fields.  A middle field
# up to 12 is the month (day first); only a larger one is read month first.
_YEAR = r"(?!0000)\d{4}"
_TIME = r"\d{1,2}:\d{2}(?::\d{2})?"
_DAY_FIRST = (r"(\d{1,2})/(0?[1-9]|1[0-2])/(%s)" % _YEAR, "dmy")
_MONTH_FIRST = (r"(\d{1,2})/(\d{1,2})/(%s)" % _YEAR, "mdy")
_SHAPED = (
    (rf"({_YEAR})-(\d{{1,2}})-(\d{{1,2}})(?:[ T]{_TIME})?", "ymd"),
    (rf"(\d{{1,2}})\.(\d{{1,2}})\.({_YEAR})", "dmy"),
    (rf"(\d{{1,2}})-(\d{{1,2}})-({_YEAR})", "dmy"),
)
# What may follow a layout: one line end.
_LINE_END = r"(?:\r\n|[\n\r\u0085\u2028\u2029])?"
# What a text lacks for a short year or a named month, put behind it: the century
# and the months' numbers.  A text's own "|" cannot stand for it: exactly 60
# letters and digits follow the century.
_LACKING = "|20Jan01Feb02Mar03Apr04May05Jun06Jul07Aug08Sep09Oct10Nov11Dec12"
_SHORT_YEAR = rf"(\d{{1,2}})/(\d{{1,2}})/(\d{{2}}){_LINE_END}\|(20)[A-Za-z0-9]{{60}}"
_NAMED = rf"([A-Z][a-z]{{2}}) (\d{{1,2}}), ({_YEAR}){_LINE_END}\|20(?=[A-Za-z0-9]{{60}}\z)[A-Za-z0-9]*?\5(\d\d)[A-Za-z0-9]*"

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, formats: tuple[str, ...] = DAY_FIRST_FORMATS, iso_fallback: bool = True) -> Column:
    """Text -> DATE; null when no layout fits (never raises, ANSI or not).

    ``12/01/2018`` -> 2018-01-12 (day first), ``12/30/2018`` -> 2018-12-30
    (month-first fallback), ``2018-12-05`` -> itself, ``31/02/2018`` -> null.
    ``iso_fallback`` also accepts ISO dates and the other layouts of
    ``SHAPED_FORMATS``, and a time of day after the date, which is dropped.
    Two-digit years are 2000 to 2099.  ``2018`` and ``2018-12-05 x`` are null.
    """
    c = _col(c)
    if tuple(formats) != DAY_FIRST_FORMATS:
        attempts = [F.try_to_date(c, fmt) for fmt in formats]
        return F.coalesce(*attempts, *([_dated(c, _SHAPED), _rare(c)] if iso_fallback else []))
    if not iso_fallback:
        return _dated(c, (_DAY_FIRST, _MONTH_FIRST))
    timed = [(rf"{shape}(?: {_TIME})?", fields) for shape, fields in (_DAY_FIRST, _MONTH_FIRST)]
    return F.coalesce(_dated(c, (*timed, *_SHAPED)), _rare(c))


def _dated(c: Column, layouts, written: str = "{y}-{m}-{d}") -> Column:
    """The date of a text in one of ``layouts``."""
    return _fields(c, layouts, written).try_cast("date")


def _fields(c: Column, layouts, written: str) -> Column:
    """The fields of the first layout that fits, as ``written``; of any other
    text nothing but what stands between them.  It is one replacement for all
    layouts: a chain of them makes the generated code of a row larger than what
    the JVM compiles, and then every row is interpreted."""
    groups: dict[str, str] = {"y": "", "m": "", "d": ""}
    for number, field in enumerate("".join(fields for _, fields in layouts), 1):
        groups[field] += f"${number}"
    shapes = "|".join(shape for shape, _ in layouts)
    return F.regexp_replace(c, rf"\A(?:(?:{shapes}){_LINE_END}\z|[\s\S]+)", written.format(**groups))


def _rare(c: Column) -> Column:
    """The date of a layout that takes more than its fields; only texts that fit
    no other layout come here.  It holds the text once: a filter on the date
    repeats what the text is made of with every use."""
    year_first = F.regexp_replace(F.concat(c, F.lit(_LACKING)), rf"\A(?:(?:{_SHORT_YEAR}|{_NAMED})\z|[\s\S]+)", "$4$3$7-$2$8-$1$6")
    return F.regexp_extract(year_first, r"^\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast("date")


def parse_date_or_fail(c: ColumnOrName, formats: tuple[str, ...] = DAY_FIRST_FORMATS) -> Column:
    """Like :func:`parse_date` but a non-null text that fits no layout fails
    the job with the offending value in the message (bronze ``on_bad_date='fail'``)."""
    c = _col(c)
    parsed = parse_date(c, formats)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparseable date: "), c.cast("string")))
                  ).otherwise(parsed)


def months_before(anchor: Column | _dt.date | str, months: int) -> Column:
    """``anchor`` minus ``months`` calendar months, clamped to month end
    (2018-03-31 minus 1 month = 2018-02-28).  ``anchor`` is a date column, a
    ``datetime.date`` or an ISO date literal."""
    if isinstance(anchor, _dt.date):
        anchor = F.lit(anchor)
    elif isinstance(anchor, str):
        anchor = F.lit(anchor).cast("date")
    return F.add_months(anchor, -months)


def partition_keys(date_col: ColumnOrName, padded: bool = False) -> dict[str, Column]:
    """``year``/``month``/``day`` partition columns of a date.

    Unpadded ints by default (``month=3``); ``padded=True`` gives zero-padded
    two-character strings for month and day (``month=03``), which Spark reads
    back as the same ints and prunes on.
    """
    d = _col(date_col)
    if padded:
        return {
            "year": F.year(d),
            "month": F.date_format(d, "MM"),
            "day": F.date_format(d, "dd"),
        }
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def date_from_keys(year: ColumnOrName = "year", month: ColumnOrName = "month",
                   day: ColumnOrName = "day") -> Column:
    """Rebuild the date from partition columns, so a range predicate stays on
    the partition columns and prunes directories."""
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), _col(day).cast("int"))
