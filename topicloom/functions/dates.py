"""Dates of feeds and listings, without weekday parsing and without shifts of the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.text import trim

#: Names in dates, and the anchored forms that are read, in any case, with one or two digits.
WEEKDAYS = "mon|tue|wed|thu|fri|sat|sun"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
CLOCK, OFFSET = r"(\d{1,2}:\d{1,2}:\d{1,2})", r"[+-]\d{2}:?\d{2}"
FORMS = (
    (rf"^(?:{WEEKDAYS}),\s+(\d{{1,2}})\s+({'|'.join(MONTHS)})\s+(\d{{4}})\s+{CLOCK}\s+({OFFSET}|z|gmt|utc)$", "@$3-$2-$1 $4 $5"),
    (rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}})t{CLOCK}({OFFSET}|z)$", "@$1 $2 $3"),
    (rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}})\s+{CLOCK}$", "@$1 $2 z"),
    (r"^(\d{4}-\d{1,2}-\d{1,2})$", "@$1 0:0:0 z"),
)


def _plain(value: Column) -> Column:
    """A date string as ``@2024-1-2 3:4:5 +0000``; one of no known form has no such start. The forms exclude each other, so each
    is one pass over a short string."""
    text = F.lower(trim(value))
    out = F.when(~F.startswith(text, F.lit("@")), text)
    for form, plain in FORMS:
        out = F.regexp_replace(out, form, plain)
    for k, name in enumerate(MONTHS, 1):
        out = F.replace(out, F.lit(f"-{name}-"), F.lit(f"-{k}-"))
    return F.regexp_replace(F.regexp_replace(out, "(?:z|gmt|utc)$", "+0000"), r"([+-]\d{2}):(\d{2})$", "$1$2")


def instant(value: Column) -> Column:
    """The moment that a date string names; no offset means UTC; null if it can't be read."""
    return F.try_to_timestamp(_plain(value), F.lit("'@'yyyy-M-d H:m:s Z"))


def wall_date(value: Column) -> Column:
    """The day on the writer's own clock, as text; null if the moment can't be read."""
    plain = _plain(value)
    day = F.try_to_timestamp(F.concat(F.substring_index(plain, " ", 1), F.lit(" 0:0:0 +0000")), F.lit("'@'yyyy-M-d H:m:s Z"))
    moment = F.try_to_timestamp(plain, F.lit("'@'yyyy-M-d H:m:s Z"))
    return F.when(moment.isNotNull(), F.date_format(F.to_utc_timestamp(day, F.current_timezone()), "yyyy-MM-dd"))


def recent(value: Column, cutoff: Column) -> Column:
    """Not before the cutoff; what can't be read is kept."""
    moment = instant(value)
    return moment.isNull() | (moment >= cutoff)


def window_start(start: Column, end: Column, days: int | None) -> Column:
    """The later of a topic's start and the first of the last ``days`` days."""
    return start if days is None else F.greatest(start, F.date_sub(end, days - 1))


def utc_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm 'UTC'")


def stamp_label(stamp: Column) -> Column:
    """An ISO stamp to the second, with a space for its T."""
    return F.replace(F.substring(stamp, 1, 19), F.lit("T"), F.lit(" "))
