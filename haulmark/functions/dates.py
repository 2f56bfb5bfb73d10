"""Month and day expressions. Months are DATE (first day) inside, strings at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# English month abbreviations of the mail date format and of month labels.
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def norm_month(c: Column) -> Column:
    """``YYYY-M`` becomes ``YYYY-0M``; anything else is only trimmed."""
    return F.regexp_replace(F.trim(c), r"^(\d{4})-(\d)$", "$1-0$2")


def compact_period(c: Column) -> Column:
    """``2021M01`` and ``2024.01`` become ``2021-01`` and ``2024-01``; other text is NULL."""
    s = F.trim(c)
    return F.when(s.rlike(r"^\d{4}[M.]\d{2}$"), F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 6, 2)))


def month_date(c: Column) -> Column:
    """First day of the month named by a ``YYYY-MM`` or ``YYYY-M`` string, else NULL."""
    m = norm_month(c)
    return F.when(m.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(m, F.lit("-01")), "yyyy-MM-dd"))


def month_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_label(c: Column) -> Column:
    """``Jan 2025``."""
    names = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    return F.concat(F.element_at(names, F.month(c)), F.lit(" "), F.year(c).cast("string"))


def month_index(c: Column) -> Column:
    """Running month number, so that a calendar distance is a plain difference."""
    return F.year(c) * 12 + F.month(c)


def parse_day(c: Column) -> Column:
    """``YYYYMMDD`` or ISO text to DATE; blank, ``-`` or anything else is NULL."""
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd")).otherwise(iso_prefix(s))


def iso_prefix(c: Column) -> Column:
    """DATE from the first ten characters when they are ``YYYY-MM-DD``, else NULL."""
    head = F.substring(c.cast("string"), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(head, "yyyy-MM-dd"))


def day_of(df: DataFrame, column: str) -> Column:
    """DATE of a column of ``df``; one that is a date already is used as it is, so filters reach the scan."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(column)
    return iso_prefix(F.col(column))


def mail_date(c: Column) -> Column:
    """Date of an RFC-822 stamp in the zone the stamp was written in (no conversion)."""
    pattern = r"^(?i:mon|tue|wed|thu|fri|sat|sun), (\d{1,2}) ([A-Za-z]{3}) (\d{4}) \d{2}:\d{2}:\d{2} [+-]\d{2}:?\d{2}$"
    s = F.trim(c)
    names = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    number = F.array_position(names, F.initcap(F.regexp_extract(s, pattern, 2)))
    text = F.concat_ws(
        "-",
        F.regexp_extract(s, pattern, 3),
        F.lpad(number.cast("string"), 2, "0"),
        F.lpad(F.regexp_extract(s, pattern, 1), 2, "0"),
    )
    return F.when(s.rlike(pattern) & (number > 0), F.try_to_date(text, "yyyy-MM-dd"))


def civil_today(zone: str = "Asia/Seoul") -> Column:
    """Today's date on the wall clock of ``zone``."""
    return F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), zone))


def utc_stamp(c: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of a UTC timestamp."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def year_month_day(c: Column) -> list[Column]:
    return [F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day")]
