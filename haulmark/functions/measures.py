"""Number parsing and measure expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURE_TYPE = "decimal(18,3)"


def parse_number(c: Column) -> Column:
    """Comma-grouped text to DOUBLE; blank, malformed and a lone dash are 0, signs are kept."""
    s = F.regexp_replace(F.trim(c.cast("string")), ",", "")
    return F.coalesce(s.try_cast("double"), F.lit(0.0))


def strict_number(c: Column) -> Column:
    """Comma-grouped text to DOUBLE; blank is 0, malformed is NULL so the row can be dropped."""
    s = F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), ",", "")
    return F.when(s == "", F.lit(0.0)).otherwise(s.try_cast("double"))


def measure(c: Column) -> Column:
    """Additive measure: blank is 0, unparsable is NULL, otherwise an exact decimal."""
    s = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(s == "", F.lit(0).cast(MEASURE_TYPE)).otherwise(s.try_cast(MEASURE_TYPE))


def amount(df: DataFrame, column: str) -> Column:
    """``measure`` of a column of ``df``; a column that is numeric already skips the text handling."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.scale <= 3:
        return F.coalesce(F.col(column), F.lit(0).cast(kind))
    if isinstance(kind, T.NumericType):
        return F.coalesce(F.col(column), F.lit(0).cast(kind)).try_cast(MEASURE_TYPE)
    return measure(F.col(column))


def whole_number(c: Column) -> Column:
    """Truncated integer of a comma-grouped number; NULL when malformed."""
    return strict_number(c).try_cast("bigint")


def int_or_zero(c: Column) -> Column:
    s = F.regexp_replace(F.trim(c.cast("string")), ",", "")
    return F.coalesce(s.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def pure_number(c: Column) -> Column:
    """Number of a display string such as ``8,810.5``; NULL otherwise."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def percentages(c: Column) -> Column:
    """Every number directly followed by a percent sign."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+\.?\d*)\s*%"), F.lit(1))
    return F.transform(found, lambda x: x.try_cast("double"))


def percent_change(now: Column, before: Column, digits: int | None = 1) -> Column:
    """(now - before) / before * 100; NULL when the base is missing or 0."""
    n, b = now.cast("double"), before.cast("double")
    pct = F.when(b != 0, (n - b) / b * 100)
    return F.round(pct, digits) if digits is not None else pct


def arrow_label(pct: Column, dead_zone: float = 0.5) -> Column:
    """Signed arrow label; a change inside the dead zone or a missing one is a dash."""
    return (
        F.when(pct.isNull() | (F.abs(pct) < dead_zone), F.lit("—"))
        .when(pct > 0, F.format_string("▲ %.1f%%", pct))
        .otherwise(F.format_string("▼ %.1f%%", F.abs(pct)))
    )


def change_direction(pct: Column, dead_zone: float = 0.5) -> Column:
    return F.when(pct.isNull() | (F.abs(pct) < dead_zone), "neutral").when(pct > 0, "up").otherwise("down")


def grouped(c: Column, digits: int = 0) -> Column:
    """Thousands-separated text."""
    return F.format_number(c.cast("double"), digits)
