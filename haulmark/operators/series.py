"""Monthly time series: sums, rolling totals, year-on-year, gaps and windows.

Every window here runs over already aggregated monthly rows, so a partition holds at most one
row per month of one series, whatever the size of the fact table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, measures


def _by(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys] or [F.lit(1)]


def monthly_sum(
    df: DataFrame,
    *,
    month: str = "month",
    value: str | Column = "value",
    keys: Sequence[str] = (),
    unit: tuple[str, str] | None = None,
    out: str = "value",
) -> DataFrame:
    """Sum per key and month. Blank measures count as 0, unparsable ones drop the row."""
    if unit:
        df = df.filter(F.col(unit[0]) == unit[1])
    amount = value if isinstance(value, Column) else measures.amount(df, value)
    rows = df.filter(F.col(month).isNotNull()).select(*keys, month, amount.alias(out)).filter(F.col(out).isNotNull())
    return rows.groupBy(*keys, month).agg(F.sum(out).alias(out))


def rolling(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    month: str = "month",
    value: str = "value",
    n: int = 12,
    frame: str = "rows",
    out: str = "rolling",
) -> DataFrame:
    """Sum over the current and ``n - 1`` earlier months.

    ``frame='rows'`` counts months that are present (gaps collapse), ``'calendar'`` counts
    calendar months.
    """
    base = Window.partitionBy(*_by(keys))
    if frame == "rows":
        w = base.orderBy(month).rowsBetween(-(n - 1), 0)
    elif frame == "calendar":
        w = base.orderBy(dates.month_index(F.col(month))).rangeBetween(-(n - 1), 0)
    else:
        raise ValueError("frame is 'rows' or 'calendar'")
    return df.withColumn(out, F.sum(value).over(w))


def prior_year(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    month: str = "month",
    value: str = "rolling",
    months: int = 12,
    out: str = "prior",
) -> DataFrame:
    """Value stored exactly ``months`` calendar months earlier, NULL when that month is absent.

    A one-point range frame on the month number does the self join's work on the partitioning
    that the rolling sum already needs.
    """
    w = Window.partitionBy(*_by(keys)).orderBy(dates.month_index(F.col(month))).rangeBetween(-months, -months)
    return df.withColumn(out, F.max(value).over(w))


def yoy(df: DataFrame, *, value: str = "rolling", out: str = "yoy_pct", **kw) -> DataFrame:
    """Change against the same month a year before, in percent, one decimal."""
    with_prior = prior_year(df, value=value, out="_prior", **kw)
    return with_prior.withColumn(out, measures.percent_change(F.col(value), F.col("_prior"))).drop("_prior")


def delta_previous(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    month: str = "month",
    value: str = "rolling",
    out: str = "delta_pct",
) -> DataFrame:
    """Change against the previous month that is present."""
    w = Window.partitionBy(*_by(keys)).orderBy(month)
    return df.withColumn(out, measures.percent_change(F.col(value), F.lag(value).over(w), digits=None))


def display_window(df: DataFrame, *, month: str = "month", n: int = 24) -> DataFrame:
    """One row ``(start, end)``: the last ``n`` calendar months up to the latest one."""
    return df.agg(F.max(month).alias("end")).select(F.add_months("end", -(n - 1)).alias("start"), "end")


def window_bounds(window: DataFrame) -> Column:
    """Both bounds of a one-row ``(start, end)`` frame as one scalar struct, evaluated once."""
    return window.select(F.struct("start", "end").alias("w")).scalar()


def densify(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    month: str = "month",
    values: Sequence[str] = ("value",),
    window: DataFrame | None = None,
    fill: str = "zero",
) -> DataFrame:
    """Every month of every key between the bounds; missing ones filled with zero, null or carry.

    ``window`` is a one-row ``(start, end)`` frame shared by all keys; without it each key spans
    its own first to last month. ``df`` is read for the keys and for the values: hand over a monthly
    aggregate that is stored (or ``kept``), not one that is still to be computed from the facts.
    """
    if window is None:
        spine = df.groupBy(*keys).agg(F.min(month).alias("start"), F.max(month).alias("end"))
    else:
        w = window_bounds(window)
        spine = df.select(*keys).distinct() if keys else window.select(F.lit(1).alias("_one"))
        spine = spine.select("*", w["start"].alias("start"), w["end"].alias("end"))
    spine = spine.select(*keys, F.explode(F.sequence("start", "end", F.expr("interval 1 month"))).alias(month))
    out = spine.join(df.select(*keys, month, *values), [*keys, month], "left")
    if fill == "zero":
        return out.select(*keys, month, *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])
    if fill == "carry":
        w = Window.partitionBy(*_by(keys)).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
        return out.select(*keys, month, *[F.last(v, ignorenulls=True).over(w).alias(v) for v in values])
    if fill == "null":
        return out
    raise ValueError("fill is 'zero', 'null' or 'carry'")


def in_window(df: DataFrame, window: DataFrame, *, month: str = "month") -> DataFrame:
    """Rows whose month lies inside a one-row ``(start, end)`` frame, bounds included."""
    w = window_bounds(window)
    return df.filter(F.col(month).between(w["start"], w["end"]))


def month_range(df: DataFrame, start: str | None, end: str | None, *, month: str = "month") -> DataFrame:
    """Inclusive month filter with literal ``YYYY-MM`` bounds; either may be open."""
    if start:
        df = df.filter(F.col(month) >= F.to_date(F.lit(f"{start}-01")))
    if end:
        df = df.filter(F.col(month) <= F.to_date(F.lit(f"{end}-01")))
    return df


def season_boundaries(window: DataFrame, start_month: int = 10) -> DataFrame:
    """First months of every season inside a one-row ``(start, end)`` frame."""
    months = window.select(F.explode(F.sequence("start", "end", F.expr("interval 1 month"))).alias("month"))
    return months.filter(F.month("month") == start_month)


def season_chip(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    month: str = "month",
    value: str = "rolling",
    end_month: int = 9,
) -> DataFrame:
    """Latest season-end total against the one a year before, with direction and label.

    A series without any season end uses its latest month instead.
    """
    rows = prior_year(df, keys=keys, month=month, value=value, out="_prior")
    point = F.struct(F.col(month).alias("month"), F.col(value).alias("now"), F.col("_prior").alias("before"))
    season = F.max_by(point, F.when(F.month(month) == end_month, F.col(month)))
    picked = rows.groupBy(*keys).agg(F.coalesce(season, F.max_by(point, F.col(month))).alias("_p"))
    pct = measures.percent_change(F.col("_p.now"), F.col("_p.before"))
    return picked.select(
        *keys,
        F.col("_p.month").alias("month"),
        pct.alias("pct"),
        measures.change_direction(pct).alias("direction"),
        measures.arrow_label(pct).alias("label"),
    )


def trailing_days(df: DataFrame, *, day: str | Column, as_of: Column, days: int) -> DataFrame:
    """Rows dated within ``days`` of ``as_of``; rows whose day does not parse are dropped."""
    d = dates.day_of(df, day) if isinstance(day, str) else day
    return df.filter(d >= F.date_sub(as_of, days))


def recent_or_first(
    df: DataFrame,
    *,
    day: str,
    days: int,
    tie: Sequence[Column],
    always: int = 3,
) -> DataFrame:
    """Rows within ``days`` of the latest row, and the ``always`` newest ones in any case.

    The newest rows are read first, ``always`` of them and at least one; they hold the latest day, so the rows
    within reach are one filter with a constant bound, which the scan takes. No row is ranked against
    the whole table.
    """
    newest = df.orderBy(F.col(day).desc_nulls_last(), *tie).limit(max(always, 1)).collect()
    latest = newest[0][day] if newest else None
    if latest is None:
        return df.sparkSession.createDataFrame(newest[:always], df.schema)
    cutoff = F.date_sub(F.lit(latest).cast("date"), days)
    recent = df.filter(F.col(day) >= cutoff)
    head = df.sparkSession.createDataFrame(newest[:always], df.schema)
    return recent.unionByName(head.filter(F.col(day).isNull() | (F.col(day) < cutoff)))


def rolling_range(latest: Column, n: int = 12) -> list[Column]:
    """Labels of the first and last month covered by an ``n``-month total."""
    return [
        dates.month_label(F.add_months(latest, -(n - 1))).alias("range_start"),
        dates.month_label(latest).alias("range_end"),
    ]


def last_calendar_months(as_of: Column, n: int = 12) -> list[Column]:
    """First and last month of the ``n`` calendar months up to ``as_of``."""
    end = F.trunc(as_of, "month")
    return [F.add_months(end, -(n - 1)).alias("from_month"), end.alias("to_month")]


def staleness(df: DataFrame, *, day: str, as_of: Column, max_age: int) -> DataFrame:
    """Adds ``available``, ``age_days`` and ``is_stale`` from a date text."""
    d = dates.iso_prefix(F.trim(F.col(day)))
    age = F.datediff(as_of, d)
    return df.select("*", d.isNotNull().alias("available"), age.alias("age_days"), (age > max_age).alias("is_stale"))
