"""Breakdowns by origin or destination, full years, rankings and price leaders.

One pre-aggregate by (bucket, month) feeds each operator; the later steps touch only its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures
from ..session import kept
from .keyed import pick_per_key
from .units import dried_sum


def bucket_months(
    df: DataFrame,
    *,
    bucket: Column,
    month: str = "month",
    value: str = "value",
    out: str = "value",
    bucket_name: str = "bucket",
    dried_form: str | None = None,
) -> DataFrame:
    """Sum per bucket and month; rows without a usable measure still mark their month as present.

    ``dried_form`` names the form column when the sum is to be in dried equivalent.
    """
    rows = df.filter(F.col(month).isNotNull()).select(
        bucket.alias(bucket_name), month, measures.amount(df, value).alias(out), *([dried_form] if dried_form else [])
    )
    total = dried_sum(F.col(out), dried_form) if dried_form else F.sum(out)
    return rows.groupBy(bucket_name, month).agg(F.coalesce(total, F.lit(0)).alias(out))


def full_years(months: DataFrame, *, month: str = "month", min_months: int = 10) -> DataFrame:
    """Years with at least ``min_months`` distinct months."""
    return (
        months.select(F.year(month).alias("year"), F.month(month).alias("_m"))
        .groupBy("year")
        .agg(F.count_distinct("_m").alias("n_months"))
        .filter(F.col("n_months") >= min_months)
    )


def _in_full_years(months: DataFrame, month: str, min_months: int) -> DataFrame:
    """Pre-aggregated rows of full years; one row per year is broadcast."""
    years = full_years(months, month=month, min_months=min_months).select("year")
    return months.withColumn("year", F.year(month)).join(F.broadcast(years), "year", "left_semi")


def _latest_years(df: DataFrame, n: int) -> DataFrame:
    """Rows of the ``n`` latest years present; ``n`` rows are broadcast."""
    years = df.select("year").distinct().orderBy(F.col("year").desc()).limit(n)
    return df.join(F.broadcast(years), "year", "left_semi")


def annual_by_bucket(
    months: DataFrame,
    *,
    month: str = "month",
    value: str = "value",
    bucket: str = "bucket",
    min_months: int = 10,
    last_years: int | None = None,
) -> DataFrame:
    """Totals per bucket for every full year, or for the latest ``last_years`` of them."""
    months = kept(months, "months")
    totals = (
        _in_full_years(months, month, min_months).groupBy("year", bucket).agg(F.sum(value).alias(value))
    )
    return totals if last_years is None else _latest_years(totals, last_years)


def latest_year_by_bucket(
    months: DataFrame,
    *,
    buckets: Sequence[str] | None = None,
    month: str = "month",
    value: str = "value",
    bucket: str = "bucket",
    min_months: int = 10,
) -> DataFrame:
    """Totals per bucket of the latest full year. Listed buckets appear even when they are empty."""
    totals = annual_by_bucket(
        months, month=month, value=value, bucket=bucket, min_months=min_months, last_years=1
    )
    if not buckets:
        return totals
    totals = kept(totals, "totals")
    spine = totals.select("year").distinct().select(
        "year", F.explode(F.array(*[F.lit(b) for b in buckets])).alias(bucket)
    )
    return spine.join(totals, ["year", bucket], "left").select(
        "year", bucket, F.coalesce(F.col(value), F.lit(0)).alias(value)
    )


def bucket_matrix(
    months: DataFrame,
    *,
    buckets: Sequence[str],
    month: str = "month",
    value: str = "value",
    bucket: str = "bucket",
    digits: int = 2,
) -> DataFrame:
    """Month rows, one column per listed bucket, 0 where a bucket has no row."""
    wide = months.groupBy(month).pivot(bucket, list(buckets)).agg(F.sum(value))
    return wide.select(
        month, *[F.round(F.coalesce(F.col(f"`{b}`"), F.lit(0)), digits).alias(b) for b in buckets]
    )


def bucket_order(months: DataFrame, *, value: str = "value", bucket: str = "bucket") -> DataFrame:
    """Buckets with their total and position, largest first."""
    totals = months.groupBy(bucket).agg(F.sum(value).alias("total"))
    w = Window.partitionBy(F.lit(1)).orderBy(F.col("total").desc(), F.col(bucket))
    return totals.withColumn("position", F.row_number().over(w))


def annual_sum(months: DataFrame, *, month: str = "month", value: str = "value", digits: int = 1) -> DataFrame:
    return months.groupBy(F.year(month).alias("year")).agg(F.round(F.sum(value), digits).alias(value))


def origin_summary(
    df: DataFrame,
    *,
    origin: Column,
    value_unit: str,
    multiplier: float = 1.0,
    month: str = "month",
    value: str = "value",
    form: str = "form",
    unit: str = "unit",
    weight_unit: str = "KG",
    min_months: int = 10,
) -> DataFrame:
    """Dried-equivalent weight, value and unit price per origin for the latest full year.

    Fullness is judged on weight rows only; an origin needs weight rows, its value may be missing.
    """
    v = measures.amount(df, value)
    is_weight = F.col(unit) == weight_unit
    months = (
        df.filter(F.col(unit).isin(weight_unit, value_unit) & F.col(month).isNotNull())
        .select(
            origin.alias("origin"),
            month,
            form,
            is_weight.alias("_w"),
            F.when(is_weight, v).alias("_kg"),
            F.when(~is_weight, v).alias("_value"),
        )
        .groupBy("origin", month)
        .agg(
            F.max("_w").alias("_has_kg"),
            dried_sum(F.col("_kg"), form).alias("_kg"),
            F.sum("_value").alias("_value"),
        )
        .withColumn("year", F.year(month))
    )
    months = kept(months, "months")
    full = _latest_years(
        months.join(
            F.broadcast(full_years(months.filter("_has_kg"), month=month, min_months=min_months).select("year")),
            "year",
            "left_semi",
        ),
        1,
    )
    totals = full.groupBy("year", "origin").agg(
        F.max("_has_kg").alias("_has_kg"), F.sum("_kg").alias("_kg"), F.sum("_value").alias("_value")
    )
    kg = F.coalesce(F.col("_kg"), F.lit(0)).cast("double")
    usd = F.coalesce(F.col("_value"), F.lit(0)).cast("double") * multiplier
    return (
        totals.filter("_has_kg").select(
            "year",
            "origin",
            F.round(kg, 1).alias("dried_kg"),
            F.round(usd, 0).alias("value"),
            F.when(kg > 0, F.round(usd / kg, 2)).alias("unit_price"),
        )
    )


def with_display(df: DataFrame, columns: dict[str, int], dash: str = "—") -> DataFrame:
    """Adds a thousands-separated ``<column>_display`` for each listed column and digit count."""
    extra = [
        F.coalesce(measures.grouped(F.col(c), digits), F.lit(dash)).alias(f"{c}_display") for c, digits in columns.items()
    ]
    return df.select("*", *extra)


def top_origin_prices(
    df: DataFrame,
    *,
    year: str = "year",
    rank: str = "rank",
    price: str = "price",
    origin: str = "origin",
    top: int = 3,
    tie: Sequence[Column] = (),
    other: str = "Other origins",
) -> DataFrame:
    """Yearly price of the ``top`` origins by row count (best-ranked row) and the mean of the rest.

    Blank origins are "Unknown", a missing rank is 999, a missing price 0, a missing or zero year is
    left out of the series but counted for the ranking of origins.
    """
    rows = df.select(
        F.coalesce(F.nullif(F.trim(F.col(origin)), F.lit("")), F.lit("Unknown")).alias("_origin"),
        F.coalesce(F.col(year), F.lit(0)).alias("_year"),
        F.coalesce(F.col(rank), F.lit(999)).alias("_rank"),
        F.coalesce(F.col(price).cast("bigint"), F.lit(0)).alias("_price"),
        F.struct(*tie).alias("_tie") if tie else F.lit(0).alias("_tie"),
    )
    cells = kept(rows.groupBy("_origin", "_year").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by("_price", F.struct("_rank", "_tie")).alias("_best"),
        F.sum("_price").alias("_sum"),
    ), "cells")
    leaders = (
        cells.groupBy("_origin")
        .agg(F.sum("_n").alias("_size"))
        .orderBy(F.col("_size").desc(), F.col("_origin"))
        .limit(top)
        .select("_origin", F.lit(True).alias("_leads"))
    )
    placed = cells.join(F.broadcast(leaders), "_origin", "left")
    named = F.coalesce(F.col("_leads"), F.lit(False))
    return (
        placed.filter(F.col("_year") != 0)
        .groupBy(F.when(named, F.col("_origin")).otherwise(F.lit(other)).alias("label"), F.col("_year").alias("year"))
        .agg(
            F.max(named).alias("_named"),
            F.max("_best").alias("_best"),
            F.round(F.sum("_sum").cast("double") / F.sum("_n").cast("double"), 0).alias("_mean"),
        )
        .select("label", "year", F.when(F.col("_named"), F.col("_best")).otherwise(F.col("_mean")).cast("bigint").alias("price"))
    )


def best_of_latest_year(
    df: DataFrame, *, year: str = "year", rank: str = "rank", price: str = "price", tie: Sequence[Column] = ()
) -> DataFrame:
    """The best-ranked row of the latest year, as one max_by over (year, -rank)."""
    order = F.struct(F.col(year), -F.coalesce(F.col(rank), F.lit(999)), *tie)
    return df.filter(F.col(year).isNotNull()).agg(
        F.max_by(F.struct(F.col(year).alias("year"), F.col(price).cast("bigint").alias("price")), order).alias("_b")
    ).select("_b.year", "_b.price")


def lowest_rank_rows(df: DataFrame, *, keys: Sequence[str], rank: Column, tie: Sequence[Column]) -> DataFrame:
    """One row per key with the lowest rank."""
    return pick_per_key(df, keys, [rank, *tie])


def totals_by_name(df: DataFrame, *, candidates: Sequence[str], value: str, unknown: str = "Unknown") -> DataFrame:
    """Total per first non-blank name, ``unknown`` where all are blank."""
    from ..functions.names import first_filled

    return df.groupBy(first_filled(*[F.col(c) for c in candidates], default=unknown).alias("name")).agg(
        F.sum(measures.amount(df, value)).alias("total")
    )
