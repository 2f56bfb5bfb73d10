"""Product forms, equivalents and blended prices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures, names

# Fixed value: weight kept when the frozen form is dried.
DRIED_PER_FROZEN = "0.33"


def form_key(form: str | Column) -> Column:
    c = F.col(form) if isinstance(form, str) else form
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def backfill_form(
    df: DataFrame,
    *,
    form: str = "form",
    series: str = "series",
    notes: str = "notes",
    by_series: Mapping[str, tuple[Sequence[tuple[Sequence[str], str]], str]] | None = None,
    default: str = "other",
) -> DataFrame:
    """Fills a blank form: per series by ordered note rules with their own default, else ``default``."""
    inferred = F.lit(default)
    for name, (rules, fallback) in (by_series or {}).items():
        inferred = F.when(F.col(series) == name, names.first_rule(F.col(notes), rules, fallback)).otherwise(inferred)
    return df.withColumn(form, F.coalesce(names.blank_to_null(F.col(form)), inferred))


def dried_equivalent(value: Column, form: str | Column = "form", factor: str = DRIED_PER_FROZEN) -> Column:
    """Frozen weight times the factor, every other form unchanged; for single rows."""
    return value * F.when(form_key(form) == "frozen", F.lit(factor).cast("decimal(5,4)")).otherwise(
        F.lit("1").cast("decimal(5,4)")
    )


def dried_sum(value: Column, form: str | Column = "form", factor: str = DRIED_PER_FROZEN) -> Column:
    """Aggregate: dried-equivalent sum, NULL when there is no value.

    The factor is applied to the sum of the frozen rows, not to each of them: same exact decimal,
    no multiplication per row.
    """
    frozen = form_key(form) == "frozen"
    part = lambda test: F.coalesce(F.sum(F.when(test, value)), F.lit(0))
    total = part(frozen) * F.lit(factor).cast("decimal(5,4)") + part(~frozen)
    return F.when(F.count(value) > 0, total)


def dried_monthly(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    month: str = "month",
    value: str = "value",
    form: str = "form",
    unit: tuple[str, str] = ("unit", "KG"),
    out: str = "dried_kg",
) -> DataFrame:
    """Dried-equivalent sum per key and month."""
    rows = df.filter(F.col(unit[0]) == unit[1]).filter(F.col(month).isNotNull())
    rows = rows.select(*keys, month, form, measures.amount(df, value).alias("_v")).filter(F.col("_v").isNotNull())
    return rows.groupBy(*keys, month).agg(dried_sum(F.col("_v"), form).alias(out))


def frozen_equivalent_totals(
    df: DataFrame,
    *,
    keys: Sequence[str],
    value: str = "value",
    form: str = "form",
    factor: str = DRIED_PER_FROZEN,
) -> DataFrame:
    """Fresh, dried and other totals in frozen equivalent (dried weight divided by the factor).

    The division is applied once to the exact sum.
    """
    v = measures.amount(df, value)
    f = F.coalesce(F.col(form), F.lit(""))
    zero = F.lit(0).cast("decimal(28,3)")
    return (
        df.select(*keys, v.alias("_v"), f.alias("_f"))
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.when(F.col("_f") == "frozen", F.col("_v"))), zero).cast("double").alias("fresh"),
            (
                F.coalesce(F.sum(F.when(F.col("_f") == "dried", F.col("_v"))), zero).cast("double")
                / F.lit(float(factor))
            ).alias("dried"),
            F.coalesce(F.sum(F.when(~F.col("_f").isin("frozen", "dried"), F.col("_v"))), zero)
            .cast("double")
            .alias("other"),
        )
    )


def blended_price(
    df: DataFrame,
    *,
    value_unit: str,
    multiplier: float = 1.0,
    keys: Sequence[str] = (),
    month: str = "month",
    value: str = "value",
    form: str = "form",
    unit: str = "unit",
    weight_unit: str = "KG",
    out: str = "price",
) -> DataFrame:
    """Value per dried-equivalent kilogram and month, two decimals.

    Only months holding both units, and only where the weight is positive. One aggregate over one
    scan gives both sums.
    """
    is_weight = F.col(unit) == weight_unit
    v = measures.amount(df, value)
    rows = df.filter(F.col(unit).isin(weight_unit, value_unit) & F.col(month).isNotNull()).select(
        *keys, month, form, F.when(is_weight, v).alias("_w"), F.when(~is_weight, v).alias("_v")
    )
    sums = rows.groupBy(*keys, month).agg(dried_sum(F.col("_w"), form).alias("_kg"), F.sum("_v").alias("_value"))
    price = F.round(F.col("_value").cast("double") * multiplier / F.col("_kg").cast("double"), 2)
    return sums.filter((F.col("_kg") > 0) & F.col("_value").isNotNull()).select(*keys, month, price.alias(out))


def origin_price(df: DataFrame, *, origin: tuple[str, str], value_unit: str, multiplier: float = 1.0, **kw) -> DataFrame:
    """Blended price series of one origin, with the latest point of each key flagged."""
    month, keys = kw.get("month", "month"), kw.get("keys") or [F.lit(1)]
    prices = blended_price(
        df.filter(F.trim(F.col(origin[0])) == origin[1]), value_unit=value_unit, multiplier=multiplier, **kw
    )
    # One row per key and month: a bounded window instead of a second pass over the facts.
    return prices.withColumn("is_latest", F.col(month) == F.max(month).over(Window.partitionBy(*keys)))
