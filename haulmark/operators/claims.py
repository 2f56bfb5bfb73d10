"""Figures quoted in a text, checked against computed reference figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures, names

# The cited-figure pattern and the unit names it may carry.
CITED = r"(?i)(\d[\d,]*\.?\d*)\s*(%|kg|kilograms?|tonnes?|dmt|articles?|declarations?|records?)"
UNITS = {
    "%": "%",
    "kg": "kg",
    "kilogram": "kg",
    "kilograms": "kg",
    "tonne": "tonnes",
    "tonnes": "tonnes",
    "dmt": "tonnes",
    "article": "articles",
    "articles": "articles",
    "declaration": "declarations",
    "declarations": "declarations",
    "record": "records",
    "records": "records",
}
ABSOLUTE_TOLERANCE = 0.5
RELATIVE_TOLERANCE = 0.02


def extract_claims(df: DataFrame, *, key: Sequence[str], text: str) -> DataFrame:
    """One row per cited figure: position, text as written, unit and value."""
    numbers = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(CITED), F.lit(1))
    unit_words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(CITED), F.lit(2))
    rows = df.select(*key, F.posexplode(F.arrays_zip(numbers.alias("n"), unit_words.alias("u"))).alias("position", "c"))
    return rows.select(
        *key,
        "position",
        F.concat("c.n", "c.u").alias("cited"),
        F.element_at(names.literal_map(UNITS), F.lower("c.u")).alias("unit"),
        F.regexp_replace("c.n", ",", "").try_cast("double").alias("value"),
    )


def reference_figures(kpis: DataFrame, figures: Sequence[tuple[str, Column]]) -> DataFrame:
    """``(unit, value)`` rows out of a headline row.

    Each figure is a unit and a text column; percent columns give every percentage in their label,
    others their number. Figures that are not computable are left out.
    """

    def tagged(unit: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(unit).alias("unit"), v.alias("value")))

    parts = [
        tagged(unit, measures.percentages(c) if unit == "%" else F.array(measures.pure_number(c))) for unit, c in figures
    ]
    rows = kpis.select(F.explode(F.concat(*parts)).alias("f")).select("f.unit", "f.value")
    return rows.filter(F.col("value").isNotNull()).distinct()


def within_tolerance(cited: Column, reference: Column) -> Column:
    """Equal within 0.5, or within 2 % of a non-zero reference."""
    gap = F.abs(cited - reference)
    return (gap <= ABSOLUTE_TOLERANCE) | (
        (reference != 0) & (gap / F.abs(F.when(reference != 0, reference)) <= RELATIVE_TOLERANCE)
    )


def _figure_map(figures: DataFrame) -> Column:
    """All reference figures as one scalar map unit -> values. A handful of numbers by construction."""
    per_unit = figures.groupBy("unit").agg(F.collect_set("value").alias("known"))
    return per_unit.agg(F.map_from_entries(F.collect_list(F.struct("unit", "known"))).alias("m")).scalar()


def _supported(unit: Column, value: Column, known: Column) -> Column:
    values = F.coalesce(F.try_element_at(known, unit), F.array().cast("array<double>"))
    return F.coalesce(F.exists(values, lambda k: within_tolerance(value, k)), F.lit(False))


def unsupported_claims(claims: DataFrame, figures: DataFrame) -> DataFrame:
    """Claims that no reference figure of their unit supports; a filter, no join."""
    rows = claims.filter(F.col("unit").isNotNull()).select("*", _figure_map(figures).alias("_known"))
    return rows.filter(~_supported(F.col("unit"), F.col("value"), F.col("_known"))).drop("_known")


# Fixed value: lead-in of the review detail.
DETAIL_LEAD = "not found among this build's figures: "


def check_texts(df: DataFrame, figures: DataFrame, *, key: Sequence[str], text: str) -> DataFrame:
    """Every text with its status (``ok`` or ``review_needed``) and the unsupported figures in order.

    A narrow projection: the figures of a text stay in an array of that row, so nothing is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    numbers, words = (F.regexp_extract_all(body, F.lit(CITED), F.lit(g)) for g in (1, 2))
    units = names.literal_map(UNITS)
    cited = df.select(*key, F.arrays_zip(numbers.alias("n"), words.alias("u")).alias("_c"), units.alias("_units"), _figure_map(figures).alias("_known"))
    wrong = F.filter(
        "_c",
        lambda c: ~_supported(
            F.element_at(F.col("_units"), F.lower(c["u"])), F.regexp_replace(c["n"], ",", "").try_cast("double"), F.col("_known")
        ),
    )
    listed = cited.select(*key, F.transform(wrong, lambda c: F.concat(c["n"], c["u"])).alias("_w"))
    none = F.size("_w") == 0
    return listed.select(
        *key,
        F.when(none, "ok").otherwise("review_needed").alias("status"),
        F.when(none, "").otherwise(F.concat(F.lit(DETAIL_LEAD), F.array_join("_w", ", "))).alias("detail"),
    )
