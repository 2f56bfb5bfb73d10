"""Headline figures, triangulation and the chart bundle, composed from the series operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, measures
from ..session import kept
from . import series as ts
from .units import dried_monthly, dried_sum


def purpose_split(
    rolling: DataFrame,
    *,
    estimate: Column,
    month: str = "month",
    value: str = "rolling",
    reference_period: str = "an earlier period",
) -> DataFrame:
    """Latest rolling total (tonnes) less an outside estimate, with shares.

    Not available when an input is missing, the total is not positive, or the estimate reaches the
    total; the last case carries a reason. The second share is 100 minus the first.
    """
    latest = rolling.agg(F.max(month).alias("as_of"), F.max_by(value, month).alias("_v"))
    total = F.round(F.col("_v").cast("double") / 1000.0, 1)
    known = latest.select("as_of", total.alias("total_t"), estimate.cast("double").alias("estimate_t"))
    has_input = F.col("as_of").isNotNull() & F.col("estimate_t").isNotNull() & (F.col("total_t") > 0)
    available = has_input & (F.col("estimate_t") < F.col("total_t"))
    share = F.round(F.col("estimate_t") / F.col("total_t") * 100, 1)
    return known.select(
        F.coalesce(available, F.lit(False)).alias("available"),
        F.when(available, dates.month_text(F.col("as_of"))).alias("as_of"),
        F.when(available, F.col("total_t")).alias("total_t"),
        F.when(available, F.col("estimate_t")).alias("estimate_t"),
        F.when(available, F.round(F.col("total_t") - F.col("estimate_t"), 1)).alias("rest_t"),
        F.when(available, share).alias("estimate_pct"),
        F.when(available, F.round(100 - share, 1)).alias("rest_pct"),
        F.when(
            has_input & ~available,
            F.lit(f"the estimate covers {reference_period} and is not below the current rolling total"),
        ).alias("reason"),
    )


def direct_supply(by_bucket: DataFrame, *, value: str = "value", bucket: str = "bucket") -> DataFrame:
    """Destination totals rounded to a decimal, plus a tonnes display."""
    v = F.round(F.col(value).cast("double"), 1)
    return by_bucket.select("year", bucket, v.alias("dried_kg"), measures.grouped(v / 1000, 1).alias("tonnes"))


def triangulation(parts: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """The derived analyses as one table (part, label, measure, value).

    ``parts`` names each analysis with its rows, the column that labels a row and its measures. They are computed by their
    own operators; nothing is derived again.
    """
    out = None
    for part, (rows, label, measures_of) in parts.items():
        long = rows.select(
            F.lit(part).alias("part"),
            F.col(label).cast("string").alias("label"),
            F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures_of])).alias("_m"),
        ).select("part", "label", "_m.measure", "_m.value")
        out = long if out is None else out.unionByName(long)
    if out is None:
        raise ValueError("no analyses given")
    return out


def trailing_count(df: DataFrame, *, day: str, as_of: Column, days: int = 90, keep: Column | None = None) -> Column:
    """Scalar count of rows dated within ``days`` of ``as_of`` that pass ``keep``."""
    d = dates.day_of(df, day)
    test = (d >= F.date_sub(as_of, days)) & (keep if keep is not None else F.lit(True))
    return df.agg(F.count_if(F.coalesce(test, F.lit(False))).alias("n")).scalar()


def latest_points(df: DataFrame, *, keys: Sequence[str], month: str = "month", value: str = "rolling") -> DataFrame:
    """Per key: latest month, its value, the previous present value and the value a year before."""
    rows = ts.prior_year(ts.delta_previous(df, keys=keys, month=month, value=value), keys=keys, month=month, value=value)
    point = F.struct(
        F.col(month).alias("month"), F.col(value).alias("value"), F.col("delta_pct"), F.col("prior").alias("prior")
    )
    return rows.groupBy(*keys).agg(F.max_by(point, F.col(month)).alias("_p")).select(*keys, "_p.*")


def headline_kpis(
    observations: DataFrame,
    *,
    export_series: str,
    import_series: str,
    articles: Column,
    declarations: Column,
    series: str = "series",
    **kw,
) -> DataFrame:
    """One display row: export total in tonnes with its change, import total with its range and
    year-on-year label, and the two trailing counts. Missing parts show a dash.
    """
    rows = observations.filter(F.col(series).isin(export_series, import_series))
    rolled = ts.rolling(dried_monthly(rows, keys=[series], **kw), keys=[series], value="dried_kg")
    latest = latest_points(rolled, keys=[series])
    one = latest.agg(
        F.max_by(F.struct("month", "value", "delta_pct", "prior"), F.when(F.col(series) == export_series, 1)).alias("x"),
        F.max_by(F.struct("month", "value", "delta_pct", "prior"), F.when(F.col(series) == import_series, 1)).alias("m"),
    )
    dash = F.lit("—")

    def signed(pct: Column) -> Column:
        return F.when(pct >= 0, F.format_string("▲ %.1f%%", pct)).otherwise(F.format_string("▼ %.1f%%", F.abs(pct)))

    import_yoy = measures.percent_change(F.col("m.value"), F.col("m.prior"), digits=None)
    start, end = ts.rolling_range(F.col("m.month"))
    return one.select(
        F.coalesce(measures.grouped(F.round(F.col("x.value").cast("double") / 1000, 1), 1), dash).alias("export_tonnes"),
        F.coalesce(F.when(F.col("x.delta_pct").isNotNull(), signed(F.col("x.delta_pct"))), dash).alias("export_delta"),
        F.coalesce(measures.grouped(F.col("m.value"), 0), dash).alias("import_kg"),
        F.coalesce(start, dash).alias("import_start"),
        F.coalesce(end, dash).alias("import_end"),
        F.coalesce(
            F.when(
                import_yoy.isNotNull(),
                F.concat(signed(import_yoy), F.lit(" vs "), dates.month_label(F.add_months("m.month", -12))),
            ),
            dash,
        ).alias("import_yoy"),
        articles.cast("string").alias("articles_90d"),
        declarations.cast("string").alias("declarations_90d"),
    )


def chart_payload(
    observations: DataFrame,
    *,
    value_unit: str,
    multiplier: float = 1.0,
    months: int = 24,
    series: str = "series",
    month: str = "month",
    value: str = "value",
    form: str = "form",
    unit: str = "unit",
    weight_unit: str = "KG",
) -> DataFrame:
    """Every series in one shared window: weight, dried weight, rolling total, price, year-on-year.

    One scan and one aggregate by (series, month) feed all columns. Missing months show 0 in the
    four measures and NULL in the change.
    """
    v = measures.amount(observations, value)
    is_weight = F.col(unit) == weight_unit
    base = (
        observations.filter(F.col(unit).isin(weight_unit, value_unit) & F.col(month).isNotNull())
        .select(
            series,
            month,
            form,
            F.when(is_weight, v).alias("kg"),
            F.when(~is_weight, v).alias("_value"),
        )
        .groupBy(series, month)
        .agg(F.sum("kg").alias("kg"), dried_sum(F.col("kg"), form).alias("dried_kg"), F.sum("_value").alias("_value"))
    )
    base = kept(base, "chart")
    priced = base.withColumn(
        "price",
        F.when(F.col("dried_kg") > 0, F.round(F.col("_value").cast("double") * multiplier / F.col("dried_kg").cast("double"), 2)),
    ).filter(F.col("kg").isNotNull())
    rolled = ts.yoy(ts.rolling(priced, keys=[series], month=month, value="dried_kg"), keys=[series], month=month)
    window = ts.display_window(base.filter(F.col("kg").isNotNull()), month=month, n=months)
    dense = ts.densify(
        rolled, keys=[series], month=month, values=["kg", "dried_kg", "rolling", "price", "yoy_pct"], window=window, fill="null"
    )
    return dense.select(
        series,
        dates.month_text(F.col(month)).alias("month"),
        *[F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), 2).alias(c) for c in ["kg", "dried_kg", "rolling", "price"]],
        "yoy_pct",
    )


def interactive_filter(
    df: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    country: tuple[Column, str] | None = None,
    form: tuple[str, str] | None = None,
    month: str = "month",
) -> DataFrame:
    """Conjunction of the optional month, mapped-country and form filters."""
    df = ts.month_range(df, start, end, month=month)
    if country:
        df = df.filter(country[0] == country[1])
    if form:
        df = df.filter(F.col(form[0]) == form[1])
    return df
