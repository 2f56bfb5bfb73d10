"""Registered queries: breakdowns, full years, rankings, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import breakdown as bd
from ..operators import headline, keyed
from . import series as _series  # noqa: F401  registers purpose_split and origin_price
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add

BUCKETS = [*t.NAMED, "Other"]
LISTED = "(" + ", ".join(f"'{n}'" for n in t.NAMED) + ")"
BUCKET_SQL = f"CASE WHEN country IN {LISTED} THEN country ELSE 'Other' END"
SPINE_SQL = "(VALUES " + ", ".join(f"('{b}')" for b in BUCKETS) + ") AS s(bucket)"
FULL_SQL = "full_y AS (SELECT year(month) AS year FROM obs WHERE unit = 'KG' GROUP BY 1 HAVING count(DISTINCT month(month)) >= 10)"


def bucketed(spark, sf, unit="KG", series=None, dried_form=None):
    keys = ["month", *(["series"] if series else []), *([dried_form] if dried_form else [])]
    obs = t.observation_totals(spark, sf, *keys, unit=unit)
    if series:
        obs = obs.filter(F.col("series") == series)
    return bd.bucket_months(obs, bucket=names.bucket(F.col("country"), t.NAMED), dried_form=dried_form)


@add("destination_months", "A4 F15", f"""
WITH {t.OBS_SQL}
SELECT {BUCKET_SQL} AS bucket, strftime(month, '%Y-%m') AS month, sum(value)::DOUBLE AS value
FROM obs WHERE unit = 'USD' GROUP BY ALL""")
def destination_months(spark, sf):
    return bucketed(spark, sf, "USD").select(
        "bucket", F.date_format("month", "yyyy-MM").alias("month"), F.col("value").cast("double").alias("value")
    )


@add("destination_matrix", "A4 A7", f"""
WITH {t.OBS_SQL}, b AS (SELECT {BUCKET_SQL} AS bucket, month, sum(value) AS v FROM obs WHERE unit = 'KG' GROUP BY ALL)
SELECT strftime(month, '%Y-%m') AS month, {", ".join(f"round(coalesce(sum(v) FILTER (WHERE bucket = '{b}'), 0), 2)::DOUBLE AS {b}" for b in BUCKETS)}
FROM b GROUP BY month""")
def destination_matrix(spark, sf):
    wide = bd.bucket_matrix(bucketed(spark, sf), buckets=BUCKETS)
    return wide.select(F.date_format("month", "yyyy-MM").alias("month"), *[F.col(b).cast("double").alias(b) for b in BUCKETS])


@add("destination_order", "A7", f"""
WITH {t.OBS_SQL}, b AS (SELECT {BUCKET_SQL} AS bucket, sum(value) AS total FROM obs WHERE unit = 'KG' GROUP BY ALL)
SELECT bucket, total::DOUBLE AS total, row_number() OVER (ORDER BY total DESC, bucket)::INTEGER AS position FROM b""")
def destination_order(spark, sf):
    return bd.bucket_order(bucketed(spark, sf)).select("bucket", F.col("total").cast("double").alias("total"), "position")


@add("full_years", "A5", f"""
WITH {t.OBS_SQL}
SELECT year(month)::INTEGER AS year, count(DISTINCT month(month)) AS n_months FROM obs WHERE unit = 'KG'
GROUP BY 1 HAVING count(DISTINCT month(month)) >= 10""")
def full_years(spark, sf):
    return bd.full_years(bucketed(spark, sf))


@add("latest_year_destinations", "A5", f"""
WITH {t.OBS_SQL}, {FULL_SQL}, y AS (SELECT max(year) AS year FROM full_y), v AS (
  SELECT {BUCKET_SQL} AS bucket, sum(value) AS v FROM obs, y WHERE unit = 'KG' AND year(month) = y.year GROUP BY 1)
SELECT y.year::INTEGER AS year, s.bucket, coalesce(v.v, 0)::DOUBLE AS value
FROM y, {SPINE_SQL} LEFT JOIN v ON v.bucket = s.bucket""")
def latest_year_destinations(spark, sf):
    out = bd.latest_year_by_bucket(bucketed(spark, sf), buckets=BUCKETS)
    return out.withColumn("value", F.col("value").cast("double"))


@add("annual_origins", "A6", f"""
WITH {t.OBS_SQL}, {FULL_SQL}
SELECT year(month)::INTEGER AS year, {BUCKET_SQL} AS bucket, sum(value)::DOUBLE AS value
FROM obs WHERE unit = 'KG' AND year(month) IN (SELECT year FROM full_y) GROUP BY 1, 2""")
def annual_origins(spark, sf):
    return bd.annual_by_bucket(bucketed(spark, sf)).withColumn("value", F.col("value").cast("double"))


@add("annual_origins_last_two", "A6", f"""
WITH {t.OBS_SQL}, {FULL_SQL}
SELECT year(month)::INTEGER AS year, {BUCKET_SQL} AS bucket, sum(value)::DOUBLE AS value FROM obs
WHERE unit = 'KG' AND year(month) IN (SELECT year FROM full_y ORDER BY year DESC LIMIT 2) GROUP BY 1, 2""")
def annual_origins_last_two(spark, sf):
    return bd.annual_by_bucket(bucketed(spark, sf), last_years=2).withColumn("value", F.col("value").cast("double"))


@add("annual_sum", "A8", f"""
WITH {t.OBS_SQL}
SELECT year(month)::INTEGER AS year, round(sum(value), 1)::DOUBLE AS value FROM obs
WHERE series = 'F' AND unit = 'USD' GROUP BY 1""")
def annual_sum(spark, sf):
    out = bd.annual_sum(bucketed(spark, sf, "USD", series="F"))
    return out.withColumn("value", F.col("value").cast("double"))


SUMMARY_SQL = f"""
{FULL_SQL}, y AS (SELECT max(year) AS year FROM full_y), kgs AS (
  SELECT country AS origin, sum(value * CASE form WHEN 'frozen' THEN 0.33 ELSE 1 END)::DOUBLE AS kg
  FROM obs, y WHERE unit = 'KG' AND year(month) = y.year GROUP BY 1
), usd AS (SELECT country AS origin, sum(value)::DOUBLE * 1000 AS v FROM obs, y WHERE unit = 'USD' AND year(month) = y.year GROUP BY 1
), summary AS (
SELECT y.year::INTEGER AS year, origin, round(kg, 1) AS dried_kg, round(coalesce(v, 0), 0) AS value,
       CASE WHEN kg > 0 THEN round(coalesce(v, 0) / kg, 2) END AS unit_price FROM y, kgs LEFT JOIN usd USING (origin))"""


@add("origin_summary", "A9 J9", f"WITH {t.OBS_SQL}, {SUMMARY_SQL} SELECT * FROM summary")
def origin_summary(spark, sf):
    obs = t.observation_totals(spark, sf, "month", "form")
    return bd.origin_summary(obs, origin=F.col("country"), value_unit="USD", multiplier=1000.0)


@add("origin_summary_display", "A9 F24", f"""
WITH {t.OBS_SQL}, {SUMMARY_SQL}
SELECT origin, format('{{:,.0f}}', dried_kg) AS dried_kg_display, format('{{:,.0f}}', value) AS value_display,
       coalesce(format('{{:,.2f}}', unit_price), '—') AS unit_price_display FROM summary""")
def origin_summary_display(spark, sf):
    out = bd.with_display(origin_summary(spark, sf), {"dried_kg": 0, "value": 0, "unit_price": 2})
    return out.select("origin", "dried_kg_display", "value_display", "unit_price_display")


@add("direct_supply", "A10", f"""
WITH {t.OBS_SQL}, {FULL_SQL}, y AS (SELECT max(year) AS year FROM full_y), v AS (
  SELECT {BUCKET_SQL} AS bucket, sum(value * CASE form WHEN 'frozen' THEN 0.33 ELSE 1 END) AS v
  FROM obs, y WHERE unit = 'KG' AND year(month) = y.year GROUP BY 1), r AS (
SELECT y.year::INTEGER AS year, s.bucket, round(coalesce(v.v, 0)::DOUBLE, 1) AS dried_kg
FROM y, {SPINE_SQL} LEFT JOIN v ON v.bucket = s.bucket)
SELECT *, format('{{:,.1f}}', dried_kg / 1000) AS tonnes FROM r""")
def direct_supply(spark, sf):
    return headline.direct_supply(bd.latest_year_by_bucket(bucketed(spark, sf, dried_form="form"), buckets=BUCKETS))


#: Registered analysis, its label and its measures.
BUNDLE = {
    "origin_summary": ("origin", ["dried_kg", "value", "unit_price"]),
    "purpose_split": ("as_of", ["total_t", "estimate_t", "rest_t", "estimate_pct", "rest_pct"]),
    "direct_supply": ("bucket", ["dried_kg"]),
    "origin_price": ("month", ["price"]),
}


@add("triangulation", "A28", "\nUNION ALL\n".join(
    f"SELECT '{part}' AS part, {label}::VARCHAR AS label, '{m}' AS measure, {m}::DOUBLE AS value FROM ({REGISTRY.sql[part]})"
    for part, (label, measures) in BUNDLE.items() for m in measures))
def triangulation(spark, sf):
    return headline.triangulation(
        {part: (REGISTRY.queries[part](spark, sf), label, measures) for part, (label, measures) in BUNDLE.items()}
    )


@add("region_annual", "A6 J7", """
WITH v AS (
  SELECT r_name AS bucket, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity::DECIMAL(18,3)) AS v
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
), f AS (SELECT year(month) AS year FROM v GROUP BY 1 HAVING count(DISTINCT month(month)) >= 12)
SELECT year(month)::INTEGER AS year, bucket, sum(v)::DOUBLE AS value FROM v WHERE year(month) IN (SELECT year FROM f) GROUP BY 1, 2""")
def region_annual(spark, sf):
    dim = t.table(spark, sf, "nation").join(t.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    obs = t.observation_totals(spark, sf, "month", unit="KG")
    rows = obs.join(dim, obs.country == dim.n_name, "left")
    months = bd.bucket_months(rows, bucket=F.coalesce("r_name", F.lit("Other")))
    return bd.annual_by_bucket(months, min_months=12).withColumn("value", F.col("value").cast("double"))


@add("top_origin_prices", "A16 W6", f"""
WITH {t.PRICE_SQL}, lead AS (SELECT origin FROM price GROUP BY origin ORDER BY count(*) DESC, origin LIMIT 3), named AS (
  SELECT origin AS label, year, arg_min(price, rank) AS price FROM price WHERE origin IN (SELECT origin FROM lead) GROUP BY ALL
), rest AS (
  SELECT 'Other origins' AS label, year, round(sum(price)::DOUBLE / count(*), 0)::BIGINT AS price FROM price
  WHERE origin NOT IN (SELECT origin FROM lead) GROUP BY year)
SELECT label, year::INTEGER AS year, price FROM named UNION ALL SELECT label, year::INTEGER, price FROM rest""")
def top_origin_prices(spark, sf):
    return bd.top_origin_prices(t.prices(spark, sf), tie=[F.col("product_name")])


@add("best_of_latest_year", "A17", f"""
WITH {t.PRICE_SQL}
SELECT year::INTEGER AS year, price FROM price WHERE year = (SELECT max(year) FROM price) ORDER BY rank LIMIT 1""")
def best_of_latest_year(spark, sf):
    return bd.best_of_latest_year(t.prices(spark, sf))


@add("lowest_rank_rows", "W6 W4", f"""
WITH {t.PRICE_SQL}
SELECT origin, year::INTEGER AS year, min(rank) AS rank, arg_min(product_name, rank) AS product_name,
       arg_min(price, rank) AS price FROM price GROUP BY ALL""")
def lowest_rank_rows(spark, sf):
    return bd.lowest_rank_rows(t.prices(spark, sf), keys=["origin", "year"], rank=F.col("rank"), tie=[F.col("product_name")])


@add("importer_totals_top", "A22 T1", f"""
WITH {t.REC_SQL}
SELECT coalesce(nullif(trim(importer_en), ''), nullif(trim(importer_local), ''), 'Unknown') AS name, sum(quantity)::DOUBLE AS total
FROM rec GROUP BY 1 ORDER BY sum(quantity) DESC, name LIMIT 20""")
def importer_totals_top(spark, sf):
    totals = bd.totals_by_name(t.import_records(spark, sf), candidates=["importer_en", "importer_local"], value="quantity")
    return keyed.top_k(totals, [F.col("total").desc(), F.col("name")], 20).select("name", F.col("total").cast("double").alias("total"))


@add("importer_totals", "A22", f"""
WITH {t.REC_SQL}
SELECT coalesce(nullif(trim(importer_en), ''), 'Unknown') AS name, sum(quantity)::DOUBLE AS total FROM rec GROUP BY 1""")
def importer_totals(spark, sf):
    totals = bd.totals_by_name(t.import_records(spark, sf), candidates=["importer_en"], value="quantity")
    return totals.withColumn("total", F.col("total").cast("double"))


@add("recent_articles", "T2", """
SELECT event_id, event_type, ts::DATE AS day FROM events ORDER BY ts DESC, event_id LIMIT 20""")
def recent_articles(spark, sf):
    e = t.table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("day"), "ts")
    return keyed.top_k(e, [F.col("ts").desc(), F.col("event_id")], 20).drop("ts")


@add("brief_inputs", "T3 U1", f"""
WITH {t.REC_SQL}, {t.ART_SQL}
SELECT * FROM (SELECT 'news' AS kind, raw_ref AS id, day FROM art WHERE relevant ORDER BY day DESC, raw_ref LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'record' AS kind, record_id AS id, day FROM rec ORDER BY day DESC, record_id LIMIT 2)""")
def brief_inputs(spark, sf):
    news = keyed.top_k(t.document_articles(spark, sf).filter("relevant"), [F.col("day").desc(), F.col("raw_ref")], 3)
    recs = keyed.top_k(t.import_records(spark, sf), [F.col("day").desc(), F.col("record_id")], 2)
    return news.select(F.lit("news").alias("kind"), F.col("raw_ref").alias("id"), "day").unionByName(
        recs.select(F.lit("record").alias("kind"), F.col("record_id").alias("id"), "day")
    )


@add("records_newest_first", "T5", f"WITH {t.REC_SQL} SELECT record_id, day, importer_local FROM rec ORDER BY day DESC, record_id")
def records_newest_first(spark, sf):
    return t.import_records(spark, sf).select("record_id", "day", "importer_local").orderBy(F.col("day").desc(), "record_id")


@add("sorted_customs", "T6", f"""
WITH {t.OBS_SQL}
SELECT strftime(month, '%Y-%m') AS period, country, form, sum(value)::DOUBLE AS value FROM obs WHERE unit = 'KG'
GROUP BY ALL ORDER BY period, country, form""")
def sorted_customs(spark, sf):
    obs = t.observations(spark, sf, unit="KG")
    out = obs.groupBy(F.date_format("month", "yyyy-MM").alias("period"), "country", "form").agg(
        F.sum("value").cast("double").alias("value")
    )
    return out.orderBy("period", "country", "form")


@add("country_picker", "A25 J7", """
SELECT DISTINCT CASE n_name WHEN 'NATION_0' THEN 'Origin A' WHEN 'NATION_1' THEN 'Origin B' ELSE n_name END AS country
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def country_picker(spark, sf):
    labels = {"NATION_0": "Origin A", "NATION_1": "Origin B"}
    rows = t.observations(spark, sf).select("country").distinct()
    return rows.select(names.mapped(F.col("country"), labels).alias("country")).distinct().orderBy("country")


@add("month_union_bounds", "U2", """
SELECT strftime(min(mo), '%Y-%m') AS first_month, strftime(max(mo), '%Y-%m') AS last_month FROM (
  SELECT date_trunc('month', l_shipdate)::DATE AS mo FROM lineitem UNION
  SELECT date_trunc('month', o_orderdate)::DATE FROM orders)""")
def month_union_bounds(spark, sf):
    a = t.table(spark, sf, "lineitem").select(F.trunc("l_shipdate", "month").alias("mo"))
    b = t.table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("mo"))
    return a.union(b).agg(
        F.date_format(F.min("mo"), "yyyy-MM").alias("first_month"), F.date_format(F.max("mo"), "yyyy-MM").alias("last_month")
    )


@add("common_months", "U3", """
SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS month FROM lineitem INTERSECT SELECT strftime(o_orderdate, '%Y-%m') FROM orders""")
def common_months(spark, sf):
    a = t.table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    b = t.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return a.distinct().intersect(b.distinct())


@add("months_without_orders", "U4", """
SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS month FROM lineitem EXCEPT SELECT strftime(o_orderdate, '%Y-%m') FROM orders""")
def months_without_orders(spark, sf):
    a = t.table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    b = t.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return a.distinct().subtract(b.distinct())
