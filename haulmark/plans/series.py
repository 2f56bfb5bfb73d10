"""Registered queries: monthly series, prices, windows and headline figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, measures
from ..operators import breakdown, headline, units
from ..operators import series as ts
from ..session import kept
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add

# Reviewed date of the observation tables: queries take "today" as an argument.
AS_OF = "2001-09-15"

DRIED_SQL = """
dried AS (
  SELECT series, month, sum(value * CASE form WHEN 'frozen' THEN 0.33 ELSE 1 END) AS dried_kg
  FROM obs WHERE unit = 'KG' GROUP BY series, month
), rolled AS (
  SELECT series, month, dried_kg,
         sum(dried_kg) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS rolling
  FROM dried
), prior AS (
  SELECT r.*, p.rolling AS prior, lag(r.rolling) OVER (PARTITION BY r.series ORDER BY r.month) AS before
  FROM rolled r LEFT JOIN rolled p ON p.series = r.series AND p.month = (r.month - INTERVAL 12 MONTH)::DATE
)"""


def m(c="month"):
    return dates.month_text(F.col(c)).alias("month")


def d(c, out=None):
    return F.col(c).cast("double").alias(out or c)


def rolled(spark, sf):
    dried = units.dried_monthly(t.observations(spark, sf, unit="KG"), keys=["series"])
    return ts.rolling(dried, keys=["series"], value="dried_kg")


@add("monthly_sum", "A1 A23 P1 P2", f"""
WITH {t.OBS_SQL}
SELECT series, strftime(month, '%Y-%m') AS month, sum(value)::DOUBLE AS value
FROM obs WHERE unit = 'KG' GROUP BY ALL""")
def monthly_sum(spark, sf):
    return ts.monthly_sum(t.observations(spark, sf, unit="KG"), keys=["series"], unit=("unit", "KG")).select("series", m(), d("value"))


@add("dried_monthly", "A2 F16", f"""
WITH {t.OBS_SQL}, filled AS (
  SELECT month, series, unit, value,
         CASE WHEN form <> 'other' THEN form
              WHEN series = 'O' THEN CASE WHEN notes LIKE '%line 1%' OR notes LIKE '%line 2%' THEN 'frozen' ELSE 'dried' END
              ELSE 'other' END AS form
  FROM obs)
SELECT series, strftime(month, '%Y-%m') AS month,
       sum(value * CASE form WHEN 'frozen' THEN 0.33 ELSE 1 END)::DOUBLE AS dried_kg
FROM filled WHERE unit = 'KG' GROUP BY ALL""")
def dried_monthly(spark, sf):
    obs = units.backfill_form(
        t.observations(spark, sf, unit="KG", blank_form=True),
        by_series={"O": ([(["line 1", "line 2"], "frozen")], "dried")},
    )
    return units.dried_monthly(obs, keys=["series"]).select("series", m(), d("dried_kg"))


@add("rolling_yoy", "W1 Z1 J10 A2", f"""
WITH {t.OBS_SQL}, {DRIED_SQL}
SELECT series, strftime(month, '%Y-%m') AS month, dried_kg::DOUBLE AS dried_kg, rolling::DOUBLE AS rolling,
       CASE WHEN prior <> 0 THEN round((rolling::DOUBLE - prior::DOUBLE) / prior::DOUBLE * 100, 1) END AS yoy_pct
FROM prior""")
def rolling_yoy(spark, sf):
    return ts.yoy(rolled(spark, sf), keys=["series"]).select("series", m(), d("dried_kg"), d("rolling"), "yoy_pct")


@add("rolling_calendar", "W1", f"""
WITH {t.OBS_SQL}, k AS (
  SELECT series, country, month, sum(value) AS v FROM obs WHERE unit = 'KG' GROUP BY ALL)
SELECT a.series, a.country, strftime(a.month, '%Y-%m') AS month, sum(b.v)::DOUBLE AS rolling
FROM k a JOIN k b ON a.series = b.series AND a.country = b.country
 AND b.month BETWEEN (a.month - INTERVAL 2 MONTH)::DATE AND a.month
GROUP BY a.series, a.country, a.month""")
def rolling_calendar(spark, sf):
    keys = ["series", "country"]
    base = ts.monthly_sum(t.observations(spark, sf, unit="KG"), keys=keys, unit=("unit", "KG"))
    return ts.rolling(base, keys=keys, n=3, frame="calendar").select(*keys, m(), d("rolling"))


@add("rolling_delta", "W2", f"""
WITH {t.OBS_SQL}, {DRIED_SQL}
SELECT series, strftime(month, '%Y-%m') AS month,
       CASE WHEN before <> 0 THEN round((rolling::DOUBLE - before::DOUBLE) / before::DOUBLE * 100, 6) END AS delta_pct
FROM prior""")
def rolling_delta(spark, sf):
    return ts.delta_previous(rolled(spark, sf), keys=["series"]).select("series", m(), F.round("delta_pct", 6).alias("delta_pct"))


PRICE_PARTS = """
kgs AS (SELECT {keys} month, sum(value * CASE form WHEN 'frozen' THEN 0.33 ELSE 1 END) AS kg FROM obs WHERE unit = 'KG' {where} GROUP BY ALL),
usd AS (SELECT {keys} month, sum(value) AS v FROM obs WHERE unit = 'USD' {where} GROUP BY ALL)"""


@add("blended_price", "A3 J8 U3", f"""
WITH {t.OBS_SQL}, {PRICE_PARTS.format(keys='series, country,', where='')}
SELECT series, country, strftime(month, '%Y-%m') AS month, round(v::DOUBLE * 1000 / kg::DOUBLE, 2) AS price
FROM kgs JOIN usd USING (series, country, month) WHERE kg > 0""")
def blended_price(spark, sf):
    keys = ["series", "country"]
    return units.blended_price(t.observations(spark, sf), value_unit="USD", multiplier=1000.0, keys=keys).select(
        *keys, m(), "price"
    )


@add("origin_price", "A11 P17", f"""
WITH {t.OBS_SQL}, {PRICE_PARTS.format(keys='', where="AND country = 'NATION_3'")}
SELECT strftime(month, '%Y-%m') AS month, round(v::DOUBLE * 1000 / kg::DOUBLE, 2) AS price,
       month = (SELECT max(month) FROM kgs JOIN usd USING (month) WHERE kg > 0) AS is_latest
FROM kgs JOIN usd USING (month) WHERE kg > 0""")
def origin_price(spark, sf):
    out = units.origin_price(t.observations(spark, sf), origin=("country", "NATION_3"), value_unit="USD", multiplier=1000.0)
    return out.select(m(), "price", "is_latest")


@add("densified_window", "Z2 Z5 T7 U2 P3", f"""
WITH {t.OBS_SQL}, k AS (
  SELECT country, month, sum(value) AS v FROM obs WHERE unit = 'KG' AND form = 'frozen' AND series = 'F' GROUP BY ALL
), w AS (SELECT max(month) AS e FROM obs WHERE unit = 'KG'), spine AS (
  SELECT c.country, g.month::DATE AS month FROM (SELECT DISTINCT country FROM k) c, w,
         generate_series((e - INTERVAL 23 MONTH)::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 MONTH) AS g(month))
SELECT country, strftime(month, '%Y-%m') AS month, round(coalesce(v, 0), 2)::DOUBLE AS value
FROM spine LEFT JOIN k USING (country, month)""")
def densified_window(spark, sf):
    obs = t.observations(spark, sf, unit="KG")
    months = kept(ts.monthly_sum(obs, keys=["series", "form", "country"], unit=("unit", "KG")), "months")
    base = months.filter("form = 'frozen' and series = 'F'")
    window = ts.display_window(months)
    return ts.densify(base, keys=["country"], window=window).select("country", m(), F.round("value", 2).cast("double").alias("value"))


@add("densified_carry", "Z2", f"""
WITH {t.OBS_SQL}, k AS (
  SELECT series, country, month, sum(value) AS v FROM obs WHERE unit = 'KG' AND form = 'frozen' GROUP BY ALL
), b AS (SELECT series, country, min(month) AS s, max(month) AS e FROM k GROUP BY ALL), spine AS (
  SELECT series, country, unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM b)
SELECT series, country, strftime(month, '%Y-%m') AS month,
       (last_value(v IGNORE NULLS) OVER (PARTITION BY series, country ORDER BY month
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS value
FROM spine LEFT JOIN k USING (series, country, month)""")
def densified_carry(spark, sf):
    keys = ["series", "country"]
    base = kept(ts.monthly_sum(t.observations(spark, sf, unit="KG").filter("form = 'frozen'"), keys=keys, unit=("unit", "KG")), "months")
    return ts.densify(base, keys=keys, fill="carry").select(*keys, m(), d("value"))


@add("window_months", "P3 T7 Z5", f"""
WITH {t.OBS_SQL}, k AS (SELECT series, month, sum(value) AS v FROM obs WHERE unit = 'KG' GROUP BY ALL)
SELECT series, strftime(month, '%Y-%m') AS month, v::DOUBLE AS value FROM k
WHERE month BETWEEN ((SELECT max(month) FROM k) - INTERVAL 23 MONTH)::DATE AND (SELECT max(month) FROM k)""")
def window_months(spark, sf):
    base = kept(ts.monthly_sum(t.observations(spark, sf, unit="KG"), keys=["series"], unit=("unit", "KG")), "months")
    return ts.in_window(base, ts.display_window(base)).select("series", m(), d("value"))


@add("season_boundaries", "Z3", """
WITH w AS (SELECT date_trunc('month', min(l_shipdate)) AS s, date_trunc('month', max(l_shipdate)) AS e FROM lineitem)
SELECT strftime(g.month, '%Y-%m') AS month FROM w, generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 MONTH) AS g(month)
WHERE month(g.month) = 10""")
def season_boundaries(spark, sf):
    bounds = t.table(spark, sf, "lineitem").agg(
        F.trunc(F.min("l_shipdate"), "month").alias("start"), F.trunc(F.max("l_shipdate"), "month").alias("end")
    )
    return ts.season_boundaries(bounds).select(m())


@add("season_chip", "Z4 F23", f"""
WITH {t.OBS_SQL}, {DRIED_SQL}, pick AS (
  SELECT series, coalesce(max(month) FILTER (WHERE month(month) = 9), max(month)) AS month FROM prior GROUP BY series
), v AS (
  SELECT series, month, CASE WHEN prior <> 0 THEN round((rolling::DOUBLE - prior::DOUBLE) / prior::DOUBLE * 100, 1) END AS pct
  FROM prior JOIN pick USING (series, month))
SELECT series, strftime(month, '%Y-%m') AS month, pct,
       CASE WHEN pct IS NULL OR abs(pct) < 0.5 THEN 'neutral' WHEN pct > 0 THEN 'up' ELSE 'down' END AS direction,
       CASE WHEN pct IS NULL OR abs(pct) < 0.5 THEN '—' WHEN pct > 0 THEN '▲ ' || printf('%.1f', pct) || '%'
            ELSE '▼ ' || printf('%.1f', abs(pct)) || '%' END AS label
FROM v""")
def season_chip(spark, sf):
    return ts.season_chip(rolled(spark, sf), keys=["series"]).select("series", m(), "pct", "direction", "label")


FROZEN = """
       coalesce(sum(value) FILTER (WHERE form = 'frozen'), 0)::DOUBLE AS fresh,
       coalesce(sum(value) FILTER (WHERE form = 'dried'), 0)::DOUBLE / 0.33::DOUBLE AS dried,
       coalesce(sum(value) FILTER (WHERE form NOT IN ('frozen', 'dried')), 0)::DOUBLE AS other"""


@add("frozen_monthly", "A13", f"""
WITH {t.OBS_SQL}
SELECT series, strftime(month, '%Y-%m') AS month, {FROZEN} FROM obs WHERE unit = 'KG' GROUP BY ALL""")
def frozen_monthly(spark, sf):
    obs = t.observations(spark, sf, unit="KG")
    return units.frozen_equivalent_totals(obs, keys=["series", "month"]).select("series", m(), "fresh", "dried", "other")


@add("frozen_yearly", "A14", f"""
WITH {t.OBS_SQL}
SELECT country, year(month)::INTEGER AS year, {FROZEN} FROM obs WHERE unit = 'KG' GROUP BY ALL""")
def frozen_yearly(spark, sf):
    obs = t.observations(spark, sf, unit="KG").withColumn("year", F.year("month"))
    return units.frozen_equivalent_totals(obs, keys=["country", "year"])


@add("filtered_months", "P5 P3 J7", f"""
WITH {t.OBS_SQL}
SELECT strftime(month, '%Y-%m') AS month, {FROZEN} FROM obs
WHERE unit = 'KG' AND month BETWEEN DATE '1997-03-01' AND DATE '2000-06-01' AND country = 'NATION_4' AND form <> 'other'
GROUP BY ALL""")
def filtered_months(spark, sf):
    obs = t.observations(spark, sf, unit="KG", since="1997-03-01", until="2000-07-01")
    rows = headline.interactive_filter(obs, start="1997-03", end="2000-06", country=(F.col("country"), "NATION_4"))
    return units.frozen_equivalent_totals(rows.filter("form <> 'other'"), keys=["month"]).select(m(), "fresh", "dried", "other")


@add("trailing_rows", "P6 A15", f"""
WITH {t.REC_SQL}
SELECT origin_local, count(*) AS n FROM rec WHERE day >= DATE '{AS_OF}' - 90 GROUP BY ALL""")
def trailing_rows(spark, sf):
    rows = ts.trailing_days(t.import_records(spark, sf), day="day", as_of=F.lit(AS_OF).cast("date"), days=90)
    return rows.groupBy("origin_local").agg(F.count(F.lit(1)).alias("n"))


@add("recent_or_first", "P7 W8", f"""
WITH {t.REC_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY day DESC, record_id) AS rn, max(day) OVER () AS latest FROM rec)
SELECT record_id, day FROM r WHERE day >= latest - 30 OR rn <= 3""")
def recent_or_first(spark, sf):
    rows = t.import_records(spark, sf).select("record_id", "day")
    return ts.recent_or_first(rows, day="day", days=30, tie=[F.col("record_id")])


@add("rolling_ranges", "Z8 F22", f"""
WITH {t.OBS_SQL}, l AS (SELECT series, max(month) AS month FROM obs WHERE unit = 'KG' GROUP BY ALL)
SELECT series, strftime((month - INTERVAL 11 MONTH)::DATE, '%b %Y') AS range_start, strftime(month, '%b %Y') AS range_end FROM l""")
def rolling_ranges(spark, sf):
    latest = t.observations(spark, sf, unit="KG").groupBy("series").agg(F.max("month").alias("month"))
    return latest.select("series", *ts.rolling_range(F.col("month")))


@add("picker_months", "Z9", f"""
WITH {t.REC_SQL}, l AS (SELECT origin_local, max(day) AS d FROM rec GROUP BY ALL)
SELECT origin_local, (date_trunc('month', d) - INTERVAL 11 MONTH)::DATE AS from_month, date_trunc('month', d)::DATE AS to_month FROM l""")
def picker_months(spark, sf):
    latest = t.import_records(spark, sf).groupBy("origin_local").agg(F.max("day").alias("d"))
    return latest.select("origin_local", *ts.last_calendar_months(F.col("d")))


@add("staleness", "Z6 Z7", f"""
WITH {t.REC_SQL}, l AS (SELECT importer_local, max(day) AS d FROM rec GROUP BY ALL)
SELECT importer_local, true AS available, (DATE '{AS_OF}' - d)::INTEGER AS age_days, (DATE '{AS_OF}' - d) > 365 AS is_stale FROM l""")
def staleness(spark, sf):
    latest = t.import_records(spark, sf).groupBy("importer_local").agg(F.max("day").cast("string").alias("d"))
    out = ts.staleness(latest, day="d", as_of=F.lit(AS_OF).cast("date"), max_age=365)
    return out.select("importer_local", "available", "age_days", "is_stale")


@add("purpose_split", "A12", f"""
WITH {t.OBS_SQL}, {DRIED_SQL}, l AS (
  SELECT max(month) AS as_of, round(arg_max(rolling, month)::DOUBLE / 1000.0, 1) AS total_t FROM rolled WHERE series = 'O'
), s AS (SELECT *, 12.5::DOUBLE AS estimate_t, total_t > 12.5 AS ok FROM l)
SELECT ok AS available, CASE WHEN ok THEN strftime(as_of, '%Y-%m') END AS as_of, CASE WHEN ok THEN total_t END AS total_t,
       CASE WHEN ok THEN estimate_t END AS estimate_t, CASE WHEN ok THEN round(total_t - estimate_t, 1) END AS rest_t,
       CASE WHEN ok THEN round(estimate_t / total_t * 100, 1) END AS estimate_pct,
       CASE WHEN ok THEN round(100 - round(estimate_t / total_t * 100, 1), 1) END AS rest_pct,
       CASE WHEN NOT ok AND total_t > 0 THEN 'the estimate covers 1999 and is not below the current rolling total' END AS reason
FROM s""")
def purpose_split(spark, sf):
    return headline.purpose_split(rolled(spark, sf).filter("series = 'O'"), estimate=F.lit(12.5), reference_period="1999")


def kpi_inputs(spark, sf):
    as_of = F.lit(AS_OF).cast("date")
    orders = t.table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return {
        "articles": headline.trailing_count(orders, day="day", as_of=as_of, keep=F.col("o_orderstatus") == "F"),
        "declarations": headline.trailing_count(orders, day="day", as_of=as_of),
    }


KPI_SQL = f"""
{DRIED_SQL}, last_row AS (
  SELECT * FROM prior QUALIFY row_number() OVER (PARTITION BY series ORDER BY month DESC) = 1
), x AS (SELECT *, (rolling::DOUBLE - before::DOUBLE) / before::DOUBLE * 100 AS pct FROM last_row WHERE series = 'F'
), i AS (SELECT *, (rolling::DOUBLE - prior::DOUBLE) / prior::DOUBLE * 100 AS pct FROM last_row WHERE series = 'O'
), kpi AS (
SELECT format('{{:,.1f}}', round(x.rolling::DOUBLE / 1000, 1)) AS export_tonnes,
       CASE WHEN x.pct >= 0 THEN '▲ ' ELSE '▼ ' END || printf('%.1f', abs(x.pct)) || '%' AS export_delta,
       format('{{:,.0f}}', i.rolling::DOUBLE) AS import_kg,
       strftime((i.month - INTERVAL 11 MONTH)::DATE, '%b %Y') AS import_start, strftime(i.month, '%b %Y') AS import_end,
       CASE WHEN i.pct >= 0 THEN '▲ ' ELSE '▼ ' END || printf('%.1f', abs(i.pct)) || '% vs '
         || strftime((i.month - INTERVAL 12 MONTH)::DATE, '%b %Y') AS import_yoy,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate::DATE >= DATE '{AS_OF}' - 90)::VARCHAR AS articles_90d,
       (SELECT count(*) FROM orders WHERE o_orderdate::DATE >= DATE '{AS_OF}' - 90)::VARCHAR AS declarations_90d
FROM x, i)"""


@add("headline_kpis", "A26 A15 F24 W2", f"WITH {t.OBS_SQL}, {KPI_SQL} SELECT * FROM kpi")
def headline_kpis(spark, sf):
    return headline.headline_kpis(
        t.observations(spark, sf, unit="KG"), export_series="F", import_series="O", **kpi_inputs(spark, sf)
    )


@add("chart_payload", "A27 Z2 P14", f"""
WITH {t.OBS_SQL}, b AS (
  SELECT series, month, sum(value) FILTER (WHERE unit = 'KG') AS kg,
         sum(value * CASE form WHEN 'frozen' THEN 0.33 ELSE 1 END) FILTER (WHERE unit = 'KG') AS dried_kg,
         sum(value) FILTER (WHERE unit = 'USD') AS v FROM obs GROUP BY ALL
), r AS (
  SELECT *, sum(dried_kg) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS rolling,
         CASE WHEN dried_kg > 0 THEN round(v::DOUBLE * 1000 / dried_kg::DOUBLE, 2) END AS price FROM b WHERE kg IS NOT NULL
), w AS (SELECT max(month) AS e FROM r), spine AS (
  SELECT c.series, g.month::DATE AS month FROM (SELECT DISTINCT series FROM r) c, w,
         generate_series((e - INTERVAL 23 MONTH)::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 MONTH) AS g(month))
SELECT s.series, strftime(s.month, '%Y-%m') AS month, round(coalesce(r.kg::DOUBLE, 0), 2) AS kg,
       round(coalesce(r.dried_kg::DOUBLE, 0), 2) AS dried_kg, round(coalesce(r.rolling::DOUBLE, 0), 2) AS rolling,
       round(coalesce(r.price, 0), 2) AS price,
       CASE WHEN p.rolling <> 0 THEN round((r.rolling::DOUBLE - p.rolling::DOUBLE) / p.rolling::DOUBLE * 100, 1) END AS yoy_pct
FROM spine s LEFT JOIN r USING (series, month)
LEFT JOIN r p ON p.series = s.series AND p.month = (s.month - INTERVAL 12 MONTH)::DATE""")
def chart_payload(spark, sf):
    return headline.chart_payload(t.observations(spark, sf), value_unit="USD", multiplier=1000.0)


@add("adhoc_trade_flow", "A23 P1", f"""
WITH {t.OBS_SQL}
SELECT series, strftime(month, '%Y-%m') AS month, country, sum(value)::DOUBLE AS value
FROM obs WHERE upper(unit) = 'KG' GROUP BY ALL""")
def adhoc_trade_flow(spark, sf):
    obs = t.observations(spark, sf, unit="KG").withColumn("unit", F.upper("unit"))
    return ts.monthly_sum(obs, keys=["series", "country"], unit=("unit", "KG")).select("series", m(), "country", d("value"))
