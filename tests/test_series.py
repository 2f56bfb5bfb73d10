import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from haulmark.operators import breakdown, headline, units
from haulmark.operators import series as ts
from haulmark.plans import tables


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


@pytest.fixture
def gappy(spark):
    rng = random.Random(7)
    data = [(s, month(i), rng.randint(1, 500)) for s in "ab" for i in range(40) if rng.random() < 0.7]
    return data, spark.createDataFrame(data, "series string, month date, value bigint")


def test_rolling_counts_present_months(gappy):
    data, df = gappy
    got = {(r.series, r.month): float(r.rolling) for r in ts.rolling(df, keys=["series"]).collect()}
    for s in "ab":
        own = sorted((m, v) for k, m, v in data if k == s)
        for i, (m, _) in enumerate(own):
            assert got[(s, m)] == sum(v for _, v in own[max(0, i - 11) : i + 1])


def test_rolling_by_calendar(gappy):
    data, df = gappy
    got = {(r.series, r.month): float(r.rolling) for r in ts.rolling(df, keys=["series"], frame="calendar").collect()}
    index = lambda m: m.year * 12 + m.month
    for s, m, _ in data:
        assert got[(s, m)] == sum(v for k, n, v in data if k == s and 0 <= index(m) - index(n) < 12)


def test_yoy_matches_calendar_month_not_position(gappy):
    data, df = gappy
    value = {(s, m): v for s, m, v in data}
    for r in ts.yoy(df, value="value", keys=["series"]).collect():
        before = value.get((r.series, r.month.replace(year=r.month.year - 1)))
        if before is None:
            assert r.yoy_pct is None
        else:
            assert r.yoy_pct == pytest.approx((float(r.value) - before) / before * 100, abs=0.051)


def test_twelve_equal_months(spark):
    df = spark.createDataFrame([(month(i), 10) for i in range(12)], "month date, value int")
    got = [r.rolling for r in ts.rolling(df).orderBy("month").collect()]
    assert got[0] == 10 and got[11] == 120


def test_densify_has_every_month(gappy):
    data, df = gappy
    window = ts.display_window(df, n=24)
    dense = ts.densify(df, keys=["series"], window=window)
    assert dense.count() == 48
    end = max(m for _, m, _ in data)
    assert dense.agg(F.max("month")).first()[0] == end
    inside = {(s, m): v for s, m, v in data}
    for r in dense.collect():
        assert float(r.value) == inside.get((r.series, r.month), 0)


def test_densify_null_and_bad_fill(gappy):
    _, df = gappy
    assert ts.densify(df, keys=["series"], fill="null").filter("value is null").count() > 0
    with pytest.raises(ValueError):
        ts.densify(df, keys=["series"], fill="guess")


def test_season_chip_without_september(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 1), 100), (dt.date(2021, 5, 1), 150)], "month date, rolling int")
    got = ts.season_chip(df).first()
    assert (got.month, got.pct, got.direction, got.label) == (dt.date(2021, 5, 1), 50.0, "up", "▲ 50.0%")


def test_season_chip_dead_zone_and_missing(spark):
    df = spark.createDataFrame([(dt.date(2020, 9, 1), 1000), (dt.date(2021, 9, 1), 1004)], "month date, rolling int")
    got = ts.season_chip(df).first()
    assert (got.direction, got.label) == ("neutral", "—")
    assert ts.season_chip(df.filter("rolling = 1000")).first().pct is None


@pytest.fixture
def observed(spark):
    m = dt.date(2024, 1, 1)
    rows = [
        (m, "x", "KG", "100", "frozen"),
        (m, "x", "KG", "50", " Dried "),
        (m, "x", "USD_thousands", "10", "dried"),
        (m, "x", "KG", "bad", "dried"),
        (m, "x", "KG", "", "dried"),
        (dt.date(2024, 2, 1), "x", "KG", "5", "dried"),
    ]
    return spark.createDataFrame(rows, "month date, series string, unit string, value string, form string")


def test_dried_equivalent(observed):
    got = {r.month.month: float(r.dried_kg) for r in units.dried_monthly(observed, keys=["series"]).collect()}
    assert got == {1: 83.0, 2: 5.0}


def test_blended_price_needs_both_units(observed):
    got = units.blended_price(observed, value_unit="USD_thousands", multiplier=1000.0).collect()
    assert [(r.month.month, r.price) for r in got] == [(1, round(10000 / 83, 2))]


def test_backfill_form(spark):
    df = spark.createDataFrame(
        [("q", "fresh goods", ""), ("q", "goods", None), ("z", "fresh goods", " "), ("q", "fresh", "other")],
        "series string, notes string, form string",
    )
    rules = {"q": ([(["fresh"], "frozen")], "dried")}
    got = [r.form for r in units.backfill_form(df, by_series=rules).collect()]
    assert got == ["frozen", "dried", "other", "other"]


@pytest.mark.parametrize("estimate, available, reason", [(40.0, True, False), (100.0, False, True), (None, False, False)])
def test_purpose_split(spark, estimate, available, reason):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 90000), (dt.date(2024, 2, 1), 100000)], "month date, rolling int")
    got = headline.purpose_split(df, estimate=F.lit(estimate).cast("double")).first()
    assert got.available is available and (got.reason is not None) is reason
    if available:
        assert (got.total_t, got.rest_t, got.estimate_pct, got.rest_pct, got.as_of) == (100.0, 60.0, 40.0, 60.0, "2024-02")


def test_full_year_needs_ten_months(spark):
    rows = [("a", dt.date(2022, m, 1), 1) for m in range(1, 11)] + [("b", dt.date(2023, m, 1), 5) for m in range(1, 10)]
    months = breakdown.bucket_months(spark.createDataFrame(rows, "c string, month date, value int"), bucket=F.col("c"))
    assert [r.year for r in breakdown.full_years(months).collect()] == [2022]
    got = breakdown.latest_year_by_bucket(months, buckets=["a", "b"])
    assert {(r.year, r.bucket, int(r.value)) for r in got.collect()} == {(2022, "a", 10), (2022, "b", 0)}
    assert breakdown.latest_year_by_bucket(months.filter("year(month) = 2023"), buckets=["a"]).count() == 0


def test_headline_dashes_when_nothing_is_known(spark):
    empty = spark.createDataFrame([], "month date, series string, unit string, value string, form string")
    got = headline.headline_kpis(
        empty, export_series="e", import_series="i", articles=F.lit(0), declarations=F.lit(0)
    ).first()
    assert got.export_tonnes == got.export_delta == got.import_kg == got.import_yoy == "—"


def test_recent_rows_keep_the_first_three(spark):
    days = [(1, "2024-01-31"), (2, "2024-01-30"), (3, "2023-06-01"), (4, "2023-05-01"), (5, None)]
    df = spark.createDataFrame(days, "id int, d string").select("id", F.to_date("d").alias("day"))
    got = ts.recent_or_first(df, day="day", days=30, tie=[F.col("id")])
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_staleness(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2025-06-01",), ("soon",)], "d string")
    got = ts.staleness(df, day="d", as_of=F.lit("2025-06-30").cast("date"), max_age=365)
    assert [(r.available, r.age_days, r.is_stale) for r in got.collect()] == [(True, 546, True), (True, 29, False), (False, None, None)]


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")
def test_facts_are_summed_before_dimensions_and_filtered_in_the_scan(spark):
    rows = tables.observation_totals(spark, SF, "month", unit="KG", since="1998-01-01", until="1998-07-01")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate") and plan.count("Aggregate") == 1
    scans = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in scans and "LessThan(l_shipdate,1998-07-01" in scans
    whole = tables.observations(spark, SF).groupBy("month", "country", "unit").agg(F.sum("value").alias("value"), F.count("*").alias("n"))
    summed = tables.observation_totals(spark, SF, "month").groupBy("month", "country", "unit").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    assert whole.exceptAll(summed.select(*whole.columns)).isEmpty() and summed.exceptAll(whole).isEmpty()


def test_recent_or_first_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int, day date")
    assert ts.recent_or_first(empty, day="day", days=30, tie=[F.col("id")]).count() == 0
    undated = spark.createDataFrame([(1, None), (2, None)], "id int, day date")
    assert ts.recent_or_first(undated, day="day", days=30, tie=[F.col("id")], always=1).count() == 1
