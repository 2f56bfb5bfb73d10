"""Registered queries: incremental jobs over the event and order files; results equal the batch ones."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.buckets import BucketTable
from ..session import scratch_folder
from ..sources import customs, wide
from ..streaming import incremental as inc
from . import layouts
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add


def place(spark, job):
    root = f"{scratch_folder(spark)}/{job}-{uuid.uuid4().hex}"
    return f"{root}/drop", f"{root}/table", f"{root}/progress"


def dropped(spark, sf, name, drop, parts, files_per_batch=2):
    """The table as several files in a drop folder."""
    t.table(spark, sf, name).repartitionByRange(parts[0], *parts[1:]).write.parquet(drop)
    return inc.file_stream(spark, drop, t.table(spark, sf, name).schema, files_per_batch=files_per_batch)


@add("streamed_append", "R1 K1", """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice::DOUBLE AS o_totalprice FROM orders""")
def streamed_append(spark, sf):
    """Orders dropped twice, as repeated polls would: each is stored once."""
    drop, table, progress = place(spark, "append")
    stream = dropped(spark, sf, "orders", drop, (4, "o_orderkey"))
    pick = lambda df: df.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    inc.append_files(stream, table, keys=["o_orderkey"], checkpoint=progress, transform=pick, prune="o_orderkey")
    inc.append_files(stream, table, keys=["o_orderkey"], checkpoint=f"{progress}-again", transform=pick, prune="o_orderkey")
    return spark.read.parquet(table)


@add("streamed_first_wins", "R2 K5", """
SELECT user_id, event_type, arg_min(event_id, (event_id % 4) * 1000000000000 + event_id) AS event_id FROM events GROUP BY ALL""")
def streamed_first_wins(spark, sf):
    """Four drops of several files each. Later drops hold early ids too, so the stored rows decide."""
    drop, table, progress = place(spark, "first")
    e = t.table(spark, sf, "events").select("user_id", "event_type", "event_id")
    dealt = f"{drop}-dealt"
    # One pass deals the rows; a drop is the rows of one folder, in whatever files Spark wrote.
    e.withColumn("turn", F.col("event_id") % 4).write.partitionBy("turn").parquet(dealt)
    target = BucketTable(spark, table, e.schema, ["user_id", "event_type"], buckets=16)
    for turn in range(4):
        stream = inc.file_stream(spark, f"{dealt}/turn={turn}", e.schema)
        inc.first_wins(stream, target, order=[F.col("event_id")], checkpoint=f"{progress}-{turn}")
    return target.read()


@add("streamed_totals", "R3 A1", """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, sum(value::DECIMAL(18,3))::DOUBLE AS value, count(*) AS n FROM events GROUP BY ALL""")
def streamed_totals(spark, sf):
    drop, table, progress = place(spark, "totals")
    stream = dropped(spark, sf, "events", drop, (4, "event_id")).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    keys = ["event_type", "day"]
    inc.running_totals(stream, table, keys=keys, value=F.col("value").cast("decimal(18,3)"), checkpoint=progress)
    return inc.current_totals(spark, table, keys=keys).select(*keys, F.col("value").cast("double").alias("value"), "n")


@add("streamed_rolling", "R3 W1", """
WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate::DATE)::DATE AS month, sum(o_totalprice::DECIMAL(18,3)) AS value FROM orders GROUP BY ALL)
SELECT o_orderpriority, strftime(month, '%Y-%m') AS month,
       (sum(value) OVER (PARTITION BY o_orderpriority ORDER BY month RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW))::DOUBLE AS value FROM m""")
def streamed_rolling(spark, sf):
    """Twelve-month totals of the orders, from monthly totals that six drops keep up to date."""
    drop, table, progress = place(spark, "rolling")
    stream = dropped(spark, sf, "orders", drop, (6, "o_orderkey"), files_per_batch=1).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    inc.running_totals(stream, table, keys=["o_orderpriority", "month"], value=F.col("o_totalprice").cast("decimal(18,3)"), checkpoint=progress)
    rolling = inc.rolling_totals(spark, table, keys=["o_orderpriority"], month="month")
    return rolling.withColumn("value", F.col("value").cast("double"))


@add("streamed_windows", "R3", """
WITH d AS (SELECT *, ts::DATE AS day, min(ts::DATE) OVER () AS first, max(ts::DATE) OVER () AS last FROM events)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, sum(value::DECIMAL(18,3))::DOUBLE AS value, count(*) AS n FROM d
WHERE day <= last - 4 AND NOT (day = first AND event_id % 7 = 0) GROUP BY ALL""")
def streamed_windows(spark, sf):
    """Day windows with a watermark of three days, eight days a batch: every day that the last event has closed.

    A fifth of each batch's last day comes one batch late, within the delay, and counts. A seventh of the first day comes with
    the last batch and is refused.
    """
    drop, table, progress = place(spark, "windows")
    # The event files carry zone-free UTC stamps; a watermark needs an instant.
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    e = t.table(spark, sf, "events")
    first, last = e.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    at, turns = F.datediff(F.to_date("ts"), F.lit(first)), (last - first).days // 8 + 2
    own = F.floor(at / 8)
    turn = F.when((at == 0) & (F.col("event_id") % 7 == 0), turns).when((F.col("event_id") % 5 == 0) & (at % 8 == 7), own + 1).otherwise(own)
    dealt = e.withColumn("turn", turn.cast("int")).withColumn("ts", instant)
    schema = dealt.drop("turn").schema
    dealt.write.partitionBy("turn").parquet(f"{drop}-dealt")
    for number in range(turns + 1):
        rows = spark.read.parquet(f"{drop}-dealt").filter(F.col("turn") == number).drop("turn")
        rows.write.mode("append").parquet(drop)
        # The same checkpoint all along: a run takes what is new.
        windows = inc.windowed_totals(
            inc.file_stream(spark, drop, schema), event_time="ts", size="1 day", delay="3 days", keys=["event_type"], value=F.col("value").cast("decimal(18,3)")
        ).select("event_type", F.date_format(F.to_utc_timestamp("window.start", F.current_timezone()), "yyyy-MM-dd").alias("day"), F.col("value").cast("double").alias("value"), "n")
        query = (
            windows.writeStream.format("parquet").option("path", table).option("checkpointLocation", progress)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.parquet(table)


# --- drop folders of several layouts ----------------------------------------------------------------


def ingested(spark, sf):
    """Customs, wide and ranking files and a stray one, dropped in two turns and read again by a replay; the target folder."""
    drop, target, progress = place(spark, "layouts")

    def customs_rows(rows, heads):
        parsed = customs.customs_csv(rows, series="customs", heads=heads)
        return parsed.rows, parsed.rejects.select("file", F.concat(F.lit("missing columns: "), "missing").alias("reason"))

    def wide_rows(rows, heads):
        destinations = {f"{c}, Republic of": c for c in layouts.nation_names(spark, sf)}
        return wide.wide_to_long(rows, heads=heads, series="wide", value_unit="NZD", destinations=destinations), None

    def price_rows(rows, heads):
        parsed = customs.price_rows(rows, heads=heads)
        return parsed.rows, parsed.rejects.select("file", F.concat(F.lit("line at "), F.col("pos").cast("string"), F.lit(": "), F.array_join("reasons", "; ")).alias("reason"))

    known = {
        "customs": inc.Layout(r"^customs_.*\.csv$", customs_rows, ["date", "series", "hs_code", "unit", "country", "hs_code_10digit", "notes"]),
        "wide": inc.Layout(r"^wide_\d{4}\.csv$", wide_rows, ["date", "series", "hs_code", "unit", "country", "product_type"], wide.HEADER_LINES),
        "prices": inc.Layout(r"^prices_.*\.csv$", price_rows, ["year", "rank", "product_name"]),
    }
    layouts.landed(layouts.customs_lines(spark, sf), "customs", f"{drop}/first")
    inc.ingest_drops(spark, drop, target, known, checkpoint=progress)
    layouts.landed(layouts.wide_lines(spark, sf), "wide", f"{drop}/second")
    layouts.landed(layouts.price_lines(spark, sf), "prices", f"{drop}/third")
    stray = t.table(spark, sf, "region").select(F.lit("notes.txt").alias("file"), F.col("r_regionkey").alias("pos"), F.col("r_name").alias("text"))
    layouts.landed(stray, "stray", f"{drop}/fourth")
    inc.ingest_drops(spark, drop, target, known, checkpoint=progress)
    inc.ingest_drops(spark, drop, target, known, checkpoint=f"{progress}-again")
    return target


@add("streamed_layouts", "R1 S1 S5 S14", f"""
WITH {layouts.CELLS_SQL}, c AS (
  SELECT series, month, country, form, sum(value) FILTER (WHERE unit = 'KG') AS q, sum(value) FILTER (WHERE unit = 'USD') AS v FROM obs GROUP BY ALL)
SELECT 'customs' AS layout, u.unit AS kind, count(*) AS n, sum(trunc(CASE u.unit WHEN 'KG' THEN q ELSE v END))::DOUBLE AS total
FROM c CROSS JOIN (VALUES ('KG'), ('USD_thousands')) u(unit) WHERE country NOT IN ('NATION_7', 'NATION_8', 'NATION_9') GROUP BY ALL
UNION ALL
SELECT 'wide', u.unit, count(*), sum(coalesce(CASE u.unit WHEN 'KG' THEN q ELSE v END, 0))::DOUBLE
FROM (SELECT DISTINCT month FROM cell) m CROSS JOIN nation CROSS JOIN (VALUES ('frozen'), ('dried'), ('other')) f(form) CROSS JOIN (VALUES ('KG'), ('NZD')) u(unit)
LEFT JOIN cell ON cell.month = m.month AND cell.country = n_name AND cell.form = f.form GROUP BY ALL
UNION ALL
SELECT 'prices', (p_size + 2000)::VARCHAR, count(*), sum(round(p_retailprice, 1)::DECIMAL(18,1))::DOUBLE FROM part WHERE p_size > 4 GROUP BY ALL""")
def streamed_layouts(spark, sf):
    """Rows and totals of each layout after all drops and a replay."""
    target = ingested(spark, sf)
    long = [
        spark.read.parquet(f"{target}/{n}").select(F.lit(n).alias("layout"), F.col("unit").alias("kind"), F.col("value").cast("decimal(24,3)").alias("x"))
        for n in ("customs", "wide")
    ]
    prices = spark.read.parquet(f"{target}/prices").select(F.lit("prices").alias("layout"), F.col("year").alias("kind"), F.col("price_krw").cast("decimal(24,3)").alias("x"))
    rows = long[0].unionByName(long[1]).unionByName(prices)
    return rows.groupBy("layout", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("x").cast("double").alias("total"))


@add("streamed_rejects", "R1 S6 S14", """
SELECT 'customs_bad.csv' AS file, 'customs' AS layout, 'missing columns' AS reason, 1 AS n FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'notes.txt', '', 'no layout has this name', 1 FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'prices_' || lower(p_type) || '.csv', 'prices',
  CASE p_size WHEN 1 THEN 'year invalid' WHEN 2 THEN 'rank invalid' WHEN 3 THEN 'product_name is empty' ELSE 'price_krw invalid' END, count(*) FROM part WHERE p_size <= 4 GROUP BY ALL""")
def streamed_rejects(spark, sf):
    """What the drops could not use; the replay replaces the rejects of the first batch and adds none."""
    rejects = spark.read.parquet(f"{ingested(spark, sf)}/rejects").drop("batch").distinct()
    kind = F.when(F.col("layout") == "customs", "missing columns").when(F.col("layout") == "prices", F.regexp_extract("reason", ": (.*)$", 1)).otherwise(F.col("reason"))
    return rejects.groupBy("file", "layout", kind.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
