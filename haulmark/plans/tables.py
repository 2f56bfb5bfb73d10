"""Adapters: the driver's tables shaped as the operators' inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEASURE = "decimal(18,3)"

# The three destinations shown by name; every other nation is "Other".
NAMED = ["NATION_0", "NATION_1", "NATION_2"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Measure of each unit in a line item.
UNITS = {"KG": "l_quantity", "USD": "l_extendedprice"}


def _facts(spark: SparkSession, sf_dir: str, since: str | None, until: str | None, blank_form: bool) -> DataFrame:
    """Line items with month, series and form. ``since`` and ``until`` (exclusive) are days and bound the raw ship date,
    so that they reach the scan.
    """
    li = table(spark, sf_dir, "lineitem")
    for day, test in ((since, F.col("l_shipdate").__ge__), (until, F.col("l_shipdate").__lt__)):
        if day:
            li = li.filter(test(F.lit(day).cast(li.schema["l_shipdate"].dataType)))
    form = F.when(F.col("l_returnflag") == "R", "frozen").when(F.col("l_returnflag") == "A", "dried")
    return li.select(
        "l_suppkey",
        F.trunc("l_shipdate", "month").alias("month"),
        F.col("l_linestatus").alias("series"),
        form.otherwise("" if blank_form else "other").alias("form"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("notes"),
        *[F.col(c).cast(MEASURE).alias(u) for u, c in UNITS.items()],
    )


def _placed(facts: DataFrame, sf_dir: str) -> DataFrame:
    """Facts with the country of their supplier."""
    # Left-deep, so that every dimension is sized by its own file: the planner multiplies the sizes
    # of a nested join and would take the fact table for the smaller side.
    s = table(facts.sparkSession, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(facts.sparkSession, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return facts.join(s, facts.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))


def _by_unit(rows: DataFrame, keep: list[str], unit: str | None) -> DataFrame:
    if unit:
        return rows.select(*keep, F.lit(unit).alias("unit"), F.col(unit).alias("value"))
    pairs = [x for u in UNITS for x in (F.lit(u), F.col(u))]
    return rows.select(*keep, F.stack(F.lit(len(UNITS)), *pairs).alias("unit", "value"))


def observations(
    spark: SparkSession, sf_dir: str, *, unit: str | None = None, blank_form: bool = False, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Long observations: two rows per line item, weight and value, or only the rows of one ``unit``.

    Line status is the series, the return flag the product form (R frozen, A dried, N other).
    ``blank_form`` leaves the form of N lines blank, with a note to infer it from.
    """
    placed = _placed(_facts(spark, sf_dir, since, until, blank_form), sf_dir)
    return _by_unit(placed, ["month", "series", "country", "form", "notes"], unit)


def observation_totals(
    spark: SparkSession, sf_dir: str, *keys: str, unit: str | None = None, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Observations summed by country, unit and ``keys``, with ``n`` rows each, for operators that sum them further.

    The facts are summed by supplier before they meet a dimension, and doubled by unit after it, so the
    join and what follows work on one row per supplier and ``keys``. The sums are exact decimals.
    """
    facts = _facts(spark, sf_dir, since, until, blank_form=False)
    wanted = [unit] if unit else list(UNITS)
    sums = facts.groupBy("l_suppkey", *keys).agg(
        *[F.sum(u).cast("decimal(24,3)").alias(u) for u in wanted], F.count(F.lit(1)).alias("n")
    )
    return _by_unit(_placed(sums, sf_dir), [*keys, "country", "n"], unit)


# The same long table for the reference queries in SQL.
OBS_SQL = """
obs AS (
  SELECT date_trunc('month', l_shipdate)::DATE AS month, l_linestatus AS series, n_name AS country,
         CASE l_returnflag WHEN 'R' THEN 'frozen' WHEN 'A' THEN 'dried' ELSE 'other' END AS form,
         'line ' || l_linenumber::VARCHAR AS notes, u.unit AS unit,
         CASE u.unit WHEN 'KG' THEN l_quantity ELSE l_extendedprice END::DECIMAL(18,3) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  CROSS JOIN (VALUES ('KG'), ('USD')) AS u(unit)
)"""


def import_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as import declarations, with blanks where the text says so.

    The importer's English name is known for two market segments only, so that resolving, filling
    and flagging all have work to do.
    """
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    known = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("record_id"),
            F.to_date("o_orderdate").alias("day"),
            F.concat(F.col("c_name"), F.lit(" Co., Ltd.")).alias("importer_local"),
            F.when(known, F.upper("c_name")).otherwise("").alias("importer_en"),
            F.col("o_orderpriority").alias("product_name"),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("product_en"),
            F.col("n_name").alias("origin_local"),
            F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("n_name")).alias("origin_en"),
            F.col("o_totalprice").cast(MEASURE).alias("quantity"),
        )
    )


REC_SQL = """
rec AS (
  SELECT o_orderkey AS record_id, o_orderdate::DATE AS day, c_name || ' Co., Ltd.' AS importer_local,
         CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN upper(c_name) ELSE '' END AS importer_en,
         o_orderpriority AS product_name,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS product_en,
         n_name AS origin_local, CASE WHEN n_regionkey = 0 THEN '' ELSE n_name END AS origin_en,
         o_totalprice::DECIMAL(18,3) AS quantity
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a yearly price ranking: the size is the year, the key the rank, the brand the origin."""
    return table(spark, sf_dir, "part").select(
        (F.col("p_size") + 2000).alias("year"),
        (F.col("p_partkey") + 1).alias("rank"),
        F.col("p_name").alias("product_name"),
        F.round(F.col("p_retailprice").cast(MEASURE), 0).cast("bigint").alias("price"),
        F.col("p_brand").alias("origin"),
    )


PRICE_SQL = """
price AS (
  SELECT p_size + 2000 AS year, p_partkey + 1 AS rank, p_name AS product_name,
         round(p_retailprice::DECIMAL(18,3), 0)::BIGINT AS price, p_brand AS origin
  FROM part
)"""


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as articles: the title is the page's own title element, cleaned, whole."""
    from ..functions import text, urls

    raw_title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("raw_ref"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int")).alias("day"),
        text.clean_html(raw_title).alias("title"),
        F.col("url"),
        urls.host(F.col("url")).alias("source"),
    )


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as judged articles: the whole text is the title, labels are the reviewers' flags."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("raw_ref"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("day"),
        F.col("text").alias("title"),
        F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com/a/"), F.col("lang")).alias("url"),
        F.col("source"),
        F.col("lang"),
        (F.col("quality") == 1).alias("relevant"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("hidden"),
        F.col("quality").isNotNull().alias("judged"),
    )


ART_SQL = """
art AS (
  SELECT d.doc_id AS raw_ref, (DATE '2024-01-01' + (d.doc_id % 30)::INTEGER)::DATE AS day, d.text AS title,
         'https://www.' || source || '.example.com/a/' || lang AS url, source, lang,
         quality = 1 AS relevant, coalesce(toxic = 1, false) AS hidden, quality IS NOT NULL AS judged
  FROM documents d LEFT JOIN labels USING (doc_id)
)"""
