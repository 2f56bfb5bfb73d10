"""Registered queries: scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, measures, names, text, urls
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add


@add("month_texts", "F1 F2 F22", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS padded, strftime(o_orderdate, '%Y-%m') AS from_compact,
       strftime(o_orderdate, '%Y-%m') AS from_dotted, strftime(o_orderdate, '%b %Y') AS label, NULL::VARCHAR AS not_a_month FROM orders""")
def month_texts(spark, sf):
    o = t.table(spark, sf, "orders")
    unpadded = F.concat(F.lit(" "), F.year("o_orderdate").cast("string"), F.lit("-"), F.month("o_orderdate").cast("string"))
    return o.select(
        "o_orderkey",
        dates.norm_month(unpadded).alias("padded"),
        dates.compact_period(F.date_format("o_orderdate", "yyyy'M'MM")).alias("from_compact"),
        dates.compact_period(F.date_format("o_orderdate", "yyyy.MM")).alias("from_dotted"),
        dates.month_label(dates.month_date(unpadded)).alias("label"),
        dates.compact_period(F.col("o_orderpriority")).alias("not_a_month"),
    )


@add("day_texts", "F4 F5 F28", """
SELECT o_orderkey, o_orderdate::DATE AS compact, o_orderdate::DATE AS iso, NULL::DATE AS dash, o_orderdate::DATE AS prefix, NULL::DATE AS bad,
       year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day FROM orders""")
def day_texts(spark, sf):
    o = t.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey",
        dates.parse_day(F.date_format(d, "yyyyMMdd")).alias("compact"),
        dates.parse_day(d).alias("iso"),
        dates.parse_day(F.lit(" - ")).alias("dash"),
        dates.iso_prefix(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).alias("prefix"),
        dates.iso_prefix(F.concat(F.lit("x"), d.cast("string"))).alias("bad"),
        *dates.year_month_day(d),
    )


@add("mail_dates", "F8", """
SELECT event_id, ts::DATE AS own_zone, NULL::DATE AS broken FROM events""")
def mail_dates(spark, sf):
    e = t.table(spark, sf, "events")
    stamp = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))
    return e.select("event_id", dates.mail_date(stamp).alias("own_zone"), dates.mail_date(F.col("event_type")).alias("broken"))


@add("number_texts", "F3 F20", """
SELECT c_custkey, c_acctbal AS parsed, c_acctbal AS strict, 0::DOUBLE AS blank, 0::DOUBLE AS dash, 0::DOUBLE AS words, NULL::DOUBLE AS strict_words,
       trunc(c_acctbal)::BIGINT AS whole, c_acctbal AS display, c_acctbal::DECIMAL(18,3)::DOUBLE AS measured FROM customer""")
def number_texts(spark, sf):
    c = t.table(spark, sf, "customer")
    shown = F.concat(F.lit(" "), F.format_number("c_acctbal", 2))
    return c.select(
        "c_custkey",
        measures.parse_number(shown).alias("parsed"),
        measures.strict_number(shown).alias("strict"),
        measures.parse_number(F.lit("  ")).alias("blank"),
        measures.parse_number(F.lit("-")).alias("dash"),
        measures.parse_number(F.col("c_mktsegment")).alias("words"),
        measures.strict_number(F.col("c_mktsegment")).alias("strict_words"),
        measures.whole_number(shown).alias("whole"),
        measures.pure_number(shown).alias("display"),
        measures.measure(F.col("c_acctbal")).cast("double").alias("measured"),
    )


@add("percent_labels", "F20 F23 F24", """
WITH p AS (SELECT p_partkey, round((p_size - 25)::DOUBLE / 7, 1) AS pct, p_retailprice FROM part), l AS (
SELECT p_partkey, pct, CASE WHEN abs(pct) < 0.5 THEN '—' WHEN pct > 0 THEN '▲ ' || printf('%.1f', pct) || '%' ELSE '▼ ' || printf('%.1f', abs(pct)) || '%' END AS label,
       CASE WHEN abs(pct) < 0.5 THEN 'neutral' WHEN pct > 0 THEN 'up' ELSE 'down' END AS direction, format('{:,.1f}', p_retailprice) AS shown FROM p)
SELECT p_partkey, label, direction, shown, CASE WHEN label = '—' THEN 0 ELSE abs(pct) END AS cited FROM l""")
def percent_labels(spark, sf):
    p = t.table(spark, sf, "part").withColumn("pct", F.round((F.col("p_size") - 25).cast("double") / 7, 1))
    rows = p.select(
        "p_partkey",
        measures.arrow_label(F.col("pct")).alias("label"),
        measures.change_direction(F.col("pct")).alias("direction"),
        measures.grouped(F.col("p_retailprice"), 1).alias("shown"),
    )
    return rows.withColumn("cited", F.coalesce(F.get(measures.percentages(F.col("label")), F.lit(0)), F.lit(0.0)))


@add("code_texts", "F6 P4", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN '0507.90' WHEN 'N' THEN '0510.00' ELSE '0101.21' END AS code,
       CASE l_returnflag WHEN 'A' THEN '0507.90' WHEN 'N' THEN '0510.00' ELSE '0101.21' END AS dotted,
       CASE l_returnflag WHEN 'A' THEN '507' WHEN 'N' THEN '510' ELSE '101' END AS prefix FROM lineitem""")
def code_texts(spark, sf):
    li = t.table(spark, sf, "lineitem")
    flag = F.col("l_returnflag")
    number = F.when(flag == "A", "507.9").when(flag == "N", "510.0").otherwise("0101.21")
    ten = F.when(flag == "A", "0507 901110").when(flag == "N", "0510.001000").otherwise(" 0101211000")
    return li.select(
        "l_orderkey", "l_linenumber", names.norm_code(number).alias("code"), names.dotted_code(ten).alias("dotted"),
        names.code_prefix(names.dotted_code(ten)).alias("prefix"),
    )


@add("clean_pages", "F7", r"""
SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'),
  '&quot;', '"'), '&#39;', ''''), '^\s+|\s+$', '', 'g') AS text FROM pages""")
def clean_pages(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", text.clean_html(F.col("html")).alias("text"))


@add("url_parts", "F9 F17", """
SELECT page_id, replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '') AS host, url AS safe, NULL::VARCHAR AS unsafe,
       CASE WHEN url LIKE 'https:%' THEN url END AS only_secure FROM pages""")
def url_parts(spark, sf):
    u = F.col("url")
    return t.table(spark, sf, "pages").select(
        "page_id",
        urls.host(u).alias("host"),
        urls.safe_url(F.concat(F.lit("  "), u, F.lit(" "))).alias("safe"),
        urls.safe_url(F.concat(F.lit("javascript:"), u)).alias("unsafe"),
        urls.safe_url(F.regexp_replace(u, "^http:", "ftp:")).alias("only_secure"),
    )


@add("content_hashes", "F10 F11", """
SELECT doc_id, substr(sha256(source || text), 1, 16) AS hash, true AS sound, false AS shouted FROM documents""")
def content_hashes(spark, sf):
    d = t.table(spark, sf, "documents").select("doc_id", text.content_hash(F.col("source"), F.col("text")).alias("hash"))
    return d.select("doc_id", "hash", text.is_hash_id(F.col("hash")).alias("sound"), text.is_hash_id(F.concat(F.lit("X"), F.col("hash"))).alias("shouted"))


@add("flags", "F12", """
SELECT doc_id, quality = 1 AS as_text, quality = 1 AS as_number, toxic = 1 AS as_word, false AS missing FROM labels""")
def flags(spark, sf):
    lab = t.table(spark, sf, "labels")
    return lab.select(
        "doc_id",
        names.truthy(F.when(F.col("quality") == 1, " true ").otherwise("no")).alias("as_text"),
        names.truthy(F.col("quality")).alias("as_number"),
        names.truthy(F.when(F.col("toxic") == 1, "Yes").otherwise("0.5")).alias("as_word"),
        names.truthy(F.lit(None).cast("string")).alias("missing"),
    )


# Rules for the routing and category queries; the words occur in the tables' invented prose.
ROUTES = [(["tion th", "que le"], "trade"), (["und der", "the "], "records"), (["ent"], "news")]
LABELS = {"BUILDING": "Construction", "MACHINERY": "Equipment"}


@add("routed_texts", "F25 S3", """
SELECT conv_id, turn, CASE WHEN contains(lower(text), 'tion th') OR contains(lower(text), 'que le') THEN 'trade'
  WHEN contains(lower(text), 'und der') OR contains(lower(text), 'the ') THEN 'records' WHEN contains(lower(text), 'ent') THEN 'news' END AS route FROM conversations""")
def routed_texts(spark, sf):
    return t.table(spark, sf, "conversations").select("conv_id", "turn", names.first_rule(F.col("text"), ROUTES).alias("route"))


@add("display_labels", "F14 F21 F15 J7", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Equipment' ELSE c_mktsegment END AS label,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Equipment' ELSE 'Other' END AS grouped,
       CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN c_mktsegment ELSE 'Other' END AS bucket FROM customer""")
def display_labels(spark, sf):
    seg = F.col("c_mktsegment")
    return t.table(spark, sf, "customer").select(
        "c_custkey", names.mapped(seg, LABELS).alias("label"), names.mapped(seg, LABELS, "Other").alias("grouped"),
        names.bucket(seg, ["BUILDING", "FURNITURE"]).alias("bucket"),
    )


@add("judge_answers", "F18", """
SELECT doc_id, CASE WHEN toxic = 1 OR lang = 'de' THEN 'other' ELSE lang END AS category,
       CASE WHEN toxic = 1 THEN '' ELSE 'T ' || source END AS english_title, CASE WHEN toxic = 1 THEN '' ELSE 's' END AS english_summary,
       toxic = 0 AND quality = 1 AS relevant, toxic = 1 AS error
FROM labels JOIN documents USING (doc_id)""")
def judge_answers(spark, sf):
    lab = t.table(spark, sf, "labels").join(t.table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")
    flag = F.when(F.col("lang") == "fr", F.when(F.col("quality") == 1, '"Yes"').otherwise('"no"')).otherwise(F.when(F.col("quality") == 1, "true").otherwise("false"))
    body = F.concat(
        F.lit('{"category": "'), F.col("lang"), F.lit('", "english_title": " T '), F.col("source"), F.lit('", "english_summary": "s ", "include_on_site": '), flag, F.lit("}")
    )
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    answer = F.when(F.col("toxic") == 1, F.substring_index(body, '"', 5)).when(F.col("quality") == 1, fenced).otherwise(body)
    parsed = text.parse_judgement(answer, ["en", "fr", "es", "it", "zh", "ko"], "other")
    return lab.select("doc_id", parsed.alias("j")).select("doc_id", "j.*")


@add("packed_fields", "F26 F27", """
SELECT c_custkey, 'segment=' || c_mktsegment || CASE WHEN c_acctbal > 0 THEN ', balance=' || c_nationkey ELSE '' END AS packed,
       CASE WHEN c_acctbal > 0 THEN c_nationkey::VARCHAR END AS balance, c_name AS cell FROM customer""")
def packed_fields(spark, sf):
    c = t.table(spark, sf, "customer")
    fields = {"segment": F.concat(F.lit(" "), F.col("c_mktsegment")), "balance": F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")), "none": F.lit("  ")}
    rows = c.select("c_custkey", names.packed(fields).alias("packed"), names.cell_text(F.concat(F.col("c_name"), F.lit("  "))).alias("cell"))
    return rows.select("c_custkey", "packed", F.try_element_at(names.unpacked(F.col("packed")), F.lit("balance")).alias("balance"), "cell")


@add("utc_stamps", "F30", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events")
def utc_stamps(spark, sf):
    return t.table(spark, sf, "events").select("event_id", dates.utc_stamp(F.col("ts")).alias("stamp"))


@add("slim_rows", "P14 P1", f"""
WITH {t.OBS_SQL} SELECT strftime(month, '%Y-%m') AS date, country, value::DOUBLE AS value, form FROM obs WHERE unit = 'KG'""")
def slim_rows(spark, sf):
    obs = t.observations(spark, sf, unit="KG").filter(F.col("month").isNotNull())
    return obs.select(dates.month_text(F.col("month")).alias("date"), "country", F.col("value").cast("double").alias("value"), "form")
