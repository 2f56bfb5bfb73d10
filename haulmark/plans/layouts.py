"""Registered queries: source layouts.

Spark renders each layout from the tables and lands it in the shared folder, as published files would
be; the operators then read the landed rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import keyed
from ..session import kept, scratch_folder
from ..sources import customs, files, grids, lines, news, wide
from . import tables as t
from .registry import REGISTRY

add = REGISTRY.add

FORMS = ["frozen", "dried", "other"]
DESCRIPTIONS = {"frozen": "Antlers; frozen", "dried": "Antlers; dried", "other": "Antlers, other than frozen or dried"}
# Codes of the three forms in the rendered files.
CODES = {"frozen": "0507901110", "dried": "0507901190", "other": "0510001000"}


def cells(spark, sf, *keys):
    """Weight and value per month, country and form (and further keys): the content of each layout.

    The facts are summed by supplier before they meet a dimension, and the few cells are written once: a layout reads
    them several times, for its lines, its files and its headings.
    """
    sums = t.observation_totals(spark, sf, "month", "form", *keys)
    every = sums.groupBy("month", "country", "form", *keys).agg(
        F.sum(F.when(F.col("unit") == "KG", F.col("value"))).alias("q"),
        F.sum(F.when(F.col("unit") == "USD", F.col("value"))).alias("v"),
    )
    return kept(every, "cells")


CELLS_SQL = f"""
{t.OBS_SQL}, cell AS (
  SELECT month, country, form, sum(value) FILTER (WHERE unit = 'KG') AS q, sum(value) FILTER (WHERE unit = 'USD') AS v FROM obs GROUP BY ALL)"""
CODE_SQL = "CASE form WHEN 'frozen' THEN '0507901110' WHEN 'dried' THEN '0507901190' ELSE '0510001000' END"


def landed(rows, name, path=None):
    """Writes lines (file, pos, text) as text files below one folder, a large file in several parts; the path."""
    path = path or f"{scratch_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    ordered = rows.repartitionByRange("file", "pos").sortWithinPartitions("file", "pos")
    ordered.select("file", "text").write.partitionBy("file").text(path)
    return path


def quoted(number):
    return F.concat(F.lit('"'), F.format_number(number.cast("double"), 3), F.lit('"'))


# --- wide files -----------------------------------------------------------------------------------


def nation_names(spark, sf):
    """Names of the nation dimension, the columns of a wide file."""
    return [r.n_name for r in t.table(spark, sf, "nation").select("n_name").distinct().orderBy("n_name").collect()]


def wide_lines(spark, sf):
    """One file per year: three header rows, a month per line, a footer and a line behind it."""
    nations = nation_names(spark, sf)
    slots = [(c, f) for c in nations for f in FORMS]
    head2 = ",".join(f'"{c}, Republic of"' + "," * (2 * len(FORMS) - 1) for c in nations)
    head3 = ",".join(f'"{DESCRIPTIONS[f]}",' for _, f in slots)
    head4 = ",".join("Quantity,Free on board" for _ in slots)
    fixed = [(1, "Exports" + "," * (2 * len(slots))), (2, '"",' + head2), (3, '" ",' + head3), (4, '" ",' + head4), (30, ",,,"), (31, "Source: office"), (32, "1990M01,5,5")]
    months = cells(spark, sf).groupBy("month").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "country", "form"), F.struct("q", "v")))).alias("m")
    )
    order = F.array(*[F.lit(f"{c}|{f}") for c, f in slots])
    texts = F.transform(
        order, lambda k: F.coalesce(F.concat(quoted(F.try_element_at("m", k)["q"]), F.lit(","), quoted(F.try_element_at("m", k)["v"])), F.lit(","))
    )
    file = F.concat(F.lit("wide_"), F.year("month").cast("string"), F.lit(".csv"))
    data = months.select(
        file.alias("file"), (F.month("month") + 4).alias("pos"), F.concat(F.date_format("month", "yyyy'M'MM"), F.lit(","), F.array_join(texts, ",")).alias("text")
    )
    others = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(x).alias("text")) for p, x in fixed])
    rest = data.select("file").distinct().select("file", F.explode(others).alias("l")).select("file", "l.pos", "l.text")
    return data.unionByName(rest)


@add("wide_to_long", "S1 S2 S3 S4 W3 W7 P12 F2", f"""
WITH {CELLS_SQL}, m AS (SELECT DISTINCT month FROM cell), p AS (
  SELECT month, row_number() OVER (PARTITION BY year(month) ORDER BY month DESC) <= 3 AS prov FROM m)
SELECT strftime(p.month, '%Y-%m') AS date, 'wide' AS series, '0507.90' AS hs_code, 'Horns, antlers, hooves, nails, claws and beaks — other' AS hs_label,
       n_name AS country, 'source: wide_' || year(p.month) || '.csv | provisional: ' || CASE WHEN prov THEN 'True' ELSE 'False' END AS notes,
       CASE f.form WHEN 'frozen' THEN '0507901110' ELSE '0507901190' END AS hs_code_10digit, f.form AS product_type,
       coalesce(CASE u.unit WHEN 'KG' THEN q ELSE v END, 0)::DOUBLE AS value, u.unit
FROM p CROSS JOIN nation CROSS JOIN (VALUES ('frozen'), ('dried'), ('other')) f(form) CROSS JOIN (VALUES ('KG'), ('NZD')) u(unit)
LEFT JOIN cell c ON c.month = p.month AND c.country = n_name AND c.form = f.form""")
def wide_to_long(spark, sf):
    destinations = {f"{c}, Republic of": c for c in nation_names(spark, sf)}
    path = landed(wide_lines(spark, sf), "wide")
    heads = lines.read_heads(spark, path, wide.HEADER_LINES)
    return wide.wide_to_long(lines.read_lines(spark, path), heads=heads, series="wide", value_unit="NZD", destinations=destinations)


# --- customs --------------------------------------------------------------------------------------


def customs_lines(spark, sf):
    """One file per series, with total rows, malformed numbers and idle rows; one file lacks a column."""
    head = "﻿기간,국가,HS코드,품목명,수출 중량,수출 금액,수입 중량,수입 금액,무역수지"
    c = cells(spark, sf, "series")
    country = F.when(F.col("country") == "NATION_8", customs.GRAND_TOTAL).otherwise(F.col("country"))
    weight = F.when(F.col("country") == "NATION_9", F.lit("n/a")).otherwise(quoted(F.when(F.col("country") == "NATION_7", F.lit(0)).otherwise(F.col("q"))))
    value = F.when(F.col("country") == "NATION_7", F.lit("0")).otherwise(quoted(F.col("v")))
    code = F.when(F.col("form") == "frozen", CODES["frozen"]).when(F.col("form") == "dried", CODES["dried"]).otherwise(CODES["other"])
    rows = c.select(
        F.concat(F.lit("customs_"), F.col("series"), F.lit(".csv")).alias("file"),
        F.lit(1).alias("pos"),
        F.concat_ws(",", F.date_format("month", "yyyy-MM"), F.concat(F.lit('"'), country, F.lit('"')), code, F.col("form"), F.lit("0"), F.lit("0"), weight, value, F.lit("-1")).alias("text"),
    )
    good = rows.select("file").distinct().select("file", F.lit(0).alias("pos"), F.lit(head).alias("text"))
    bad = rows.select(F.lit("customs_bad.csv").alias("file"), "pos", "text").unionByName(
        rows.limit(1).select(F.lit("customs_bad.csv").alias("file"), F.lit(0).alias("pos"), F.lit(head.replace("수입 중량", "중량")).alias("text"))
    )
    return rows.unionByName(good).unionByName(bad)


def parsed_customs(spark, sf):
    path = landed(customs_lines(spark, sf), "customs")
    return customs.customs_csv(lines.read_lines(spark, path), heads=lines.read_heads(spark, path, 1), series="customs")


@add("customs_csv", "S5 S6 P11 P12 F6", f"""
WITH {t.OBS_SQL}, c AS (
  SELECT series, month, country, form, sum(value) FILTER (WHERE unit = 'KG') AS q, sum(value) FILTER (WHERE unit = 'USD') AS v FROM obs GROUP BY ALL)
SELECT strftime(month, '%Y-%m') AS date, 'customs' AS series, substr({CODE_SQL}, 1, 4) || '.' || substr({CODE_SQL}, 5, 2) AS hs_code, form AS hs_label,
       country, 'source=customs_' || series || '.csv' AS notes, {CODE_SQL} AS hs_code_10digit, form AS product_type,
       trunc(CASE u.unit WHEN 'KG' THEN q ELSE v END)::DOUBLE AS value, u.unit
FROM c CROSS JOIN (VALUES ('KG'), ('USD_thousands')) u(unit) WHERE country NOT IN ('NATION_7', 'NATION_8', 'NATION_9')""")
def customs_csv(spark, sf):
    return parsed_customs(spark, sf).rows


@add("customs_csv_rejects", "S6", "SELECT 'customs_bad.csv' AS file, '수입 중량' AS missing FROM region WHERE r_regionkey = 0")
def customs_csv_rejects(spark, sf):
    return parsed_customs(spark, sf).rejects


LABELS = {"0507901110": "frozen goods", "0507901190": "dried goods"}
LABEL_SQL = f"CASE form WHEN 'frozen' THEN 'frozen goods' WHEN 'dried' THEN 'dried goods' ELSE '0510001000' END"


@add("customs_json", "S7 P11", f"""
WITH {CELLS_SQL}
SELECT strftime(month, '%Y-%m') AS date, 'api' AS series, substr({CODE_SQL}, 1, 4) || '.' || substr({CODE_SQL}, 5, 2) AS hs_code, {LABEL_SQL} AS hs_label,
       country, 'hs10=' || {CODE_SQL} AS notes, {CODE_SQL} AS hs_code_10digit, form AS product_type,
       trunc(CASE u.unit WHEN 'KG' THEN q ELSE v END)::DOUBLE AS value, u.unit
FROM cell CROSS JOIN (VALUES ('KG'), ('USD_thousands')) u(unit)""")
def customs_json(spark, sf):
    item = F.struct(
        F.col("country").alias("cntyNm"),
        F.col("q").cast("double").alias("imp_cur_mon_wgt"),
        F.col("v").cast("string").alias("imp_cur_mon_usd"),
    )
    code = F.when(F.col("form") == "frozen", CODES["frozen"]).when(F.col("form") == "dried", CODES["dried"]).otherwise(CODES["other"])
    pages = cells(spark, sf).groupBy(F.date_format("month", "yyyy-MM").alias("period"), F.month("month").alias("mo"), code.alias("code")).agg(
        F.to_json(F.collect_list(item)).alias("items"), F.to_json(F.first(item)).alias("one"), F.count(F.lit(1)).alias("n")
    )
    one = F.when(F.col("n") == 1, F.col("one")).otherwise(F.col("items"))
    body = (
        F.when(F.col("mo") % 3 == 0, F.concat(F.lit('{"items":'), F.col("items"), F.lit("}")))
        .when(F.col("mo") % 3 == 1, F.concat(F.lit('{"response":{"body":{"items":{"item":'), one, F.lit("}}}}")))
        .otherwise(F.concat(F.lit('{"response":{"body":{"items":'), F.col("items"), F.lit("}}}")))
    )
    return customs.customs_json(pages.withColumn("body", body), body="body", period="period", code="code", series="api", labels=LABELS)


@add("customs_xml", "S8 P11", f"""
WITH {CELLS_SQL}
SELECT strftime(month, '%Y-%m') AS date, 'api' AS series, substr({CODE_SQL}, 1, 4) || '.' || substr({CODE_SQL}, 5, 2) AS hs_code, {LABEL_SQL} AS hs_label,
       CASE country WHEN 'NATION_1' THEN 'First land' ELSE country END AS country, 'hs10=' || {CODE_SQL} || ' | source=getNitemtradeList' AS notes,
       {CODE_SQL} AS hs_code_10digit, form AS product_type,
       CASE u.unit WHEN 'KG' THEN trunc(q)::DOUBLE ELSE round(v::DOUBLE / 1000.0, 3) END AS value, u.unit
FROM cell CROSS JOIN (VALUES ('KG'), ('USD_thousands')) u(unit) WHERE country <> 'NATION_6'""")
def customs_xml(spark, sf):
    tag = lambda n, c: F.concat(F.lit(f"<{n}>"), c, F.lit(f"</{n}>"))
    shown = F.when(F.col("country") == "NATION_1", F.lit(" ")).otherwise(F.col("country"))
    item = tag("item", F.concat(tag("year", F.date_format("month", "yyyy.MM")), tag("statCdCntnKor1", shown), tag("impWgt", F.col("q").cast("string")), tag("impDlr", F.col("v").cast("string"))))
    total = "<item><year>총계</year><impWgt>5</impWgt><impDlr>5</impDlr></item>"
    code = F.when(F.col("form") == "frozen", CODES["frozen"]).when(F.col("form") == "dried", CODES["dried"]).otherwise(CODES["other"])
    pages = cells(spark, sf).groupBy("country", F.year("month").alias("y"), code.alias("code")).agg(F.array_join(F.collect_list(item), "").alias("items"))
    status = F.when(F.col("country") == "NATION_6", "99").otherwise("00")
    body = F.concat(
        F.lit("<response><header>"), tag("resultCode", status), F.lit("</header><body><items>" + total), F.col("items"), F.lit("</items></body></response>")
    )
    return customs.customs_xml(
        pages.withColumn("body", body), body="body", country_code="country", code="code", series="api", labels=LABELS, countries={"NATION_1": "First land"}
    )


# --- grids ----------------------------------------------------------------------------------------

# The layouts name years from 2000 on; the tables start in 1995.
SHIFT_YEARS = 10
PRODUCT_OF = {"frozen": "생녹용", "dried": "녹용", "other": "녹각"}
GRID_LABEL_SQL = "'0507.90' AS hs_code, 'Horns, antlers, hooves, nails, claws and beaks — other' AS hs_label"


def product():
    return F.when(F.col("form") == "frozen", PRODUCT_OF["frozen"]).when(F.col("form") == "dried", PRODUCT_OF["dried"]).otherwise(PRODUCT_OF["other"])


def annual_sheet(spark, sf):
    """One sheet per year: title, headings over column pairs, merged product cells, subtotal rows."""
    c = cells(spark, sf)
    months = F.sequence(F.lit(1), F.lit(12))
    rows = c.groupBy((F.year("month") + SHIFT_YEARS).alias("y"), "country", "form").agg(
        F.map_from_entries(F.collect_list(F.struct(F.month("month"), F.struct("q", "v")))).alias("m")
    )
    number = lambda x: F.coalesce(F.format_number(x.cast("double"), 3), F.lit("-"))
    values = F.flatten(F.transform(months, lambda k: F.array(number(F.try_element_at("m", k)["v"]), number(F.try_element_at("m", k)["q"]))))
    form_no = F.when(F.col("form") == "frozen", 0).when(F.col("form") == "dried", 1).otherwise(2)
    nation = F.regexp_extract("country", r"(\d+)", 1).cast("int")
    # NATION_0 carries the merged product cell: it is the first line of each product block.
    named = F.when(F.col("country") == "NATION_0", product()).otherwise("")
    file = F.concat(F.lit("sheet_"), F.col("y").cast("string"), F.lit("_ANNUAL.xlsx"))
    data = rows.select(file.alias("file"), (form_no * 40 + nation + 5).alias("row_no"), F.concat(F.array(F.lit("축산물"), named, F.col("country")), values).alias("cells"))
    years = rows.select("y").distinct()
    blank = lambda n: F.array(*[F.lit("")] * n)
    pair = F.flatten(F.transform(months, lambda k: F.array(F.format_string("%d.%02d", F.col("y"), k), F.lit(""))))
    sub = F.flatten(F.transform(months, lambda k: F.array(F.lit("건수"), F.lit("수량"))))
    heads = years.select(
        file.alias("file"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("row_no"), F.concat(F.array(F.lit("검역 현황")), blank(2)).alias("cells")),
                F.struct(F.lit(3).alias("row_no"), F.concat(F.array(F.lit("품목명"), F.lit("품 명"), F.lit("국가명")), pair).alias("cells")),
                F.struct(F.lit(4).alias("row_no"), F.concat(blank(3), sub).alias("cells")),
                F.struct(F.lit(32).alias("row_no"), F.concat(F.array(F.lit(""), F.lit(""), F.lit("국가계")), F.transform(sub, lambda _: F.lit("9"))).alias("cells")),
            )
        ).alias("l"),
    ).select("file", "l.row_no", "l.cells")
    sheet = kept(data.unionByName(heads), "annual_sheet")
    return sheet.select("file", F.lit(0).alias("table_no"), F.col("row_no").cast("bigint").alias("row_no"), "cells")


@add("annual_grid", "S9 W3 P10 P11 F3", f"""
WITH {CELLS_SQL}, c AS (SELECT (month + INTERVAL 10 YEAR)::DATE AS m, * FROM cell WHERE form <> 'other'),
first AS (SELECT DISTINCT year(m) AS y, form FROM c WHERE country = 'NATION_0')
SELECT strftime(m, '%Y-%m') AS date, 'quarantine' AS series, {GRID_LABEL_SQL}, country,
       'source: sheet_' || year(m) || '_ANNUAL.xlsx | product: ' || CASE form WHEN 'frozen' THEN '생녹용' ELSE '녹용' END AS notes,
       {CODE_SQL} AS hs_code_10digit, form AS product_type, CASE u.unit WHEN 'KG' THEN q ELSE v END::DOUBLE AS value, u.unit
FROM c CROSS JOIN (VALUES ('KG'), ('shipments')) u(unit) WHERE (year(m), form) IN (SELECT (y, form) FROM first)""")
def annual_grid(spark, sf):
    return grids.annual_grid(annual_sheet(spark, sf), series=F.lit("quarantine"))


def monthly_pages(spark, sf):
    """One HTML table per month inside a layout table, country cells spanning rows, subtotal rows."""
    c = cells(spark, sf).withColumn("kg", F.format_number(F.col("q").cast("double"), 3)).withColumn("n", F.format_number(F.col("v").cast("double"), 3))
    td = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    line = F.struct("form", F.concat(td(product()), td("n"), td("kg"), F.lit("</tr>")).alias("rest"))
    blocks = c.groupBy("month", "country").agg(F.sort_array(F.collect_list(line)).alias("l"))
    block = F.concat(
        F.lit("<tr><td rowspan='3'>"), F.col("country"), F.lit("</td>"), F.get("l", F.lit(0))["rest"],
        F.array_join(F.transform(F.slice("l", 2, 5), lambda x: F.concat(F.lit("<tr><td></td>"), x["rest"])), ""),
        F.lit("<tr><td></td><td>품명계</td><td>9</td><td>9</td></tr>"),
    )
    body = blocks.groupBy("month").agg(F.array_join(F.collect_list(block), "").alias("b"))
    head = "\n\n <html><table><tr><td>검역 <table><tr><th>국 가</th><th>품 명</th><th>건 수</th><th>중량(kg/ea)</th></tr>"
    pages = body.select(
        F.concat(F.lit("month_"), F.date_format(F.add_months("month", 12 * SHIFT_YEARS), "yyyy-MM"), F.lit("_IMPORT.xls")).alias("file"),
        F.concat(F.lit(head), F.col("b"), F.lit("<tr><td>총 계</td><td>x</td><td>1</td><td>1</td></tr></table></td></tr></table></html>")).alias("html"),
    )
    return kept(pages, "monthly_pages")


@add("monthly_grid", "S10 S22 W3 P11", f"""
WITH {CELLS_SQL}, c AS (SELECT strftime((month + INTERVAL 10 YEAR)::DATE, '%Y-%m') AS m, * FROM cell)
SELECT m AS date, 'quarantine' AS series, {GRID_LABEL_SQL}, country, 'source: month_' || m || '_IMPORT.xls' AS notes,
       '0507901190' AS hs_code_10digit, 'dried' AS product_type, CASE u.unit WHEN 'KG' THEN q ELSE v END::DOUBLE AS value, u.unit
FROM c CROSS JOIN (VALUES ('KG'), ('shipments')) u(unit)""")
def monthly_grid(spark, sf):
    series = files.series_of(F.col("file"), "quarantine", "quarantine_export")
    rows = kept(grids.rows_from_html(monthly_pages(spark, sf)), "tables")
    return grids.monthly_grid(rows, series=series, period=files.period_of(F.col("file")))


@add("html_cells", "S10", """
SELECT page_id::VARCHAR AS file, 0 AS table_no, 0 AS row_no, 0 AS col_no, url AS cell FROM pages
UNION ALL SELECT page_id::VARCHAR, 0, 0, 1, length(html)::VARCHAR FROM pages""")
def html_cells(spark, sf):
    """Every page with a one-row table put behind its own markup."""
    row = F.concat(F.lit("<table><tr><td> "), F.regexp_replace("url", "&", "&amp;"), F.lit(" </td><td>"), F.length("html").cast("string"), F.lit("</td></tr></table>"))
    p = t.table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("file"), F.concat("html", row).alias("html"))
    return grids.rows_from_html(p).select("file", "table_no", F.col("row_no").cast("int").alias("row_no"), F.posexplode("cells").alias("col_no", "cell"))


def record_sheet(spark, sf, heads, values, *, title_rows, file):
    """Lines of import lists: title rows, the headings of each file, one line per record. The records are joined once."""
    body = t.import_records(spark, sf).select(
        file.alias("file"), (F.col("record_id") + title_rows + 1).cast("bigint").alias("row_no"), F.array(*values).alias("cells")
    )
    body = kept(body, "record_lines")
    headings = F.create_map(*[x for name, h in heads.items() for x in (F.lit(name), F.array(*[F.lit(c) for c in h]))])
    top = body.select("file").distinct().select("file", F.lit(title_rows).cast("bigint").alias("row_no"), F.element_at(headings, F.col("file")).alias("cells"))
    rows = body.unionByName(kept(top, "record_heads"))
    return rows.select("file", F.lit(0).alias("table_no"), "row_no", "cells")


@add("historical_records", "S12 F4 F5 F27", f"""
WITH {t.REC_SQL}
SELECT day::VARCHAR AS date, CASE WHEN product_name LIKE '1%' THEN strftime(day, '%Y') ELSE year(day)::VARCHAR END AS year,
       CASE WHEN product_name LIKE '1%' THEN strftime(day, '%m') ELSE month(day)::VARCHAR END AS month,
       CASE WHEN product_name LIKE '1%' THEN strftime(day, '%d') ELSE day(day)::VARCHAR END AS day,
       importer_en, '' AS product_type_en, origin_en AS country_origin_en, '' AS country_export_en, importer_local AS importer_ko, product_name,
       product_en, '' AS product_type_ko, '' AS exporter_en, (day + 365)::VARCHAR AS expiry_date, origin_local AS country_origin_ko,
       '' AS country_export_ko, importer_local AS importer, '' AS notes FROM rec""")
def historical_records(spark, sf):
    own = ~F.col("product_name").startswith("1")
    part = lambda f: F.when(own, F.concat(f("day").cast("string"), F.lit(".0"))).otherwise("")
    values = [
        part(F.year), part(F.month), part(F.dayofmonth), F.col("importer_en"), F.col("importer_local"), F.concat(F.lit(" "), F.col("product_name")),
        F.col("product_en"), F.date_format("day", "yyyyMMdd"), F.date_add("day", 365).cast("string"), F.col("origin_local"), F.col("origin_en"),
    ]
    heads = ["Year", "Month", "Day", "Importer", "Importer (Korean)", "Product name (Korean)", "Product name (English)", "Date",
             "Expire date start from", "Country of origin (KR)", "Country of origin"]
    sheet = record_sheet(spark, sf, {"import_list.xlsx": heads}, values, title_rows=1, file=F.lit("import_list.xlsx"))
    return grids.historical_records(sheet)


@add("portal_records", "S13 S21 F26 F4", f"""
WITH {t.REC_SQL}
SELECT day::VARCHAR AS date, strftime(day, '%Y') AS year, strftime(day, '%m') AS month, strftime(day, '%d') AS day, '' AS importer_en, '' AS product_type_en,
       '' AS country_origin_en, '' AS country_export_en, importer_local AS importer_ko, product_name, product_en,
       'type ' || product_name AS product_type_ko, 'maker' AS exporter_en, (day + 365)::VARCHAR AS expiry_date, origin_local AS country_origin_ko,
       '' AS country_export_ko, importer_local AS importer,
       '신고번호=' || record_id || CASE WHEN origin_en <> '' THEN ', 원산지=' || origin_en ELSE '' END AS notes FROM rec""")
def portal_records(spark, sf):
    values = [
        F.date_format("day", "yyyyMMdd"), F.col("importer_local"), F.col("product_name"), F.col("product_en"), F.col("origin_local"),
        F.concat(F.lit("type "), F.col("product_name")), F.lit("maker"), F.date_add("day", 365).cast("string"), F.col("record_id").cast("string"), F.col("origin_en"),
    ]
    common = ["처리일자", "수입업체", "제품명(한글)", "제품명(영문)", "제조국"]

    old, new = "수입식품조회20240101.xlsx", "수입식품조회20260701.xlsx"
    heads = {
        name: [*common, *extra, "신고번호", "원산지"]
        for name, extra in ((old, ["품목류", "제조사(영문)", "유통기한"]), (new, ["품목(유형)", "해외제조업소", "소비기한"]))
    }
    file = F.when(F.col("day") < F.lit("1998-01-01").cast("date"), old).otherwise(new)
    rows = record_sheet(spark, sf, heads, values, title_rows=2, file=file)
    routed = rows.withColumn("layout", files.record_layout(F.col("file"))).filter("layout = 'portal'")
    return grids.portal_records(routed)


# --- rankings, inventory, names ---------------------------------------------------------------------


def price_lines(spark, sf):
    p = t.table(spark, sf, "part")
    year = F.when(F.col("p_size") == 1, "1999").otherwise((F.col("p_size") + 2000).cast("string"))
    rank = F.when(F.col("p_size") == 2, "0").otherwise((F.col("p_partkey") + 1).cast("string"))
    name = F.when(F.col("p_size") == 3, " ").otherwise(F.col("p_name"))
    price = F.when(F.col("p_size") == 4, "abc").otherwise(F.concat(F.lit('"'), F.format_number("p_retailprice", 1), F.lit('"')))
    file = F.concat(F.lit("prices_"), F.lower("p_type"), F.lit(".csv"))
    rows = p.select(file.alias("file"), (F.col("p_partkey") + 1).alias("pos"), F.concat_ws(",", year, name, rank, price, F.col("p_brand")).alias("text"))
    head = F.when(F.col("file").contains("small"), "﻿연 도,제품명,순위,가격(원),원산지").otherwise("Year,Product Name,RANK,price,country")
    heads = rows.select("file").distinct().select("file", F.lit(0).cast("bigint").alias("pos"), head.alias("text"))
    return rows.unionByName(heads)


def parsed_prices(spark, sf):
    path = landed(price_lines(spark, sf), "prices")
    return customs.price_rows(lines.read_lines(spark, path), heads=lines.read_heads(spark, path, 1))


@add("ranking_rows", "S14", """
SELECT (p_size + 2000)::VARCHAR AS year, (p_partkey + 1)::VARCHAR AS rank, p_name AS product_name,
       CASE WHEN round(p_retailprice, 1) = floor(round(p_retailprice, 1)) THEN round(p_retailprice, 1)::BIGINT::VARCHAR ELSE round(p_retailprice, 1)::VARCHAR END AS price_krw,
       '' AS company_name, p_brand AS origin_country, '' AS notes FROM part WHERE p_size > 4""")
def ranking_rows(spark, sf):
    return parsed_prices(spark, sf).rows


@add("ranking_rejects", "S14", """
WITH l AS (SELECT p_partkey, p_size, 'prices_' || lower(p_type) || '.csv' AS file, concat_ws(',', CASE p_size WHEN 1 THEN '1999' ELSE (p_size + 2000)::VARCHAR END,
    CASE p_size WHEN 3 THEN ' ' ELSE p_name END, CASE p_size WHEN 2 THEN '0' ELSE (p_partkey + 1)::VARCHAR END,
    CASE p_size WHEN 4 THEN 'abc' ELSE '"' || format('{:,.1f}', round(p_retailprice, 1)) || '"' END, p_brand) AS text FROM part),
b AS (SELECT *, strlen(CASE WHEN file LIKE '%small%' THEN chr(65279) || '연 도,제품명,순위,가격(원),원산지' ELSE 'Year,Product Name,RANK,price,country' END) + 1
    + coalesce(sum(strlen(text) + 1) OVER (PARTITION BY file ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM l)
SELECT file, pos::BIGINT AS pos,
       CASE p_size WHEN 1 THEN 'year invalid' WHEN 2 THEN 'rank invalid' WHEN 3 THEN 'product_name is empty' ELSE 'price_krw invalid' END AS reasons
FROM b WHERE p_size <= 4""")
def ranking_rejects(spark, sf):
    """``pos`` is the byte of the file at which the rejected line starts."""
    return parsed_prices(spark, sf).rejects.withColumn("reasons", F.array_join("reasons", "; "))


def listing(spark, sf):
    """Pages as a file listing: a third without a media type, some names without a suffix."""
    p = t.table(spark, sf, "pages")
    kind = F.col("page_id") % 5
    name = F.concat(F.lit("report_20"), F.lpad((F.col("page_id") % 40).cast("string"), 2, "0"), F.when(kind == 0, "-07").otherwise(""), F.when(kind == 1, "_export").otherwise("_import"))
    suffix = F.when(kind == 0, ".xls").when(kind == 1, ".XLSX").when(kind == 2, ".pdf").when(kind == 3, "").otherwise(".hwp")
    media = F.when(kind == 2, "application/pdf").when(kind == 1, "application/vnd.ms-excel").otherwise("application/octet-stream")
    return p.select(F.concat(F.lit("id-"), F.col("page_id").cast("string")).alias("file_id"), F.concat(name, suffix).alias("name"), media.alias("media"), F.lit("in").alias("folder"), F.col("html"), F.col("page_id"))


NAME_SQL = """
n AS (SELECT page_id, html, page_id % 5 AS k, 'report_20' || lpad((page_id % 40)::VARCHAR, 2, '0') || CASE page_id % 5 WHEN 0 THEN '-07' ELSE '' END
  || CASE page_id % 5 WHEN 1 THEN '_export' ELSE '_import' END || CASE page_id % 5 WHEN 0 THEN '.xls' WHEN 1 THEN '.XLSX' WHEN 2 THEN '.pdf' WHEN 3 THEN '' ELSE '.hwp' END AS name FROM pages)"""


@add("file_inventory", "S18", f"""
WITH {NAME_SQL}
SELECT 'id-' || page_id AS file_id, name AS filename, 'in' AS source_folder, CASE k WHEN 0 THEN 'xls' WHEN 1 THEN 'xls' WHEN 2 THEN 'pdf' WHEN 3 THEN 'unknown' ELSE 'hwp' END AS file_type,
       '2024-01-01' AS ingested_at FROM n""")
def file_inventory(spark, sf):
    inv = files.inventory(listing(spark, sf), file_id="file_id", name="name", media_type="media", folder="folder", seen_at=F.lit("2024-01-01"))
    return keyed.pick_per_key(inv, ["file_id"], [F.col("filename")])


@add("file_names", "S11 S21 S22 F28", f"""
WITH {NAME_SQL}
SELECT page_id, CASE WHEN k = 0 THEN substr(name, 8, 7) ELSE substr(name, 8, 4) END AS period, CASE k WHEN 1 THEN 'q_export' ELSE 'q' END AS series,
       CASE k WHEN 0 THEN 'html' WHEN 1 THEN 'workbook' END AS format, 'historical' AS layout FROM n""")
def file_names(spark, sf):
    rows = listing(spark, sf)
    content = F.concat(F.lit("\n\n  "), F.col("html")).cast("binary")
    return rows.select(
        "page_id",
        files.period_of(F.col("name")).alias("period"),
        files.series_of(F.col("name"), "q", "q_export").alias("series"),
        files.sheet_format(F.col("name"), content).alias("format"),
        files.record_layout(files.composed(F.col("name"))).alias("layout"),
    )


@add("keyword_list", "S20", "SELECT DISTINCT o_orderpriority AS term FROM orders")
def keyword_list(spark, sf):
    terms = t.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("term")).distinct()
    return news.keywords(terms, ["default"])
