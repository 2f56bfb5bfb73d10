"""Customs statistics: delimited files, JSON and XML responses, yearly totals, ranking files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures, names
from ..session import kept, small_side
from .lines import first_lines, split_cells
from .wide import two_units

# Header names of the customs file.
PERIOD, COUNTRY, CODE, LABEL = "기간", "국가", "HS코드", "품목명"
WEIGHT, VALUE = "수입 중량", "수입 금액"
REQUIRED = [PERIOD, COUNTRY, CODE, LABEL, WEIGHT, VALUE]
# Fixed value: the name of a grand-total row.
GRAND_TOTAL = "총계"
# Product form of the ten-digit codes.
FORM_OF_CODE = {"0507901110": "frozen", "0507901190": "dried"}
# Accepted header spellings of the ranking file.
PRICE_ALIASES = {
    "year": ["year", "연도", "연 도", "년도"],
    "rank": ["rank", "순위", "순 위"],
    "product_name": ["product_name", "제품명", "품목명", "product name"],
    "price_krw": ["price_krw", "가격", "단가(원)", "단가", "가격(원)", "price"],
    "company_name": ["company_name", "업체명", "수입업체", "company name"],
    "origin_country": ["origin_country", "원산지", "원산지국", "country"],
    "notes": ["notes", "비고", "메모", "note"],
}
PRICE_REQUIRED = ["year", "rank", "product_name", "price_krw"]


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def keyed_cells(
    lines: DataFrame, *, rename: Mapping[str, Sequence[str]] | None = None, required: Sequence[str], heads: DataFrame | None = None
) -> Parsed:
    """Delimited lines as ``(file, pos, cells map<name, text>)``; columns are found by header name.

    A file without a required column is left out and reported with the names it lacks; the other
    files go on. ``rename`` gives accepted spellings, compared without case and with spaces as
    underscores; the first matching column counts. ``heads`` has the first lines of the files where
    they can be read apart.
    """
    clean = F.transform(split_cells(F.regexp_replace("text", "^﻿", "")), lambda c: F.trim(c))
    head = first_lines(lines if heads is None else heads, 1).select("file", F.col("pos").alias("header_pos"), clean.alias("names"))
    if rename:
        spelling = {a.lower().replace(" ", "_"): k for k, spellings in rename.items() for a in spellings}
        known = names.literal_map(spelling)
        head = head.withColumn(
            "names", F.transform("names", lambda n: F.element_at(known, F.regexp_replace(F.lower(F.trim(n)), " ", "_")))
        )
        head = head.withColumn(
            "names",
            F.transform("names", lambda n, i: F.when(F.array_position(F.col("names"), n) == i + 1, n)),
        )
    missing = F.array_except(F.array(*[F.lit(r) for r in required]), F.array_compact("names"))
    # One row per file; stored, so that the broadcast decision rests on its real size.
    checked = kept(head.withColumn("missing", missing), "headers")
    good = checked.filter(F.size("missing") == 0).select("file", "header_pos", "names")
    bad = checked.filter(F.size("missing") > 0).select("file", F.array_join("missing", ", ").alias("missing"))
    cells = F.transform(split_cells(F.col("text")), lambda c: F.trim(c))
    rows = (
        lines.join(small_side(good), "file")
        .filter((F.col("pos") > F.col("header_pos")) & (F.trim("text") != ""))
        .select(
            "file",
            "pos",
            F.map_from_entries(
                F.filter(
                    F.arrays_zip(F.col("names").alias("k"), F.slice(cells, 1, F.size("names")).alias("v")),
                    lambda e: F.coalesce(e["k"], F.lit("")) != "",
                )
            ).alias("cells"),
        )
    )
    return Parsed(rows, bad)


def cell(name: str) -> Column:
    return F.coalesce(F.element_at("cells", F.lit(name)), F.lit(""))


def observation_rows(df: DataFrame, *, series: str, value_unit: str, weight_unit: str = "KG") -> DataFrame:
    """Stored rows from ``date, hs_code, hs_label, country, notes, hs_code_10digit, weight, amount``.

    Rows with no activity in either measure are dropped.
    """
    active = df.filter((F.col("weight") != 0) | (F.col("amount") != 0))
    full = active.select(
        "date",
        F.lit(series).alias("series"),
        "hs_code",
        "hs_label",
        "country",
        "notes",
        "hs_code_10digit",
        names.mapped(F.col("hs_code_10digit"), FORM_OF_CODE, "other").alias("product_type"),
        F.col("weight").cast("double").alias("weight"),
        F.col("amount").cast("double").alias("amount"),
    )
    return two_units(full, {weight_unit: "weight", value_unit: "amount"})


def customs_csv(lines: DataFrame, *, series: str, value_unit: str = "USD_thousands", heads: DataFrame | None = None) -> Parsed:
    """Customs files: total and blank countries, malformed numbers and inactive rows are left out."""
    parsed = keyed_cells(lines, required=REQUIRED, heads=heads)
    country = F.trim(cell(COUNTRY))
    code = F.regexp_replace(F.trim(cell(CODE)), r"[. ]", "")
    rows = parsed.rows.filter(~country.isin("", GRAND_TOTAL)).select(
        F.trim(cell(PERIOD)).alias("date"),
        names.dotted_code(cell(CODE)).alias("hs_code"),
        F.trim(cell(LABEL)).alias("hs_label"),
        country.alias("country"),
        F.concat(F.lit("source="), F.col("file")).alias("notes"),
        code.alias("hs_code_10digit"),
        measures.whole_number(cell(WEIGHT)).alias("weight"),
        measures.whole_number(cell(VALUE)).alias("amount"),
    )
    return Parsed(observation_rows(rows.dropna(subset=["weight", "amount"]), series=series, value_unit=value_unit), parsed.rejects)


def customs_json(
    landed: DataFrame, *, body: str, period: str, code: str, series: str, labels: Mapping[str, str], value_unit: str = "USD_thousands"
) -> DataFrame:
    """JSON responses. Items sit under ``items`` or ``response.body.items``, as a list, one object, or
    an object with ``item``.
    """
    found = F.coalesce(F.get_json_object(body, "$.items"), F.get_json_object(body, "$.response.body.items"))
    inner = F.when(found.startswith("{"), F.get_json_object(found, "$.item")).otherwise(found)
    listed = F.when(inner.startswith("{"), F.concat(F.lit("["), inner, F.lit("]"))).otherwise(inner)
    shape = "array<struct<cntyNm: string, imp_cur_mon_wgt: string, imp_cur_mon_usd: string>>"
    items = landed.select(F.col(period).alias("date"), F.col(code).alias("code"), F.explode(F.from_json(listed, shape)).alias("i"))
    rows = items.select(
        "date",
        names.dotted_code(F.col("code")).alias("hs_code"),
        names.mapped(F.col("code"), labels).alias("hs_label"),
        names.cell_text(F.col("i.cntyNm")).alias("country"),
        F.concat(F.lit("hs10="), F.col("code")).alias("notes"),
        F.col("code").alias("hs_code_10digit"),
        measures.whole_number(F.col("i.imp_cur_mon_wgt")).alias("weight"),
        measures.whole_number(F.col("i.imp_cur_mon_usd")).alias("amount"),
    )
    return observation_rows(rows.dropna(subset=["weight", "amount"]), series=series, value_unit=value_unit)


def customs_xml(
    landed: DataFrame,
    *,
    body: str,
    country_code: str,
    code: str,
    series: str,
    labels: Mapping[str, str],
    countries: Mapping[str, str],
    value_unit: str = "USD_thousands",
) -> DataFrame:
    """XML responses with result code 00; periods ``YYYY.MM``; plain dollars become thousands."""
    shape = (
        "header struct<resultCode: string>, body struct<items: struct<item: array<struct<year: string, "
        "statCdCntnKor1: string, impWgt: string, impDlr: string>>>>"
    )
    parsed = landed.select(F.col(country_code).alias("cc"), F.col(code).alias("code"), F.from_xml(body, shape, {"mode": "PERMISSIVE"}).alias("x"))
    items = parsed.filter(F.trim(F.col("x.header.resultCode")) == "00").select("cc", "code", F.explode("x.body.items.item").alias("i"))
    period = F.trim(F.coalesce(F.col("i.year"), F.lit("")))
    rows = items.filter((period != GRAND_TOTAL) & period.contains(".")).select(
        F.replace(period, F.lit("."), F.lit("-")).alias("date"),
        names.dotted_code(F.col("code")).alias("hs_code"),
        names.mapped(F.col("code"), labels).alias("hs_label"),
        F.coalesce(names.blank_to_null(F.col("i.statCdCntnKor1")), names.mapped(F.col("cc"), countries)).alias("country"),
        F.concat(F.lit("hs10="), F.col("code"), F.lit(" | source=getNitemtradeList")).alias("notes"),
        F.col("code").alias("hs_code_10digit"),
        measures.whole_number(F.col("i.impWgt")).alias("weight"),
        F.round(measures.strict_number(F.col("i.impDlr")) / 1000.0, 3).alias("amount"),
    )
    return observation_rows(rows.dropna(subset=["weight", "amount"]), series=series, value_unit=value_unit)


def price_rows(lines: DataFrame, *, heads: DataFrame | None = None) -> Parsed:
    """Ranking files: valid rows, and rejected ones with their reasons.

    Valid: year 2000 to 2099, rank from 1, a product name, a numeric price.
    """
    parsed = keyed_cells(lines, rename=PRICE_ALIASES, required=PRICE_REQUIRED, heads=heads)
    plain = lambda n: F.regexp_replace(F.trim(cell(n)), ",", "")
    year, rank = (F.when(plain(c).rlike(r"^[+-]?\d+$"), plain(c).try_cast("int")) for c in ("year", "rank"))
    price = F.when(plain("price_krw") != "", plain("price_krw").try_cast("double"))
    reasons = F.array_compact(
        F.array(
            F.when(~F.coalesce(year.between(2000, 2099), F.lit(False)), "year invalid"),
            F.when(~F.coalesce(rank >= 1, F.lit(False)), "rank invalid"),
            F.when(F.trim(cell("product_name")) == "", "product_name is empty"),
            F.when(price.isNull(), "price_krw invalid"),
        )
    )
    text_price = F.when(price == F.floor(price), price.cast("bigint").cast("string")).otherwise(price.cast("string"))
    rows = parsed.rows.select(
        "file",
        "pos",
        year.cast("string").alias("year"),
        rank.cast("string").alias("rank"),
        F.trim(cell("product_name")).alias("product_name"),
        text_price.alias("price_krw"),
        *[F.trim(cell(c)).alias(c) for c in ("company_name", "origin_country", "notes")],
        reasons.alias("reasons"),
    )
    ok = F.size("reasons") == 0
    return Parsed(rows.filter(ok).drop("reasons", "pos", "file"), rows.filter(~ok).select("file", "pos", "reasons"))


def annual_statistics(
    spark: SparkSession,
    totals: Mapping[int, float],
    by_country: Mapping[tuple[int, str], float],
    *,
    series: str,
    code: str,
    label: str,
    note: str,
    unit: str = "USD_thousands",
    everywhere: str = "all origins",
) -> DataFrame:
    """Yearly figures handed over as arguments, in the stored layout; every date is the January."""
    rows = [(f"{y}-01", series, code, label, float(v), unit, everywhere, note) for y, v in totals.items()]
    rows += [(f"{y}-01", f"{series}_country", code, label, float(v), unit, c, note) for (y, c), v in by_country.items()]
    return spark.createDataFrame(
        rows, "date string, series string, hs_code string, hs_label string, value double, unit string, country string, notes string"
    )
