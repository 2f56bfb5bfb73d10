"""Sheets and HTML tables as rows ``(file, table_no, row_no, cells)``.

``cells`` is the array of a line's cells by column, so a line stays one row from the parser to the
record. Rows count from 0. A sheet has at most 1,048,576 rows, which bounds the per-file windows used
for merged cells. Readers that give one row a cell are brought into this form by ``grid_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, measures, names
from ..session import kept, small_side
from .wide import two_units

# Header words of the quarantine tables.
PRODUCT, CATEGORY, COUNTRY, COUNT, WEIGHT = "품명", "품목명", "국가", "건수", "중량"
# Names that open a subtotal row.
SUBTOTALS = ["국가계", "품명계", "총 계", "총계", "합 계", "합계", "계"]
# Product names kept, with ten-digit code and form.
PRODUCTS = {"녹용": ("0507901190", "dried"), "생녹용": ("0507901110", "frozen")}
# Code and label of the quarantine rows.
GRID_CODE = "0507.90"
GRID_LABEL = "Horns, antlers, hooves, nails, claws and beaks — other"
# Columns of the historical import list.
HISTORICAL = {
    "Year": "year",
    "Month": "month",
    "Day": "day",
    "Importer": "importer_en",
    "Translation of type": "product_type_en",
    "Country of origin": "country_origin_en",
    "Country of export": "country_export_en",
    "Importer (Korean)": "importer_ko",
    "Product name (Korean)": "product_name",
    "Product name (English)": "product_en",
    "Product type (Korean)": "product_type_ko",
    "Exporter (English)": "exporter_en",
    "Date": "date_raw",
    "Expire date start from": "expiry_raw",
    "Country of origin (KR)": "country_origin_ko",
    "Country of export (KR)": "country_export_ko",
}
HISTORICAL_REQUIRED = ["Year", "Importer (Korean)", "Product name (Korean)", "Date"]
# Columns of the portal list, each with its old and new names.
PORTAL = {
    "date_raw": ["처리일자"],
    "importer_ko": ["수입업체"],
    "product_name": ["제품명(한글)"],
    "product_en": ["제품명(영문)"],
    "country_export_ko": ["수출국"],
    "country_origin_ko": ["제조국"],
    "product_type_ko": ["품목(유형)", "품목류"],
    "exporter_en": ["해외제조업소", "제조사(영문)"],
    "expiry_raw": ["소비기한", "유통기한"],
}
PORTAL_REQUIRED = ["처리일자", "수입업체", "제품명(한글)"]
PORTAL_EXTRAS = ["신고번호", "품목제조번호", "순중량(KG)", "수량(갯수)", "원산지"]


class _Tables(HTMLParser):
    """Collects table lines; a table gets its number when it closes, inner tables first."""

    def __init__(self) -> None:
        super().__init__()
        self.done: list[tuple[int, int, list[str]]] = []
        self.closed = 0
        self.open: list[dict] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.open.append({"lines": [], "line": [], "text": None})
        elif self.open and tag == "tr":
            self.open[-1]["line"] = []
        elif self.open and tag in ("td", "th"):
            self.open[-1]["text"] = []

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        top = self.open[-1]
        if tag in ("td", "th") and top["text"] is not None:
            top["line"].append("".join(top["text"]).strip())
            top["text"] = None
        elif tag == "tr":
            if top["line"]:
                top["lines"].append(top["line"])
            top["line"] = []
        elif tag == "table":
            self.open.pop()
            self.done += [(self.closed, i, line) for i, line in enumerate(top["lines"])]
            self.closed += bool(top["lines"])


def rows_from_html(files: DataFrame, *, file: str = "file", html: str = "html") -> DataFrame:
    """Lines of every table in every file, nested tables included."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = _Tables()
                parser.feed(text or "")
                if parser.done:
                    table, row, cells = zip(*parser.done, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(row), pa.string()), pa.array(table, pa.int32()), pa.array(row, pa.int64()), pa.array(cells, pa.list_(pa.string()))],
                        names=["file", "table_no", "row_no", "cells"],
                    )

    return files.select(F.col(file).alias("file"), F.col(html).alias("html")).mapInArrow(
        lines, "file string, table_no int, row_no bigint, cells array<string>"
    )


def grid_rows(grid: DataFrame) -> DataFrame:
    """Rows from single cells ``(file, table_no, row_no, col_no, cell)``; a missing cell is blank."""
    rows = grid.groupBy("file", "table_no", "row_no").agg(F.map_from_entries(F.collect_list(F.struct("col_no", "cell"))).alias("_m"))
    last = F.array_max(F.map_keys("_m"))
    return rows.select(
        "file",
        "table_no",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.transform(F.sequence(F.lit(0), last), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(""))).alias("cells"),
    )


def _clean(rows: DataFrame) -> DataFrame:
    return rows.select("file", "table_no", "row_no", F.transform("cells", names.cell_text).alias("cells"))


def _squeezed(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def _any(cells: Column, test) -> Column:
    return F.exists(cells, test)


def _at(cells: Column, position: Column) -> Column:
    return F.coalesce(F.get(cells, position), F.lit(""))


def _first_where(cells: Column, test) -> Column:
    """0-based position of the first cell that passes, NULL when none does."""
    hits = F.filter(F.transform(cells, lambda c, i: F.when(test(c), i)), lambda i: i.isNotNull())
    return F.get(hits, F.lit(0))


def is_subtotal(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in SUBTOTALS])


def _blank_row() -> Column:
    return ~_any(F.col("cells"), lambda c: c != "")


def _fill_down(value: Column, by: Sequence[str] = ("file", "table_no")) -> Column:
    w = Window.partitionBy(*by).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    return F.coalesce(F.last(F.nullif(value, F.lit("")), ignorenulls=True).over(w), F.lit(""))


def _quarantine(df: DataFrame, *, series: Column) -> DataFrame:
    active = df.filter((F.col("n") != 0) | (F.col("kg") != 0))
    full = active.select(
        "date",
        series.alias("series"),
        F.lit(GRID_CODE).alias("hs_code"),
        F.lit(GRID_LABEL).alias("hs_label"),
        "country",
        "notes",
        "hs_code_10digit",
        "product_type",
        "n",
        "kg",
    )
    return two_units(full, {"shipments": "n", "KG": "kg"})


def annual_grid(rows: DataFrame, *, series: Column, products: Mapping[str, tuple[str, str]] = PRODUCTS) -> DataFrame:
    """Annual sheet: month headings over (count, weight) column pairs, merged product cells.

    The header is the first of the top ten rows that names a product, a country and a month.
    """
    rows = _clean(rows)
    c = F.col("cells")
    month = lambda x: x.rlike(r"^20\d{2}\.\d{2}")
    head = (
        rows.filter(F.col("row_no") < 10)
        .select(
            "file",
            "table_no",
            "row_no",
            _first_where(c, lambda x: _squeezed(x) == PRODUCT).alias("at_product"),
            _first_where(c, lambda x: x.contains(COUNTRY)).alias("at_country"),
            F.filter(
                F.transform(c, lambda x, i: F.struct(i.alias("at"), F.when(month(x), F.replace(x, F.lit("."), F.lit("-"))).alias("date"))),
                lambda m: m["date"].isNotNull(),
            ).alias("months"),
        )
        .filter(F.col("at_product").isNotNull() & F.col("at_country").isNotNull() & (F.size("months") > 0))
        .groupBy("file", "table_no")
        .agg(F.min_by(F.struct("row_no", "at_product", "at_country", "months"), "row_no").alias("h"))
    )
    head = kept(head, "headers")
    # The line below the headings repeats the sub-headings.
    body = rows.filter(~_blank_row()).join(small_side(head), ["file", "table_no"]).filter(F.col("row_no") > F.col("h.row_no") + 1)
    named = body.withColumn("product", _fill_down(_at(c, F.col("h.at_product")))).withColumn("country", _at(c, F.col("h.at_country")))
    chosen_rows = named.filter(
        F.col("product").isin(list(products)) & (F.col("country") != "") & ~is_subtotal(F.col("country")) & ~is_subtotal(F.col("product"))
    )
    cells = chosen_rows.select("file", "product", "country", "cells", F.explode("h.months").alias("m")).select(
        F.col("m.date").alias("date"),
        "country",
        F.concat(F.lit("source: "), F.col("file"), F.lit(" | product: "), F.col("product")).alias("notes"),
        names.mapped(F.col("product"), {p: v[0] for p, v in products.items()}).alias("hs_code_10digit"),
        names.mapped(F.col("product"), {p: v[1] for p, v in products.items()}).alias("product_type"),
        measures.parse_number(_at(c, F.col("m.at"))).alias("n"),
        measures.parse_number(_at(c, F.col("m.at") + 1)).alias("kg"),
        "file",
    )
    return _quarantine(cells, series=series)


def monthly_grid(rows: DataFrame, *, series: Column, period: Column) -> DataFrame:
    """Monthly table: the first table with a heading of country, product and count within five rows.

    The country cell spans rows; the month comes from the file name; the form is always dried.
    """
    rows = _clean(rows)
    c = F.col("cells")
    has = lambda word: _any(c, lambda x: _squeezed(x) == word)
    titled = rows.filter((F.col("row_no") < 5) & (F.size("cells") >= 4) & has(COUNTRY) & has(PRODUCT) & has(COUNT))
    chosen = titled.groupBy("file").agg(F.min("table_no").alias("table_no"))
    where = lambda word: _first_where(c, lambda x: F.lower(_squeezed(x)).contains(word))
    head = (
        rows.join(small_side(chosen), ["file", "table_no"], "left_semi")
        .filter(_any(c, lambda x: _squeezed(x).contains(COUNTRY)))
        .select("file", "table_no", "row_no", where(COUNTRY).alias("a"), where(PRODUCT).alias("b"), where(COUNT).alias("n"), where(WEIGHT).alias("w"))
        .groupBy("file", "table_no")
        .agg(F.min_by(F.struct("row_no", "a", "b", "n", "w"), "row_no").alias("h"))
        .filter("h.a is not null and h.b is not null and h.n is not null and h.w is not null")
    )
    head = kept(head, "headers")
    body = rows.filter(~_blank_row()).join(small_side(head), ["file", "table_no"]).filter(F.col("row_no") > F.col("h.row_no"))
    named = body.withColumn("country", _fill_down(_at(c, F.col("h.a")))).withColumn("product", _at(c, F.col("h.b")))
    chosen_rows = named.filter(
        (F.col("country") != "") & (F.col("product") != "") & ~is_subtotal(F.col("product")) & ~is_subtotal(F.col("country"))
    )
    code, form = PRODUCTS["녹용"]
    cells = chosen_rows.select(
        period.alias("date"),
        "country",
        F.concat(F.lit("source: "), F.col("file")).alias("notes"),
        F.lit(code).alias("hs_code_10digit"),
        F.lit(form).alias("product_type"),
        measures.parse_number(_at(c, F.col("h.n"))).alias("n"),
        measures.parse_number(_at(c, F.col("h.w"))).alias("kg"),
        "file",
    )
    return _quarantine(cells, series=series)


def header_records(rows: DataFrame, *, required: Sequence[str], header_row: int | None = None, search: int = 5) -> tuple[DataFrame, DataFrame]:
    """Sheet lines as ``(file, row_no, cells map<heading, text>)``, and the files without a usable header.

    The header is a fixed row, or the first of the top ``search`` rows holding all required headings;
    on a repeated heading the last column counts. Only header rows are shuffled: one per table is
    stored and meets the lines in a join, so a line goes from the reader to its record in one task.
    """
    rows = _clean(rows)
    place = (F.col("row_no") == header_row) if header_row is not None else (F.col("row_no") < search)
    holds = reduce(lambda a, b: a & b, [F.array_contains("cells", r) for r in required])
    found = rows.filter(place & holds).groupBy("file", "table_no").agg(F.min_by(F.struct("row_no", "cells"), "row_no").alias("h"))
    names_of = F.col("h.cells")
    last = lambda n, i: F.size(names_of) - F.array_position(F.reverse(names_of), n) == i
    headings = F.filter(
        F.transform(names_of, lambda n, i: F.when((n != "") & last(n, i), F.struct(n.alias("name"), i.alias("col_no")))), lambda h: h.isNotNull()
    )
    head = kept(found.select("file", "table_no", F.col("h.row_no").alias("at"), headings.alias("headings")), "headers")
    body = rows.join(small_side(head), ["file", "table_no"]).filter((F.col("row_no") > F.col("at")) & ~_blank_row())
    named = F.map_from_entries(
        F.transform("headings", lambda h: F.struct(h["name"].alias("k"), _at(F.col("cells"), h["col_no"]).alias("v")))
    )
    records = body.select("file", "row_no", named.alias("cells"))
    unusable = rows.select("file").distinct().join(head.select("file").distinct(), "file", "left_anti")
    return records, unusable


def _heading(*spellings: str) -> Column:
    return names.first_filled(*[F.element_at("cells", F.lit(s)) for s in spellings], default="")


def _fields(records: DataFrame, by_field: Mapping[str, Column]) -> DataFrame:
    """Each heading looked up and each date parsed once a line; ``_day`` is the date, ``expiry_date`` text."""
    fields = records.select(*[c.alias(f) for f, c in by_field.items()])
    expiry = dates.parse_day(F.col("expiry_raw")).cast("string")
    return fields.withColumns({"_day": dates.parse_day(F.col("date_raw")), "expiry_date": expiry}).drop("date_raw", "expiry_raw")


def _record(day: Column, columns: Mapping[str, Column]) -> list[Column]:
    from ..operators.catalog import IMPORT_RECORDS

    iso = F.coalesce(day.cast("string"), F.lit(""))
    full = {"date": iso, **columns}
    return [F.coalesce(full.get(f.name, F.lit("")), F.lit("")).alias(f.name) for f in IMPORT_RECORDS.fields]


def historical_records(rows: DataFrame) -> DataFrame:
    """The old import list: title row, then headings. Year, month and day fall back to the date."""
    records, _ = header_records(rows, required=HISTORICAL_REQUIRED, header_row=1)
    fields = _fields(records, {field: _heading(heading) for heading, field in HISTORICAL.items()})
    day, own = F.col("_day"), F.col("year") != ""
    part = lambda field: F.substring_index(F.col(field), ".", 1)
    columns = {f: F.col(f) for f in fields.columns if f != "_day"}
    columns |= {
        "year": F.when(own, part("year")).otherwise(F.date_format(day, "yyyy")),
        "month": F.when(own, part("month")).otherwise(F.date_format(day, "MM")),
        "day": F.when(own, part("day")).otherwise(F.date_format(day, "dd")),
        "importer": names.first_filled(F.col("importer_ko"), F.col("importer_en"), default=""),
    }
    return fields.select(*_record(day, columns))


def portal_records(rows: DataFrame) -> DataFrame:
    """The portal's list in its old and new layout; a field takes whichever name is filled.

    Further fields go into the notes as ``label=value``.
    """
    records, _ = header_records(rows, required=PORTAL_REQUIRED)
    by_field = {field: _heading(*spellings) for field, spellings in PORTAL.items()}
    notes = names.packed({label: _heading(label) for label in PORTAL_EXTRAS})
    fields = _fields(records, {**by_field, "notes": notes})
    day = F.col("_day")
    columns = {f: F.col(f) for f in fields.columns if f != "_day"}
    columns |= {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
        "importer": F.col("importer_ko"),
    }
    return fields.select(*_record(day, columns))
