"""Table schemas, conforming, drift reports, source sections and their status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, measures, names


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType()}


def _struct(spec: str) -> T.StructType:
    """Nullable columns from ``name type, ...``; needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[k], True) for n, k in (part.split() for part in spec.split(","))])


# Column names and order of the stored tables.
OBSERVATIONS = _struct(
    "date string, series string, hs_code string, hs_label string, value string, unit string, country string, "
    "notes string, hs_code_10digit string, product_type string"
)
IMPORT_RECORDS = _struct(
    "date string, year string, month string, day string, importer_en string, product_type_en string, "
    "country_origin_en string, country_export_en string, importer_ko string, product_name string, product_en string, "
    "product_type_ko string, exporter_en string, expiry_date string, country_origin_ko string, "
    "country_export_ko string, importer string, notes string"
)
PRICES = _struct(
    "year string, rank string, product_name string, price_krw string, company_name string, origin_country string, notes string"
)
RAW_ARTICLES = _struct(
    "id bigint, content_hash string, url string, title_ko string, description string, published_date string, "
    "source_name string, source_domain string, keyword_matched string, collected_at string, raw_metadata string"
)
ARTICLES = _struct(
    "id bigint, raw_ref bigint, relevant boolean, relevance_judged_at string, category string, english_title string, "
    "english_summary string, classified_at string, duplicate_of_raw_ref bigint, dedup_judged_at string, "
    "manual_override boolean, hidden boolean"
)
BRIEF_DRAFTS = _struct(
    "id bigint, week_ending_date string, draft_text string, fact_check_status string, fact_check_detail string, generated_at string"
)
BRIEFS = _struct("id bigint, draft_ref bigint, approved boolean, approved_at string, published_text string, notes string")
LIBRARY_FILES = _struct(
    "id bigint, drive_file_id string, filename string, source_folder string, file_type string, ingested_at string, raw_metadata string"
)
LIBRARY_DOCS = _struct(
    "id bigint, file_ref bigint, title string, doc_date string, category string, tags string, summary string, "
    "download_url string, curated_at string, curated_by string"
)
MAPPINGS = _struct("source_name_kr string, match_key string, canonical_name_en string, notes string")
NEEDS_REVIEW = _struct(
    "source_tab string, row_ref string, field string, raw_value string, match_key string, reason string, flagged_at string"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order: missing ones NULL, others cast where they can be."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def header_order(df: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Text rendering in header order, a missing column or value is empty."""
    have = set(df.columns)
    return df.select(
        *[F.coalesce(F.col(h).cast("string"), F.lit("")).alias(h) if h in have else F.lit("").alias(h) for h in headers]
    )


def schema_drift(spark: SparkSession, df: DataFrame, expected: T.StructType) -> DataFrame:
    """Differences between a live header and the declared one; a warning table, never an error.

    ``n_filled`` counts the values in a live column concerned, so that an empty new column can be told
    from data that would be lost.
    """
    live = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)}
    want = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(expected.fields)}
    out = []
    for name in [*want, *[n for n in live if n not in want]]:
        if name not in live:
            issue = "missing"
        elif name not in want:
            issue = "unexpected"
        elif live[name][1] != want[name][1]:
            issue = "type"
        elif live[name][0] != want[name][0]:
            issue = "position"
        else:
            continue
        out.append((name, issue, want.get(name, (0, ""))[1], live.get(name, (0, ""))[1]))
    concerned = [name for name, *_ in out if name in live]
    counts = df.agg(*[F.count(f"`{name}`").alias(name) for name in concerned]).first().asDict() if concerned else {}
    rows = [(*row, counts.get(row[0], 0)) for row in out]
    return spark.createDataFrame(rows, "column string, issue string, expected string, live string, n_filled bigint")


class Source(NamedTuple):
    """One registered source: its table, section, optional series filter and switch."""

    id: str
    table: str
    section: str
    series: str | None = None
    enabled: bool = True


def load_tables(
    spark: SparkSession, paths: Mapping[str, str], sources: Sequence[Source], schemas: Mapping[str, T.StructType]
) -> dict[str, DataFrame]:
    """Each distinct enabled table once; one whose path does not exist is empty with its declared schema.

    Any other failure to read is raised. Month texts are normalised on the way in.
    """
    seen: set[str] = set()
    for s in sources:
        if not s.id or not s.table or not s.section:
            raise ValueError(f"incomplete source entry: {s}")
        if s.id in seen:
            raise ValueError(f"source {s.id} is listed twice")
        seen.add(s.id)
    out: dict[str, DataFrame] = {}
    for name in dict.fromkeys(s.table for s in sources if s.enabled):
        try:
            df = spark.read.parquet(paths[name])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            df = spark.createDataFrame([], schemas.get(name, T.StructType([])))
        if "date" in df.columns and df.schema["date"].dataType == T.StringType():
            df = df.withColumn("date", dates.norm_month(F.col("date")))
        out[name] = df
    return out


def section_rows(tables: Mapping[str, DataFrame], sources: Sequence[Source], section: str, *, series: str = "series") -> DataFrame | None:
    """Union of the section's enabled sources, each with its own series filter."""
    parts = []
    for s in sources:
        if s.section != section or not s.enabled or s.table not in tables:
            continue
        df = tables[s.table]
        parts.append(df.filter(F.col(series) == s.series) if s.series else df)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def last_updated(df: DataFrame, columns: Sequence[str] = ("date", "published_date")) -> Column:
    """Aggregate: latest normalised date text over the listed columns that exist."""
    texts = [names.blank_to_null(dates.norm_month(F.col(c).cast("string"))) for c in columns if c in df.columns]
    if not texts:
        return F.lit(None).cast("string")
    return F.max(F.greatest(*texts) if len(texts) > 1 else texts[0])


def section_status(sections: Mapping[str, DataFrame | None], columns: Sequence[str] = ("date", "published_date")) -> DataFrame:
    """One row per section: row count, has_data and last_updated."""
    parts = [
        df.agg(
            F.lit(name).alias("section"),
            F.count(F.lit(1)).alias("n_rows"),
            last_updated(df, columns).alias("last_updated"),
        )
        for name, df in sections.items()
        if df is not None
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("has_data", F.col("n_rows") > 0)


def unassigned_series(df: DataFrame, sources: Sequence[Source], table: str, *, series: str = "series") -> DataFrame:
    """Stored series that no enabled source of the table reads."""
    read = [s.series for s in sources if s.table == table and s.enabled]
    if None in read:
        return df.select(series).limit(0)
    return df.filter(~F.col(series).isin(read)).groupBy(series).agg(F.count(F.lit(1)).alias("n_rows"))


def split_by_code(df: DataFrame, prefixes: Mapping[str, str], *, code: str = "hs_code") -> dict[str, DataFrame]:
    """One frame per code prefix (dots and leading zeros ignored)."""
    return {name: df.filter(names.code_prefix(F.col(code), len(p)) == p) for name, p in prefixes.items()}


def price_rows(df: DataFrame, *, price: str = "price_krw") -> DataFrame:
    """Price text to whole numbers, 0 where it is not a number."""
    return df.withColumn(price, measures.int_or_zero(F.col(price)))


def is_available(df: DataFrame | None, predicate: Column | None = None) -> bool:
    """Whether any row passes; a missing table is not available."""
    if df is None:
        return False
    return not (df.filter(predicate) if predicate is not None else df).isEmpty()


def documents_listing(docs: DataFrame, *, category: str | None = None) -> DataFrame:
    """Published documents, newest first, with unsafe links removed."""
    from ..functions.urls import safe_url

    if category:
        docs = docs.filter(F.col("category") == category)
    return docs.withColumn("download_url", safe_url(F.col("download_url"))).orderBy(F.col("doc_date").desc(), "id")
