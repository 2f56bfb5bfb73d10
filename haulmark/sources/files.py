"""File names, formats and inventories."""

from __future__ import annotations

from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Media type to short file type.
FILE_TYPES = {
    "application/pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "application/vnd.ms-excel": "xls",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
    "image/jpeg": "jpg",
    "image/png": "png",
}
# Fixed value: name prefix of the portal's download files.
PORTAL_PREFIX = "수입식품조회"
HEAD_BYTES = 64


def period_of(name: Column) -> Column:
    """``20YY-MM`` in a file name, else its year, else empty."""
    month = F.regexp_extract(name, r"(20\d{2}-\d{2})", 1)
    return F.when(month != "", month).otherwise(F.regexp_extract(name, r"(20\d{2})", 1))


def series_of(name: Column, series: str, export_series: str) -> Column:
    return F.when(F.upper(name).contains("EXPORT"), export_series).otherwise(series)


def suffix_of(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^/.]\.([^./]+)$", 1))


def file_type(media_type: Column, name: Column) -> Column:
    from ..functions.names import literal_map

    hit = F.element_at(literal_map(FILE_TYPES), F.coalesce(media_type, F.lit("")))
    return F.coalesce(hit, F.nullif(suffix_of(name), F.lit("")), F.lit("unknown"))


def sheet_format(name: Column, content: Column) -> Column:
    """``html`` for an .xls that opens with ``<`` within its first 64 bytes, ``workbook`` for .xlsx, else NULL."""
    head = F.ltrim(F.regexp_replace(F.decode(F.substring(content, 1, HEAD_BYTES), "ISO-8859-1"), r"^\s+", ""))
    suffix = suffix_of(name)
    return F.when((suffix == "xls") & head.startswith("<"), "html").when(suffix == "xlsx", "workbook")


def composed(name: Column) -> Column:
    """Unicode NFC of a file name; some systems store names decomposed."""

    @F.pandas_udf("string")
    def nfc(values: pd.Series) -> pd.Series:
        return values.map(lambda s: None if s is None else normalize("NFC", s))

    return nfc(name)


def record_layout(name: Column) -> Column:
    """Layout of an import-record file by its (composed) name."""
    portal = name.startswith(PORTAL_PREFIX) & name.endswith(".xlsx")
    return F.when(portal, "portal").otherwise("historical")


def inventory(listing: DataFrame, *, file_id: str, name: str, media_type: str, folder: str, seen_at: Column) -> DataFrame:
    """Inventory rows of a file listing."""
    return listing.select(
        F.col(file_id).alias("file_id"),
        F.col(name).alias("filename"),
        F.col(folder).alias("source_folder"),
        file_type(F.col(media_type), F.col(name)).alias("file_type"),
        seen_at.alias("ingested_at"),
    )


def list_folder(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of every file below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("path").alias("file_id"),
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
            "length",
            "modificationTime",
        )
    )
