"""Exports: the projections behind each file, and the CSV and parquet writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, names
from ..operators.catalog import header_order

BYTE_ORDER_MARK = "﻿"
DASH = "—"
NESTED = (T.ArrayType, T.MapType, T.StructType)


def trade_rows(df: DataFrame, columns: Sequence[str], *, date: str = "date") -> DataFrame:
    """Every row in fixed column order, months normalised, other columns dropped."""
    return header_order(df.withColumn(date, dates.norm_month(F.col(date).cast("string"))), columns)


def record_rows(
    df: DataFrame,
    *,
    columns: Sequence[str],
    importer: Sequence[str],
    product: Sequence[str],
    aliases: Mapping[str, str],
) -> DataFrame:
    """Declarations with the display fallbacks and public names applied."""
    out = (
        df.withColumn(importer[0], names.mapped(names.first_filled(*[F.col(c) for c in importer], default=""), aliases))
        .withColumn("importer_en", names.mapped(F.coalesce(F.col("importer_en"), F.lit("")), aliases))
        .withColumn(product[0], names.first_filled(*[F.col(c) for c in product], default=""))
    )
    return out.select(*columns)


def has_content(columns: Sequence[str]) -> Column:
    """Any of the text fields is non-blank."""
    return names.first_filled(*[F.col(c) for c in columns]).isNotNull()


def news_rows(df: DataFrame, *, flag: str, content: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Publishable articles that have any content."""
    return df.filter(names.truthy(F.col(flag)) & has_content(content)).select(*columns)


def display_records(
    df: DataFrame,
    *,
    chains: Mapping[str, Sequence[str]],
    aliases: Mapping[str, Mapping[str, str]],
    day: str,
    as_of: Column,
    days: int = 90,
) -> DataFrame:
    """Fallback chains with a dash for blanks, public names, and a flag for recent rows."""
    shown = []
    for out, chain in chains.items():
        value = names.first_filled(*[F.col(c) for c in chain], default=DASH)
        shown.append((names.mapped(value, aliases[out]) if out in aliases else value).alias(out))
    keep = [c for c in df.columns if c not in chains]
    recent = F.coalesce(F.col(day) >= F.date_sub(as_of, days), F.lit(False))
    return df.select(*keep, *shown, recent.alias(f"in_last_{days}d"))


def export_csv(df: DataFrame, path: str, *, mode: str = "overwrite", excel: bool = False, files: int | None = None) -> None:
    """CSV with a header (also when there are no rows), RFC-4180 quoting; nested columns as JSON text.

    ``excel`` marks the header with a byte order mark. ``files`` bounds the number of part files of
    an extract that is known to be small.
    """
    if excel:
        first, *rest = df.columns
        df = df.select(F.col(first).alias(BYTE_ORDER_MARK + first), *rest)
    if files:
        df = df.coalesce(files)
    nested = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f"`{f.name}`") for f in df.schema.fields]
    df.select(*nested).write.mode(mode).csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """What ``export_csv`` wrote, as text; quoted cells may hold line ends."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', lineSep="\n")


def export_all(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Every table to its own CSV folder, with row counts; no rows at all is an error.

    Rows are counted while they are written.
    """
    from pyspark.sql import Observation

    counts = []
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        seen = Observation(f"export {name}")
        export_csv(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{name}")
        counts.append((name, int(seen.get["n"])))
    if spark is None or not any(n for _, n in counts):
        raise ValueError("nothing to export: every table is empty")
    return spark.createDataFrame(counts, "table string, n_rows bigint")


def append_partitioned(df: DataFrame, path: str, *, by: Sequence[str]) -> None:
    """Append to a parquet table partitioned by ``by``, one writer per partition value and task."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_view(df: DataFrame, path: str) -> None:
    """Snapshot of a review view."""
    df.write.mode("overwrite").parquet(path)
