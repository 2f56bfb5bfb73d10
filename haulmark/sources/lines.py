"""Text files as numbered lines, and delimited lines as cells."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, FORMAT, LineFiles

# Encodings tried in turn for ranking files.
ENCODINGS = ["utf-8-sig", "utf-8", "cp949"]


def read_lines(spark: SparkSession, path: str | Sequence[str], *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(file, pos, text)`` for every line below ``path``, or of several; ``pos`` is the byte at which it starts.

    Large files stay splittable and no file passes through one task. A mark at the start of a file
    and carriage returns are not part of the text.
    """
    return _lines(spark, path, block_bytes=block_bytes)


def read_heads(spark: SparkSession, path: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` lines of every file below ``path``, without reading the rest."""
    return _lines(spark, path, head=n)


def _lines(spark: SparkSession, path: str | Sequence[str], **options: int) -> DataFrame:
    spark.dataSource.register(LineFiles)
    paths = json.dumps([path] if isinstance(path, str) else list(path))
    return spark.read.format(FORMAT).options(paths=paths, **options).load()


def decode_lines(files: DataFrame, *, file: str = "file", content: str = "content") -> DataFrame:
    """Lines of small files in UTF-8 (with or without mark) or CP949; each file is one short ranking."""

    @F.pandas_udf("string")
    def decoded(raw: pd.Series) -> pd.Series:
        def one(data: bytes) -> str | None:
            for encoding in ENCODINGS:
                try:
                    return bytes(data).decode(encoding)
                except UnicodeDecodeError:
                    continue
            return None

        return raw.map(one)

    body = files.select(F.col(file).alias("file"), decoded(F.col(content)).alias("body"))
    return body.select("file", F.posexplode(F.split("body", r"\r?\n")).alias("pos", "text"))


def split_cells(text: Column) -> Column:
    """Cells of a comma-separated line; quoted cells may hold commas and doubled quotes."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'), F.replace(F.regexp_replace(c, r'^"|"$', ""), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )


def cell_at(cells: Column, index: Column | int) -> Column:
    """Cell at a 0-based position; NULL beyond the end of a short line."""
    return F.get(cells, F.lit(index) if isinstance(index, int) else index)


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of every file with ``line_no`` from 1.

    The rank limit is applied before the shuffle, so a file of any length sends at most ``n`` lines
    per task.
    """
    w = Window.partitionBy("file").orderBy("pos")
    return lines.withColumn("line_no", F.row_number().over(w)).filter(F.col("line_no") <= n)
