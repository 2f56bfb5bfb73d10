"""Helpers shared by the operators: bounded slices of text, code-point classes, whole-row filters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulmark.session import Stages, delete_path, small_side

SLICE_BYTES = 1 << 20
#: For work that needs a hundred bytes and more for each character of a text.
SMALL_SLICE = 1 << 18
GOLD = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


_OPEN: list[Stages] = []


def job(spark, name: str) -> Stages:
    """Intermediate tables of one operator, in the shared folder until ``release``."""
    stages = Stages(spark, name)
    _OPEN.append(stages)
    return stages


def release() -> None:
    """Deletes the intermediate tables of all operators. Call it when their results are written."""
    while _OPEN:
        stages = _OPEN.pop()
        delete_path(stages.spark, stages.base)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the documents that no model learns from. A null id counts as an empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the texts of a slice hold about ``limit`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a slice; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@lru_cache(maxsize=1)
def categories() -> np.ndarray:
    """First letter of the Unicode general category of every code point, as a byte."""
    return np.frombuffer("".join(unicodedata.category(chr(i))[0] for i in range(0x110000)).encode(), dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names that none of ``taken`` clashes with, whatever the case."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        out.append(name)
    return out


def filter_rows(docs: DataFrame, decided: DataFrame, stages: Stages) -> DataFrame:
    """Rows of ``docs`` that ``decided`` keeps, whole and unchanged.

    ``decided`` has (doc_id, text_key = xxhash64 of the text, kept) for each row. Documents that go are few beside those
    that stay, so they are anti-joined. Rows repeated as a whole (same id, same text) are reduced to the number kept: one.
    """
    keys = decided.groupBy("doc_id", "text_key").agg(F.max("kept").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    keys = stages.keep("decided", keys.filter(~F.col("_keep") | (F.col("_n") > 1)))
    own_id, own_key = fresh(docs.columns, "_id", "_key")
    named = (F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key))
    drop = small_side(keys.filter(~F.col("_keep")).select(*named))
    repeated = keys.filter("_keep").select(*named)
    same = docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_key))
    left = docs.join(drop, same, "left_anti")
    if repeated.isEmpty():
        return left
    repeated = small_side(repeated)
    once = docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").unionByName(once)


def add_columns(docs: DataFrame, text: str, ddl: str, compute, limit: int = SLICE_BYTES) -> DataFrame:
    """All columns of ``docs`` and those of ``ddl``; ``compute`` makes them, as Arrow arrays, from the texts of a slice.

    A column of ``docs`` that has the name of a new one is replaced.
    """
    new = StructType.fromDDL(ddl)
    docs = docs.drop(*new.names)
    schema = StructType(docs.schema.fields + new.fields)

    def run(batches):
        for batch in slices(batches, text, limit):
            arrays = [*batch.columns, *compute(texts_of(batch, text))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)
