"""Helpers of the vector operators: whole components, matrices of Arrow batches, exact means of groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .topk import takes_part

LONG_MAX = 2**63 - 1
VECTOR_ROWS = 4096

__all__ = ["LONG_MAX", "VECTOR_ROWS", "as_long", "group_sums", "largest", "matrix", "pieces", "takes_part", "whole"]


def largest(width: int, times: int = 1) -> int:
    """The largest component for which ``times`` a squared distance of two vectors of ``width`` components fits in 64 bits."""
    return isqrt(LONG_MAX // (max(1, width) * times)) // 2


def whole(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of each component as a long, within ``limit`` on both sides."""

    def one(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * F.lit(float(scale)), F.lit(float(limit))), F.lit(float(-limit))))

    return F.transform(vector, one)


def as_long(total: Column) -> Column:
    """A decimal total as a long; beyond 64 bits the largest long."""
    return F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("bigint")


def pieces(batches: Iterator[pa.RecordBatch], rows: int = VECTOR_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def matrix(column: pa.Array | pa.ChunkedArray, width: int, dtype) -> np.ndarray:
    """Rows of a list column; shorter ones are padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=dtype)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def group_sums(rows: DataFrame, groups: int, width: int, read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[int, list[int]]]:
    """Count and exact sums of components of each group that has rows.

    ``read`` gives the group of each vector of a batch and the vectors. A task adds up its rows and returns one line per
    group and component, which Spark adds up; ``groups`` x ``width`` totals reach the driver.
    """

    def run(batches):
        total, count = np.zeros((groups, width), dtype=np.int64), np.zeros(groups, dtype=np.int64)
        for batch in pieces(batches):
            group, vectors = read(batch)
            order = np.argsort(group, kind="stable")
            found, first = np.unique(group[order], return_index=True)
            total[found] += np.add.reduceat(vectors[order], first, axis=0)
            count += np.bincount(group, minlength=groups)
        group, place = np.nonzero(np.broadcast_to((count > 0)[:, None], total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (group, place, count[group], total[group, place])], names=["group", "place", "n", "total"]
        )

    parts = rows.mapInArrow(run, "group bigint, place bigint, n bigint, total bigint")
    sums = parts.groupBy("group", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums:
        out.setdefault(r["group"], (r["n"], [0] * width))[1][r["place"]] = int(r["total"])
    return out
