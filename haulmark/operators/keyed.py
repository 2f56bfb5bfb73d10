"""Per-key picks that combine before the shuffle, so one hot key never fills a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``.

    An aggregate with map-side combine replaces ``row_number() = 1``; ties are settled by the
    order columns, which should therefore end in a unique one.
    """
    pick = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(k) if k in keys else F.col(f"_row.`{k}`").alias(k) for k in df.columns])


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows; planned as a per-partition heap followed by one merge."""
    return df.orderBy(*order).limit(k)


def is_present(df: DataFrame) -> bool:
    """Whether any row exists; reads only as far as the first one."""
    return not df.isEmpty()
