"""Dense positions in a total order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import Stages, small_side

#: monotonically_increasing_id() has the partition above these bits and the row within it below.
ROW_BITS = 33


def positions(df: DataFrame, order: Sequence[str | Column], stages: Stages, name: str = "position") -> DataFrame:
    """``df`` with its position, from 0, in the given order; rows of equal keys follow each other in any order.

    Rows are dealt by ranges and sorted inside. The table is written with the partition and the row
    number of each row, and the rows before each partition are a prefix sum over one row a partition.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
    placed = stages.keep(f"{name}-rows", placed)
    part = F.shiftright(F.col(name), ROW_BITS)
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    base = stages.keep(f"{name}-base", counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    row = F.col(name).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = placed.withColumn("_part", part).join(small_side(base), "_part")
    return joined.withColumn(name, F.col("_base") + row).drop("_part", "_base").select(*df.columns, name)
