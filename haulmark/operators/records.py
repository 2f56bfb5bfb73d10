"""Import records as one job: append by key, resolve names, copy to the raw layer, flag what stays open."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buckets import Manifest
from .resolve import Gate, resolve_flagged, unresolved
from .writes import append_new, raw_copy

TABLES = ("records", "raw", "exceptions")


class Ingested(NamedTuple):
    parsed: int
    written: int
    skipped: int


class RecordStore:
    """Three tables that change together: records, their raw copies, and exceptions.

    A run writes its part of each below a folder of its own and names them in one manifest, so either
    all three have a file's rows or none has. A file that comes again finds its keys stored: it adds
    no record, no copy and no exception. One writer owns the store.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, *, keys: Sequence[str], raw: Sequence[str], row_ref: str, name: str):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.raw, self.row_ref, self.name = list(keys), list(raw), row_ref, name
        self.manifest = Manifest(spark, path)

    def read(self, table: str) -> DataFrame:
        """One of the three tables as of the last finished run."""
        runs = self.manifest.load()[1].get("runs", [])
        if not runs and table == "records":
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(*[f"{self.path}/{run}/{table}" for run in runs])

    def ingest(self, parsed: DataFrame, gates: Sequence[Gate], *, now: Column, scope: Column | None = None) -> Ingested:
        """Only rows whose key is not stored are resolved, so no row is flagged twice.

        ``scope`` is true for every stored row whose key ``parsed`` may hold, for example from its first day on.
        """
        number, content = self.manifest.load()
        run = f"run={number + 1:012d}"
        offered, added = Observation(), Observation()
        new = parsed.observe(offered, F.count(F.lit(1)).alias("n"))
        if content.get("runs"):
            new = append_new(new, self.read("records"), keys=self.keys, scope=scope)
        # Resolved and written once, with the values as they came: the three outputs are read from here without a join.
        new = new.observe(added, F.count(F.lit(1)).alias("n")).select(*self.schema.names, F.struct(*self.raw).alias("_raw"))
        new = resolve_flagged(new, gates)
        new.write.mode("overwrite").parquet(f"{self.path}/{run}/new")
        fresh = self.spark.read.schema(new.schema).parquet(f"{self.path}/{run}/new")
        outputs = {
            "records": fresh.select(*self.schema.names),
            "raw": raw_copy(fresh.select("_raw.*"), self.raw, now),
            "exceptions": unresolved(fresh, row_ref=self.row_ref, table_name=self.name, flagged_at=now),
        }
        for table in TABLES:
            outputs[table].write.mode("overwrite").parquet(f"{self.path}/{run}/{table}")
        self.manifest.commit(number + 1, {"runs": [*content.get("runs", []), run]})
        parsed_n, written = offered.get["n"], added.get["n"]
        return Ingested(parsed_n, written, parsed_n - written)
