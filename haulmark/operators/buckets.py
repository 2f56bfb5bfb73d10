"""A keyed table in hash buckets: a write reads and replaces the buckets of its keys and no others.

A table is a folder in shared storage. Each commit writes the buckets it touches below a folder of its
own, then a manifest that names the live folders of every bucket; the manifest appears by one rename.
Readers take the newest manifest, so they see a commit whole or not at all, and a run that fails
leaves the table as it was: what it wrote is named by no manifest, and the next commit replaces it.
One writer owns a table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path
from .keyed import pick_per_key
from .writes import append_new, merged, text_key

#: Folders of a bucket from appends; one more and the bucket is written anew.
MOST_FOLDERS = 8


class Manifest:
    """The live folders of a table, as a small file of names; its newest number counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/_manifest"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self.fs.exists(self._path(self.path)):
            return []
        found = [s.getPath().getName() for s in self.fs.listStatus(self._path(self.path))]
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("_"))

    def load(self) -> tuple[int, dict]:
        """The newest number and its content; (0, {}) before the first commit."""
        numbers = self.numbers()
        if not numbers:
            return 0, {}
        stream = self.fs.open(self._path(f"{self.path}/{numbers[-1]:012d}.json"))
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return numbers[-1], json.loads(text)

    def commit(self, number: int, content: Mapping) -> None:
        draft, final = self._path(f"{self.path}/_draft-{number}"), self._path(f"{self.path}/{number:012d}.json")
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            raise RuntimeError(f"{self.path}: commit {number} is taken, another writer is at work")

    def forget(self, keep: int = 1) -> None:
        """Drops all but the newest manifests."""
        for number in self.numbers()[:-keep]:
            self.fs.delete(self._path(f"{self.path}/{number:012d}.json"), False)


class Written(NamedTuple):
    """What a commit did; ``buckets`` are the ones it read and wrote."""

    offered: int
    inserted: int
    updated: int
    buckets: list[int]

    @property
    def skipped(self) -> int:
        return self.offered - self.inserted - self.updated


class BucketTable:
    """Rows of ``schema`` with unique ``keys`` in ``buckets`` hash buckets below ``path``.

    The number of buckets is fixed when the table is first written; choose it so that a bucket is a
    few hundred MB at the size the table will have. Key columns must not be null.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.manifest = Manifest(spark, path)
        self.buckets = self.manifest.load()[1].get("buckets", buckets)

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*[text_key(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def folders(self, buckets: Iterable[int] | None = None) -> list[str]:
        """Live folders, of all buckets or the given ones."""
        live = self.manifest.load()[1].get("live", {})
        wanted = live if buckets is None else [str(b) for b in buckets if str(b) in live]
        return [f"{self.path}/{f}" for b in wanted for f in live[b]]

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        folders = self.folders(buckets)
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket_of()).distinct().collect())

    def _write(self, rows: DataFrame, touched: list[int], replace: set[int]) -> None:
        number, content = self.manifest.load()
        folder = f"v={number + 1:012d}"
        placed = rows.withColumn("bucket", self.bucket_of()).repartition(max(1, len(touched)), "bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        root = self.manifest._path(f"{self.path}/{folder}")
        written = {int(s.getPath().getName().removeprefix("bucket=")) for s in self.manifest.fs.listStatus(root) if s.isDirectory()}
        live = dict(content.get("live", {}))
        for b in touched:
            kept = [] if b in replace else live.get(str(b), [])
            live[str(b)] = kept + ([f"{folder}/bucket={b}"] if b in written else [])
        self.manifest.commit(number + 1, {"buckets": self.buckets, "live": live})

    def upsert(
        self, updates: DataFrame, *, update: Sequence[str], order: Sequence[Column], on_insert: Mapping[str, Column] | None = None
    ) -> Written:
        """Insert or update by key; the last update of a key, by ``order``, counts."""
        touched = self._touched(updates)
        seen = Observation()
        last = pick_per_key(updates, self.keys, order, last=True)
        rows = merged(self.read(touched), last, keys=self.keys, update=update, on_insert=on_insert).observe(
            seen, F.count_if(F.col("_action") == "inserted").alias("inserted"), F.count_if(F.col("_action") == "updated").alias("updated")
        )
        if not touched:
            return Written(0, 0, 0, [])
        self._write(rows.drop("_action"), touched, set(touched))
        inserted, updated = seen.get["inserted"], seen.get["updated"]
        return Written(inserted + updated, inserted, updated, touched)

    def insert_or_ignore(self, batch: DataFrame, *, order: Sequence[Column]) -> Written:
        """First arrival of a key, within the batch by ``order`` and against the table.

        Of the stored rows only the keys of the batch's buckets are read. New rows are added to their
        buckets; a bucket with many small folders is written anew.
        """
        touched = self._touched(batch)
        live = self.manifest.load()[1].get("live", {})
        full = {b for b in touched if len(live.get(str(b), [])) >= MOST_FOLDERS}
        counted, added = Observation(), Observation()
        fresh = append_new(batch.observe(counted, F.count(F.lit(1)).alias("n")), self.read(touched), keys=self.keys)
        fresh = pick_per_key(fresh, self.keys, order).select(*self.schema.names).observe(added, F.count(F.lit(1)).alias("n"))
        if not touched:
            return Written(0, 0, 0, [])
        rows = fresh.unionByName(self.read(full)) if full else fresh
        self._write(rows, touched, full)
        return Written(counted.get["n"], added.get["n"], 0, touched)

    def vacuum(self) -> None:
        """Deletes what no manifest but the newest names."""
        self.manifest.forget()
        live = {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1] for f in self.folders()}
        for version in self.manifest.fs.listStatus(self.manifest._path(self.path)):
            name = version.getPath().getName()
            if name.startswith("v="):
                inside = [s.getPath() for s in self.manifest.fs.listStatus(version.getPath()) if s.isDirectory()]
                dead = [p for p in inside if f"{name}/{p.getName()}" not in live]
                for p in dead:
                    self.manifest.fs.delete(p, True)
                if len(dead) == len(inside):
                    delete_path(self.spark, f"{self.path}/{name}")
