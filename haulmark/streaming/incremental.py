"""Incremental jobs: dropped files appended by key, first-wins deduplication, running totals.

Each job drains what is new (``availableNow``) and stops. Progress lives in the stream's checkpoint,
so a restart continues where the last run ended. A batch that is replayed after a failure meets its
own rows in the target and adds nothing twice, as long as one writer owns the target.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.buckets import BucketTable, Manifest, Written
from ..operators.keyed import pick_per_key
from ..operators.writes import append_new
from ..sources.lines import read_heads, read_lines


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet", files_per_batch: int | None = None, **options: str
) -> DataFrame:
    """Stream of the files dropped below ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The target as it stands, empty before the first write."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    exists = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def _near(stored: DataFrame, batch: DataFrame, prune: str | None) -> DataFrame:
    """Stored rows within the batch's range of the pruning column, so old partitions are not read."""
    if prune is None:
        return stored
    low, high = batch.agg(F.min(prune), F.max(prune)).first()
    return stored.filter(F.col(prune).between(low, high)) if low is not None else stored.limit(0)


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], *, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs ``handle`` on every new micro-batch until nothing is left."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append_files(
    stream: DataFrame,
    target: str,
    *,
    keys: Sequence[str],
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    prune: str | None = None,
) -> StreamingQuery:
    """Each new batch: layout to rows, drop stored keys, append.

    ``prune`` names a column of the key; only stored rows in the batch's range are compared.
    """

    def handle(batch: DataFrame, _: int) -> None:
        rows = transform(batch) if transform else batch
        stored = _near(stored_rows(rows.sparkSession, target, rows.schema), rows, prune)
        fresh = append_new(rows, stored, keys=keys)
        writer = fresh.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)

    return drain(stream, handle, checkpoint=checkpoint)


def first_wins(stream: DataFrame, table: BucketTable, *, order: Sequence[Column], checkpoint: str) -> list[Written]:
    """First arrival per key for ever: within the batch by ``order``, across batches by the table.

    A batch reads the keys of the buckets its own keys fall into. Returns what each batch did; a
    batch that is replayed finds its rows stored and adds nothing.
    """
    done: list[Written] = []

    def handle(batch: DataFrame, _: int) -> None:
        done.append(table.insert_or_ignore(batch, order=order))

    drain(stream, handle, checkpoint=checkpoint)
    return done


def first_within(stream: DataFrame, *, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival per key within ``delay``; state is bounded by the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


#: Versions of one level that are merged into one of the next.
FAN = 4


def running_totals(
    stream: DataFrame, target: str, *, keys: Sequence[str], value: Column, checkpoint: str
) -> StreamingQuery:
    """Totals per key kept up to date from an append stream.

    State holds one running sum per key. Each batch writes only the keys it changed, as a new
    version; ``current_totals`` reads the latest one per key. ``FAN`` versions of one level are merged
    into one of the next, so that n batches leave at most FAN * log(n) versions and a row is rewritten
    log(n) times. The live versions are named by a manifest: a replay replaces its own version.
    """
    totals = stream.groupBy(*keys).agg(F.sum(value).alias("value"), F.count(F.lit(1)).alias("n"))
    manifest = Manifest(stream.sparkSession, target)

    def handle(batch: DataFrame, number: int) -> None:
        commit, content = manifest.load()
        live: list[list[int | str]] = [v for v in content.get("live", []) if v[1] < number]
        folder = f"version={number}"
        batch.withColumn("_at", F.lit(number)).write.mode("overwrite").parquet(f"{target}/{folder}")
        live.append([0, number, folder])
        # The newest versions of one level, while there are enough of them.
        while len(live) >= FAN and len({v[0] for v in live[-FAN:]}) == 1:
            level, some = live[-1][0] + 1, live[-FAN:]
            folder = f"level={level}-{number}"
            newest = pick_per_key(_versions(batch.sparkSession, target, some), list(keys), [F.col("_at")], last=True)
            newest.write.mode("overwrite").parquet(f"{target}/{folder}")
            live = [*live[:-FAN], [level, number, folder]]
        manifest.commit(commit + 1, {"live": live})

    return drain(totals, handle, checkpoint=checkpoint, mode="update")


def _versions(spark: SparkSession, target: str, live: Sequence[Sequence[int | str]]) -> DataFrame:
    return spark.read.parquet(*[f"{target}/{v[2]}" for v in live])


def live_versions(spark: SparkSession, target: str) -> list[str]:
    """Folders that ``current_totals`` reads."""
    return [v[2] for v in Manifest(spark, target).load()[1].get("live", [])]


def current_totals(spark: SparkSession, target: str, *, keys: Sequence[str]) -> DataFrame:
    """The latest version of every key."""
    live = Manifest(spark, target).load()[1]["live"]
    return pick_per_key(_versions(spark, target, live), list(keys), [F.col("_at")], last=True).drop("_at")


def rolling_totals(spark: SparkSession, target: str, *, keys: Sequence[str], month: str, months: int = 12) -> DataFrame:
    """Sum over each month and the ``months`` - 1 before it, from the running totals per (keys, month).

    The totals are small: one row per key and month, whatever the stream has brought.
    """
    totals = current_totals(spark, target, keys=[*keys, month])
    number = F.year(F.to_date(F.concat(F.col(month), F.lit("-01")))) * 12 + F.month(F.to_date(F.concat(F.col(month), F.lit("-01"))))
    reach = Window.partitionBy(*keys).orderBy(number).rangeBetween(1 - months, 0)
    return totals.select(*keys, month, F.sum("value").over(reach).alias("value"))


def windowed_totals(stream: DataFrame, *, event_time: str, size: str, delay: str, keys: Sequence[str], value: Column) -> DataFrame:
    """Totals per time window with late data accepted up to ``delay``; closed windows leave the state."""
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, size), *keys)
        .agg(F.sum(value).alias("value"), F.count(F.lit(1)).alias("n"))
    )


class Layout(NamedTuple):
    """How the files of one layout become rows: which names it has, its parser and the key of its rows."""

    names: str
    parse: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame | None]]
    keys: Sequence[str]
    header_lines: int = 1


def ingest_drops(
    spark: SparkSession, drop: str, target: str, layouts: Mapping[str, Layout], *, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Files of several layouts in one drop folder: each goes to its parser, its new rows to
    ``target/<layout>``, what cannot be read to ``target/rejects``.

    The stream lists files and does not read them; the first layout whose ``names`` pattern matches the
    file's name reads its lines. A file that fits no layout, and what a parser rejects, becomes a line
    (file, layout, reason) of its batch. Rows are appended by key, and the rejects of a batch replace
    those of an earlier attempt, so a replay changes nothing.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    options = {"recursiveFileLookup": "true"}
    listing = file_stream(spark, drop, T.StructType.fromDDL(schema), fmt="binaryFile", files_per_batch=files_per_batch, **options).select("path")
    name = F.regexp_extract("path", r"(?:file=([^/]*)/[^/]*|([^/]*))$", 1)
    plain = F.regexp_extract("path", r"([^/]*)$", 1)
    named = F.when(name != "", name).otherwise(plain)
    which = F.coalesce(*[F.when(named.rlike(layout.names), F.lit(key)) for key, layout in layouts.items()], F.lit(""))

    def handle(batch: DataFrame, number: int) -> None:
        # One row a file; the stream's batch size bounds them.
        found = batch.select("path", named.alias("file"), which.alias("layout")).collect()
        rejects = [spark.createDataFrame([], "file string, layout string, reason string")]
        unknown = sorted({r.file for r in found if not r.layout})
        if unknown:
            rejects.append(spark.createDataFrame([(f, "", "no layout has this name") for f in unknown], rejects[0].schema))
        for key, layout in layouts.items():
            paths = sorted(r.path for r in found if r.layout == key)
            if not paths:
                continue
            rows, bad = layout.parse(read_lines(spark, paths), read_heads(spark, paths, layout.header_lines))
            place = f"{target}/{key}"
            append_new(rows, stored_rows(spark, place, rows.schema), keys=layout.keys).write.mode("append").parquet(place)
            if bad is not None:
                rejects.append(bad.select("file", F.lit(key).alias("layout"), "reason"))
        every = rejects[0]
        for more in rejects[1:]:
            every = every.unionByName(more)
        every.write.mode("overwrite").parquet(f"{target}/rejects/batch={number}")

    return drain(listing, handle, checkpoint=checkpoint)
