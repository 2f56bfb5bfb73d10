"""Session set-up, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
BROADCAST_LIMIT = 64 * 1024 * 1024


def build_session(app: str = "haulmark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect. Cluster settings already present win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only where none is named."""
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="haulmark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{scratch_root(spark)}/haulmark/{spark.sparkContext.applicationId}"


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Drops every intermediate table this application wrote. Call it when no result is needed any more."""
    delete_path(spark, scratch_folder(spark))


class Stages:
    """Written intermediate tables of one iterative job.

    Each ``keep`` writes the frame to the shared folder and reads it back, which cuts the
    lineage, survives lost executors and gives the planner real file sizes. A name that is
    written again drops the table it replaces.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.base = f"{scratch_folder(spark)}/{job}-{uuid.uuid4().hex}"
        self._round = 0
        self._paths: dict[str, str] = {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        self._round += 1
        path = f"{self.base}/{name}-{self._round}"
        df.write.parquet(path)
        old = self._paths.get(name)
        self._paths[name] = path
        if old:
            self._delete(old)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        delete_path(self.spark, path)

    def release(self, *names: str) -> None:
        for name in names:
            path = self._paths.pop(name, None)
            if path:
                self._delete(path)


def kept(df: DataFrame, job: str) -> DataFrame:
    """A small pre-aggregate written once to the shared folder, for operators that read it several times.

    Without it every consumer would prune the aggregate differently and scan the facts again.
    """
    return Stages(df.sparkSession, job).keep(job, df)


def planned_bytes(df: DataFrame) -> int:
    """Size the optimizer expects, from file statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only when the planned size is within ``limit``; otherwise left to AQE."""
    return F.broadcast(df) if planned_bytes(df) <= limit else df
