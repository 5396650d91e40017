"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library's results rely on: UTC for wall-clock timestamps, ANSI so bad casts fail,
# AQE so skewed join partitions are split and small shuffles are merged at run time.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

ROWS_PER_TASK = 250_000
LEAST_ROWS_PER_TASK = 5_000


def local_session(app: str = "millrace", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_local_folders: dict[str, str] = {}  # application id -> temporary folder, in local mode without a setting


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    The cluster's `spark.checkpoint.dir`, or the one given to `setCheckpointDir`; in local mode without either, one temporary
    folder for the whole application.
    """
    context = spark.sparkContext
    given = context._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or (given.get() if given.isDefined() else None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="millrace-checkpoint-")
        folder = _local_folders[context.applicationId]
    if given.isEmpty():
        context.setCheckpointDir(folder)
    return folder


def _application_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/millrace/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table under the checkpoint folder and read it back.

    Cuts the lineage like `checkpoint()`, but computes the table once and keeps column pruning; the files outlive lost
    executors. `delete_materialised` removes them once their results are no longer read.
    """
    path = f"{_application_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK, rows: int | None = None) -> DataFrame:
    """The rows dealt evenly, to as many tasks as keep every core busy and hold no more than `rows_per_task` rows.

    For tables that are stored and then passed over very often, as by iterative fits: files written by the few tasks of a small or
    compact input are read again in as few, uneven tasks. A multiple of the cores, so that equal files fill equal tasks.
    `rows` is their number, if it is known; else they are counted, which computes them.
    """
    cores, rows = df.sparkSession.sparkContext.defaultParallelism, df.count() if rows is None else rows
    least = min(cores, max(1, rows // LEAST_ROWS_PER_TASK))
    tasks = max(least, math.ceil(rows / rows_per_task))
    return df.repartition(tasks if tasks <= cores else math.ceil(tasks / cores) * cores)


def delete_materialised(spark: SparkSession) -> None:
    """Delete every table this application has materialised. Results that were built on them can no longer be computed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
