"""Session settings and the two helpers that need a session: reading a named table and cutting lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", name: str = "dossierlake", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session instead."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.driver.memory", memory)
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(partitions), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def text_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table whose rows are much work each (texts, XML). Where its files have less than half as many parts as there are
    cores, the rows are dealt out to all; each part is at most spark.sql.files.maxPartitionBytes, so little is moved, and a
    large table is read as it lies."""
    df, cores = table(spark, directory, name), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < max(2, cores / 2) else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session without spark.checkpoint.dir (tests) gets one of its own; on a cluster a missing one is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext._jsc.sc()
    if configured:
        if not context.getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir().isDefined():
        return context.getCheckpointDir().get()
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="dossierlake-checkpoint-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there, so that a lost executor costs no recomputation of what is above."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder on whatever store its address names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession) -> str:
    """A new path for a table in the shared folder, below the application's own folder."""
    return f"{_tables(spark)}/{uuid.uuid4().hex}"


def write_shared(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, read back: columnar and compressed, unlike a checkpoint. It stays until drop_shared."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_shared(spark: SparkSession) -> None:
    """Remove the tables this application has written, once the results that read them are computed and stored."""
    fs, p = hadoop_path(spark, _tables(spark))
    fs.delete(p, True)


def task_slots(spark: SparkSession) -> int:
    """Partitions to use for work that is heavy in CPU but small in bytes, where AQE would coalesce too far."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
