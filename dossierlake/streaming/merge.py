"""Deliveries as a stream: every file that arrives is merged into a target table once, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dossierlake.operators.relational import keep_first
from dossierlake.session import subfolders


def first_of_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key, the least by its other columns; rows with a null key stay, for they match nothing. Without keys, different rows."""
    others = [c for c in batch.columns if c not in keys]
    if not keys or not others:
        return batch.dropDuplicates()
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return keep_first(batch.where(known), keys, [F.to_json(F.struct(*others))]).unionByName(batch.where(~known))


def merge_stream(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, keys: list[str], files_at_once: int = 100) -> None:
    """Append one row of each key that the target does not have, out of all new files; ends when all files there are have been read.

    A batch is written under its own number and replaced if it is run again, so a failure between writing and the
    checkpoint does not double rows. target is a table of Parquet partitioned by batch, at any address Spark can write;
    of the earlier batches only the key columns are read.
    """

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        existing = [p for p in subfolders(session, target) if p.startswith("batch=") and p != f"batch={number}"]
        fresh = first_of_keys(batch, keys)
        if existing and keys:
            main = session.read.schema(T.StructType([batch.schema[k] for k in keys])).parquet(*(f"{target.rstrip('/')}/{p}" for p in existing))
            fresh = fresh.join(main, keys, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    query = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, at: str, by: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows by window and key of a stream or table; a stream drops what is later than the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), by, "n")
