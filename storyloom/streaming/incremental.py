"""Incremental reprocessing: a file stream keeps the latest digest of each key and hands on what changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import changed, upsert


def process_changes(spark: SparkSession, source: str, schema: str, state: str, checkpoint: str, key: str, digest: str, version: str, handle: Callable[[DataFrame], None]) -> None:
    """Runs once over the files that are new under ``source``; rows whose digest differs from the one in ``state`` go to ``handle``.

    ``state`` holds one directory per batch that ended, named by the batch, and the last one counts. A batch that is run
    again after a failure starts from the state before it and writes the same, so that ``handle`` must bear repeats.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def batches() -> list[int]:
        folder = path(state)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[6:]) for n in names if n.startswith("batch=") and fs.exists(path(f"{state}/{n}/_SUCCESS")))

    def each(df: DataFrame, number: int) -> None:
        before = [n for n in batches() if n < number]
        columns = df.select(key, digest, version)
        known = spark.read.parquet(f"{state}/batch={before[-1]}") if before else spark.createDataFrame([], columns.schema)
        latest = upsert(columns.limit(0), columns, [key], version)
        new = changed(df.join(latest.select(key, version), [key, version], "left_semi"), known, key, digest)
        handle(new)
        upsert(known, columns, [key], version).write.mode("overwrite").parquet(f"{state}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(stream: DataFrame, ts: str, key: str, late: str = "1 hour", size: str = "1 hour") -> DataFrame:
    """Counts by event-time window and key; rows later than ``late`` are left out when the frame is a stream."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, size), key).agg(F.count("*").alias("n"))
