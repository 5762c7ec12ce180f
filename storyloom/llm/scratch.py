"""Intermediate tables in the folder that the cluster shares.

A lost executor takes its shuffle files and cached blocks with it. Steps that cut lineage therefore
write Parquet under ``spark.checkpoint.dir``, which every executor and the driver can read.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a new local folder only where it is unset and Spark runs on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/storyloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Writes ``df`` to the shared folder, with a folder for each value of ``folders``, and reads it back, so that later steps start from files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").partitionBy(*folders).parquet(path)
    found = spark.read.schema(schema).parquet(path)
    found._written_at = path
    return found


def forget(df: DataFrame) -> None:
    """Deletes the files of a materialized table that no later step reads."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """For each name one like it that is no column of ``df``, in upper or lower case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
