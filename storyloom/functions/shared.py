"""The folder that driver and executors share, and the few things done to its files from the driver."""

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


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/storyloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, for steps that use it several times; an executor that is lost takes nothing of it along."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out evenly by ``keys`` for a step that takes much time a row: rows of few bytes would else be put into few tasks."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


class Files:
    """Files of one store by Hadoop's own client, which reaches every store that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        """What is in a folder, in order; nothing where there is none."""
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Puts a whole file in place of ``name``: it is written beside it and renamed, so that readers see the old one or the new one."""
        beside = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(beside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(self.path(beside), self.path(name), options)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
