"""Keyed state in a stream: what changed since a key was last seen, with a value per key in Spark's state store.

The state of a key is written when the key comes, whatever the number of keys that are known. The stream's checkpoint
holds offsets and state together, so that a batch that is run again starts from the state before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Latest(StatefulProcessor):
    """Keeps (version, digest) of a key and hands on its newest row, if that has another digest than the one kept."""

    def __init__(self, columns: list[str], digest: str, version: str, version_type: str, state: str):
        self.columns, self.digest, self.version = columns, digest, version
        self.state_type = f"version {version_type}, digest string, {state}"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", self.state_type)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = None
        for part in rows:
            top = part.loc[part[self.version].idxmax()]
            if newest is None or top[self.version] > newest[self.version]:
                newest = top
        number, digest = newest[self.version], newest[self.digest]
        known = self.kept.get() if self.kept.exists() else None
        if known is None or number > known[0]:
            times = 0 if known is None else known[2]
            changed = known is None or known[1] != digest
            self.kept.update((number.item() if hasattr(number, "item") else number, digest, times + int(changed)))
            if changed:
                yield pd.DataFrame([newest[self.columns]]).assign(kind="new" if known is None else "changed", times=times + 1)

    def close(self) -> None:
        pass


def changes(stream: DataFrame, key: str, digest: str, version: str) -> DataFrame:
    """Rows of ``stream`` whose digest is new or another one for their key, with kind (new or changed) and times (changes of the key so far).

    Of a key's rows in a batch the newest by ``version`` counts (the first on a tie), and only if it is newer than
    what the state has; a row that comes again, or comes late, is not handed on. Rows without a key or version are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    out = StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", kind string, times long")
    own = stream.where(F.col(key).isNotNull() & F.col(version).isNotNull())
    return own.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Latest(stream.columns, digest, version, kinds[version], "times long"), outputStructType=out, outputMode="Append", timeMode="None"
    )


def follow(spark: SparkSession, source: str, schema: str, key: str, digest: str, version: str, out: str, checkpoint: str, files: int | None = None) -> None:
    """Runs over the files that are new under ``source`` and appends their changes to the Parquet folder ``out``, each batch once.

    Files are taken ``files`` at a time. A run that fails goes on where it stopped: ``out`` and the state both belong to
    batches by number, so that a batch that is run again adds no row twice. Readers take the folder as a stream's output.
    """
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, PROVIDER)
    try:
        reader = spark.readStream.schema(schema)
        stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source)
        writer = changes(stream, key, digest, version).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(conf)
        else:
            spark.conf.set(conf, before)
