"""Several tables with one key, replaced together: readers see all of a change or nothing of it.

Rows are dealt out by key into a fixed number of buckets. A change writes the buckets of its keys anew, those of all
tables, into the folder of its version, then a small file that says which version has each bucket of each table, and
at the very end the file ``current`` with that file's name. A run that fails before leaves everything as it was, and one
that comes again writes the same under another version. Buckets that no key of the change falls into are not read.
One writer at a time; any number of readers, whose files stay until ``prune``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.shared import Files

BUCKETS = 64


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Snapshot:
    """The tables as they were when the snapshot was taken."""

    def __init__(self, spark: SparkSession, root: str, state: dict):
        self.spark, self.root, self.state = spark, root, state

    def table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """A whole table, or the rows of some buckets."""
        known = self.state["tables"][name]
        schema = StructType.fromJson(known["schema"])
        paths = [f"{self.root}/{v}/{name}/bucket={b}" for b, v in sorted(known["buckets"].items(), key=lambda x: int(x[0])) if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def of(self, name: str, keys: list) -> DataFrame:
        """The rows of a few keys, from their buckets alone."""
        key = self.state["key"]
        kind = StructType.fromJson(self.state["tables"][name]["schema"])[key].dataType
        at = self.spark.createDataFrame([(k,) for k in keys], StructType().add(key, kind)).select(_bucket(key, self.state["n"])).distinct().collect()
        return self.table(name, [r[0] for r in at]).where(F.col(key).isin(keys))


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """What ``root`` has now; None where nothing was written yet."""
    files = Files(spark, root)
    if not files.exists(f"{root}/current"):
        return None
    return Snapshot(spark, root, json.loads(files.read(f"{root}/{files.read(f'{root}/current')}")))


def replace(spark: SparkSession, root: str, tables: dict[str, DataFrame], key: str, keys: DataFrame | None = None, buckets: int = BUCKETS) -> Snapshot:
    """Puts the rows of ``tables`` in place of all rows, in every table, of ``keys`` (a column of that name), and returns the new state.

    Without ``keys`` those of the first table, the parent, count. A table's rows of other keys are an error that ends the
    change; a table that is not given loses the keys' rows. Keys without any new row are deleted. The number of
    buckets is that of the first change. A null key is a key like others.
    """
    files, before = Files(spark, root), current(spark, root)
    n = before.state["n"] if before else buckets
    known = before.state["tables"] if before else {}
    if before and before.state["key"] != key:
        raise ValueError(f"these tables are kept by {before.state['key']}")
    keys = (keys if keys is not None else next(iter(tables.values()))).select(key).distinct()
    touched = sorted(r[0] for r in keys.select(_bucket(key, n)).distinct().collect())  # at most one number per bucket
    number = 1 + max([int(v[1:]) for v in files.names(root) if v[1:].isdigit() and v[0] == "v"], default=0)
    version, state = f"v{number:08d}", {"key": key, "n": n, "tables": {}}
    same = lambda df: df.select(F.col(key).alias("_k"))
    for name in [*known, *(t for t in tables if t not in known)]:
        new = tables.get(name)
        old = before.table(name, touched).join(same(keys), F.col(key).eqNullSafe(F.col("_k")), "left_anti") if name in known else None
        if new is not None:
            if not new.join(same(keys), F.col(key).eqNullSafe(F.col("_k")), "left_anti").isEmpty():
                raise ValueError(f"{name} has rows of keys that are not replaced")
            rows = new if old is None else old.unionByName(new)
        else:
            rows = old
        rows.withColumn("bucket", _bucket(key, n)).repartition(F.col("bucket")).write.partitionBy("bucket").parquet(f"{root}/{version}/{name}")
        there = {x[7:]: version for x in files.names(f"{root}/{version}/{name}") if x.startswith("bucket=")}
        kept = {b: v for b, v in known.get(name, {"buckets": {}})["buckets"].items() if int(b) not in touched}
        state["tables"][name] = {"schema": (before.table(name).schema if name in known else new.schema).jsonValue(), "buckets": {**kept, **there}}
    files.write(f"{root}/{version}.json", json.dumps(state))
    files.write(f"{root}/current", f"{version}.json")
    return Snapshot(spark, root, state)


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes the folders that none of the last ``keep`` states names, and what changes that failed left; returns their names."""
    files = Files(spark, root)
    if not files.exists(f"{root}/current"):
        return []
    last = files.read(f"{root}/current")
    states = [x for x in files.names(root) if x.startswith("v") and x.endswith(".json") and x <= last][-keep:]
    used = {v for x in states for t in json.loads(files.read(f"{root}/{x}"))["tables"].values() for v in t["buckets"].values()}
    gone = [x for x in files.names(root) if x.startswith("v") and x not in states and x not in used]
    for x in gone:
        files.delete(f"{root}/{x}")
    return gone
