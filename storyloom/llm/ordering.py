"""Positions in a total order without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import materialize


def with_position(df: DataFrame, group: str, order: list[str], name: str = "position") -> DataFrame:
    """Adds the place (from 1) of each row within its group, nulls first.

    Rows are dealt out by ranges of group and order, so that a large group spans several tasks. Only groups
    that span tasks need offsets: one row per task and such a group, which is at most two per task.
    """
    dealt = materialize(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), "ordered")
    counts = dealt.groupBy("_part", group).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.withColumn("_before", before).where("_before IS NOT NULL").select(F.col("_part").alias("_p"), F.col(group).alias("_g"), "_before")
    own = F.row_number().over(W.partitionBy("_part", group).orderBy(*order))
    placed = dealt.withColumn("_own", own)
    joined = placed.join(F.broadcast(offsets), (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left")
    return joined.withColumn(name, (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("long")).drop("_part", "_own", "_p", "_g", "_before")
