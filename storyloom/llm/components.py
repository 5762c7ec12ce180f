"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import forget, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung on the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung on the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v")))


def connected(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of the undirected links (two columns of longs).

    Links of a node with itself are ignored. Work and tables are in proportion to the links; each step is
    an aggregate and a join whose other side has one row per node, so that a node with very many links is
    split. Each round is written to the shared folder.
    """
    a, b = links.columns
    edges, written = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), False
    while True:
        turned = materialize(_small_star(_large_star(edges)).distinct(), "components")
        if written:
            forget(edges)
        edges, written = turned, True
        # done when every node hangs on one node that hangs on none
        ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("up")))
        if ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
