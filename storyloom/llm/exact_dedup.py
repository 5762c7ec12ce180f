"""Exact deduplication by most-significant-digit radix partitioning.

A digit is the next run of bytes of the normalised text. Level by level, documents that share every
digit so far are split by the next one, until each group is a single document or its texts have ended
together. Groups are compared by their bytes; no digest decides equality. Digits widen from level to
level, so that the number of levels follows the logarithm of the longest repeated text. Only members
of groups that are still open carry text to the next level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import forget, materialize, unused

FIRST_DIGIT = 64
WIDENING = 6
WIDEST = 1 << 20


def normalised(text) -> F.Column:
    """Runs of space, tab, line feed, vertical tab, form feed and carriage return become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def radix_groups(docs: DataFrame, first: int = FIRST_DIGIT, widening: int = WIDENING) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text equals empty text. Of equal texts the smallest doc_id stays (null ids last); where a
    doc_id itself repeats with the same text, exactly one of its rows stays. An empty table gives an
    empty result; columns other than doc_id and text are ignored.

    Counting a digit combines on the map side, and the join back has one row per group on its right,
    so that a group with a third of all rows is split by adaptive execution and never held in one task.
    """
    return _groups(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), first, widening).drop("row")


def _groups(rows: DataFrame, first: int, widening: int) -> DataFrame:
    """``radix_groups`` of rows with doc_id, text and a number row of their own, which stays."""
    text = F.encode(normalised(F.col("text")), "UTF-8")
    state = rows.select("doc_id", "row", text.alias("rest"), F.lit(0).cast("long").alias("grp"))
    width, level, done, owned = first, 0, [], []
    while True:
        digit = F.substring(F.col("rest"), 1, width)
        groups = materialize(
            state.groupBy("grp", digit.alias("digit")).agg(F.count("*").alias("n")).where("n > 1").select("grp", "digit", F.monotonically_increasing_id().alias("next")),
            f"radix-groups-{level}",
        )
        known = state.withColumn("digit", digit).join(groups.hint("merge"), ["grp", "digit"], "left")
        open_ = F.col("next").isNotNull() & (F.octet_length("digit") == width)
        split = materialize(
            known.select(
                "doc_id",
                "row",
                F.sha2("rest", 256).alias("text_sha256") if level == 0 else F.col("text_sha256"),
                F.when(open_, F.substring(F.col("rest"), width + 1, 2**31 - 1)).alias("rest"),
                F.col("next").alias("grp"),
            ),
            f"radix-level-{level}",
        )
        done.append(split.where("rest is null").select("doc_id", "row", "text_sha256", "grp", F.lit(level).alias("level")))
        forget(groups)
        owned.append(split)
        state = split.where("rest is not null")
        if state.isEmpty():
            break
        width, level = min(width * widening, WIDEST), level + 1
    ended = reduce(DataFrame.unionByName, done)
    alone = ended.where("grp is null").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "row")
    shared = ended.where("grp is not null")
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    # written, so that the join below has a plain exchange on either side and a large group is split
    heads = materialize(shared.groupBy("level", "grp").agg(F.count("*").alias("group_size"), first_row.alias("head")), "radix-heads")
    return alone.unionByName(
        shared.join(heads.hint("merge"), ["level", "grp"]).select(
            "doc_id", F.col("head.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("head.row")).alias("kept"), "text_sha256", "row"
        )
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another kept row has; all columns stay, whatever their names, and whole rows that repeat go.

    A row with a null doc_id stays only if no row with a doc_id has its text. Rows are numbered and written first, and
    groups are told apart by their bytes, so that no digest decides which rows go. An empty table gives no rows.
    """
    (number,) = unused(docs, "row")
    numbered = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "radix-rows")
    groups = _groups(numbered.select("doc_id", "text", F.col(number).alias("row")), FIRST_DIGIT, WIDENING)
    kept = groups.where("kept").select(F.col("row").alias(number))
    return numbered.join(kept, number, "left_semi").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return radix_groups(docs)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, text_sha256
FROM t
"""
