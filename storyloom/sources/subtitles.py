"""Subtitle files and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import srt_seconds, srt_timestamp

WORDS = "array<struct<text:string,start:double,end:double>>"


def parse_srt(files: DataFrame, key: str, text: str) -> DataFrame:
    """key, idx, start, end, text of each block: a number, a line ``start --> end`` and the text's lines. A malformed block is an error."""
    blocks = files.select(key, F.explode(F.split(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), r"\n[ \t]*\n+")).alias("b"))
    block = F.regexp_replace("b", r"^\n+|\n+$", "")
    form = r"(?s)^[ \t]*(\d+)[ \t]*\n([\d:,.]+) --> ([\d:,.]+)[ \t]*(?:\n(.*))?$"
    rows = blocks.withColumn("b", block).where(F.trim("b") != "")
    rows = rows.withColumn("b", F.when(F.col("b").rlike(form), F.col("b")).otherwise(F.raise_error(F.concat(F.lit("malformed block: "), F.col("b")))))
    part = lambda i: F.regexp_extract("b", form, i)
    return rows.select(key, part(1).cast("int").alias("idx"), srt_seconds(part(2)).alias("start"), srt_seconds(part(3)).alias("end"), part(4).alias("text"))


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """Cues of every file under ``path``, with the file's name as stem."""
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # Spark gives it as part of a URI
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1).alias("stem"), "value")
    return parse_srt(files, "stem", "value")


def srt_block(idx, start, end, text):
    return F.concat(idx.cast("string"), F.lit("\n"), srt_timestamp(start), F.lit(" --> "), srt_timestamp(end), F.lit("\n"), text)


def render_srt(cues: DataFrame, key: str) -> DataFrame:
    """key and srt: blocks in order of idx, apart by a blank line, with one line break at the end."""
    blocks = F.array_sort(F.collect_list(F.struct("idx", srt_block(F.col("idx"), F.col("start"), F.col("end"), F.col("text")).alias("b"))))
    return cues.groupBy(key).agg(F.concat(F.array_join(F.transform(blocks, lambda x: x["b"]), "\n\n"), F.lit("\n")).alias("srt"))


def parse_words(files: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, text, start, end of each word of JSON lists."""
    return files.select(key, F.posexplode(F.from_json(text, WORDS)).alias("pos", "w")).select(key, "pos", "w.text", "w.start", "w.end")
