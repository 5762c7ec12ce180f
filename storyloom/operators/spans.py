"""Joins and lookups over ordered intervals (cues): neighbours, containment, overlap, time context, cross-row match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import ascii_lower


def grep(rows: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """Rows whose text contains any term literally, A-Z and a-z alike."""
    folded = ascii_lower(F.col(text))
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(folded, F.lit("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)))
    return rows.where(hit)


def time_context(rows: DataFrame, at: DataFrame, key: str, start: str, span: float) -> DataFrame:
    """Rows of ``key`` that start within ``span`` of ``at`` (key, at); current marks the last one that starts before at + 1."""
    met = rows.join(at, key).where(F.col(start).between(F.col("at") - span, F.col("at") + span))
    last = F.max(F.when(F.col(start) < F.col("at") + 1, F.col(start))).over(W.partitionBy(key, "at"))
    return met.withColumn("current", F.coalesce(F.col(start) == last, F.lit(False)))


def neighbours(rows: DataFrame, key: str, idx: str, text: str, reach: int = 3) -> DataFrame:
    """Adds the texts of up to ``reach`` indexes before and after; gaps in the index are not bridged."""
    w = W.partitionBy(key).orderBy(idx)
    joined = lambda lo, hi: F.concat_ws("\n", F.collect_list(text).over(w.rangeBetween(lo, hi)))
    return rows.withColumn("before", joined(-reach, -1)).withColumn("after", joined(1, reach))


def span_text(spans: DataFrame, rows: DataFrame, key: str, idx: str, text: str) -> DataFrame:
    """Each span (key, lo, hi) with its rows' texts joined in order and their number."""
    wide = spans.withColumn(idx, F.explode(F.sequence("lo", "hi")))
    parts = F.array_sort(F.collect_list(F.struct(F.col(idx), F.col(text))))
    return wide.join(rows.select(key, idx, text), [key, idx]).groupBy(key, "lo", "hi").agg(F.array_join(F.transform(parts, lambda p: p[text]), "\n").alias("text"), F.count("*").alias("n"))


def contained(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str, bucket: int) -> DataFrame:
    """Pairs with lo <= point <= hi, as an equi-join on buckets of width ``bucket``."""
    cut = lambda c: F.floor(c / bucket)
    wide = ranges.withColumn("_b", F.explode(F.sequence(cut(F.col(lo)), cut(F.col(hi)))))
    return points.withColumn("_b", cut(F.col(point))).join(wide, "_b").where(F.col(point).between(F.col(lo), F.col(hi))).drop("_b")


def overlaps(a: DataFrame, b: DataFrame, key: str, bucket: float) -> DataFrame:
    """Pairs of closed intervals (key, a0, a1) and (key, b0, b1) that share a point, each pair once.

    Intervals are dealt to all buckets that they touch; the pair counts in the bucket where the later start is.
    """
    cut = lambda c: F.floor(c / bucket).cast("long")
    left = a.withColumn("_b", F.explode(F.sequence(cut(F.col("a0")), cut(F.col("a1")))))
    right = b.withColumn("_b", F.explode(F.sequence(cut(F.col("b0")), cut(F.col("b1")))))
    met = left.join(right, [key, "_b"]).where("a0 <= b1 AND b0 <= a1")
    return met.where(F.col("_b") == cut(F.greatest("a0", "b0"))).drop("_b")


def merged(intervals: DataFrame, key: str, start: str, end: str, gap: float = 0.0) -> DataFrame:
    """key, start and end of the unions of closed intervals that touch, or lie at most ``gap`` apart.

    An interval opens a union if it starts beyond the latest end before it, by order of start. Empty ones (end before start) are left out.
    """
    w = W.partitionBy(key).orderBy(start, end)
    real = intervals.where(F.col(start) <= F.col(end)).select(key, F.col(start).alias("start"), F.col(end).alias("end"))
    latest = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    opened = real.withColumn("_o", F.when(F.col("start") <= latest + gap, 0).otherwise(1))
    run = opened.withColumn("_r", F.sum("_o").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return run.groupBy(key, "_r").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_r")


def covered(a: DataFrame, b: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, a_seconds, b_seconds and both_seconds: how long either side's intervals are, each moment once, and where both are.

    The starts and ends of both sides' unions are swept in order: between two of them a side is on or off. A key's
    events are as many as its unions on both sides, twice.
    """
    sides = [merged(df, key, start, end).select(key, F.inline(F.array(F.struct(F.col("start").alias("at"), F.lit(one).alias("a"), F.lit(two).alias("b")), F.struct(F.col("end").alias("at"), F.lit(-one).alias("a"), F.lit(-two).alias("b"))))) for df, one, two in ((a, 1, 0), (b, 0, 1))]
    events = sides[0].unionByName(sides[1]).groupBy(key, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = W.partitionBy(key).orderBy("at")
    on = events.select(key, F.sum("a").over(w).alias("a"), F.sum("b").over(w).alias("b"), (F.lead("at").over(w) - F.col("at")).alias("t"))
    long_ = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("t"))), F.lit(0.0)).alias(name)
    return on.groupBy(key).agg(long_(F.col("a") > 0, "a_seconds"), long_(F.col("b") > 0, "b_seconds"), long_((F.col("a") > 0) & (F.col("b") > 0), "both_seconds"))


def met_either_way(a: DataFrame, b: DataFrame, key: str, bucket: float) -> DataFrame:
    """key, a_n, a_met, b_n and b_met: the intervals of either side (``overlaps`` has their columns) and how many of them meet one of the other."""
    pairs = overlaps(a, b, key, bucket)
    number = lambda df, cols, name: df.select(key, *cols).distinct().groupBy(key).agg(F.count("*").alias(name))
    out = number(a, ["a0", "a1"], "a_n").join(number(b, ["b0", "b1"], "b_n"), key, "full")
    out = out.join(number(pairs, ["a0", "a1"], "a_met"), key, "left").join(number(pairs, ["b0", "b1"], "b_met"), key, "left")
    return out.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("a_n", "a_met", "b_n", "b_met")])


def match_across(rows: DataFrame, needle: str, key: str, idx: str, text: str) -> DataFrame:
    """Rows that overlap the first occurrence of ``needle`` in the joined letters and digits of all rows of a key.

    Offsets are running sums; the search text of a row is its own and as much of the next rows as a match needs.
    """
    norm = ascii_lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]", ""))
    rows = rows.withColumn("_n", norm)
    w = W.partitionBy(key).orderBy(idx)
    rows = rows.withColumn("_end", F.sum(F.length("_n")).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_start", F.col("_end") - F.length("_n"))
    ahead = F.concat_ws("", F.collect_list("_n").over(w.rowsBetween(0, len(needle) - 1)))
    found = F.locate(needle, ahead)
    first = F.min(F.when((found > 0) & (found <= F.length("_n")), F.col("_start") + found - 1)).over(W.partitionBy(key))
    rows = rows.withColumn("_at", first)
    return rows.where((F.col("_start") < F.col("_at") + len(needle)) & (F.col("_end") > F.col("_at"))).drop("_n", "_end", "_start", "_at")


def nearest_row(rows: DataFrame, at: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """For each (key, at) the row that covers it (start <= at < end), else the one that starts nearest; ties to the earlier."""
    d = F.abs(F.col(start) - F.col("at"))
    order = F.struct(F.when((F.col(start) <= F.col("at")) & (F.col("at") < F.col(end)), 0).otherwise(1), d, F.col(start))
    kept = F.min_by(F.struct(*[c for c in rows.columns if c != key]), order)
    return rows.join(at, key).groupBy(key, "at").agg(kept.alias("row")).select(key, "at", "row.*")


def one_by_fragment(rows: DataFrame, column: str, fragment: str) -> DataFrame:
    """Rows of the one value of ``column`` that holds ``fragment``; none or several such values end the query with an error."""
    found = rows.where(F.contains(F.col(column), F.lit(fragment)))
    kinds = rows.agg(F.min(F.when(F.contains(F.col(column), F.lit(fragment)), F.col(column))).alias("lo"), F.max(F.when(F.contains(F.col(column), F.lit(fragment)), F.col(column))).alias("hi"))
    only = kinds.select(F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.raise_error(F.lit(f"not one value with {fragment!r}"))).alias("_only"))
    return found.join(F.broadcast(only), F.col(column) == F.col("_only")).drop("_only")
