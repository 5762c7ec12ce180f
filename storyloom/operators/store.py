"""Keyed tables on Parquet: upserts, replaced partitions, logs, digests, dumps and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spans import span_text


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows of both tables, of each key the one with the highest version; on a tie the new one. One shuffle by key, combined before it."""
    value = [c for c in old.columns if c not in keys]
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    last = F.max_by(F.struct(*value), F.struct(version, "_new")).alias("v")
    return both.groupBy(*keys).agg(last).select(*keys, *[F.col(f"v.{c}").alias(c) for c in value])


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and those new rows whose key it lacks."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def replace_partition(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` in place of all rows of the keys that it has."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def write_partitions(df: DataFrame, path: str, key: str) -> None:
    """Replaces the partitions of ``key`` that ``df`` has, and no others; writing the same again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def changed(now: DataFrame, known: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows whose digest is new or differs from the known one."""
    old = known.select(F.col(key), F.col(digest).alias("_d"))
    return now.join(old, key, "left").where(~F.col(digest).eqNullSafe(F.col("_d"))).drop("_d")


def pending(items: DataFrame, done: DataFrame, key: str, n: int = 0, cached: DataFrame | None = None) -> DataFrame:
    """Items without a finished counterpart, by name: the first n in order of the name, or all for 0.

    ``cached`` (key and others) has what earlier stages left for some of them; its columns go along, null where there is
    nothing. A name comes once there.
    """
    left = items.join(done.select(key), key, "left_anti")
    left = left.orderBy(key).limit(n) if n else left
    return left if cached is None else left.join(cached, key, "left")


def reused(items: DataFrame, cache: DataFrame, key: str, stage: str) -> DataFrame:
    """``items`` (key, stage: the key that the stage would have now) with the cached columns of those whose stage key is equal, and fresh, whether there are none."""
    known = cache.withColumn("_hit", F.lit(True))
    return items.join(known, [key, stage], "left").withColumn("fresh", F.col("_hit").isNull()).drop("_hit")


def doc_digest(model: str, text):
    return F.md5(F.concat(F.lit(model + "\n"), text))


def stage_key(*parts):
    """Sixteen hex digits over the parts' canonical JSON."""
    return F.substring(F.sha2(F.to_json(F.struct(*parts)), 256), 1, 16)


def retired(files: DataFrame, name: str, pattern: str, keep: int) -> DataFrame:
    """Files named by ``pattern`` beyond the newest ``keep``. The newest are a bounded list, so that no task sorts all names."""
    dated = files.where(F.col(name).rlike(pattern))
    newest = dated.select(name).distinct().orderBy(F.desc(name)).limit(keep)
    return dated.join(F.broadcast(newest), name, "left_anti")


def dump(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Writes each table as Parquet and returns the rows written, which are counted as they are written."""
    out = {}
    for name, df in tables.items():
        seen = Observation(f"dump {name}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/{name}")
        out[name] = seen.get["n"]
    return out


def page(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The next ``size`` rows by key after ``last``."""
    return (df if last is None else df.where(F.col(key) > last)).orderBy(key).limit(size)


def lookup_lists(df: DataFrame, key: str, *value: str, part) -> DataFrame:
    """key, part and its rows' values as a sorted array of structs. ``part`` is a column, by ranges of the values, that bounds a list where a key is hot."""
    return df.groupBy(key, part.alias("part")).agg(F.array_sort(F.collect_list(F.struct(*value))).alias("items"))


def breaker(runs: DataFrame, key: str, order: str, failed: str, limit: int = 3) -> DataFrame:
    """Rows up to and with the one at which ``limit`` failures in a row are reached."""
    w = W.partitionBy(key).orderBy(order)
    streak = F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w)
    rows = runs.withColumn("_s", streak)
    rows = rows.withColumn("_n", F.sum(F.when(F.col(failed), 1).otherwise(0)).over(W.partitionBy(key, "_s").orderBy(order)))
    stop = F.min(F.when(F.col("_n") >= limit, F.col(order))).over(W.partitionBy(key))
    return rows.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop"))).drop("_s", "_n", "_stop")


def within_budget(runs: DataFrame, key: str, order: str, seconds: str, budget: float) -> DataFrame:
    """``runs`` with started: whether a run still begins inside the budget, that is, whether the ones before it took less than ``budget`` seconds together.

    Seconds are added as decimals of nine places, so that a sum that reaches the budget exactly is not below it by the
    rounding of single additions; where one is no such decimal (not finite, or of over 20 digits), as they are.
    """
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    exact = F.col(seconds).try_cast("decimal(29,9)")
    rough = F.bool_or(exact.isNull() & F.col(seconds).isNotNull()).over(w)
    before = F.when(rough, F.sum(seconds).over(w)).otherwise(F.sum(exact).over(w).cast("double"))
    return runs.withColumn("started", F.coalesce(before, F.lit(0.0)) < budget)


def token_cost(df: DataFrame, keys: list[str], prompt: str, answer: str, rates: tuple[float, float] = (0.14, 0.28)) -> DataFrame:
    """Cost of prompt and answer tokens at rates per million."""
    cost = F.sum(F.col(prompt) / 1e6 * rates[0] + F.col(answer) / 1e6 * rates[1])
    return df.groupBy(*keys).agg(F.round(cost, 6).alias("cost"))


def refresh_status(old: DataFrame, new: DataFrame, key: str, idx: str, times: list[str], text: str) -> DataFrame:
    """key and status of every episode of either table: new, gone, same, text (all rows and times are equal, some text is not) or times."""
    a = old.select(key, idx, F.struct(*times).alias("_t"), F.col(text).alias("_x"), F.lit(1).alias("_a"))
    b = new.select(key, idx, F.struct(*times).alias("_u"), F.col(text).alias("_y"), F.lit(1).alias("_b"))
    both = a.join(b, [key, idx], "full")
    status = both.groupBy(key).agg(
        F.count("_a").alias("a"), F.count("_b").alias("b"),
        F.bool_and(F.col("_t").eqNullSafe(F.col("_u")) & F.col("_a").eqNullSafe(F.col("_b"))).alias("timed"),
        F.bool_and(F.col("_x").eqNullSafe(F.col("_y"))).alias("said"),
    )
    kind = F.when(F.col("a") == 0, "new").when(F.col("b") == 0, "gone").when(~F.col("timed"), "times").when(~F.col("said"), "text").otherwise("same")
    return status.select(key, kind.alias("status"))


def refresh_text(old: DataFrame, new: DataFrame, key: str, idx: str, times: list[str], text: str) -> DataFrame:
    """``old`` with the new texts of episodes whose rows and times are all equal; other episodes stay for reprocessing."""
    ready = refresh_status(old, new, key, idx, times, text).where("status = 'text'").select(key)
    fresh = new.join(ready, key, "left_semi").select(key, idx, F.col(text).alias("_fresh"), F.lit(True).alias("_is"))
    joined = old.join(fresh, [key, idx], "left")
    return joined.withColumn(text, F.when(F.col("_is"), F.col("_fresh")).otherwise(F.col(text))).select(*old.columns)


def refresh_quotes(quotes: DataFrame, old: DataFrame, new: DataFrame, key: str, idx: str, times: list[str], text: str) -> DataFrame:
    """``quotes`` (key, lo, hi, text and others) with the texts of refreshed episodes cut anew from their rows lo to hi.

    A quote keeps everything else, as its rows and times are what they were. Quotes of other episodes stay as they are.
    """
    ready = refresh_status(old, new, key, idx, times, text).where("status = 'text'").select(key)
    ranges = quotes.join(ready, key, "left_semi").select(key, "lo", "hi").distinct()
    fresh = span_text(ranges, new, key, idx, text).select(key, "lo", "hi", F.col("text").alias("_fresh"))
    joined = quotes.join(fresh, [key, "lo", "hi"], "left")
    return joined.withColumn("text", F.coalesce("_fresh", "text")).select(*quotes.columns)


def set_where(df: DataFrame, column: str, condition, value) -> DataFrame:
    """``df`` with ``column`` set to ``value`` where the condition holds."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def append_log(log: DataFrame, entries: DataFrame) -> DataFrame:
    """``log`` and the new entries; columns go by name, and one that the entries lack is null."""
    return log.unionByName(entries, allowMissingColumns=True)


def manifest(stages: dict, **fields):
    """A provenance record as JSON: digest by stage, and further fields, each in order of its name."""
    keys = F.map_from_entries(F.array(*[F.struct(F.lit(k), v) for k, v in sorted(stages.items())]))
    return F.to_json(F.struct(*[v.alias(k) for k, v in sorted({**fields, "stage_keys": keys}.items())]))


def stage_done(record, stage: str, key):
    """Whether a manifest has this key for the stage."""
    return F.coalesce(F.from_json(record, "stage_keys map<string, string>")["stage_keys"][stage] == key, F.lit(False))


def run_report(runs: DataFrame, key: str, status: str, cost: str) -> DataFrame:
    """Per key and in total (key null): runs that went well (``ok``), that failed, that did not start, and their cost."""
    one = lambda name: F.sum(F.when(F.col(status) == name, 1).otherwise(0)).alias(name)
    return runs.rollup(key).agg(one("ok"), one("failed"), one("not_started"), F.round(F.sum(cost), 6).alias("cost"))
