"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources that each belongs to. The flow network has
one node per pattern and one per source: start -> pattern (one arc per repetition, each with the pattern's
words as capacity and a cost that rises with the repetition, so that costs are convex), pattern ->
each of its sources, source -> end (the source's quota). The cheapest flow fills quotas with as little
repetition as can be. It is solved on the driver, since its size is the number of patterns and not of
documents. Each pattern's words are then met by documents in a seeded order.

The seeded order is never sorted as a whole: words are summed per pattern and leading hash digits, and only
the bucket in which a pattern's amount is reached is ordered within.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 17
#: Hex digits of the seeded hash by which words are summed; a pattern's last bucket holds 1 / 16 ** DIGITS of it.
DIGITS = 3


def n_words(text) -> F.Column:
    """Number of runs of characters other than space and 0x09-0x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def target_sizes(sizes: dict, weights: dict, share: float = SHARE, cap: float = MAX_REPEATS) -> dict:
    """Targets in proportion to weights, together ``share`` of all sizes; none above ``cap`` times its size, excess reshared by weight."""
    left = share * sum(sizes.values())
    out, open_ = {}, set(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > cap * sizes[s]}
        if not over:
            return out | {s: left * weights[s] / total for s in open_}
        out |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def weights_by_name(sources, weights=WEIGHTS) -> dict:
    """Weights dealt in turn to sources in order of code points, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: weights[i % len(weights)] for i, s in enumerate(ordered)}


class MinCostFlow:
    """Primal-dual: shortest distances by cost, then blocking flow on the arcs of shortest paths."""

    def __init__(self):
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.arcs: dict[int, list[int]] = defaultdict(list)

    def add(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.arcs[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def flow(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def _distances(self, start: int) -> dict[int, tuple[int, int]]:
        """Least (cost, arcs) to each node."""
        best, queue, queued = {start: (0, 0)}, deque([start]), {start}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for arc in self.arcs[a]:
                b, way = self.to[arc], (best[a][0] + self.cost[arc], best[a][1] + 1)
                if self.room[arc] and (b not in best or way < best[b]):
                    best[b] = way
                    if b not in queued:
                        queued.add(b)
                        queue.append(b)
        return best

    def solve(self, start: int, end: int) -> None:
        while True:
            far = self._distances(start)
            if end not in far:
                return
            at = {n: iter(arcs) for n, arcs in self.arcs.items()}
            path: list[int] = []
            node = start
            while True:
                if node == end:
                    push = min(self.room[a] for a in path)
                    for a in path:
                        self.room[a] -= push
                        self.room[a ^ 1] += push
                    cut = next(i for i, a in enumerate(path) if not self.room[a])
                    node = self.to[path[cut] ^ 1]
                    del path[cut:]
                    at[node] = (x for x in self.arcs[node])
                    continue
                for arc in at[node]:
                    b = self.to[arc]
                    if self.room[arc] and far.get(b) == (far[node][0] + self.cost[arc], far[node][1] + 1):
                        path.append(arc)
                        node = b
                        break
                else:
                    if node == start:
                        break
                    far.pop(node, None)
                    node = self.to[path.pop() ^ 1]


def route(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = MAX_REPEATS) -> list[dict]:
    """For each (sources, words) of ``patterns`` the words that go to each of its sources, by source."""
    net, names = MinCostFlow(), sorted(quotas, key=lambda s: (s is None, s or ""))
    node = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
    out = []
    for i, (sources, words) in enumerate(patterns):
        for r in range(repeats):
            net.add(0, 2 + i, words, r * (r + 1) // 2)
        out.append({s: net.add(2 + i, node[s], repeats * words, 0) for s in sources})
    for s in names:
        net.add(node[s], 1, quotas[s], 0)
    net.solve(0, 1)
    return [{s: net.flow(arc) for s, arc in arcs.items()} for arcs in out]


def _seeded(seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(docs: DataFrame, targets: dict | None = None, share: float = SHARE, repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, size, sources: array of strings, entries may be null) with target and taken.

    taken is size times the number of repetitions, 0 to ``repeats``. ``targets`` are words by source; left out,
    they come from ``target_sizes`` with weights by name, a document of several sources counting in each.
    target is the sum over the document's sources. Repeated rows and rows that share a doc_id are taken
    together; documents without words and without sources have taken 0. In a pattern, the last document in
    seeded order is the one that brings the words nearest to the amount, so that the sum is off by less than
    half of a document. An empty table gives no rows. Results depend on the seed and the rows alone. Columns of the
    input stay, except ones named target, source_size, taken or repeats, in whose place the results stand.
    """
    spark = docs.sparkSession
    columns = docs.columns
    names = F.array_sort(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>"))))
    # the input's columns travel as one, so that their names meet none of those below
    docs = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), "doc_id", "size", names.alias("s"))
    docs = docs.withColumn("pattern", F.to_json(F.struct("s"), {"ignoreNullFields": "false"}))
    slim = materialize(docs.select("pattern", "size", _seeded(seed).alias("h"), "s"), "mix-sizes")
    # a row per pattern, which is the size of the network that the driver solves
    summed = slim.groupBy("pattern").agg(F.sum("size").alias("words"), F.first("s").alias("s")).collect()
    sizes: dict = defaultdict(int)
    for row in summed:
        for s in row.s:
            sizes[s] += row.words
    if targets is None:
        targets = target_sizes(sizes, weights_by_name(sizes), share, repeats)
    quotas = {s: round(targets.get(s, 0)) for s in sizes}
    routed = route([(tuple(row.s), row.words) for row in summed], quotas, repeats)
    plan = []
    for row, to in zip(summed, routed):
        amount = sum(to.values())
        full = min(repeats, amount // row.words) if row.words else 0
        plan.append((row.pattern, float(sum(targets.get(s, 0) for s in row.s)), sum(sizes[s] for s in row.s), int(full), int(amount - full * row.words) if full < repeats else 0))
    shown = spark.createDataFrame(plan, "pattern string, target double, source_size long, full int, need long")
    shown = F.broadcast(shown) if len(plan) <= 10_000 else shown  # a row per pattern
    # full: repetitions that every document of the pattern has; need: words of the next repetition
    slim = slim.join(shown, "pattern").withColumn("b", F.substring("h", 1, DIGITS))
    docs = docs.join(shown, "pattern").withColumn("h", _seeded(seed)).withColumn("b", F.substring("h", 1, DIGITS))
    sums = slim.where("need > 0").groupBy("pattern", "need", "b").agg(F.sum("size").alias("w"))
    upto = F.sum("w").over(W.partitionBy("pattern").orderBy("b"))
    last = sums.withColumn("upto", upto).where("upto >= need AND upto - w < need").select("pattern", F.col("b").alias("edge"), (F.col("need") - F.col("upto") + F.col("w")).alias("room"))
    last = F.broadcast(last) if len(plan) <= 10_000 else last  # a row per pattern
    docs = docs.join(last, "pattern", "left")
    edge = slim.join(last, "pattern").where("b = edge").groupBy("pattern", "room", "h").agg(F.sum("size").alias("w"))
    # of the edge bucket, documents that fit go in; the one that crosses the amount only if that comes nearer
    run = F.sum("w").over(W.partitionBy("pattern").orderBy("h"))
    inside = edge.withColumn("upto", run).where("upto <= room OR (upto - w < room AND upto - room < room - upto + w)")
    cut = inside.groupBy(F.col("pattern").alias("p")).agg(F.max("h").alias("cut"))
    cut = F.broadcast(cut) if len(plan) <= 10_000 else cut  # a row per pattern
    docs = docs.join(cut, docs.pattern == cut.p, "left")
    extra = (F.col("need") > 0) & ((F.col("b") < F.col("edge")) | ((F.col("b") == F.col("edge")) & F.coalesce(F.col("h") <= F.col("cut"), F.lit(False))))
    times = F.col("full") + F.when(extra, 1).otherwise(0)
    made = {"target": F.col("target"), "source_size": F.col("source_size"), "taken": F.col("size") * times, "repeats": F.when(F.col("size") > 0, times).otherwise(0)}
    own = [F.col("row")[c].alias(c) for c in columns if c.lower() not in made]
    return docs.select(*own, *[v.alias(k) for k, v in made.items()])


def repeat_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix of its source takes it; all columns stay, whatever their names.

    A row without words is no part of any source's words and stays once. Repeated rows and rows with a null source or doc_id
    are mixed like others. An empty table gives no rows.
    """
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), "doc_id", n_words(F.col("text")).alias("size"), F.array("source").alias("sources"))
    times = F.when(F.col("size") > 0, F.col("repeats")).otherwise(1)
    mixed = mix(packed).select("whole", times.alias("times")).where("times > 0")
    return mixed.select("whole", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("whole.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", n_words(F.col("text")).alias("size"), F.array("source").alias("sources"))).select(
        "doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken"
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
r AS (  -- sources in the order in which they reach twice their size
  SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i,
         sum(2 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS capped,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM s),
l AS (
  SELECT (1.5 * (SELECT sum(size) FROM d) - coalesce(capped, 0)) / rest AS level
  FROM r WHERE (1.5 * (SELECT sum(size) FROM d) - coalesce(capped, 0)) / rest <= 2 * source_size / w ORDER BY i LIMIT 1),
t AS (SELECT source, source_size, least(2.0 * source_size, w * level)::DOUBLE AS target FROM s, l),
n AS (
  SELECT *, round_even(target, 0)::BIGINT AS quota,
         CASE WHEN source_size > 0 THEN least(2, round_even(target, 0)::BIGINT // source_size) ELSE 0 END AS times FROM t),
o AS (
  SELECT d.doc_id, d.size, n.source_size, n.target, n.times, CASE WHEN n.times < 2 THEN n.quota - n.times * n.source_size ELSE 0 END AS need,
         sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, round(target, 4) AS target,
       (size * (times + CASE WHEN need > 0 AND (upto <= need OR (upto - own < need AND upto - need < need - upto + own)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""
