"""Exact top-k search by inner product with a table of distances to pivots.

Vectors are integers (components floor(1024 x)). For a pivot p the triangle inequality bounds the distance of a
query and a candidate from below by |d(q, p) - d(c, p)|, and so their inner product
(|q|^2 + |c|^2 - d(q, c)^2) / 2 from above. The distances of every row to ``PIVOTS`` pivots are computed once,
next to the rows. Candidates come in the order of their best bound, and a query is done when the next bound is
below its k-th score. The pivots' own scores give each query a first k-th score.

Rows go through as packed blocks. Blocks of queries meet every block of candidates; each such meeting
gives at most k rows per query, of which the k best stay. A task takes a query's k-th score on to its next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .katz import pack, unpack
from .scratch import materialize

K = 10
PIVOTS = 24
PIVOT_SAMPLE = 1024
BLOCK = 8192
QUERY_BLOCK = 256
STEP = 256


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component as long. Rows without a vec_id, and vectors that are null, empty or hold a null or non-finite component, are left out."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & fine)
        .select("vec_id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))
    )


def choose_pivots(rows: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows far from each other, the first one given and each next one farthest from those before; fewer than n where fewer vectors differ, so that no row comes twice."""
    rows = rows.astype(float)
    chosen = [0]
    far = ((rows - rows[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(rows)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def pivot_sample(rows: DataFrame, n: int) -> list:
    """The PIVOT_SAMPLE rows of the smallest hashes of vec_id, of ``n``; a task sends those below a hash that few rows are below, not as many rows as are wanted of all."""
    share = 4 * PIVOT_SAMPLE / max(n, 1)
    first = lambda df: df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    found = first(rows.where(F.xxhash64("vec_id") < int(share * 2**64) - 2**63)) if share < 1 else []
    return found if len(found) == PIVOT_SAMPLE else first(rows)  # a vec_id that repeats can leave too few


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = v.astype(float), pivots.astype(float)
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * x @ p.T))


def _most(v: np.ndarray) -> int:
    return max(-int(v.min(initial=0)), int(v.max(initial=0)))


def _narrow(v: np.ndarray) -> np.ndarray:
    most = _most(v)
    return v.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def products(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products (below 2 ** 63) of the rows of c with q."""
    if c.size and float(np.abs(c).max()) * float(np.abs(q).max(initial=0)) * len(q) < 2**53:
        return (c.astype(float) @ q.astype(float)).astype(np.int64)
    return c.astype(np.int64) @ q.astype(np.int64)


def blocks(rows: DataFrame, pivots: dict[int, np.ndarray], size: int, k: int) -> DataFrame:
    """dim and body (packed ids, vectors, pivot distances, first k-th scores) of up to ``size`` rows of one dimension."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def close(dim: int) -> pa.RecordBatch:
            ids, v = zip(*held.pop(dim))
            ids, v = np.array(ids, np.int64), np.array(v, np.int64)
            p = shared.value.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
            first = np.full(len(ids), np.iinfo(np.int64).min)
            if len(p[1]) > k:
                for i, (own, row) in enumerate(zip(ids, v)):
                    scores = products(p[1], row)[p[0] != own]
                    if len(scores) >= k:
                        first[i] = np.partition(scores, -k)[-k]
            body = pack([ids, _narrow(v).ravel(), _distances(v, p[1]).ravel(), first])
            return pa.record_batch([pa.array([dim], pa.int64()), pa.array([body], pa.binary())], names=["dim", "body"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy()
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == size:
                    yield close(len(v))
        for dim in list(held):
            yield close(dim)

    return rows.select("vec_id", "v").mapInArrow(run, "dim long, body binary")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores in order with their ids, of equal ones those of the smaller ids."""
    if len(scores) > k:
        high = scores >= np.partition(scores, -k)[-k]
        ids, scores = ids[high], scores[high]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def best_in_block(q_id: int, q: np.ndarray, dq: np.ndarray, kth: int, ids: np.ndarray, v: np.ndarray, dv: np.ndarray, norms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of up to k candidates: all that can be among the k best given that the k-th score is at least ``kth``.

    ``dv`` has a row per pivot. The STEP candidates of the best bounds are evaluated first, then those that the k-th score
    so far leaves, all of the block at once if these are most of it. Rows of ``v`` and ``q`` are floats if products of them are exact.
    """
    q2 = float((q.astype(float) ** 2).sum())
    gap, one = np.zeros(len(ids)), np.empty(len(ids))
    for to_pivot, own in zip(dv, dq):
        np.maximum(gap, np.abs(np.subtract(to_pivot, own, out=one), out=one), out=gap)
    bound = (q2 + norms - gap * gap) / 2
    bound += 1e-9 * (q2 + norms) + 1e-3  # rounding of distances
    live = np.flatnonzero((bound >= kth) & (ids != q_id))
    if len(live) > STEP:
        first = live[np.argpartition(bound[live], -STEP)[-STEP:]]
        met = _best(ids[first], (v[first] @ q).astype(np.int64), k)
        live = live[bound[live] >= (met[1][-1] if len(met[1]) == k else kth)]
    scores = (v @ q)[live] if 2 * len(live) > len(ids) else v[live] @ q
    return _best(ids[live], scores.astype(np.int64), k)


def top_k(vectors: DataFrame, is_query, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: of each query (a vec_id for which ``is_query`` holds) its k highest scores among all other rows.

    Ties go to the smaller vec_id; fewer rows come where there are fewer candidates. Rows that share the query's
    vec_id count as its own. A vec_id that repeats is one query, with its smallest vector, and as many
    candidates as rows. Vectors of other lengths than the query's are no candidates. See ``quantised`` for rows that
    take no part. Scores of 2 ** 63 and more are not defined. Without queries there are no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors), "topk-vectors")
    n = rows.count()
    sample = pivot_sample(rows, n)
    table: dict[int, tuple] = {}
    for dim in {len(r.v) for r in sample}:
        own = [r for r in sample if len(r.v) == dim]
        v = np.array([r.v for r in own], np.int64)
        chosen = choose_pivots(v, pivots)
        table[dim] = (np.array([own[i].vec_id for i in chosen], np.int64), v[chosen])
    # a lane has a block or two; queries are copied to each lane, and no join may broadcast these copies, as it takes them for small
    lanes = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * -(-n // BLOCK) + rows.rdd.getNumPartitions()))
    candidates = blocks(rows, table, BLOCK, k).withColumn("lane", F.pmod(F.monotonically_increasing_id() % 1009 + F.spark_partition_id(), F.lit(lanes)))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = blocks(asked, table, QUERY_BLOCK, k).select("dim", F.col("body").alias("queries"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[int, int] = {}  # k-th score of a query in an earlier block
        for batch in batches:
            for dim, body, queries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                ids, v, dv, _ = unpack(body.as_py())
                v, dv = v.reshape(-1, dim), np.ascontiguousarray(dv.reshape(len(ids), -1).T)
                norms = (v.astype(float) ** 2).sum(1)
                q_ids, q, dq, kth = unpack(queries.as_py())
                q, dq = q.reshape(-1, dim), dq.reshape(len(q_ids), -1)
                kind = float if _most(v) * _most(q) * dim < 2**53 else np.int64
                v, q = v.astype(kind), q.astype(kind)
                found = []
                for i, *x, least in zip(q_ids.tolist(), q, dq, kth.tolist()):
                    found.append(best_in_block(i, *x, max(least, reached.get(i, least)), ids, v, dv, norms, k))
                    if len(found[-1][1]) == k:
                        reached[i] = max(int(found[-1][1][-1]), reached.get(i, least))
                yield pa.record_batch(
                    [pa.array(np.repeat(q_ids, [len(i) for i, _ in found])), pa.array(np.concatenate([i for i, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
                    names=["query_id", "vec_id", "score"],
                )

    met = candidates.join(asked.hint("merge"), ["dim", "lane"]).select("dim", "body", "queries").mapInArrow(run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
