"""A stored inverted index: postings by term, ranked search by bounds of document ranges, changed documents written alone.

An index is a folder of segments, each written once: ``docs`` (id, length and digest of the documents of a change),
``postings`` (a row per term and range of RANGE ids, with its documents' places in the range, tf and lengths, the largest tf
and the least length, in a folder per bucket of terms, sorted by term; a range that two tasks or batches share has two rows)
and ``gone`` (ids of older segments that no longer count). The file ``current`` lists the segments; it is renamed into place
at the end of a change.

The weight of a term grows with tf and falls with the length, so that a row's largest tf and least length bound the
weight of all its documents whatever the mean length is by then. The sum of a query's bounds over a range of ids bounds
every score in that range. The ranges with the highest sums are scored first; then all whose sum reaches the k-th score.

Texts are dealt out by ranges, so that their terms are counted in the task that has them, and rows of terms are dealt out by
ranges to be scored: no single term or score is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.shared import Files, spread, written
from ..functions.text import bigrams
from .search import BLOCK_SCORES, BROADCAST_ROWS, K1, SLACK, B, asked_terms, kept, top_k

BUCKETS, RANGE, FIRST_RANGES = 64, 512, 4
ROW = "term string, range bigint, at array<int>, tfs array<int>, lens array<int>, most int, least int"
COLUMNS = ["term", "range", "at", "tfs", "lens", "most", "least"]
ARROW_ROW = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int32()]


def segments(spark: SparkSession, root: str) -> list[str]:
    files = Files(spark, root)
    return json.loads(files.read(f"{root}/current"))["segments"] if files.exists(f"{root}/current") else []


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _range(id_):
    return F.expr(f"{id_} div {RANGE}L - if({id_} % {RANGE}L < 0, 1L, 0L)")


def _numbered(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """A table of all segments with seg, the place of each row's segment."""
    parts = [spark.read.schema(schema).parquet(f"{root}/{s}/{table}").withColumn("seg", F.lit(k)) for k, s in enumerate(segments(spark, root))]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"{schema}, seg int")


def _gone(spark: SparkSession, root: str) -> DataFrame:
    """id and the last segment that took it away from those before."""
    return _numbered(spark, root, "gone", "id bigint").groupBy("id").agg(F.max("seg").alias("last"))


def documents(spark: SparkSession, root: str) -> DataFrame:
    """id, len and digest of the documents that count."""
    docs = _numbered(spark, root, "docs", "id bigint, len int, digest string").join(_gone(spark, root), "id", "left")
    return docs.where(F.coalesce("last", F.lit(-1)) <= F.col("seg")).select("id", "len", "digest")


def update(spark: SparkSession, root: str, docs: DataFrame, id_: str = "doc_id", text: str = "text", terms_of=bigrams, complete: bool = True) -> int:
    """Makes the index that of ``docs`` (each id once) and returns how many documents were written: those that are new or have another text.

    With ``complete`` documents that ``docs`` lacks are taken away, else they stay. Nothing is written if nothing
    changed. A run that fails before its end leaves the index as it was. Ids are whole numbers, not null; a null text has no terms, and its length does not count.
    """
    files, known = Files(spark, root), documents(spark, root)
    now = docs.where(F.col(id_).isNotNull()).select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
    fresh = now.withColumn("range", _range("id"))
    if segments(spark, root):
        # a range's known digests are one row, so that a text goes no further than to its range
        held = known.groupBy(_range("id").alias("range")).agg(F.collect_list(F.struct("id", "digest")).alias("held"))
        fresh = fresh.join(held, "range", "left").where(F.col("held").isNull() | ~F.array_contains("held", F.struct("id", "digest"))).drop("held")
    name = f"s{len(files.names(root)):06d}"
    while files.exists(f"{root}/{name}"):  # what a change that failed has left
        name = f"s{int(name[1:]) + 1:06d}"
    dealt = spread(fresh, "range").sortWithinPartitions("range", "id").select("id", "range", "digest", terms_of(F.col("text")).alias("terms"))
    counted = written(dealt.mapInArrow(_counter(RANGE), f"{ROW}, digests array<string>"), "counted")
    each = counted.where(F.col("digests").isNotNull()).select("range", F.inline(F.arrays_zip("at", "lens", "digests")))
    each.select((F.col("range") * RANGE + F.col("at")).alias("id"), F.col("lens").alias("len"), F.col("digests").alias("digest")).write.parquet(f"{root}/{name}/docs")
    new = spark.read.schema("id bigint, len int, digest string").parquet(f"{root}/{name}/docs")
    gone = known.select("id").join(new, "id", "left_semi")
    if complete:
        gone = gone.unionByName(known.select("id").join(now.select("id"), "id", "left_anti"))
    gone.write.parquet(f"{root}/{name}/gone")
    count = new.count()
    if not count and spark.read.schema("id bigint").parquet(f"{root}/{name}/gone").isEmpty():
        files.delete(f"{root}/{name}")
        return 0
    _write_postings(counted.where(F.col("digests").isNull()).select(*COLUMNS), f"{root}/{name}/postings")
    files.write(f"{root}/current", json.dumps({"segments": [*segments(spark, root), name]}))
    return count


def _write_postings(rows: DataFrame, folder: str) -> None:
    spread(rows.withColumn("bucket", _bucket("term")), "bucket").sortWithinPartitions("bucket", "term", "range").write.partitionBy("bucket").parquet(folder)


def _counter(size: int):
    """From documents (id, range, digest, terms) in order of ranges: a row per term and range, and one per range with its lengths and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ids, ranges = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = b.column(3)
            sizes = pc.list_value_length(lists)
            lens = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = (ids - ranges * size).astype(np.int32)
            first = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
            told = pc.dictionary_encode(lists.flatten())
            there = pc.is_valid(told.indices).to_numpy(zero_copy_only=False)
            term = pc.fill_null(told.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)[there]
            doc = np.repeat(np.arange(n), lens)[there]
            kinds = max(1, len(told.dictionary))
            found, tf = np.unique((of[doc] * kinds + term) * n + doc, return_counts=True)
            key, doc = np.divmod(found, n)
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))[: len(key)]
            if len(key):
                where, which = np.divmod(key[begin], kinds)
                cut = lambda x: pa.ListArray.from_arrays(pa.array(np.append(begin, len(key)), pa.int32()), pa.array(x, pa.int32()))
                columns = [told.dictionary.take(pa.array(which)), pa.array(ranges[first][where]), cut(at[doc]), cut(tf), cut(lens[doc])]
                columns += [pa.array(f.reduceat(x, begin), pa.int32()) for f, x in ((np.maximum, tf), (np.minimum, lens[doc]))]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(begin), pa.list_(pa.string()))], [*COLUMNS, "digests"])
            ends = pa.array(np.append(first, n), pa.int32())
            none = lambda k: pa.nulls(len(first), ARROW_ROW[k])
            columns = [none(0), pa.array(ranges[first]), pa.ListArray.from_arrays(ends, pa.array(at)), none(3), pa.ListArray.from_arrays(ends, sizes.cast(pa.int32())), none(5), none(6)]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, b.column(2).cast(pa.string()))], [*COLUMNS, "digests"])

    return run


def merge(spark: SparkSession, root: str) -> None:
    """Writes the segments as one, without what is gone, and deletes the old ones; searches that are under way must have ended."""
    old, files = segments(spark, root), Files(spark, root)
    if len(old) < 2:
        return
    name = f"s{int(old[-1][1:]) + 1:06d}"
    while files.exists(f"{root}/{name}"):
        name = f"s{int(name[1:]) + 1:06d}"
    documents(spark, root).write.parquet(f"{root}/{name}/docs")
    spark.createDataFrame([], "id bigint").write.parquet(f"{root}/{name}/gone")
    each = _postings(spark, root).select("term", "range", F.inline(F.arrays_zip("at", "tfs", "lens")))
    rows = each.groupBy("term", "range").agg(F.array_sort(F.collect_list(F.struct("at", "tfs", "lens"))).alias("e"), F.max("tfs").alias("most"), F.min("lens").alias("least"))
    _write_postings(rows.select("term", "range", "e.at", "e.tfs", "e.lens", "most", "least"), f"{root}/{name}/postings")
    files.write(f"{root}/current", json.dumps({"segments": [name]}))
    for s in old:
        files.delete(f"{root}/{s}")


def _postings(spark: SparkSession, root: str, buckets: list[int] | None = None, terms: DataFrame | None = None) -> DataFrame:
    """Rows of the documents that count, from the given buckets' folders and of the given terms (a frame) alone."""
    rows = _numbered(spark, root, "postings", f"{ROW}, bucket int")
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    if terms is not None:
        rows = rows.join(terms, "term", "left_semi")
    if len(segments(spark, root)) < 2:
        return rows.select(*COLUMNS)
    # what is gone goes to the rows of its range, ahead of them
    dead = _gone(spark, root).groupBy(_range("id").alias("range"), F.col("last").alias("seg")).agg(F.collect_list((F.col("id") - _range("id") * RANGE).cast("int")).alias("at"))
    both = rows.select(*COLUMNS, "seg").unionByName(dead, allowMissingColumns=True)
    return spread(both, "range").sortWithinPartitions("range", F.col("term").asc_nulls_first()).mapInArrow(_living(RANGE), ROW)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches in order of their column range, cut where it changes."""
    for b in batches:
        ranges = b.column("range").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                yield int(ranges[i]), b.slice(i, j - i)


def _flat(part: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    """The rows' numbers of entries, then all entries of each list."""
    sizes = pc.fill_null(pc.list_value_length(part.column(names[0])), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return [sizes, *(part.column(n).flatten().to_numpy(zero_copy_only=False) for n in names)]


def _living(size: int):
    """Rows without the entries that later segments took away; a row without a term tells which, ahead of its range's others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last = None, None
        for where, part in _parts(batches):
            if where != here:
                here, last = where, np.full(size, -1)
            told = pc.is_null(part.column("term")).to_numpy(zero_copy_only=False)
            segs = part.column("seg").to_numpy(zero_copy_only=False)
            if told.any():
                mark = part.filter(pa.array(told))
                sizes, at = _flat(mark, "at")
                last[at] = np.repeat(segs[told], sizes)
                part, segs = part.filter(pa.array(~told)), segs[~told]
            sizes, at, tfs, lens = _flat(part, "at", "tfs", "lens")
            row = np.repeat(np.arange(len(sizes)), sizes)
            stay = last[at] <= segs[row]
            left = np.bincount(row[stay], minlength=len(sizes))
            some = pa.array(left > 0)
            ends = pa.array(np.append(0, np.cumsum(left[left > 0])), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[stay], pa.int32())) for x in (at, tfs, lens)]
            columns = [part.column(c).filter(some) for c in ("term", "range", "most", "least")]
            yield pa.RecordBatch.from_arrays([*columns[:2], *lists, *columns[2:]], COLUMNS)

    return run


def _weight(tf, length):
    return F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.col("mean")))


def _found(spark: SparkSession, root: str, queries: DataFrame, terms_of) -> tuple[DataFrame, DataFrame, bool]:
    """The queries' terms' rows, the terms with their queries and idf, and whether these are few enough to go to every task."""
    wanted = queries.select("query_id", F.explode(F.array_distinct(terms_of(F.col("query")))).alias("term"))
    buckets = sorted(r[0] for r in wanted.select(_bucket("term")).distinct().collect())  # at most BUCKETS numbers
    few = wanted.count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda df: df)
    postings = written(_postings(spark, root, buckets, small(wanted.select("term").distinct())), "postings")
    stats = documents(spark, root).agg(F.count("*").alias("n"), F.avg("len").alias("mean"))
    df = postings.groupBy("term").agg(F.sum(F.size("at")).alias("df"))
    idf = df.crossJoin(F.broadcast(stats)).select("term", "mean", F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf"))
    asked = written(idf.join(wanted, "term").select("query_id", "term", "idf", "mean"), "asked")
    return postings, small(asked), few


def _ranges(postings: DataFrame, asked: DataFrame, few: bool, k: int) -> DataFrame:
    """query_id, range and bound of the ranges that can hold one of the k best documents of a query."""
    bounds = postings.select("term", "range", "most", "least").join(asked, "term").groupBy("query_id", "range").agg(F.sum(_weight(F.col("most"), F.col("least"))).alias("bound"))
    bounds = written(bounds, "bounds")
    first = top_k(bounds, "query_id", [F.desc("bound"), F.col("range")], FIRST_RANGES).select("query_id", "range")
    if few:  # a few ranges for each of the queries
        first = F.broadcast(written(first, "first"))
        postings = postings.join(first.select("range").distinct(), "range", "left_semi")
    # the k-th score among the first ranges is no higher than among all
    best = top_k(_scored(first, postings, asked, few, k), "query_id", [F.desc("score"), F.col("id")], k)
    least = best.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).otherwise(0.0).alias("least"))
    return bounds.join(least, "query_id").where(F.col("bound") >= F.col("least") - 1e-5).select("query_id", "range", "bound")


def candidates(spark: SparkSession, root: str, queries: DataFrame, k: int = 10, terms_of=bigrams) -> tuple[DataFrame, DataFrame]:
    """Ranges that can hold one of the k best documents of a query (query_id, range, bound), and a frame with the terms' rows of each query."""
    postings, asked, few = _found(spark, root, queries, terms_of)
    return _ranges(postings, asked, few, k), postings.join(asked, "term")


def _scored(ranges: DataFrame, postings: DataFrame, asked: DataFrame, few: bool, k: int) -> DataFrame:
    """query_id, id and score of the documents in each query's ranges; with few terms, of those that are among the k best in their task."""
    if not few:
        met = postings.join(asked, "term").join(ranges.select("query_id", "range"), ["query_id", "range"])
        each = met.select("query_id", "range", "idf", "mean", F.inline(F.arrays_zip("at", "tfs", "lens")))
        return each.groupBy("query_id", (F.col("range") * RANGE + F.col("at")).alias("id")).agg(F.round(F.sum(_weight(F.col("tfs"), F.col("lens"))), 6).alias("score"))
    ids, terms, starts, queries, idf, mean = asked_terms(asked)
    shared = asked.sparkSession.sparkContext.broadcast((ids, terms, starts, queries, idf, mean))
    schema = asked.select("query_id").schema.add("id", "long").add("score", "double")
    size, block = RANGE, max(1, BLOCK_SCORES // RANGE)
    # a range's queries go to its rows, ahead of them
    told = ranges.groupBy("range").agg(F.collect_set("query_id").alias("queries"))
    both = postings.select("term", "range", "at", "tfs", "lens").unionByName(told, allowMissingColumns=True)
    dealt = spread(both, "range").sortWithinPartitions("range", F.col("term").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, starts, queries, idf, mean = shared.value
        place_of = {q: i for i, q in enumerate(ids)}
        vocabulary = pa.array(terms, pa.string())
        by_query = np.argsort(queries, kind="stable")
        query_of, term_of = queries[by_query], np.repeat(np.arange(len(terms)), np.diff(starts))[by_query]
        best, here, held, open_ = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), None, [], []

        def scored():
            """The best of the range at hand are added to those of the task."""
            nonlocal best
            if not (held and open_):
                return
            term, at, tf, length = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(term, kind="stable")
            term, at = term[order], at[order]
            weight = (idf[term] * tf[order] * (K1 + 1)) / (tf[order] + K1 * (1 - B + B * length[order] / mean))
            begin = np.searchsorted(term, np.arange(len(terms) + 1))
            wanted = np.unique(np.array(open_, np.int64))
            for some in (wanted[i : i + block] for i in range(0, len(wanted), block)):
                lo, hi = np.searchsorted(query_of, some), np.searchsorted(query_of, some, "right")
                row = np.repeat(np.arange(len(some)), hi - lo)
                pair = np.arange((hi - lo).sum()) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
                start = begin[term_of[pair]]
                times = begin[term_of[pair] + 1] - start
                entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start, times)
                score = np.bincount(np.repeat(row, times) * size + at[entry], weight[entry], len(some) * size).reshape(len(some), size)
                hit = score > 0  # an idf is above 0
                if size > k:
                    hit &= score >= np.partition(score, -k, axis=1)[:, -k, None] - SLACK
                q, d = np.nonzero(hit)
                best = kept(best, some[q], here * size + d, score[q, d], k)

        for where, part in _parts(batches):
            if where != here:
                scored()
                here, held, open_ = where, [], []
            asking = part.column("queries")
            if asking.null_count < len(asking):
                open_ += [place_of[q] for q in asking.flatten().to_pylist()]
                part = part.filter(pc.is_null(asking))
            if open_ and part.num_rows:
                sizes, at, tfs, lens = _flat(part, "at", "tfs", "lens")
                term = pc.index_in(part.column("term").cast(pa.string()), value_set=vocabulary).to_numpy(zero_copy_only=False)
                held.append((np.repeat(term.astype(np.int64), sizes), at.astype(np.int64), tfs, lens))
        scored()
        if len(best[0]):
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in best[0]], to_arrow_type(schema["query_id"].dataType)), pa.array(best[1]), pa.array(best[2])], ["query_id", "id", "score"])

    return dealt.mapInArrow(run, schema).withColumn("score", F.round("score", 6))


def search(spark: SparkSession, root: str, queries: DataFrame, k: int = 10, terms_of=bigrams) -> DataFrame:
    """query_id, id, score and rank of the k best documents of each query (query_id, query): what ``search.bm25`` gives for the indexed documents.

    Only the folders of the queries' terms are read, and only ranges that can hold one of the best are scored.
    """
    postings, asked, few = _found(spark, root, queries, terms_of)
    return top_k(_scored(_ranges(postings, asked, few, k), postings, asked, few, k), "query_id", [F.desc("score"), F.col("id")], k)
