"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are hashed n-grams of code points with A-Z lower-cased. For all labelled training rows
Spark counts in how many documents of either class each feature is. These counts give a log-count ratio
per feature, and the features whose counts depend on the class (likelihood-ratio statistic) stay, however many. A
document's value of a feature is the ratio times the logarithm of one more than its occurrences. Logistic regression then weighs each feature, scaled by its ratio.
Only its fit uses a sample: at most about ``max_fit_rows`` labelled rows, by a hash of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels
from .scratch import materialize

ORDERS = (4, 5, 6)
BITS = 18
BLOCKS = 64
LOTS = 512
MAX_FIT_ROWS = 10_000
#: A feature stays if its presence tells something about the class: mutual information of at least 0.0015 nats, which is a
#: likelihood-ratio statistic of 0.003 a labelled row, the same at every number of rows. On fewer than 5,333 rows the
#: statistic must also be above 16, so that it is no chance. Where the strongest feature of a small table has less than twice
#: as much, half of that is asked for.
EVIDENCE = 16.0
INFORMATION = 0.0015
THRESHOLD = 0.7
SMOOTHING = 1.0
RIDGE = 3e-4
STEPS = 400
WINDOW = 1 << 20
FIT_SLICE = 1 << 21

_PAIRS = np.dtype([("f", np.int32), ("v", np.float32)])
_START, _FACTOR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _code_points(data: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes, A-Z lower-cased."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    codes[(codes >= 65) & (codes <= 90)] += np.uint64(32)
    return codes


def _buckets(codes: np.ndarray, before: int = 0) -> Iterator[np.ndarray]:
    """Feature numbers of the n-grams of each order, without those that lie in the first ``before`` code points alone."""
    h = np.full(len(codes), _START)
    for k in range(min(max(ORDERS), len(codes))):
        h = (h[: len(codes) - k] ^ codes[k:]) * _FACTOR
        h ^= h >> np.uint64(29)
        if k + 1 in ORDERS:
            yield (kernels.mix(h[max(0, before - k) :]) >> np.uint64(64 - BITS)).astype(np.int64)


def wanted_features(column: pa.Array, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the features in the mask ``wanted`` that each row has, and the logarithm of one more than their counts."""
    for found in document_features(column, wanted):
        numbers, n = np.unique(found, return_counts=True)
        yield numbers, np.log1p(n)


def document_features(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each row; with ``wanted`` (a mask), each occurrence of those alone."""
    data, offsets = kernels.utf8(column)
    mark = np.empty(1 << BITS, np.int64)
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        found, tail, at = [np.zeros(0, np.int64)], np.zeros(0, np.uint64), lo
        while at < hi:  # long texts go through in windows that begin with the last code points of the one before
            end = min(hi, at + WINDOW)
            while end < hi and data[end] & 0xC0 == 0x80:
                end += 1
            codes = np.concatenate([tail, _code_points(data[at:end])])
            found += [b if wanted is None else b[wanted[b]] for b in _buckets(codes, len(tail))]
            tail, at = codes[-(max(ORDERS) - 1) :], end
        b = np.concatenate(found)
        if wanted is None:
            place = np.arange(len(b))
            mark[b] = place
            b = b[mark[b] == place]
        yield b


@dataclass
class Model:
    """Weights by feature number; zero where a feature was not chosen."""

    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        wanted = self.weights != 0
        z = np.array([self.weights[b] @ n for b, n in wanted_features(column, wanted)]) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Over all rows (text, toxic): documents of each class, and documents with each feature by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for label, b in zip(toxic, document_features(batch.column(0))):
                rows[label] += 1
                counts[label][b] += 1
        if rows.any():
            for block in range(BLOCKS):
                part = counts.reshape(2, BLOCKS, -1)[:, block]
                yield pa.record_batch([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary())], names=["block", "counts", "rows"])

    def add(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("counts"))
        rows = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("rows"))
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([counts.tobytes()], pa.binary()), "rows": pa.array([rows.tobytes()], pa.binary())})

    schema = "block int, counts binary, rows binary"
    parts = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, schema)
    # first by block and lot of tasks, then by block: no task receives more than a share of all tasks' counts
    lots = parts.withColumn("lot", F.spark_partition_id() % LOTS).groupBy("block", "lot").applyInArrow(lambda t: add(t.drop_columns(["lot"])), schema)
    merged = lots.groupBy("block").applyInArrow(add, schema).collect()  # BLOCKS rows
    counts, rows = np.zeros((2, BLOCKS, (1 << BITS) // BLOCKS), np.int64), np.zeros(2, np.int64)
    for row in merged:
        counts[:, row.block] = np.frombuffer(row.counts, np.int64).reshape(2, -1)
        rows = np.frombuffer(row.rows, np.int64)
    return rows, counts.reshape(2, -1)


def log_count_ratios(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of each feature, and the likelihood-ratio statistic of its presence against the class."""
    p = (counts + SMOOTHING) / (rows + 2 * SMOOTHING)[:, None]
    ratio = np.log(p[1] / p[0])
    seen = np.stack([counts, rows[:, None] - counts]).astype(float)  # with and without, by class
    expected = seen.sum(1, keepdims=True) * seen.sum(0, keepdims=True) / max(1, rows.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = 2 * np.where(seen > 0, seen * np.log(seen / expected), 0).sum((0, 1))
    return ratio, evidence


def _fit(rows: list[np.ndarray], labels: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge by accelerated gradient steps; rows: (feature, value) pairs of each document.

    A step goes over the documents in slices of about ``FIT_SLICE`` pairs, so that beside the pairs themselves memory does not
    depend on how many there are.
    """
    upto = np.cumsum([0] + [len(r) for r in rows])
    cuts = np.unique(np.searchsorted(upto, [*range(0, int(upto[-1]), FIT_SLICE), int(upto[-1])])).tolist() if upto[-1] else [0]
    slices = []
    for lo, hi in zip(cuts, cuts[1:]):
        pairs = np.concatenate(rows[lo:hi])
        slices.append((lo, hi, np.diff(upto[lo : hi + 1]), pairs["f"].copy(), pairs["v"].copy()))
        rows[lo:hi] = [None] * (hi - lo)
    norms = sum(float(val @ val) for *_, val in slices)
    rate = 4 / (1 + norms / max(1, len(rows)) * 4)
    w, b, vw, vb = np.zeros(n), 0.0, np.zeros(n), 0.0
    for step in range(STEPS):
        z = np.full(len(rows), vb)
        for lo, hi, sizes, col, val in slices:
            z[lo:hi] += np.bincount(np.repeat(np.arange(hi - lo), sizes), val * vw[col], hi - lo)
        g = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / max(1, len(rows))
        slope = RIDGE * vw
        for lo, hi, sizes, col, val in slices:
            slope += np.bincount(col, val * np.repeat(g[lo:hi], sizes), n)
        nw, nb = vw - rate * slope, vb - rate * g.sum()
        m = step / (step + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, b


def train(labelled: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Model:
    """Fits on rows (doc_id, text, toxic); a label above 0 is toxic, rows with a null label are left out. No row of one class: the score is the share of that class."""
    labelled = labelled.where("toxic IS NOT NULL").select("doc_id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    labelled = materialize(labelled, "toxicity-labelled")  # joined once, read twice
    rows, counts = class_counts(labelled)
    total = int(rows.sum())
    prior = float(np.log((rows[1] + 0.5) / (rows[0] + 0.5)))
    ratio, evidence = log_count_ratios(rows, counts)
    least = min(max(EVIDENCE, 2 * INFORMATION * total), evidence.max(initial=0) / 2)
    chosen = np.flatnonzero(evidence > least)
    weights = np.zeros(1 << BITS)
    if not rows.all() or not len(chosen):
        return Model(weights, prior)
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen] = True
    keep = max_fit_rows / max(1, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.rec.fromarrays([b, n], dtype=_PAIRS).tobytes() for b, n in wanted_features(batch.column(0), wanted)]
            yield pa.record_batch([batch.column(1), pa.array(found, pa.binary())], names=["toxic", "found"])

    # by text too, so that rows that share a doc_id are not taken or left all together
    sample = labelled if keep >= 1 else labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(keep * 1_000_000))
    found = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "toxic int, found binary")
    # at most about max_fit_rows documents, from one partition after the other, so that the driver holds their pairs once
    fitted = [(r.toxic, bytes(r.found)) for r in materialize(found, "toxicity-fit").toLocalIterator()]
    fitted.sort()
    labels = np.array([t for t, _ in fitted], float)
    place = np.zeros(1 << BITS, np.int32)
    place[chosen] = np.arange(len(chosen))
    pairs = []
    for i, (_, body) in enumerate(fitted):
        b = np.frombuffer(body, _PAIRS)
        pairs.append(np.rec.fromarrays([place[b["f"]], (ratio[b["f"]] * b["v"]).astype(np.float32)], dtype=_PAIRS))
        fitted[i] = None
    w, bias = _fit(pairs, labels, len(chosen))
    weights[chosen] = w * ratio[chosen]
    return Model(weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; an empty or null text gets the score of a text without features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(shared.value.score(batch.column(1)))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels of rows that are held out are never read. Labels of unknown documents and null labels have no
    effect, a document with several labels counts once as toxic if one says so. A null doc_id is scored and
    not held out. No labels at all give every document the same score. Rows with equal texts have equal scores, and
    a repeated doc_id has a row for each of its rows. Long texts are read whole, in windows. An empty table gives no
    rows; columns other than doc_id, text and toxic are not read, whatever their names.
    """
    marks = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    training = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text").join(marks.hint("merge"), "doc_id")  # one plan at every size
    model = train(training)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores at least ``threshold``; all columns stay, whatever their names.

    The score is made next to the row, without a join, so that rows with a null or repeated doc_id are judged by their own
    text. Null and empty texts score as texts without features. Without labels of both classes every row has the same
    score. An empty table gives no rows. Learns from labels as ``classify`` does.
    """
    marks = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text").join(marks.hint("merge"), "doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
