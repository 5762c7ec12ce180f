"""Language-model scoring with a Katz backoff bigram model.

P(w | h) is the Good-Turing discounted share of w among the words after h where (h, w) is in the training text,
else alpha(h) times the discounted unigram share of w, else (w unknown) the unigram mass that discounting
left over, which stands for one unknown word. alpha(h) makes the sum over all words and the unknown word
exactly 1. Counts of 1 to 5 are discounted; higher ones are kept. The history of a first word is a start
mark, and each document ends with an end token.

No task and no executor holds the model. Tables are partitioned by hashes, as packed sorted arrays:

* chunks: some million tokens of whole documents, as places in the chunk's own sorted list of words;
* unigrams: each chunk asks for the training counts of its distinct words, which are summed by word;
* bigrams: each chunk asks for its distinct pairs, dealt out by history (pairs of very common histories by
  their second word), which are summed by pair and by history.

The answers have the order of the questions, so that they need no keys. Each chunk then scores its tokens.
Repeated text costs one question per chunk. What is gathered grows with the distinct pairs of chunks.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels
from .scratch import materialize, new_path

CHUNK_TOKENS = 1_000_000
#: Tokens of the corpus for each part of the tables, and the most parts: beyond these a chunk's questions to a part would be
#: a few pairs each, and parts grow with the corpus.
PART_TOKENS = 1_200_000
MOST_PARTS = 1200
MAX_DISCOUNTED = 5
#: A word with more than 1 / (HOT_PARTS * partitions) of all tokens is common enough to be dealt out by its followers.
HOT_PARTS = 4
CANDIDATES = 64

END, START = (np.uint64(x) for x in (0xE5D0F17E0E0D0C0B, 0x57A1271234567891))
_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
STATS = -1


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same non-negative integers in the least width."""
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes: of each one all first bytes, then all second bytes and so on, compressed."""
    out = [struct.pack("<B", len(arrays))]
    for x in arrays:
        body = _PACKER.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes())
        out += [struct.pack("<cBQQ", x.dtype.kind.encode(), x.dtype.itemsize, len(x), len(body)), body]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 1
    for _ in range(data[0]):
        kind, width, n, size = struct.unpack_from("<cBQQ", data, at)
        at += struct.calcsize("<cBQQ")
        raw = np.frombuffer(_UNPACKER.decompress(data[at : at + size], max_output_size=max(1, n * width)) if n else b"", np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(width, n).T).view(f"<{kind.decode()}{width}").ravel())
        at += size
    return out


def _deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


def _deal(x: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash; ascending hashes have ascending parts."""
    return ((x >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


class Chunk:
    """Whole documents as places in a sorted list of distinct words (with END and START)."""

    def __init__(self, arrays: list[np.ndarray]):
        deltas, self.stream, self.sizes, self.doc_id, self.missing, self.held, self.train = arrays
        self.words = np.cumsum(deltas, dtype=np.uint64)
        self.stream = self.stream.astype(np.int32)
        self.sizes = self.sizes.astype(np.int64)

    @staticmethod
    def build(hashes: np.ndarray, sizes: np.ndarray, doc_id: np.ndarray, missing: np.ndarray, held: np.ndarray) -> bytes:
        words, stream = np.unique(np.concatenate([hashes, np.array([END, START])]), return_inverse=True)
        stream = stream[:-2]
        live = np.repeat(~held, sizes)
        train = np.bincount(stream[live], minlength=len(words))
        train[np.searchsorted(words, END)] += int((~held).sum())
        return pack([_deltas(words), _narrow(stream), _narrow(sizes), doc_id, missing.astype(np.uint8), held.astype(np.uint8), _narrow(train)])

    def tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the history, place of the word and document of each token, END included."""
        end, start = np.searchsorted(self.words, np.array([END, START]))
        full = self.sizes + 1
        close = np.cumsum(full) - 1
        word = np.full(int(full.sum()), end, np.int32)
        inner = np.ones(len(word), bool)
        inner[close] = False
        word[inner] = self.stream
        history = np.empty_like(word)
        history[1:] = word[:-1]
        history[np.concatenate([[0], close[:-1] + 1])[: len(full)]] = start
        return history, word, np.repeat(np.arange(len(full), dtype=np.int32), full)

    def pairs(self, parts: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct pairs in the order of (part, word, history): part, history, word, training count; and the pair of each token."""
        history, word, doc = self.tokens()
        code = word.astype(np.int64) << 32 | history
        distinct, which = np.unique(code, return_inverse=True)
        count = np.bincount(which[self.held[doc] == 0], minlength=len(distinct))
        h, w = distinct & 0xFFFFFFFF, distinct >> 32
        part = _deal(kernels.mix(self.words[h] ^ np.uint64(0xA5A5)), parts)
        common = np.isin(self.words[h], hot)
        part[common] = _deal(kernels.mix(self.words[w[common]] ^ np.uint64(0x5A5A)), parts)
        order = np.argsort(part, kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return part[order], h[order], w[order], count[order], back[which]


def _slices(part: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    bounds = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(bounds)):
        yield int(p), int(bounds[p]), int(bounds[p + 1])


def chunks(docs: DataFrame, size: int = CHUNK_TOKENS) -> DataFrame:
    """chunk, its tokens and its packed documents. ``docs``: doc_id, text, held_out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        tokens, number = 0, TaskContext.get().partitionId() << 24

        def close() -> pa.RecordBatch:
            body = Chunk.build(*(np.concatenate(x) for x in zip(*held)))
            kernels.release()
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([tokens], pa.int64()), pa.array([body], pa.binary())], names=["chunk", "tokens", "body"])

        for batch in batches:
            ids = batch.column(0)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, hashes, counts in kernels.word_hashes(batch.column(1)):
                held.append((hashes, counts, ids[lo:hi], missing[lo:hi], out[lo:hi]))
                tokens += len(hashes) + hi - lo
                if tokens >= size:
                    yield close()
                    held.clear()
                    tokens, number = 0, number + 1
        if held:
            yield close()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out").mapInArrow(run, "chunk long, tokens long, body binary")


def _rows(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.binary() if n == "body" else pa.int64()) for n, c in zip(names, columns)})


ANSWER = "chunk long, part long, body binary"


def unigram_counts(packed: DataFrame, parts: int) -> DataFrame:
    """Answers to each chunk by part: training counts of its words. Rows of chunk STATS: counts of counts and common words of the part."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column("body")):
                c = Chunk(unpack(body.as_py()))
                rows = [(number, p, pack([_deltas(c.words[lo:hi]), c.train[lo:hi]])) for p, lo, hi in _slices(_deal(c.words, parts), parts)]
                yield _rows(rows, ["chunk", "part", "body"]).combine_chunks().to_batches()[0]

    def add(table: pa.Table) -> pa.Table:
        asked = [unpack(b.as_py()) for b in table.column("body")]
        words = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in asked])
        distinct, which = np.unique(words, return_inverse=True)
        total = np.bincount(which, np.concatenate([n for _, n in asked]).astype(float), len(distinct)).astype(np.int64)
        part = table.column("part")[0].as_py()
        seen = total > 0
        top = np.argsort(-total)[:CANDIDATES]
        small = np.bincount(total[seen & (total <= MAX_DISCOUNTED + 1)], minlength=MAX_DISCOUNTED + 2)
        rows = [(STATS, part, pack([np.array([total.sum(), seen.sum(), *small], np.int64), distinct[top], total[top]]))]
        at = 0
        for number, (d, _) in zip(table.column("chunk").to_pylist(), asked):
            rows.append((number, part, pack([_narrow(total[which[at : at + len(d)]])])))
            at += len(d)
        return _rows(rows, ["chunk", "part", "body"])

    return packed.mapInArrow(ask, ANSWER).groupBy("part").applyInArrow(add, ANSWER)


def discounts(n: np.ndarray, total: int) -> np.ndarray:
    """Good-Turing factors of counts 0 to 5 and of higher ones (last); ``n``: number of kinds by count, from 0 to 6.

    Fewer counts are discounted where the numbers give no factor between 0 and 1. Without any kind seen once,
    or if none works, every count gives the same small share away.
    """
    out = np.ones(MAX_DISCOUNTED + 2)
    for k in range(MAX_DISCOUNTED, 0, -1):
        if (n[1 : k + 2] > 0).all():
            r = np.arange(1, k + 1)
            common = (k + 1) * n[k + 1] / n[1]
            if common < 1:
                d = ((r + 1) * n[2 : k + 2] / (r * n[1 : k + 1]) - common) / (1 - common)
                if (d > 0).all() and (d < 1).all():
                    out[1 : k + 1] = d
                    return out
    if n[1] and total > n[1]:
        out[1] = 0.5
        return out
    return np.full(MAX_DISCOUNTED + 2, total / (total + 1))


def _kept(count: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return count * factors[np.minimum(count, MAX_DISCOUNTED + 1)]


class Unigrams:
    """Totals, and shares by count: 0 is the one unknown word."""

    def __init__(self, n: np.ndarray):
        self.tokens, self.kinds = int(n[0]), int(n[1])
        self.factors = discounts(n[2:], self.tokens)
        seen = np.arange(1, MAX_DISCOUNTED + 1)
        lost = float((n[3 : 3 + MAX_DISCOUNTED] * seen * (1 - self.factors[1:-1])).sum())
        if self.factors[-1] < 1:
            lost = self.tokens * (1 - float(self.factors[-1]))
        self.unknown = lost / self.tokens if self.tokens else 1.0

    def share(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, _kept(count, self.factors) / max(1, self.tokens), self.unknown)


def _ask_pairs(c: Chunk, number: int, counts: np.ndarray, parts: int, hot: np.ndarray) -> list[tuple]:
    part, h, w, n, _ = c.pairs(parts, hot)
    rows = []
    for p, lo, hi in _slices(part, parts):
        ws, first, per = np.unique(w[lo:hi], return_index=True, return_counts=True)
        hs, which = np.unique(h[lo:hi], return_inverse=True)
        rows.append((number, p, pack([_deltas(c.words[ws]), _narrow(per), _narrow(counts[ws]), _deltas(c.words[hs]), _narrow(which), _narrow(n[lo:hi])])))
    return rows


def bigram_counts(packed: DataFrame, unigram_answers: DataFrame, uni: Unigrams, parts: int, hot: np.ndarray) -> DataFrame:
    """Answers to each chunk by part: training counts of its pairs; of its histories there the count, the kinds seen 1 to 5 times and the unigram share of the words seen after them.

    Rows of chunk STATS: counts of counts, and the sums of common histories, which stand in all parts.
    """

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for number, body in zip(left.column("chunk").to_pylist(), left.column("body")):
            c = Chunk(unpack(body.as_py()))
            rows += _ask_pairs(c, number, _answered(right), parts, hot)
        kernels.release()
        return _rows(rows, ["chunk", "part", "body"])

    def add(table: pa.Table) -> pa.Table:
        asked = [unpack(b.as_py()) for b in table.column("body")]
        word = np.concatenate([np.repeat(np.cumsum(d, dtype=np.uint64), per) for d, per, *_ in asked])
        share = np.concatenate([np.repeat(uni.share(n.astype(np.int64)), per) for _, per, n, *_ in asked])
        lists = [np.cumsum(d, dtype=np.uint64) for _, _, _, d, _, _ in asked]
        history = np.concatenate([hs[which] for hs, (_, _, _, _, which, _) in zip(lists, asked)])
        count = np.concatenate([n for *_, n in asked]).astype(np.int64)
        pair, first, which = np.unique(kernels.mix(history) + word * np.uint64(0x9E3779B97F4A7C15), return_index=True, return_inverse=True)
        total = np.bincount(which, count, len(pair)).astype(np.int64)
        seen = total > 0
        owners, owner = np.unique(history[first][seen], return_inverse=True)
        c, s = total[seen], share[first][seen]
        sums = [np.bincount(owner, c, len(owners)).astype(np.int64)]
        sums += [np.bincount(owner[c == r], minlength=len(owners)) for r in range(1, MAX_DISCOUNTED + 1)]
        sums += [np.bincount(owner, s, len(owners))]
        small = np.bincount(c[c <= MAX_DISCOUNTED + 1], minlength=MAX_DISCOUNTED + 2)
        common = np.isin(owners, hot)
        part = table.column("part")[0].as_py()
        rows = [(STATS, part, pack([np.array([c.sum(), len(c), *small], np.int64), owners[common], *(x[common] for x in sums)]))]
        at = 0
        for number, hs, (*_, spot, n) in zip(table.column("chunk").to_pylist(), lists, asked):
            place = np.minimum(np.searchsorted(owners, hs), max(0, len(owners) - 1))
            known = owners[place] == hs if len(owners) else np.zeros(len(hs), bool)
            own = [np.where(known, x[place], 0) if len(owners) else np.zeros(len(hs), x.dtype) for x in sums]
            counts = total[which[at : at + len(n)]]
            # the share is for backing off, which only histories of unseen pairs do
            needed = np.zeros(len(hs), bool)
            needed[spot[counts == 0]] = True
            rows.append((number, part, pack([_narrow(counts), *(_narrow(x) for x in own[:-1]), np.where(needed, own[-1], 0)])))
            at += len(n)
        kernels.release()
        return _rows(rows, ["chunk", "part", "body"])

    asked = packed.groupBy("chunk").cogroup(unigram_answers.where(F.col("chunk") != STATS).groupBy("chunk")).applyInArrow(ask, ANSWER)
    return asked.groupBy("part").applyInArrow(add, ANSWER)


def _answered(table: pa.Table) -> np.ndarray:
    """Training counts of a chunk's words, from the answers of all parts."""
    by_part = sorted(zip(table.column("part").to_pylist(), table.column("body").to_pylist()))
    return np.concatenate([unpack(b)[0].astype(np.int64) for _, b in by_part])


class Bigrams:
    """Factors by count, and the sums of common histories."""

    def __init__(self, n: np.ndarray, hot: np.ndarray, hot_sums: np.ndarray):
        self.factors, self.hot, self.hot_sums = discounts(n[2:], int(n[0])), hot, hot_sums

    def history(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, factor on the shares of words seen, and backoff weight of histories. ``sums``: by row count, kinds by count, share seen."""
        count, share = sums[0], np.minimum(sums[-1], 1.0)
        r = np.arange(1, MAX_DISCOUNTED + 1)[:, None]
        lost = (sums[1:-1] * r * (1 - self.factors[1:-1])[:, None]).sum(0)
        if self.factors[-1] < 1:
            lost = count * (1 - self.factors[-1])
        left = lost / np.maximum(count, 1)
        # a history with high counts alone would leave nothing: it gives away as much as one more count
        scale = np.where(left > 0, 1.0, count / (count + 1.0))
        left = np.where(left > 0, left, 1 / (count + 1.0))
        return count, scale, np.where(count > 0, left / (1 - share), 1.0)


def score_chunk(c: Chunk, unigram: np.ndarray, answers: list[tuple[int, bytes]], uni: Unigrams, bi: Bigrams, parts: int) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base_score and score of each document of a chunk."""
    part, h, w, _, which = c.pairs(parts, bi.hot)
    total = np.zeros(len(h), np.int64)
    sums = np.zeros((MAX_DISCOUNTED + 2, len(c.words)))
    by_part = dict(answers)
    for p, lo, hi in _slices(part, parts):
        n, *own = unpack(by_part[p])
        total[lo:hi] = n
        hs = np.unique(h[lo:hi])
        sums[:, hs] = own
    if len(bi.hot):
        place = np.searchsorted(c.words, bi.hot)
        there = np.flatnonzero(c.words[np.minimum(place, len(c.words) - 1)] == bi.hot)
        sums[:, place[there]] = bi.hot_sums[:, there]
    count, scale, alpha = bi.history(sums)
    seen = total > 0
    lower = uni.share(unigram[w])
    with np.errstate(divide="ignore", invalid="ignore"):
        upper = _kept(total, bi.factors) / count[h] * scale[h]
    pair_score = np.log10(np.where(seen, upper, alpha[h] * lower))
    history, word, doc = c.tokens()
    base = np.log10((unigram[word] + 1) / (uni.tokens + uni.kinds + 1))
    n = len(c.sizes)
    return c.sizes + 1, np.bincount(doc[unigram[word] > 0], minlength=n), np.bincount(doc, base, n), np.bincount(doc, pair_score[which], n)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out. Null and empty texts consist of the end token; a null
    held_out counts as false; repeated rows count as often as they come. With no training row every word is
    unknown and has probability 1. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    name = f"storyloom_chunks_{uuid.uuid4().hex}"
    # each chunk is one row, so that a bucketed table of them needs no shuffle and the joins below leave them in place;
    # with more buckets, fewer of them hold many chunks
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks(docs).write.format("parquet").bucketBy(buckets, "chunk").option("path", new_path(spark, "katz-chunks")).saveAsTable(name)
    packed = spark.table(name)
    # many more parts than tasks: each is built by itself and is small, and a task's share of them is even
    tokens = packed.agg(F.sum("tokens")).first()[0] or 0
    parts = max(8, min(MOST_PARTS, tokens // PART_TOKENS))

    answers = materialize(unigram_counts(packed, parts), "katz-unigrams")
    stats = [unpack(r.body) for r in answers.where(F.col("chunk") == STATS).select("body").collect()]  # a row per part
    uni = Unigrams(sum((s[0] for s in stats), np.zeros(MAX_DISCOUNTED + 4, np.int64)))
    hot = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s[1][s[2] * HOT_PARTS * parts > max(1, uni.tokens)] for s in stats), np.array([START])]))

    pairs = materialize(bigram_counts(packed, answers, uni, parts, hot), "katz-bigrams")
    stats = [unpack(r.body) for r in pairs.where(F.col("chunk") == STATS).select("body").collect()]  # a row per part
    hot_sums = np.zeros((MAX_DISCOUNTED + 2, len(hot)))
    for _, owners, *sums in stats:
        hot_sums[:, np.searchsorted(hot, owners)] += sums
    bi = Bigrams(sum((s[0] for s in stats), np.zeros(MAX_DISCOUNTED + 4, np.int64)), hot, hot_sums)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for body in left.column("body"):
            c = Chunk(unpack(body.as_py()))
            kind = np.array(right.column("kind").to_pylist())
            unigram = _answered(right.filter(pa.array(kind == 1)))
            rest = right.filter(pa.array(kind == 2))
            n_tokens, n_known, base, score = score_chunk(c, unigram, list(zip(rest.column("part").to_pylist(), rest.column("body").to_pylist())), uni, bi, parts)
            n = len(n_tokens)
            out.append(pa.table([
                pa.array(c.doc_id, mask=c.missing.astype(bool)), pa.array(c.held.astype(bool)), pa.array(n_tokens), pa.array(n_known.astype(np.int64)),
                pa.array(np.full(n, uni.tokens)), pa.array(base), pa.array(score),
            ], names=[x.split()[0] for x in RESULT.split(", ")]))
        kernels.release()
        return pa.concat_tables(out)

    both = answers.withColumn("kind", F.lit(1)).unionByName(pairs.withColumn("kind", F.lit(2))).where(F.col("chunk") != STATS)
    return packed.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return score_documents(docs.select("doc_id", "text", held_out.alias("held_out")))
