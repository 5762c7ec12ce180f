"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased, runs of anything but letters become one space, and a space stands at either end. Each
language has a model of order ``ORDER``: raw counts at the highest order, continuation counts (number of
distinct left neighbours) below, one absolute discount per order, and a uniform distribution over the
alphabet and one unknown character at the base. N-grams are kept as bijective 64-bit hashes of
their packed characters in one sorted array per order, with a row of log-probabilities (one per language).
The language with the lowest cross-entropy per character is chosen. A language's cross-entropies on
training documents that its counts did not use give the bound beyond which a text is marked
as rejected, and the sharpness of the score.

Counts come from a sample of training rows (``max_fit_rows`` a language, by a hash of doc_id), which bounds
the model that executors receive. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels

ORDER = 4
MAX_FIT_ROWS = 2000
INDEX_BITS = 18
#: Of a hundred sampled rows, so many calibrate and are not counted.
CALIBRATION = 20
#: Rows from which a language has some set aside; with fewer, all are counted.
ASIDE_FROM = 250
REJECT_DEVIATIONS = 6.0
SEGMENT = 1 << 18


#: Whether a code point is a letter (no digit, fraction or letter-like numeral).
LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def prepare(text: str | None) -> np.ndarray:
    """Code points of the letters in lower case, words apart by one space; empty if there is no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letter = LETTER[codes]
    if not letter.any():
        return np.zeros(0, np.uint32)
    # of what is no letter, only what comes after a letter stays, as a space
    kept = np.append(letter, False) | np.append(False, letter)
    return np.append(np.uint32(32), np.append(np.where(letter, codes, 32), 32)[kept]).astype(np.uint32)


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` characters up to and with each character from the second on, packed; the text's start is padded by its first space.

    A character beyond U+FFFF is folded to 16 bits, so that a rare one may count as another character.
    """
    units = ((codes ^ (codes >> np.uint32(16))) & np.uint32(0xFFFF)).astype(np.uint64)
    padded = np.concatenate([np.full(order - 1, units[0] if len(units) else 0, np.uint64), units])
    n = len(units)
    out = np.zeros(n, np.uint64)
    for k in range(order):
        out = (out << np.uint64(16)) | padded[k : k + n]
    return out[1:]


def _shorten(packed: np.ndarray, order: int) -> np.ndarray:
    """Without the first character."""
    return packed & np.uint64((1 << (16 * (order - 1))) - 1)


class HashArray:
    """A sorted array of hashes with rows of values; the leading bits of a hash give its neighbourhood."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashed = keys * _ODD
        order = np.argsort(hashed)
        self.hashes, self.values = hashed[order], values[order]
        self.starts = np.searchsorted(self.hashes >> np.uint64(64 - INDEX_BITS), np.arange((1 << INDEX_BITS) + 1, dtype=np.uint64)).astype(np.int64)
        self.longest = int(np.diff(self.starts).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is absent."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.hashes):
            return out
        hashed = keys * _ODD
        lead = (hashed >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        live = np.arange(len(keys))
        for _ in range(self.longest):
            room = at < end
            live, at, end = live[room], at[room], end[room]
            if not len(live):
                break
            hit = self.hashes[at] == hashed[live]
            out[live[hit]] = at[hit]
            live, at, end = live[~hit], at[~hit] + 1, end[~hit]
        return out


@dataclass
class Model:
    languages: list[str]
    probs: list[HashArray]  # by order from 1: log-probabilities of n-grams seen in some language
    backoffs: list[HashArray]  # by length from 1: log weight of the next lower order after a context
    base: np.ndarray  # log-probability of an unknown character by language
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sharpness: float = 1.0

    def log_probs(self, packed: np.ndarray, order: int) -> np.ndarray:
        """ln P(last character | the ones before) for each packed n-gram and language."""
        if not self.languages:
            return np.zeros((len(packed), 0), np.float32)
        if order == 0:
            return np.broadcast_to(self.base, (len(packed), len(self.languages))).astype(np.float32)
        row = self.probs[order - 1].find(packed)
        out = self.probs[order - 1].values[row]
        lost = np.flatnonzero(row < 0)
        if len(lost):
            rest = packed[lost]
            lower = self.log_probs(_shorten(rest, order), order - 1)
            if order > 1:
                context = self.backoffs[order - 2].find(rest >> np.uint64(16))
                known = context >= 0
                lower[known] += self.backoffs[order - 2].values[context[known]]
            else:
                lower = self.base + np.zeros_like(lower)
            out[lost] = lower
        return out

    def entropies(self, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
        """Cross-entropy per character by language of each text; NaN if it has no letter. Long texts go through in parts."""
        held: list[np.ndarray] = []
        ends: list[tuple[int, int]] = []  # text number, characters so far
        sums: dict[int, np.ndarray] = {}
        sizes: dict[int, int] = {}
        done = -1

        def flush() -> None:
            if held:
                part = self.log_probs(np.concatenate(held), ORDER).astype(np.float64)
                starts = np.cumsum([0] + [len(x) for x in held[:-1]])
                for (i, n), row in zip(ends, np.add.reduceat(part, starts, axis=0)):
                    sums[i] = sums.get(i, 0) + row
                    sizes[i] = sizes.get(i, 0) + n
                held.clear()
                ends.clear()

        count, size = 0, 0
        for i, text in enumerate(texts):
            packed = grams(prepare(text), ORDER)
            for at in range(0, len(packed), SEGMENT):
                piece = packed[at : at + SEGMENT]
                held.append(piece)
                ends.append((i, len(piece)))
                size += len(piece)
                if size >= SEGMENT:
                    flush()
                    size = 0
            count = i + 1
            if not held:
                for j in range(done + 1, count):
                    yield -sums.pop(j) / sizes.pop(j) if j in sums else np.full(len(self.languages), np.nan)
                done = count - 1
        flush()
        for j in range(done + 1, count):
            yield -sums.pop(j) / sizes.pop(j) if j in sums else np.full(len(self.languages), np.nan)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (posterior of the choice among the languages) and whether it is rejected."""
        names, scores, rejected = [], [], []
        for h in self.entropies(kernels.strings(column)):
            if np.isnan(h).any() or not len(h):
                names.append("und")
                scores.append(0.0)
                rejected.append(True)
                continue
            best = int(h.argmin())
            names.append(self.languages[best])
            scores.append(float(1 / np.exp(-np.clip(self.sharpness * (h - h[best]), 0, 500)).sum()))
            rejected.append(bool(h[best] > self.mean[best] + REJECT_DEVIATIONS * self.spread[best]))
        return names, np.array(scores), np.array(rejected, bool)


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, gram (packed, as a long) and n over all rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def packed(lang):
            keys, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            return pa.record_batch([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), kernels.strings(batch.column(1))):
                found = grams(prepare(text), ORDER)
                held.setdefault(lang, []).append(found)
                sizes[lang] = sizes.get(lang, 0) + len(found)
                if sizes[lang] > 1 << 22:
                    yield packed(lang)
                    sizes[lang] = 0
        for lang in list(held):
            yield packed(lang)

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discount(counts: np.ndarray) -> float:
    n1, n2 = (counts == 1).sum(), (counts == 2).sum()
    return float(n1 / (n1 + 2 * n2)) if n1 and n2 else 0.5


def _tables(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Kneser-Ney tables from the counts of the highest order."""
    languages = sorted(counts)
    levels = {lang: {ORDER: counts[lang]} for lang in languages}
    for lang in languages:
        for order in range(ORDER - 1, 0, -1):
            keys, n = np.unique(_shorten(levels[lang][order + 1][0], order + 1), return_counts=True)
            levels[lang][order] = (keys, n)
    alphabet = [len(levels[lang][1][0]) + 1 for lang in languages]
    model = Model(languages, [], [], -np.log(np.array(alphabet, float)))
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([levels[lang][order][0] for lang in languages]))
        values = np.empty((len(union), len(languages)))
        contexts = np.unique(np.concatenate([levels[lang][order][0] >> np.uint64(16) for lang in languages]))
        weights = np.zeros((len(contexts), len(languages)))
        lower = np.exp(model.log_probs(_shorten(union, order), order - 1).astype(float)) if order > 1 else np.exp(np.broadcast_to(model.base, values.shape))
        for j, lang in enumerate(languages):
            keys, n = levels[lang][order]
            d = _discount(n)
            own, which = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(which, n), np.bincount(which)
            backoff = np.ones(len(contexts))
            backoff[np.searchsorted(contexts, own)] = d * kinds / total
            top = np.zeros(len(union))
            top[np.searchsorted(union, keys)] = (n - d) / total[which]
            values[:, j] = top + backoff[np.searchsorted(contexts, union >> np.uint64(16))] * lower[:, j]
            weights[:, j] = np.log(backoff)
        if order == 1:
            model.base = model.base + weights[0]
        else:
            model.backoffs.append(HashArray(contexts, weights.astype(np.float32)))
        model.probs.append(HashArray(union, np.log(values).astype(np.float32)))
    return model


def _calibrate(model: Model, rows: list) -> None:
    """Mean and spread of each language's cross-entropy on its own texts, and the sharpness with the least log loss."""
    k = len(model.languages)
    h = np.array([h for _, h in rows]).reshape(-1, k)
    truth = np.array([model.languages.index(lang) for lang, _ in rows], int)
    fine = ~np.isnan(h).any(axis=1)
    h, truth = h[fine], truth[fine]
    model.mean, model.spread = np.full(k, np.inf), np.zeros(k)
    for j in range(k):
        own = h[truth == j, j]
        if len(own) > 1:
            model.mean[j], model.spread[j] = own.mean(), own.std() + 0.02
    if len(h):
        gap = h - h.min(axis=1, keepdims=True)
        best = [-(-s * gap[np.arange(len(h)), truth] - np.log(np.exp(-s * gap).sum(axis=1))).mean() for s in (1, 2, 5, 10, 20, 50)]
        model.sharpness = float((1, 2, 5, 10, 20, 50)[int(np.argmin(best))])


def train(rows: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Model:
    """Fits on rows (doc_id, lang, text); rows with a null lang are left out."""
    rows = rows.where("lang IS NOT NULL").select("doc_id", "lang", "text")
    share = F.least(F.lit(1_000_000), F.floor(F.lit(1_000_000.0) * max_fit_rows / F.count("*")) + 1)
    bounds = rows.groupBy("lang").agg(share.alias("bound"), (F.count("*") >= ASIDE_FROM).alias("many"))  # a row per language
    # by text too, so that rows that share a doc_id are not taken or left all together
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("langid")), F.lit(1_000_000))
    aside = F.col("many") & (F.pmod(F.xxhash64("doc_id", "text", F.lit("calibration")), F.lit(100)) < CALIBRATION)
    sample = rows.join(F.broadcast(bounds), "lang").where(place < F.col("bound"))
    found: dict[str, list] = {}
    for batch in count_grams(sample.where(~aside)).toArrow().to_batches():  # the model's own size
        for lang in set(batch.column(0).to_pylist()):
            part = batch.filter(pc.equal(batch.column(0), lang))
            found.setdefault(lang, []).append((part.column(1).to_numpy().view(np.uint64), part.column(2).to_numpy()))
    counts = {}
    for lang, parts in found.items():
        keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
        order = np.argsort(keys)
        counts[lang] = (keys[order], n[order])
    if not counts:
        return Model([], [], [], np.zeros(0))
    model = _tables(counts)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [x.tolist() for x in shared.value.entropies(kernels.strings(batch.column(1)))]
            yield pa.record_batch([batch.column(0), pa.array(h, pa.list_(pa.float64()))], names=["lang", "h"])

    apart = sample.where(aside & F.col("lang").isin(model.languages)).select("lang", "text").mapInArrow(run, "lang string, h array<double>")
    _calibrate(model, sorted((r.lang, r.h) for r in apart.collect()))  # about max_fit_rows * CALIBRATION / 100 rows a language
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Learns from rows that are not held out and have a lang. A text that is null or has no letter gets
    ``und`` with score 0. A rejected text (its cross-entropy is far from the language's) keeps its best
    language in lang_pred. Without any training row every text is ``und``.
    """
    training = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    shared = docs.sparkSession.sparkContext.broadcast(train(training, max_fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, rejected = shared.value.predict(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text"))
