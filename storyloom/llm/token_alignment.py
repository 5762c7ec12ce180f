"""Two tokenizers' ids of the same text, aligned by bytes, and how often their ids go together in a corpus.

A is a byte-level BPE of the tokenizers library, which gets a space and the text; B a sentencepiece model, which puts
that space before a text itself. Where a token of A and one of B end at the same byte, a group ends. Two tokens are linked
where their bytes overlap; a group of n and m tokens has n + m - 1 links, one for each piece between neighbouring ends.

The map from an id of A to the id of B with the same bytes is made once. Links of a document that it foretells (groups
of one token each, nearly all of them) are counted in a vector as long as A's vocabulary; only the distinct other pairs
of a chunk of documents, with the number of documents that hold them, are shuffled by pair, summed, and handed back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels
from .byte_bpe import PartEncoder
from .scratch import materialize

VOCABULARY_A = public_tokenizers.path("byte_bpe_50k.json")
MODEL_B = public_tokenizers.path("piece_bpe_32k.model")
#: Pieces of text between places that no token of B crosses: a space, tab or line feed after something else.
PIECE = re.compile(r"[ \t\n]*+[^ \t\n]++|[ \t\n]++")
REMEMBERED, JOINED, LONG = 300_000, 5_000, 64
#: Characters of text and links that are worked on together, and links of a chunk, after which the next one begins.
BATCH_CHARS, CHUNK_LINKS = 2 << 20, 2_000_000
BLANK = "▁"


class PieceEncoder:
    """Ids of a space and a text by a sentencepiece model, piece by piece; pieces are remembered."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace(BLANK, " ").encode() for i, x in enumerate(names)]
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, size)
        if any(re.search(rf"[^{BLANK}]{BLANK}|.[\t\n]|[\t\n].", x, re.S) for x in names) or size > 1 << 16:
            raise ValueError("pieces of this model cross spaces, or their numbers need more than two bytes")
        self.blank = self.model.piece_to_id(BLANK)
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> list[int]:
        """Ids of ``text``, which the model's own space does not precede."""
        if text == " ":
            return [self.blank]
        return self.model.encode(text[1:]) if text[0] == " " else self.model.encode(text)[1:]

    def _learn(self, pieces: list[str]) -> None:
        for k in range(0, len(pieces), JOINED):
            some = pieces[k : k + JOINED]
            ids = np.asarray(self.plain("".join(some)), np.uint16)
            cuts = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(x.encode()) for x in some])) + 1
            data = ids.tobytes()
            self.known.update(zip(some, (data[2 * i : 2 * j] for i, j in zip([0, *cuts], cuts))))

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, which begins with a space and has no BLANK, as two bytes each."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        split = [PIECE.findall(x) for x in texts]
        new = set(chain.from_iterable(split)).difference(self.known)
        whole = [x for x in new if x[-1] not in " \t\n"]
        self._learn(whole)
        self.known.update((x, np.asarray(self.plain(x), np.uint16).tobytes()) for x in new.difference(whole))
        out = [b"".join(map(self.known.__getitem__, x)) for x in split]
        for x in new:
            if len(x) > LONG:
                del self.known[x]
        return out


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible ones of Latin-1 stand for themselves, the others follow from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers as one task uses them."""

    def __init__(self, vocabulary: bytes, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary.decode())
        tokenizer.encode_special_tokens = True
        ids, byte = tokenizer.get_vocab(), byte_of_char()
        bytes_a = {n: bytes(map(byte.__getitem__, x)) for x, n in ids.items()}
        self.lengths_a = np.zeros(max(bytes_a) + 1, np.int64)
        for n, x in bytes_a.items():
            self.lengths_a[n] = len(x)
        self.a = PartEncoder(lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.lengths_a)
        if self.a.kind.itemsize != 2:
            raise ValueError("numbers of A need more than two bytes")
        self.b = PieceEncoder(model)
        self.lengths_b = self.b.lengths
        # of ids of B with the same bytes the last one: pieces come after the bytes that stand in for unknown ones
        same = {x: n for n, x in enumerate(self.b.bytes)}
        self.same = np.full(len(self.lengths_a), -1, np.int64)
        for n, x in bytes_a.items():
            self.same[n] = same.get(x, -1)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of A and B of each text; none where a side's bytes are not a space and the text."""
        fit = [" " + x for x in texts if x and BLANK not in x]
        found = zip(fit, self.a.many(fit), self.b.many(fit))
        sums = lambda data, lengths: int(lengths[np.frombuffer(data, np.uint16)].sum())
        told = (((a, b) if sums(a, self.lengths_a) == sums(b, self.lengths_b) == len(x.encode()) else (b"", b"")) for x, a, b in found)
        return [next(told) if x and BLANK not in x else (b"", b"") for x in texts]


class Joint:
    """Documents' tokens on one line of bytes, and their groups and links."""

    def __init__(self, pairs: list[tuple[bytes, bytes]], lengths_a: np.ndarray, lengths_b: np.ndarray):
        self.a, self.b = (np.frombuffer(b"".join(x[k] for x in pairs), np.uint16) for k in (0, 1))
        ends_a, ends_b = np.cumsum(lengths_a[self.a]) - 1, np.cumsum(lengths_b[self.b]) - 1
        n = int(ends_a[-1]) + 1 if len(ends_a) else 0
        at_a, at_b = np.zeros(n, bool), np.zeros(n, bool)
        at_a[ends_a] = at_b[ends_b] = True
        before_a, before_b = np.cumsum(at_a, dtype=np.int32) - at_a, np.cumsum(at_b, dtype=np.int32) - at_b
        links = np.flatnonzero(at_a | at_b)
        self.key = self.a[before_a[links]].astype(np.uint32) << np.uint32(16) | self.b[before_b[links]]
        self.closes_a, self.closes_b = at_b[ends_a], at_a[ends_b]  # whether a token ends its group
        count = np.array([(len(x) // 2, len(y) // 2) for x, y in pairs], np.int64).reshape(-1, 2)
        self.tokens_a, self.tokens_b = count[:, 0], count[:, 1]
        last = np.cumsum(self.tokens_a)
        stops = np.where(last > 0, ends_a[np.maximum(last - 1, 0)] if n else 0, -1)
        self.links = np.diff(np.searchsorted(links, stops, side="right"), prepend=0)
        self.groups = np.diff(np.concatenate([[0], np.cumsum(self.closes_a)])[last], prepend=0)

    def documents(self) -> np.ndarray:
        """The document of each link."""
        return np.repeat(np.arange(len(self.links), dtype=np.uint64), self.links)

    def digests(self, shown_a: np.ndarray, shown_b: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups, A's numbers before B's; an empty string without tokens."""
        per_a, per_b = (np.diff(np.flatnonzero(x), prepend=-1) for x in (self.closes_a, self.closes_b))
        before_b = np.repeat(np.cumsum(per_b) - per_b, per_a)
        after_a = np.repeat(np.cumsum(per_a), per_b)
        out = np.zeros((len(self.a) + len(self.b), shown_a.shape[1]), np.uint8)
        out[np.arange(len(self.a)) + before_b] = shown_a[self.a.astype(np.int64) * 2 + self.closes_a]
        out[np.arange(len(self.b)) + after_a] = shown_b[self.b.astype(np.int64) * 2 + self.closes_b]
        some = out != 0
        size = np.concatenate([[0], np.cumsum(some.sum(axis=1))])[np.cumsum(self.tokens_a + self.tokens_b)]
        line = out[some].tobytes()
        return [hashlib.sha256(line[i : j - 1]).hexdigest() if j > i else "" for i, j in zip([0, *size], size)]


def _shown(n: int, within: str, last: str) -> np.ndarray:
    """Rows 2 * id and 2 * id + 1: the id in decimal and the mark after it inside and at the end of a list, filled up with zeros."""
    return np.frombuffer(b"".join(f"{i}{x}".encode().ljust(6, b"\0") for i in range(n) for x in (within, last)), np.uint8).reshape(-1, 6)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of the counts of each."""
    all_keys, all_counts = np.concatenate([*keys, np.zeros(0, np.uint32)]), np.concatenate([*counts, np.zeros(0, np.int64)])
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.diff(all_keys, prepend=all_keys[:1] + np.uint32(1)) != 0) if len(all_keys) else np.zeros(0, np.int64)
    return all_keys[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


ENCODED = "kind string, chunk long, doc_id long, a binary, b binary, n_groups long, groups_sha256 string, keys binary, docs binary"
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
_NAMES = [x.split()[0] for x in ENCODED.split(", ")]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], names=_NAMES)


class _Chunk:
    """Counts of a chunk's documents by pair: of the pairs that the map foretells in a vector, of the others as sorted keys."""

    def __init__(self, number: int, same: np.ndarray):
        self.number, self.same, self.links = number, same, 0
        self.vector = np.zeros(len(same), np.int64)
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, joint: Joint) -> None:
        held = np.sort(joint.documents() << np.uint64(32) | joint.key)
        key = held[np.diff(held, prepend=~held[:1]) != 0].astype(np.uint32)
        a = (key >> np.uint32(16)).astype(np.int64)
        foretold = self.same[a] == (key & np.uint32(0xFFFF)).astype(np.int64)
        self.vector += np.bincount(a[foretold], minlength=len(self.vector))
        keys, counts = np.unique(key[~foretold], return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.links += len(joint.key)

    def rows(self) -> list[tuple]:
        keys, counts = _summed(self.keys, self.counts)
        ids = np.flatnonzero(self.vector)
        pack = lambda x: x.astype("<u4").tobytes()
        return [("pairs", self.number, None, None, None, None, None, pack(keys), pack(counts)), ("same", self.number, None, None, None, None, None, pack(ids), pack(self.vector[ids]))]


def _batches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, vocabulary: str = VOCABULARY_A, model: str = MODEL_B) -> DataFrame:
    """Rows of three kinds, written to the shared folder in a folder of each.

    ``doc``: chunk, doc_id, ids of both sides (two bytes each, as a zstd frame), n_groups and groups_sha256 of each row of ``docs``; ``pairs``
    and ``same``: each chunk's distinct pairs (a * 65,536 + b) beside the map and ids of A of pairs of the map, with the
    chunk's number of documents that hold them. Both files are read on the driver and sent out; they have a fixed size.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f, open(model, "rb") as g:
        shared = spark.sparkContext.broadcast((f.read(), g.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = Pair(*shared.value), TaskContext.get().partitionId() << 32
        shown_a, shown_b = _shown(len(pair.lengths_a), ",", "|"), _shown(len(pair.lengths_b), ",", ";")
        chunk = _Chunk(number, pair.same)
        for some in _batches((i.as_py(), t) for b in batches for i, t in zip(b.column(0), kernels.strings(b.column(1)))):
            ids = pair.encode([t for _, t in some])
            joint = Joint(ids, pair.lengths_a, pair.lengths_b)
            chunk.add(joint)
            shas = joint.digests(shown_a, shown_b)
            packed = zstandard.ZstdCompressor(level=1).compress
            yield _record([("doc", chunk.number, i, packed(a), packed(b), int(n), sha, None, None) for (i, _), (a, b), n, sha in zip(some, ids, joint.groups, shas)])
            if chunk.links >= CHUNK_LINKS:
                yield _record(chunk.rows())
                chunk = _Chunk(chunk.number + 1, pair.same)
        yield _record(chunk.rows())
        del pair
        kernels.release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)
    return materialize(rows, "aligned", "kind")


def _spread(named: str, wide: bool):
    """Packed keys and counts of chunks as rows; ``wide`` rows have their chunk, others are summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[list, list] = ([], [])
        for b in batches:
            for chunk, keys, docs in zip(*(c.to_pylist() for c in b.columns)):
                k, n = np.frombuffer(keys, "<u4"), np.frombuffer(docs, "<u4").astype(np.int64)
                if wide:
                    yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(np.full(len(k), chunk, np.int64))], names=[named, "chunk"])
                else:
                    total = tuple([x] for x in _summed([*total[0], k], [*total[1], n]))
        if total[0]:
            yield pa.RecordBatch.from_arrays([pa.array(total[0][0].astype(np.int64)), pa.array(total[1][0])], names=[named, "n"])

    return run


def pair_counts(encoded: DataFrame, kind: str) -> DataFrame:
    """key and n: in how many documents each pair beside the map (``pairs``), or each id of A with its like (``same``), is linked."""
    rows = encoded.where(F.col("kind") == kind).select("chunk", "keys", "docs").mapInArrow(_spread("key", False), "key long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


def counted(encoded: DataFrame, vocabulary: str = VOCABULARY_A, model: str = MODEL_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document of ``encode``'s table."""
    spark = encoded.sparkSession
    with open(vocabulary, "rb") as f, open(model, "rb") as g:
        pair = Pair(f.read(), g.read())
    counts = materialize(pair_counts(encoded, "pairs"), "pair-counts")
    vector = np.zeros(len(pair.same), np.int64)
    for r in pair_counts(encoded, "same").collect():  # a row per id of A at most, as below
        vector[r.key] = r.n
    best = vector.copy()
    for r in counts.groupBy(F.shiftright("key", 16).alias("a")).agg(F.max("n").alias("n")).collect():
        best[r.a] = max(best[r.a], r.n)
    shared = spark.sparkContext.broadcast((pair.lengths_a, pair.lengths_b, pair.same, vector, best))
    asked = encoded.where("kind = 'pairs'").select("chunk", "keys", "docs").mapInArrow(_spread("key", True), "key long, chunk long")
    answers = asked.join(counts, "key").select("chunk", "key", "n")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        lengths_a, lengths_b, same, vector, best = shared.value
        keys, ns = told.column("key").to_numpy().astype(np.uint32), told.column("n").to_numpy()
        order, plain = np.argsort(keys), zstandard.ZstdDecompressor().decompress
        keys, ns = np.append(keys[order], np.uint32(0xFFFFFFFF)), np.append(ns[order], 0)
        parts = []
        for some in docs.select(["a", "b"]).to_batches(max_chunksize=256):
            joint = Joint(list(zip(*([plain(x) for x in c.to_pylist()] for c in some.columns))), lengths_a, lengths_b)
            a = (joint.key >> np.uint32(16)).astype(np.int64)
            foretold = same[a] == (joint.key & np.uint32(0xFFFF)).astype(np.int64)
            n = np.where(foretold, vector[a], 0)
            n[~foretold] = ns[np.searchsorted(keys, joint.key[~foretold])]
            ends = np.cumsum(joint.links)
            upto = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends], prepend=0)
            parts.append([joint.tokens_a, joint.tokens_b, joint.groups, joint.links, upto(n == best[a]), upto(n)])
        numbers = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 6
        return pa.table([docs.column("doc_id"), *map(pa.array, numbers), docs.column("groups_sha256")], names=names)

    own = encoded.where("kind = 'doc'").select("chunk", "doc_id", "a", "b", "groups_sha256").groupBy("chunk")
    return own.cogroup(answers.groupBy("chunk")).applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, vocabulary: str = VOCABULARY_A, model: str = MODEL_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of ``docs`` (doc_id, text).

    A pair's count is the number of rows that hold it linked, once each; n_best: links whose count is the highest of their
    id of A, ties included; count_sum: the sum of the links' counts. Every row gives one row and counts as a document
    of its own, whatever its doc_id (null too). Null and empty texts, and texts with U+2581, which B takes for a space,
    have no tokens: zeros and an empty digest. Other columns are not looked at, whatever their names. A text is encoded as
    a whole by one task. What is shuffled is the documents' ids, once, and each chunk's distinct pairs beside the map.
    """
    return counted(encode(docs, vocabulary, model), vocabulary, model)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
