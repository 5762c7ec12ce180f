"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are split where white space follows something else: no match of the pattern crosses such a
place, so that the parts are encoded separately with the same result. Parts that come again (most words
do) are encoded once per task, or per Python worker where ``worker_encoder`` is used, as long as they are remembered. Decoding gives raw bytes, since a token may end inside a character.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: A word is told apart from the ASCII marks after it: no match of the pattern crosses from a letter or digit to a mark.
PART = re.compile(r"[ \t\n\r]*+[^\W_]++(?=[!-/:-@\[-`{-~])|[ \t\n\r]*+[^ \t\n\r]++|[ \t\n\r]++")
#: A part that ends in one of these is not a safe place to split: they may belong to a run of white space.
UNSURE = frozenset("\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u200b\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200B))))
#: Parts of a generation; two are kept.
CACHED_PARTS = 300_000
JOINED_PARTS = 5_000
SPACES = frozenset(" \t\n\r")
CACHED_CHARS = 64
#: Rows of a batch go on in groups of about so many bytes.
OUT_BYTES = 8 << 20


class PartEncoder:
    """Encodes texts part by part. ``encode`` maps a string to ids, ``lengths`` has the bytes that each id stands for.

    Parts that are new go through joined to long strings, which costs one call for many; the ids are cut at the
    parts' ends by their bytes. Parts are joined only where the join is a safe place to split. ``added`` are tokens,
    by their text, that are found before anything else; what stands between them is encoded by itself.
    Parts are remembered in two generations: when the newer one is full, the older one goes.
    """

    def __init__(self, encode: Callable[[str], np.ndarray], lengths: np.ndarray, added: dict[str, int] | None = None):
        self.encode, self.lengths = encode, lengths
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.most = CACHED_PARTS
        self.kind = np.dtype("<u2" if max(len(lengths), *(added or {}).values(), 0) <= 1 << 16 else "<u4")
        self.added = {text: np.array([number], self.kind).tobytes() for text, number in (added or {}).items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None

    def _plain(self, text: str) -> bytes:
        return np.asarray(self.encode(text), dtype=self.kind).tobytes()

    def _joined(self, parts: list[str]) -> list[bytes]:
        out, at = [], 0
        while at < len(parts):
            some = parts[at : at + JOINED_PARTS]
            ids = np.asarray(self.encode("".join(some)), dtype=self.kind)
            ends = np.cumsum(np.fromiter((len(x.encode()) for x in some), np.int64, len(some)))
            told = np.cumsum(self.lengths[ids])
            cuts = np.searchsorted(told, ends)
            if not (len(told) and (told[np.minimum(cuts, len(told) - 1)] == ends).all()):
                raise ValueError("ids do not end where parts do")
            data, cuts = ids.tobytes(), ((cuts + 1) * self.kind.itemsize).tolist()
            out += [data[i:j] for i, j in zip([0, *cuts], cuts)]
            at += len(some)
        return out

    def _unknown(self, split: list[list[str]]) -> set[str]:
        """Parts that the newer generation lacks."""
        return set(filterfalse(self.cache.__contains__, chain.from_iterable(split)))

    def _remember(self, missing: set[str]) -> set[str]:
        """Sees to it that the newer generation has the ids of ``missing``; gives those that the older one lacks too."""
        found, older = self.cache, self.older
        again = missing.intersection(older)
        found.update(zip(again, map(older.__getitem__, again)))
        new = missing.difference(again)
        easy = [x for x in new if x[0] in SPACES and x[-1] not in SPACES and x[-1] not in UNSURE]
        found.update(zip(easy, self._joined(easy)))
        found.update([(x, self._plain(x)) for x in new.difference(easy)])
        return new

    def _many(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.most:
            self.older, self.cache = self.cache, {}
        split = [PART.findall(x) for x in texts]
        missing = self._unknown(split)
        # parts that end in an unsure character are never remembered, so that they are among these
        unsure = {x for x in missing if x[-1] in UNSURE}
        if unsure:
            split = [x if unsure.isdisjoint(x) else _rejoined(x) for x in split]
            missing = self._unknown(split)
        new = self._remember(missing)
        found = self.cache
        out = [b"".join(map(found.__getitem__, x)) for x in split]
        for x in new:
            if len(x) > CACHED_CHARS or x[-1] in UNSURE:
                del found[x]
        return out

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of ``kind``, the least that holds every id."""
        if self.special is None:
            return self._many(texts)
        cut = [self.special.split(x) if self.special.search(x) else [x] for x in texts]  # text, added token, text ...
        between = iter(self._many([y for x in cut for y in x[::2]]))
        return [b"".join(self.added[y] if k % 2 else next(between) for k, y in enumerate(x)) for x in cut]

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(self.many([text])[0], self.kind)

    def stream(self, rows: Iterator[tuple[int | None, str]]) -> Iterator[tuple[int | None, bytes]]:
        """Identifier and ids of each (identifier, text), in groups of about OUT_BYTES of text."""
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[1])
            if size > OUT_BYTES // 4:
                yield from zip([i for i, _ in held], self.many([t for _, t in held]))
                held, size = [], 0
        yield from zip([i for i, _ in held], self.many([t for _, t in held]))


def _rejoined(parts: list[str]) -> list[str]:
    """Parts joined to the one after where they end in a character that is no safe place to split."""
    out, held = [], ""
    for x in parts:
        held += x
        if x[-1] not in UNSURE:
            out.append(held)
            held = ""
    return [*out, held] if held else out


_ENCODERS: dict[tuple, PartEncoder] = {}


def worker_encoder(build: Callable[..., PartEncoder], *args) -> PartEncoder:
    """The encoder that ``build`` makes of ``args`` (bytes and strings), kept with its parts for the worker's next tasks."""
    key = (build.__module__, build.__name__, *(hashlib.sha256(a if isinstance(a, bytes) else a.encode()).digest() for a in args))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = build(*args)
    return _ENCODERS[key]


def rank_table(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}


def encoding(ranks: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=rank_table(ranks), special_tokens={})


def part_encoder(ranks: bytes, pattern: str) -> PartEncoder:
    enc, table = encoding(ranks, pattern), rank_table(ranks)
    lengths = np.zeros(max(table.values()) + 1, np.int64)
    for token, number in table.items():
        lengths[number] = len(token)
    return PartEncoder(lambda text: enc.encode_to_numpy(text, disallowed_special=()), lengths)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size > OUT_BYTES or len(held) >= 5000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and token_bytes: the ids of each text as little-endian unsigned 32-bit integers.

    Every row gives one row; null and empty texts give no ids. No special token is recognised. The rank
    file is read on the driver and sent to the executors (it has a fixed size); texts are not moved
    between tasks, and each goes through as one row whatever its length.
    """
    spark = docs.sparkSession
    with open(ranks, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.int64()), ("token_bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = part_encoder(shared.value, pattern)  # the task's own, so that a worker's later tasks have the memory
        found = part.stream((i.as_py(), t) for b in batches for i, t in zip(b.column(0), kernels.strings(b.column(1))))
        yield from _batches(((i, np.frombuffer(body, part.kind).astype("<u4").tobytes()) for i, body in found), schema)
        del part, found
        kernels.release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, token_bytes binary")


def decode(tokens: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Adds text_bytes, the bytes that token_bytes stand for, to doc_id and token_bytes. Null ids give no bytes."""
    spark = tokens.sparkSession
    with open(ranks, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.int64()), ("token_bytes", pa.binary()), ("text_bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value, pattern)
        for b in batches:
            rows = ((i.as_py(), t.as_py() or b"") for i, t in zip(b.column(0), b.column(1)))
            yield from _batches(((i, t, enc.decode_bytes(np.frombuffer(t, "<u4").tolist())) for i, t in rows), schema)

    return tokens.select("doc_id", "token_bytes").mapInArrow(run, "doc_id long, token_bytes binary, text_bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.octet_length("token_bytes") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_bytes", 256).alias("ids_sha256"),
        F.sha2("text_bytes", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(decode(encode(docs)))
