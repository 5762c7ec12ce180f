"""Sorted-string-table shards of token ids, keyed by document.

Layout of a shard, all integers little-endian::

    magic | data blocks | index block | Bloom filter | footer

A data block holds entries in key order. An entry is three varints (bytes shared with the key before,
further key bytes, value bytes), the key's further bytes and the value. Every ``RESTART``-th entry has
its whole key; the places of these entries end the block, so that a key is found by binary search. A
block is compressed with zstd. The index block has the last key, place and length of each data block.
The footer says where index and filter are and how many documents and ids the shard has.

A key is one byte (0 for a null doc_id, else 1) and the doc_id as eight big-endian bytes with its sign
bit turned over, which sorts as doc_id does, null first. A value is the ids as unsigned 16- or 32-bit integers.
"""

from __future__ import annotations

import bisect
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels
from .byte_bpe import PartEncoder, worker_encoder
from .scratch import materialize, new_path

MAGIC = b"SLSST001"
FOOTER = struct.Struct("<QQQQQQB7s")
BLOCK_BYTES = 64 << 10
RESTART = 16
BLOOM_BITS_PER_KEY = 10
BLOOM_PROBES = 7
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", (doc_id & (2**64 - 1)) ^ (1 << 63))


def doc_of(key: bytes) -> int | None:
    if key == b"\0":
        return None
    n = struct.unpack(">Q", key[1:])[0] ^ (1 << 63)
    return n - (1 << 64) if n >> 63 else n


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


class _Block:
    def __init__(self):
        self.parts: list[bytes] = []
        self.size = self.count = 0
        self.last = b""
        self.restarts: list[int] = []

    def add(self, key: bytes, value: bytes) -> None:
        if self.count % RESTART:
            shared = len(os.path.commonprefix([key, self.last]))
        else:
            shared = 0
            self.restarts.append(self.size)
        entry = _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.parts.append(entry)
        self.size += len(entry)
        self.count += 1
        self.last = key

    def raw(self) -> bytes:
        return b"".join(self.parts) + struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts))


def _entry(data: bytes, at: int, before: bytes) -> tuple[bytes, int, int]:
    """Key, place and end of the value of the entry at ``at``."""
    shared, at = _read_varint(data, at)
    more, at = _read_varint(data, at)
    size, at = _read_varint(data, at)
    return before[:shared] + data[at : at + more], at + more, at + more + size


def _entries(data: bytes, at: int = 0) -> Iterator[tuple[bytes, bytes]]:
    end = len(data) - 4 - 4 * struct.unpack_from("<I", data, len(data) - 4)[0]
    key = b""
    while at < end:
        key, lo, at = _entry(data, at, key)
        yield key, data[lo:at]


def _block_find(data: bytes, key: bytes) -> list[bytes]:
    """Values of ``key``: binary search over the restarts, then a short scan."""
    n = struct.unpack_from("<I", data, len(data) - 4)[0]
    places = struct.unpack_from(f"<{n}I", data, len(data) - 4 - 4 * n)
    lo = max(0, bisect.bisect_left(places, key, key=lambda at: _entry(data, at, b"")[0]) - 1)
    out = []
    for k, v in _entries(data, places[lo]):
        if k > key:
            break
        if k == key:
            out.append(v)
    return out


def _probes(keys: np.ndarray, bits: int) -> np.ndarray:
    a = kernels.mix(keys)
    b = kernels.mix(keys ^ np.uint64(0x94D049BB133111EB)) | np.uint64(1)
    return (a[None, :] + np.arange(BLOOM_PROBES, dtype=np.uint64)[:, None] * b[None, :]) % np.uint64(bits)


def _bloom_key(key: bytes) -> int:
    return int.from_bytes(key[1:], "big") if len(key) > 1 else 0x5EED


class ShardWriter:
    """Writes one shard to a stream; keys come in ascending order."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.place = self.docs = self.tokens = 0
        self.index, self.keys, self.block = _Block(), [], _Block()
        self.packer = zstandard.ZstdCompressor(level=1)
        self._put(MAGIC)

    def _put(self, data: bytes) -> tuple[int, int]:
        at = self.place
        self.out.write(data)
        self.place += len(data)
        return at, len(data)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        self.put(key, ids.astype("<u2" if self.width == 2 else "<u4").tobytes())

    def put(self, key: bytes, value: bytes) -> None:
        """Adds ids that are integers of the shard's width already."""
        self.block.add(key, value)
        self.keys.append(_bloom_key(key))
        self.docs += 1
        self.tokens += len(value) // self.width
        if self.block.size >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block.count:
            at, size = self._put(self.packer.compress(self.block.raw()))
            self.index.add(self.block.last, struct.pack("<QQ", at, size))
            self.block = _Block()

    def close(self) -> None:
        self._flush()
        index = self._put(self.packer.compress(self.index.raw()))
        bits = max(64, len(self.keys) * BLOOM_BITS_PER_KEY)
        mask = np.zeros(bits + -bits % 8, np.uint8)
        if self.keys:
            mask[_probes(np.array(self.keys, np.uint64), bits).ravel().astype(np.int64)] = 1
        bloom = self._put(struct.pack("<Q", bits) + np.packbits(mask, bitorder="little").tobytes())
        self._put(FOOTER.pack(*index, *bloom, self.docs, self.tokens, self.width, MAGIC[:7]))


class Shard:
    """Reads a shard from a random-access file; ``get`` reads the footer, index and filter once, then one or a few blocks."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        file.seek(0, 2)
        end = file.tell()
        index_at, index_size, bloom_at, bloom_size, self.docs, self.tokens, self.width, mark = FOOTER.unpack(self._read(end - FOOTER.size, FOOTER.size))
        if mark != MAGIC[:7]:
            raise ValueError("not a shard, or a shard that was cut short")
        index = list(_entries(self._block(index_at, index_size)))
        self.lasts = [k for k, _ in index]
        self.places = [struct.unpack("<QQ", v) for _, v in index]
        bloom = self._read(bloom_at, bloom_size)
        self.bits, self.bloom = struct.unpack_from("<Q", bloom)[0], np.frombuffer(bloom, np.uint8, offset=8)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _block(self, at: int, size: int) -> bytes:
        return self.unpack.decompress(self._read(at, size))

    def ids(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, "<u2" if self.width == 2 else "<u4").astype("<u4")

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for place in self.places:
            for key, value in _entries(self._block(*place)):
                yield doc_of(key), self.ids(value)

    def may_have(self, key: bytes) -> bool:
        at = _probes(np.array([_bloom_key(key)], np.uint64), self.bits).ravel().astype(np.int64)
        return bool(((self.bloom[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all())

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """Ids of the documents with this identifier (one each, more if it repeats)."""
        key, out = key_of(doc_id), []
        if not self.may_have(key):
            return out
        at = bisect.bisect_left(self.lasts, key)
        while at < len(self.places):
            out += [self.ids(v) for v in _block_find(self._block(*self.places[at]), key)]
            if self.lasts[at] > key:
                break
            at += 1
        return out


def open_shard(path: str) -> Shard:
    store, at = arrow_fs.FileSystem.from_uri(path)
    return Shard(store.open_input_file(at))


def tokenizers_encoder(vocabulary: bytes) -> PartEncoder:
    """Text to ids as the tokenizers library gives them; its added tokens are found in the text, as the library does."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary.decode())
    vocabulary_ids = tokenizer.get_vocab()
    lengths = np.zeros(max(vocabulary_ids.values()) + 1, np.int64)
    for token, number in vocabulary_ids.items():
        lengths[number] = len(token)  # one character stands for one byte
    added = tokenizer.get_added_tokens_decoder()
    if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
        raise ValueError("added tokens that take spaces or words with them are not supported")
    found = PartEncoder(lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, lengths, {t.content: n for n, t in added.items()})
    found.most += found.most // 3  # it stays in its worker, whose only work it is
    return found


def write_shards(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Writes shards that follow each other in doc_id order; one row per shard: shard, path, n_docs, n_tokens, n_bytes.

    Texts are dealt out by ranges of doc_id (rows of one doc_id by their place in the input, so that a
    repeated identifier does not fill one task), sorted, encoded and written where they are. A null text
    is a document with the end id alone; a null doc_id comes first; an empty table gives no shards. A
    retried task writes a file of another name, and only files that the manifest lists count.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "sstable")
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    store, at = arrow_fs.FileSystem.from_uri(folder)
    store.create_dir(at)
    schema = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        encode = worker_encoder(tokenizers_encoder, shared.value)
        for doc_id, body in encode.stream((i.as_py(), t) for b in batches for i, t in zip(b.column(0), kernels.strings(b.column(1)))):
            if writer is None:
                name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.sst"
                out_fs, out_at = arrow_fs.FileSystem.from_uri(folder)
                out = out_fs.open_output_stream(f"{out_at}/{name}")
                writer, end = ShardWriter(out, encode.kind.itemsize), np.array([end_id], encode.kind).tobytes()
            writer.put(key_of(doc_id), body + end)
        if writer is not None:
            writer.close()
            out.close()
            row = [TaskContext.get().partitionId(), f"{folder}/{name}", writer.docs, writer.tokens, writer.place]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    sorted_ = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    return materialize(sorted_.select("doc_id", "text").mapInArrow(run, "shard long, path string, n_docs long, n_tokens long, n_bytes long"), "sstable-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document of the shards, from their files: doc_id, start (ids of all documents before), token_bytes."""
    spark = manifest.sparkSession
    shards, start = [], 0
    for row in manifest.orderBy("shard").select("path", "n_tokens").toLocalIterator():  # a row per file
        shards.append((len(shards), row.path, start))
        start += row.n_tokens
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("token_bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                held, size = [], 0
                for doc_id, ids in open_shard(path).scan():
                    held.append((doc_id, at, ids.tobytes()))
                    at, size = at + len(ids), size + 4 * len(ids)
                    if size > 8 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    listed = spark.createDataFrame(shards, "shard long, path string, start long")
    return listed.repartitionByRange(max(1, len(shards)), "shard").mapInArrow(run, "doc_id long, start long, token_bytes binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_shards(write_shards(docs)).select(
        "doc_id", "start", (F.octet_length("token_bytes") / 4).cast("long").alias("n_tokens"), F.crc32("token_bytes").alias("ids_crc32")
    )
