"""Numpy kernels over Arrow string columns, used inside Spark tasks.

They work on the UTF-8 bytes of a whole batch at once and make no Python string per word. A word is a
run of bytes other than space and ``\\t``..``\\r`` (0x09-0x0D), with A-Z lower-cased.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEGMENT_BYTES = 1 << 19
_STEP = 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_DRAWN = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _DRAWN.integers(1, 2**64, 256, dtype=U64)
_BYTE_CODE_LOWER = _BYTE_CODE[_LOWER]
#: A multiplier drawn for each place, not powers of one base: modulo 2^64 those cancel out on words of a known form, whatever the base.
_PLACES = _DRAWN.integers(1, 2**64, _STEP, dtype=U64) | U64(1)


def release() -> None:
    """Gives freed memory back to the system, where the C library can; idle Python workers keep it otherwise."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits of the input."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null row counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _hash_segment(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of ``data`` and the place where each word begins; ``firsts``: starts of documents."""
    solid = ~_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = firsts[(firsts > 0) & (firsts < len(data))]
    opens[inner] = solid[inner]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, U64), starts
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    codes = _BYTE_CODE_LOWER[data]
    codes[~solid] = 0
    if place.max(initial=0) < _STEP:
        codes *= _PLACES[place]
    else:
        codes *= _PLACES[place & (_STEP - 1)]
        codes *= mix(np.arange(int(place.max()) // _STEP + 1, dtype=U64))[place // _STEP] | U64(1)  # 1 for the first block
    return mix(np.add.reduceat(codes, starts)), starts


def _hash_long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long document, cut at white space into parts of bounded size."""
    found, at = [], 0
    while at < len(data):
        end = min(at + SEGMENT_BYTES, len(data))
        while end < len(data):
            gaps = np.flatnonzero(_SPACE[data[max(at, end - _STEP) : end]])
            if len(gaps):
                end = max(at, end - _STEP) + int(gaps[-1]) + 1
                break
            end = min(end + _STEP, len(data))
        found.append(_hash_segment(data[at:end], np.zeros(0, np.int64))[0])
        at = end
    return np.concatenate(found) if found else np.zeros(0, U64)


def word_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, hashes of all their words, number of words of each row)."""
    data, offsets = utf8(column)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + SEGMENT_BYTES, side="right")) - 1
        if end <= at:
            found = _hash_long(data[offsets[at] : offsets[at + 1]])
            yield at, at + 1, found, np.array([len(found)], np.int64)
            at += 1
            continue
        end = min(end, rows)
        part = data[offsets[at] : offsets[end]]
        inside = offsets[at : end + 1] - offsets[at]
        hashes, starts = _hash_segment(part, inside[:-1])
        yield at, end, hashes, np.diff(np.searchsorted(starts, inside, side="left"))
        at = end


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words and their number in each row; a shorter row is one run as a whole."""
    n = len(hashes)
    if not n:
        return hashes, np.zeros(len(counts), np.int64)
    place = np.arange(n, dtype=np.int64)
    begin = np.cumsum(counts) - counts
    left = np.repeat(begin + counts, counts) - place
    length = np.minimum(np.repeat(counts, counts), width)
    keep = (left >= length) & ((length == width) | (place == np.repeat(begin, counts)))
    out = np.zeros(n, U64)
    for k in range(width):
        step = np.zeros(n, U64)
        step[: max(0, n - k)] = hashes[k:]
        live = k < length
        out = np.where(live, mix(out * U64(0x2545F4914F6CDD1D) + step + U64(k + 1)), out)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    return out[keep], sizes


def strings(column: pa.Array) -> Iterator[str]:
    """The rows as Python strings, null as empty, one at a time."""
    for value in column:
        yield value.as_py() or ""
