"""Blocks that two strings share, the same as those of difflib's SequenceMatcher without junk and popularity."""

from __future__ import annotations

import numpy as np

#: Least length of the runs by which blocks are looked for, doubled while more than PAIRS pairs of places a character have the same one.
GRAM, PAIRS = 3, 8
#: Pairs of places that are held at once.
BLOCK_PAIRS = 1 << 21


def _grams(a: str, b: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Lengths, each twice the one before, and at each place of a and b a number for the run of that length that begins there."""
    codes = np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    q, keys = GRAM, codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]
    while q <= min(len(a), len(b)):
        numbers = np.unique(keys, return_inverse=True)[1]
        out.append((q, numbers[: len(a) - q + 1], numbers[len(a) :]))
        kinds = int(numbers.max()) + 1
        pairs = np.bincount(out[-1][1], minlength=kinds) @ np.bincount(out[-1][2], minlength=kinds)
        if pairs <= PAIRS * len(codes):
            break
        keys, q = numbers[:-q] * kinds + numbers[q:], 2 * q
    return out


def _runs(a: np.ndarray, b: np.ndarray, q: int, alo: int, blo: int) -> list[tuple[int, int, int]]:
    """Length (negative) and places of each run of ``q`` characters or more that a and b share and that could not be longer."""
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    lo = np.searchsorted(ranked, a)
    upto = np.cumsum(np.searchsorted(ranked, a, "right") - lo)
    told, at = [], 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK_PAIRS, "right")))
        sizes = np.diff(upto[at:to], prepend=upto[at - 1] if at else 0)
        i = np.repeat(np.arange(at, to), sizes)
        j = order[np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes - lo[at:to], sizes)]
        told.append(_stretches(np.sort((i - j + len(b)) * (len(a) + 1) + i)))
        at = to
    first, size = np.concatenate(told, axis=1)
    if len(told) > 1:  # runs that go on in the next block of places
        order = np.argsort(first)
        first, size = first[order], size[order]
        begins = np.flatnonzero(np.append(True, first[1:] != first[:-1] + size[:-1]))
        first, size = first[begins], np.add.reduceat(size, begins)
    i = first % (len(a) + 1)
    return list(zip((1 - q - size).tolist(), (i + alo).tolist(), (i - first // (len(a) + 1) + len(b) + blo).tolist()))


def _stretches(keys: np.ndarray) -> np.ndarray:
    """First number and length of each stretch of ascending numbers without a gap."""
    begins = np.flatnonzero(np.diff(keys, prepend=-2) != 1)
    return np.stack([keys[begins], np.diff(begins, append=len(keys))])


def _greedy(a: str, b: str, alo: int, ahi: int, blo: int, bhi: int, q: int, out: list[tuple[int, int, int]]) -> None:
    """Blocks where none is longer than ``q``: the first one counts, before it there are only shorter ones, and beyond it the same holds."""
    if q == 0 or alo >= ahi or blo >= bhi:
        return
    i = alo
    while i + q <= ahi:
        j = b.find(a[i : i + q], blo, bhi)
        if j < 0:
            i += 1
            continue
        out.append((i, j, q))
        _greedy(a, b, alo, i, blo, j, q - 1, out)
        i, blo = i + q, j + q
        alo = i
    _greedy(a, b, alo, ahi, blo, bhi, q - 1, out)


def matching_blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """Place in a, place in b and length of each block, in order; blocks that touch in both are one.

    The longest block is taken first, the first on a tie, and what lies on either side of it is gone through alike. Common
    runs of a least length are made once and cut to the sides' bounds; where none is left, shorter ones are made.
    """
    if a == b:
        return [(0, 0, len(a))] if a else []
    out: list[tuple[int, int, int]] = []
    grams = _grams(a, b)
    waiting: list[tuple] = [(0, len(a), 0, len(b), len(grams), [])]
    while waiting:
        alo, ahi, blo, bhi, level, runs = waiting.pop()
        while not runs and level:
            level -= 1
            q, own, other = grams[level]
            if q <= min(ahi - alo, bhi - blo):
                runs = _runs(own[alo : ahi - q + 1], other[blo : bhi - q + 1], q, alo, blo)
        if not runs:
            _greedy(a, b, alo, ahi, blo, bhi, GRAM - 1, out)
            continue
        size, i, j = min(runs)
        out.append((i, j, -size))
        m, n, q = i - size, j - size, grams[level][0]
        before = [(-s, x, y) for r, x, y in runs if (s := min(-r, i - x, j - y)) >= q]
        after = [(-s, x + d, y + d) for r, x, y in runs if (s := -r - (d := max(0, m - x, n - y))) >= q]
        waiting += [(alo, i, blo, j, level, before), (m, ahi, n, bhi, level, after)]
    joined: list[tuple[int, int, int]] = []
    for i, j, size in sorted(out):
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            i, j, size = *joined[-1][:2], joined.pop()[2] + size
        joined.append((i, j, size))
    return joined


def ratio(a: str, b: str) -> float:
    """Twice the characters in blocks over all characters; 1 for two empty strings."""
    return 2.0 * sum(size for _, _, size in matching_blocks(a, b)) / (len(a) + len(b)) if a or b else 1.0


def steps(a: str, b: str) -> list[tuple[str, int, int, int, int]]:
    """Edit steps from a to b: equal, replace, delete or insert, with the places in a and b."""
    out, i, j = [], 0, 0
    for m, n, size in [*matching_blocks(a, b), (len(a), len(b), 0)]:
        if i < m or j < n:
            out.append(("replace" if i < m and j < n else "delete" if i < m else "insert", i, m, j, n))
        if size:
            out.append(("equal", m, m + size, n, n + size))
        i, j = m + size, n + size
    return out
