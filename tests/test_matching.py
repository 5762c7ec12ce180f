"""Blocks shared by two strings, held against difflib."""

import random
import time
from difflib import SequenceMatcher

import pytest

from storyloom.functions import matching, shared


def _pairs(seed: int, n: int):
    r = random.Random(seed)
    for t in range(n):
        letters = ("a", "ab", "abcde", "abcdefghijklmnop", "的字𠀀é ")[t % 5]
        a = "".join(r.choice(letters) for _ in range(r.randrange(r.choice((3, 10, 40, 150)))))
        b = list(a * r.choice((1, 1, 2))) if t % 2 else [r.choice(letters) for _ in range(r.randrange(90))]
        for _ in range(r.randrange(6)):
            if b:
                b[r.randrange(len(b))] = r.choice(letters)
                del b[r.randrange(len(b))]
        yield a, "".join(b)


@pytest.mark.parametrize("block", [matching.BLOCK_PAIRS, 5])
def test_same_steps_and_ratio_as_difflib(monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK_PAIRS", block)
    for a, b in _pairs(7, 1500):
        known = SequenceMatcher(None, a, b, autojunk=False)
        assert matching.steps(a, b) == known.get_opcodes(), (a, b)
        assert matching.ratio(a, b) == known.ratio(), (a, b)


def test_time_does_not_grow_with_the_square_of_a_text():
    r = random.Random(3)
    words = [r.choice(("view", "click", "error", "purchase", "signup")) for _ in range(3000)]
    a, b = "".join(words), "".join("x" + w[1:] if k % 7 == 6 else w for k, w in enumerate(words))
    began = time.process_time()
    found = matching.matching_blocks(a, b)
    assert time.process_time() - began < 5  # difflib: 10 s and more
    assert sum(size for _, _, size in found) >= len(a) - len(words) // 7


def test_turns_are_dealt_out_evenly(spark):
    few = shared.spread(spark.range(4000).coalesce(1), "id")
    sizes = few.rdd.glom().map(len).collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 8 * 4000 / len(sizes)
