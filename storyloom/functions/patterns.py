"""Many patterns at once: which of them a text holds is found in one pass, however many there are."""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heappop, heappush

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms and characters of one automaton; what goes beyond them is dealt out to further ones, which follow each other.
MOST_TERMS, MOST_CHARS = 200_000, 8_000_000
#: Parts of texts whose result is kept in a task, and the longest of them.
MOST_PARTS, MOST_KEPT = 100_000, 64


class Patterns:
    """An automaton over ``terms``; empty ones are in no text."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.numbers: dict[str, list[int]] = {}
        for i, t in enumerate(terms):
            if t:
                self.numbers.setdefault(t, []).append(i)
        self.machine = ahocorasick.Automaton()
        for t in self.numbers:
            self.machine.add_word(t, t)
        self.machine.make_automaton()

    def present(self, text: str) -> list[int]:
        """Numbers of the terms that ``text`` holds, in order."""
        if not self.numbers:
            return []
        return sorted(i for t in {t for _, t in self.machine.iter(text)} for i in self.numbers[t])


class Glossary:
    """Replaces wrong spellings by right ones, the longest wrong one first, then in the order given, over the whole text each time."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.pairs = sorted(((w, r) for w, r in pairs if w and w != r), key=lambda p: -len(p[0]))
        self.patterns = Patterns([w for w, _ in self.pairs])
        self.longest = max((len(w) for w, _ in self.pairs), default=0)
        used = sorted({c for p in self.pairs for x in p for c in x})
        self.between = re.compile("([" + "".join(map(re.escape, used)) + "]+)" if used else r"(?!)()")
        self.done: dict[tuple[str, int], tuple[str, int]] = {}

    def once(self, text: str) -> tuple[str, int]:
        """One pass over all terms, and the number of replacements. A term that an earlier one brings into the text is found too."""
        count, queue = 0, self.patterns.present(text)
        known = set(queue)
        while queue:
            i = heappop(queue)
            wrong, right = self.pairs[i]
            # where the right spelling holds the wrong one, parts that are right already stay
            parts = text.split(right) if wrong in right else [text]
            pieces = [p.split(wrong) for p in parts]
            found = sum(map(len, pieces)) - len(pieces)
            if not found:
                continue
            text, count = right.join(right.join(p) for p in pieces), count + found
            # what is new in the text lies across a new right spelling; the rest of the text is not gone through again
            reach, width, at, last = self.longest - 1, len(right), 0, len(pieces) - 1
            for n, piece in enumerate(pieces):
                for m, x in enumerate(piece):
                    at += len(x)
                    if m < len(piece) - 1:
                        for k in self.patterns.present(text[max(0, at - reach) : at + width + reach]):
                            if k > i and k not in known:
                                known.add(k)
                                heappush(queue, k)
                        at += width
                at += width if n < last else 0
        return text, count

    def apply(self, text: str, passes: int) -> tuple[str, int]:
        """Passes until nothing changes, ``passes`` at most. No term reaches over a character that is in none of them, so that
        what is between such characters stands by itself, and is looked up where it came before."""
        out, told = [], []
        for k, part in enumerate(self.between.split(text)):
            if k % 2:  # characters of some term
                known = self.done.get((part, passes))
                if known is None:
                    known = self._passes(part, passes)
                    if len(part) <= MOST_KEPT:
                        if len(self.done) >= MOST_PARTS:
                            self.done.clear()
                        self.done[part, passes] = known
                part, *counts = known
                told.append(counts)
            out.append(part)
        # a part that its last pass left as it was, by replacements that undo each other, counts them in each pass of the others
        most = max((n for _, _, n in told), default=0)
        return "".join(out), sum(total + (most - n) * again for total, again, n in told)

    def _passes(self, text: str, passes: int) -> tuple[str, int, int, int]:
        """The text after its passes, the number of replacements, that of the last pass, and the number of passes."""
        total = n = k = 0
        for k in range(1, passes + 1):
            after, n = self.once(text)
            total += n
            if after == text:
                break
            text = after
        return text, total, n, k


def slices(pairs: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """``pairs`` in the order of their replacement, in lists that keep MOST_TERMS and MOST_CHARS."""
    out: list[list[tuple[str, str]]] = []
    size = 0
    for w, r in sorted(((w, r) for w, r in pairs if w and w != r), key=lambda p: -len(p[0])):
        if not out or len(out[-1]) >= MOST_TERMS or size + len(w) + len(r) > MOST_CHARS:
            out.append([])
            size = 0
        out[-1].append((w, r))
        size += len(w) + len(r)
    return out


def replace_glossary(df: DataFrame, text: str, pairs: list[tuple[str, str]], passes: int = 3) -> DataFrame:
    """``df`` with the wrong spellings of ``pairs`` (wrong, right) replaced in ``text``, and replaced, how many were; null stays null, with 0.

    Gives what ``text.replace_terms`` gives. Each run of characters that occur in some term is gone through once, and once
    more for each term in it, whatever the number of terms; what follows a replacement is looked for around it alone. A list is sent out once, after its size is checked; a longer one goes as several, one after the other.
    """
    spark, parts = df.sparkSession, slices(pairs)

    def step(some: list[tuple[str, str]], rounds: int):
        shared = spark.sparkContext.broadcast(some)

        def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            glossary = Glossary(shared.value)
            for batch in texts:
                yield pd.DataFrame([(None, 0) if t is None else glossary.apply(t, rounds) for t in batch], columns=["text", "n"])

        return F.pandas_udf(run, "text string, n long")

    rounds = [(p, passes) for p in parts] if len(parts) == 1 else [(p, 1) for _ in range(passes) for p in parts]
    out = df.withColumn("replaced", F.lit(0).cast("long"))
    for some, n in rounds:
        out = out.withColumn("_g", step(some, n)(text)).withColumn(text, F.col("_g.text")).withColumn("replaced", F.col("replaced") + F.col("_g.n")).drop("_g")
    return out


def holding(df: DataFrame, text: str, terms: list[str]) -> Column:
    """The sorted numbers of ``terms`` that ``text`` holds, as an array; none for null."""
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        patterns = Patterns(shared.value)
        for batch in texts:
            yield pd.Series([patterns.present(t or "") for t in batch], dtype=object)

    return F.pandas_udf(run, "array<int>")(text)
