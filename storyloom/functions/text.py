"""Text functions as column expressions; a pandas function only where Spark has no expression for the rule."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import matching

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Punctuation and spelling variants that the rules below name.
SENTENCE_END = "。！？!?…"
SOFT_BREAK = "，,、；;：:"
TURN = "／"
FULL_WIDTH = {",": "，", "?": "？", "!": "！", ";": "；", ":": "："}
VARIANTS = ["他她它牠祂", "的得地", "你妳", "那哪", "麼么", "嗎嘛", "裡里", "做作", "在再", "啦喇", "哦喔噢", "呀啊阿", "吧罷", "惟唯", "彩采", "份分"]
INITIALS = (("zh", "z"), ("ch", "c"), ("sh", "s"))
FINALS = (("ing", "in"), ("eng", "en"))


def ascii_lower(text) -> Column:
    """Lower case of A-Z alone."""
    return F.translate(text, UPPER, LOWER)


def one_upper(text) -> Column:
    """Upper case of every letter that has one of a single character; sharp s has the capital one, and others stay (Spark's ``upper`` gives several)."""
    long_ = [c for c in map(chr, range(0xDF, 0x10000)) if len(c.upper()) > 1]
    short = "".join("\u1e9e" if c == "\xdf" else c.title() if len(c.title()) == 1 else c for c in long_)
    each = F.transform(F.split(text, ""), lambda c: F.when(F.length(F.upper(c)) == 1, F.upper(c)).otherwise(F.translate(c, "".join(long_), short)))
    return F.when(F.octet_length(text) == F.length(text), F.upper(text)).otherwise(F.array_join(each, ""))


@lru_cache
def wide_class() -> str:
    """Code points that are East Asian wide or full-width, as the inside of a regular-expression class."""
    ranges, start = [], None
    for cp in range(sys.maxunicode + 2):
        wide = cp <= sys.maxunicode and unicodedata.east_asian_width(chr(cp)) in "WF"
        if wide and start is None:
            start = cp
        elif not wide and start is not None:
            ranges.append(f"\\x{{{start:X}}}-\\x{{{cp - 1:X}}}")
            start = None
    return "".join(ranges)


def wide_count(text) -> Column:
    """Number of wide characters. What lies below U+1100, where none is wide, goes first and in whole runs."""
    rest = F.regexp_replace(text, r"[\x{0}-\x{10FF}]+", "")
    found = F.length(F.regexp_replace(rest, f"[^{wide_class()}]+", ""))
    return F.when(F.octet_length(text) == F.length(text), 0).otherwise(found)


def display_width(text) -> Column:
    """1 for each wide character, 0.5 for each other one."""
    return (F.length(text) + wide_count(text)) / 2.0


def width(text: str) -> float:
    """``display_width`` of a Python string."""
    if text.isascii():
        return len(text) / 2
    return sum(1.0 if unicodedata.east_asian_width(c) in "WF" else 0.5 for c in text)


def letters_and_digits(text) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


def bigrams(text) -> Column:
    """Overlapping pairs of letters and digits; a single one stands alone; none of an empty text."""
    chars = F.filter(F.split(letters_and_digits(text), ""), lambda c: c != "")
    n = F.size(chars)
    pairs = F.zip_with(F.slice(chars, F.lit(1), n - 1), F.slice(chars, F.lit(2), n - 1), lambda a, b: F.concat(a, b))
    return F.when(n > 1, pairs).otherwise(chars)


def words(text) -> Column:
    """Runs of letters and digits, A-Z in lower case."""
    return F.filter(F.split(ascii_lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def clean_spaces(text) -> Column:
    """White-space runs as one space, trimmed, and no space between two wide characters."""
    wide = wide_class()
    return F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), f" (?<=[{wide}] )(?=[{wide}])", "")  # a space is looked for first


def full_width(text) -> Column:
    """``,?!;:`` right after a Han character become full-width."""
    for half, full in FULL_WIDTH.items():
        text = F.regexp_replace(text, rf"\Q{half}\E(?<=[\x{{3400}}-\x{{9FFF}}]\Q{half}\E)", full)
    return text


def _compatible(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield t.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def compatible(text) -> Column:
    """Compatibility form (NFKC), for which Spark has no function; plain ASCII stays without a call."""
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(F.pandas_udf(_compatible, "string")(text))


def slugify(text, longest: int = 80) -> Column:
    """Compatibility form, in which runs of punctuation, symbols, control characters and separators become one hyphen; trimmed, cut, or ``untitled``."""
    dashed = F.regexp_replace(compatible(text), r"[\p{P}\p{S}\p{C}\p{Z}]+", "-")
    cut = F.regexp_replace(F.substring(F.regexp_replace(dashed, "^-+|-+$", ""), 1, longest), "-+$", "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("untitled"))


def canonical_variants(text) -> Column:
    """Every spelling variant as the first of its set, so that equal results mean interchangeable texts."""
    return F.translate(text, "".join(v[1:] for v in VARIANTS), "".join(v[0] * (len(v) - 1) for v in VARIANTS))


def sound_key(syllable) -> Column:
    """A syllable with easily confused initials and finals merged: of each list the first that fits."""
    start, end = syllable, None
    for a, b in reversed(INITIALS):
        start = F.when(F.startswith(syllable, F.lit(a)), F.concat(F.lit(b), F.substr(syllable, F.lit(len(a) + 1)))).otherwise(start)
    end = start
    for a, b in reversed(FINALS):
        end = F.when(F.endswith(start, F.lit(a)), F.concat(F.substr(start, F.lit(1), F.length(start) - len(a)), F.lit(b))).otherwise(end)
    return end


def close_syllables(a, b) -> Column:
    """Equal, or the same initial, or the same final."""
    first = r"^(zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?"
    return (a == b) | (F.regexp_extract(a, first, 0) == F.regexp_extract(b, first, 0)) | (F.regexp_replace(a, first, "") == F.regexp_replace(b, first, ""))


def sounds_alike(a, b) -> Column:
    """Arrays of syllables of one length, of which at least one and at most half differ, each to a close one."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    differ = F.filter(pairs, lambda p: p["a"] != p["b"])
    return (F.size(a) == F.size(b)) & (F.size(differ) >= 1) & (F.size(differ) * 2 <= F.size(a)) & F.forall(differ, lambda p: close_syllables(p["a"], p["b"]))


def replace_terms(text, pairs: list[tuple[str, str]], passes: int = 3) -> tuple[Column, Column]:
    """The text with each (wrong, right) replaced, longest wrong first, up to ``passes`` times, and the number of replacements.

    Where right contains wrong, parts that are right already stay.
    """
    count = F.lit(0)
    mark = "\ufdd0"  # no character, by Unicode's own rule; texts that hold it all the same keep it escaped meanwhile
    text = F.replace(text, F.lit(mark), F.lit(mark + "0"))
    for _ in range(passes):
        for wrong, right in sorted(pairs, key=lambda p: -len(p[0])):
            if not wrong or wrong == right:
                continue
            bare = F.replace(text, F.lit(right), F.lit(mark + "1")) if wrong in right else text
            count = count + ((F.length(bare) - F.length(F.replace(bare, F.lit(wrong), F.lit("")))) / len(wrong)).cast("int")
            text = F.replace(F.replace(bare, F.lit(wrong), F.lit(right)), F.lit(mark + "1"), F.lit(right)) if wrong in right else F.replace(text, F.lit(wrong), F.lit(right))
    return F.replace(text, F.lit(mark + "0"), F.lit(mark)), count


def occurrences(text, term) -> Column:
    """How often ``term`` (not empty) occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / F.length(term)).cast("int")


def srt_timestamp(seconds) -> Column:
    """HH:MM:SS,mmm; milliseconds by half-to-even rounding. A negative time is an error."""
    ms = F.bround(seconds * 1000, 0).cast("long")
    shown = F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)
    return F.when(seconds < 0, F.raise_error(F.lit("negative time"))).otherwise(shown)


def srt_seconds(stamp) -> Column:
    part = lambda i: F.regexp_extract(stamp, r"^(\d+):(\d+):(\d+)[,.](\d+)$", i).cast("double")
    return part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000


def utc_stamp(ts) -> Column:
    """A time in ISO form with whole seconds and Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def valid_token(text) -> Column:
    """Whether the text, without space around it, is 10 to 100 ASCII letters, digits, underscores and hyphens; false for null."""
    return F.coalesce(F.trim(text).rlike(r"^[A-Za-z0-9_-]{10,100}\z"), F.lit(False))


def numbered_line(number, seconds, text) -> Column:
    """``number|m:ss|text`` with line breaks as spaces."""
    return F.concat_ws("|", number.cast("string"), clock_text(seconds), F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")))


def caption_lines(text) -> Column:
    """Lines of a caption: in corner brackets, further lines set in by a full-width space; empty lines go. Null without any."""
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    return F.when(F.size(lines) > 0, F.concat(F.lit("「"), F.array_join(lines, "\n　"), F.lit("」")))


def source_line(speaker, show, season, episode, title, seconds) -> Column:
    """Where a caption is from: speaker (if there is one), show, season, episode, title and time."""
    who = F.when(F.coalesce(speaker, F.lit("")) == "", "").otherwise(F.concat(speaker, F.lit("｜")))
    number = F.format_string("S%02d ep%03d", season, episode)
    return F.concat(F.lit("—— "), who, F.lit("《"), show, F.lit("》"), number, F.lit("〈"), title, F.lit("〉"), clock_text(seconds))


def frame_times(start, end, count: int = 6, step: float = 0.5, window: float = 3.0) -> Column:
    """``count`` times, ``step`` apart, around the middle of start and end, as an array with hundredths of a second.

    A span longer than ``count`` steps is divided evenly, and the middle of each part counts. Else all times lie within
    ``window`` of the span and not below 0, closer together where they would not fit. One time alone is the middle.
    """
    hundredths = lambda x: F.floor(x * 100 + 0.5) / 100
    if count == 1:
        return F.array(hundredths((start + end) / 2))
    lo, hi = F.greatest(start - window, F.lit(0.0)), end + window
    close = F.least(F.lit(step), (hi - lo) / (count - 1))
    first = F.least(F.greatest((start + end) / 2 - close * (count - 1) / 2, lo), hi - close * (count - 1))
    every = F.sequence(F.lit(0), F.lit(count - 1))
    long_ = F.transform(every, lambda i: hundredths(start + (i + 0.5) * (end - start) / count))
    return F.when(end - start > count * step, long_).otherwise(F.transform(every, lambda i: hundredths(first + i * close)))


def clock_seconds(text) -> Column:
    """``m:ss`` or ``ss(.f)`` to seconds."""
    parts = F.split(text, ":")
    return F.when(F.size(parts) == 2, parts[0].cast("double") * 60 + parts[1].cast("double")).otherwise(text.cast("double"))


def clock_text(seconds) -> Column:
    """m:ss with whole seconds."""
    whole = F.floor(seconds)
    return F.concat(F.floor(whole / 60).cast("string"), F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0"))


def _leaks(pairs: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for query, answer, chars in pairs:
        yield pd.Series([q is not None and a is not None and any(q[i : i + n] in a for i in range(len(q) - n + 1)) for q, a, n in zip(query, answer, chars)], dtype=bool)


def leak(query, answer, chars: int = 4) -> Column:
    """Whether any ``chars`` letters or digits in a row of the query occur so in the answer.

    A pandas function: Spark's own search for each run, in arrays, took over a hundred times as long.
    """
    fold_ = lambda c: ascii_lower(letters_and_digits(c))
    return F.pandas_udf(_leaks, "boolean")(fold_(query), fold_(answer), F.lit(chars))


def _ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Twice the matched characters over all characters, matched in the Ratcliff-Obershelp way without a popularity rule; null if one is null."""
    for a, b in pairs:
        yield pd.Series([None if x is None or y is None else matching.ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def _budgets(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Shares of the first folded text's length that the second deletes and inserts; a replacement counts its change of length."""
    for a, b in pairs:
        rows = []
        for x, y in zip(a, b):
            x, y = "".join(map(_content, x or "")), "".join(map(_content, y or ""))
            lost = more = 0
            for kind, i, j, k, m in matching.steps(x, y):
                if kind != "equal":
                    lost, more = lost + max(0, (j - i) - (m - k)), more + max(0, (m - k) - (j - i))
            rows.append((lost / len(x), more / len(x)) if x else (0.0, 0.0))
        yield pd.DataFrame(rows, columns=["deleted", "inserted"])


def _content_of(c: str, variants: dict[int, str]) -> str:
    return "".join(d for d in unicodedata.normalize("NFKC", c).translate(variants).casefold() if not d.isspace() and unicodedata.category(d)[0] not in "PZ")


@lru_cache(1 << 16)
def _content(c: str) -> str:
    """What ``fold`` makes of a character without variants."""
    return _content_of(c, {})


def fold(text: str, variants: dict[int, str] | None = None) -> tuple[str, list[int]]:
    """Compatibility form, variants folded, case folded, without punctuation, separators and spaces; and the place in ``text`` of each character."""
    parts = [_content_of(c, variants) for c in text] if variants else list(map(_content, text))
    return "".join(parts), [i for i, x in enumerate(parts) for _ in x]


def _folded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """``fold`` of each text; null is empty."""
    for t in texts:
        yield pd.DataFrame([fold(x or "") for x in t], columns=["norm", "at"])


def similarity_ratio(a, b) -> Column:
    return F.pandas_udf(_ratios, "double")(a, b)


def _bounded(pairs: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Ratio of pairs that reach the least one, else null, and whether the bound by their characters' counts let them be matched."""
    for a, b, least in pairs:
        rows = []
        for x, y, low in zip(a, b, least):
            matcher = None if x is None or y is None else SequenceMatcher(None, x, y, autojunk=False)
            matched = matcher is not None and matcher.quick_ratio() >= low
            found = matching.ratio(x, y) if matched else None
            rows.append((found if matched and found >= low else None, matched))
        yield pd.DataFrame(rows, columns=["ratio", "matched"]).astype({"ratio": "Float64"})


def similarity_at_least(a, b, least: float) -> Column:
    """ratio: ``similarity_ratio`` where it is ``least`` or more, else null; matched: whether the strings were matched at all.

    No ratio is above twice the shorter length over both lengths, which Spark compares first, nor above twice the number of
    characters they have in common in any order, which is counted before they are matched.
    """
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    lengths = F.length(a) + F.length(b)
    fits = F.when(lengths == 0, True).otherwise(2 * F.least(F.length(a), F.length(b)) >= least * lengths)
    other = F.when(fits, b)  # a null side is not looked at
    return F.pandas_udf(_bounded, "struct<ratio double, matched boolean>")(a, other, F.lit(least))


def edit_budget(a, b) -> Column:
    return F.pandas_udf(_budgets, "struct<deleted double, inserted double>")(a, b)


def normalized(text) -> Column:
    return F.pandas_udf(_folded, "struct<norm string, at array<int>>")(text)


def cosine_distance(a, b) -> Column:
    """1 - cosine of two arrays; 1 if either has no length."""
    product = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(product(a, a)) * F.sqrt(product(b, b))
    return F.when(norms == 0, 1.0).otherwise(1 - product(a, b) / norms)
