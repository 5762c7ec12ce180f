"""Ordered-sequence operators over words and cues.

Rules that need only the row before are window expressions. Rules whose next step depends on what the step
before decided are folds over one episode's rows in order, as grouped pandas functions.
Words: ep, pos, text, start, end. Cues: ep, idx, start, end, text (times in seconds).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.patterns import Patterns
from ..functions.shared import spread
from ..functions.text import SOFT_BREAK, ascii_lower, display_width, fold, letters_and_digits, width
from . import episodes
from .episodes import Cue, Track

#: Words of a part of an episode, and a pause beyond every limit of the rules.
PART_WORDS, PART_PAUSE = 5000, 2.0
CUE = "ep long, idx int, start double, end double, text string"


# --- windows ---------------------------------------------------------------------------------------


def gap_segments(rows: DataFrame, key: str, start: str, end: str, gap: float) -> DataFrame:
    """Adds segment: a new one where a row starts more than ``gap`` after the latest end so far."""
    w = W.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    flag = F.when(F.col(start) - before > gap, 1).otherwise(0)
    return rows.withColumn("_f", flag).withColumn("segment", F.sum("_f").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_f")


def collapse_runs(rows: DataFrame, key: str, order: str, value: str, longest: int = 6) -> DataFrame:
    """Of each run of equal values the first ``longest`` rows, with the run's number and size."""
    w = W.partitionBy(key).orderBy(order)
    flag = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)
    runs = rows.withColumn("_f", flag).withColumn("run", F.sum("_f").over(w)).drop("_f")
    own = W.partitionBy(key, "run")
    return runs.withColumn("size", F.count("*").over(own)).withColumn("_n", F.row_number().over(own.orderBy(order))).where(F.col("_n") <= longest).drop("_n")


def collapse_repeats(text, longest: int = 6):
    """A character that repeats more than ``longest`` times in a row stays that often."""
    return F.regexp_replace(text, rf"(?s)(.)\1{{{longest},}}", "".join(["$1"] * longest))


def _runs(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """First and last content character of each text, the lengths of its first and last run, and whether it is one run; n is 0 without content."""
    for batch in texts:
        out = []
        for t in batch.fillna(""):
            runs = [(c, len(list(g))) for c, g in groupby(c for c in t if fold(c)[0])]
            out.append((runs[0][0], runs[0][1], runs[-1][0], runs[-1][1], len(runs) == 1) if runs else (None, 0, None, 0, False))
        yield pd.DataFrame(out, columns=["a", "n", "z", "m", "one"])


def _shortened(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Texts without the content characters past the limit of a run, of which ``carry`` came before the first one, and how many went."""
    for texts, carries, longest in rows:
        out = []
        for t, before, most in zip(texts.fillna(""), carries, longest):
            gone: set[int] = set()
            for _, run in groupby((i for i, c in enumerate(t) if fold(c)[0]), key=t.__getitem__):
                gone.update(islice(run, max(0, most - before), None))
                before = 0
            out.append(("".join(c for i, c in enumerate(t) if i not in gone), len(gone)))
        yield pd.DataFrame(out, columns=["text", "dropped"])


def collapse_word_repeats(words: DataFrame, longest: int = 6) -> DataFrame:
    """Words whose run of one character, over words too, stays ``longest`` long; adds dropped (characters) and content (whether any is left).

    Punctuation and spaces stay and do not break a run. Only words with content are kept by ``content``; the others
    stay as rows, so that an episode's dropped characters can be summed. Runs over words are islands of words that are one run each.
    """
    w = W.partitionBy("ep").orderBy("pos")
    r = words.withColumn("_r", F.pandas_udf(_runs, "a string, n long, z string, m long, one boolean")("text"))
    full = r.where("_r.n > 0").withColumns({"_z": F.lag("_r.z").over(w), "_m": F.lag("_r.m").over(w), "_one": F.lag("_r.one").over(w)})
    same = F.coalesce(F.col("_z") == F.col("_r.a"), F.lit(False))
    full = full.withColumn("_base", F.when(same & ~F.col("_one"), F.col("_m")).otherwise(0)).withColumn("_new", F.when(same & F.col("_one"), 0).otherwise(1))
    full = full.withColumn("_island", F.sum("_new").over(w))
    own = W.partitionBy("ep", "_island").orderBy("pos")
    before = F.coalesce(F.sum("_r.n").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.first("_base").over(own.rowsBetween(W.unboundedPreceding, 0))
    carried = full.select(*words.columns, before.alias("_carry")).unionByName(r.where("_r.n = 0").select(*words.columns, F.lit(0).cast("long").alias("_carry")))
    short = F.pandas_udf(_shortened, "text string, dropped long")("text", "_carry", F.lit(longest))
    out = carried.withColumn("_s", short).withColumn("text", F.col("_s.text")).withColumn("dropped", F.col("_s.dropped"))
    return out.select(*words.columns, "dropped").withColumn("content", F.pandas_udf(_runs, "a string, n long, z string, m long, one boolean")("text")["n"] > 0)


def reindex(cues: DataFrame) -> DataFrame:
    return cues.withColumn("idx", F.row_number().over(W.partitionBy("ep").orderBy("start", "end", "idx")))


def strip_leading(cues: DataFrame) -> DataFrame:
    """Without leading punctuation and then empty cues, renumbered."""
    bare = F.regexp_replace("text", r"^[，,、；;：:。！？!?]+\s*", "")
    return reindex(cues.withColumn("text", bare).where(F.trim("text") != ""))


def drop_phrases(words: DataFrame, phrases: list[str]) -> DataFrame:
    """Words of an episode that no occurrence of a phrase touches; phrases are compared without case, spaces and punctuation.

    All phrases are looked for in one pass over an episode; the list, a configuration, is sent out once.
    """
    shared = words.sparkSession.sparkContext.broadcast([fold(x)[0] for x in phrases])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        gone = episodes.touched(list(pdf.text.fillna("")), _patterns(shared))
        return pdf[[i not in gone for i in range(len(pdf))]]

    return _each(words, "ep").applyInPandas(run, words.schema)


def correct_words(words: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Words with wrong spellings overwritten in place, over the borders of words too; adds hits, the corrections that begin in a word. Times stay.

    Only pairs (wrong, right) whose right spelling is as long as the folded wrong one are used. All are looked for in one pass
    over an episode; the list, a configuration, is sent out once.
    """
    fit = [(n, right) for n, right in ((fold(wrong)[0], right) for wrong, right in pairs) if n and len(n) == len(right)]
    shared = words.sparkSession.sparkContext.broadcast([n for n, _ in fit])
    rights = words.sparkSession.sparkContext.broadcast(fit)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        texts, hits = episodes.corrected(list(pdf.text.fillna("")), rights.value, _patterns(shared))
        return pdf.assign(text=texts, hits=hits)

    return _each(words, "ep").applyInPandas(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in words.schema)}, hits long")


_KNOWN: dict[tuple[str, ...], Patterns] = {}


def _patterns(shared) -> Patterns:
    """The automaton of a list that was sent out, kept for a worker's next episodes."""
    key = tuple(shared.value)
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Patterns(list(key))
    return _KNOWN[key]


# --- lines ------------------------------------------------------------------------------------------


def split_at_pause(text, least: int = 200):
    """left and right of the line break nearest to the middle, the first on a tie; right begins with the break. Null below ``least`` characters or without a break."""
    sizes = F.transform(F.split(text, "\n"), lambda x: F.length(x))
    ends = F.transform(F.sequence(F.lit(1), F.size(sizes) - 1), lambda i: F.aggregate(F.slice(sizes, F.lit(1), i), i - 1, lambda s, x: s + x))
    nearest = F.array_min(F.transform(ends, lambda p: F.struct(F.abs(p - F.length(text) / 2).alias("far"), p.alias("at"))))["at"]
    both = F.struct(F.substr(text, F.lit(1), nearest).alias("left"), F.substr(text, nearest + 1).alias("right"))
    return F.when((F.length(text) >= least) & (F.size(sizes) > 1), both)


def bare_text(text):
    """Letters and digits, A-Z in lower case."""
    return ascii_lower(letters_and_digits(text))


def strip_echo(lines, before, after):
    """Lines (an array) without the first ones that ``before`` holds and the last ones that ``after`` holds, by letters and digits."""
    own = lambda side: F.transform(lines, lambda x: F.contains(bare_text(F.coalesce(side, F.lit(""))), bare_text(x)))
    # places of the first line that stays from either end, 0 if none does
    head, tail = F.array_position(own(before), False), F.array_position(F.reverse(own(after)), False)
    kept = F.size(lines) - tail - head + 2
    return F.when((head == 0) | (tail == 0) | (kept < 1), F.array().cast("array<string>")).otherwise(F.slice(lines, head.cast("int"), F.greatest(kept, F.lit(1)).cast("int")))


def dedupe_lines(rows: DataFrame, keys: list[str], text: str, least: int = 8) -> DataFrame:
    """keys, pos and line of each row's lines; of lines with equal letters and digits (``least`` or more) the first stays, blank ones go."""
    each = rows.select(*keys, F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("_bare", bare_text(F.col("line")))
    nth = F.row_number().over(W.partitionBy(*keys, "_bare").orderBy("pos"))
    return each.where(F.trim("line") != "").withColumn("_n", nth).where((F.col("_n") == 1) | (F.length("_bare") < least)).drop("_bare", "_n")


# --- grouped passes -----------------------------------------------------------------------------------


def _each(rows: DataFrame, *keys: str):
    """Groups of rows, dealt out evenly over tasks however few bytes they have."""
    return spread(rows, *keys).groupBy(*keys)


def _frame(ep, cues: list[Cue]) -> pd.DataFrame:
    return pd.DataFrame([(ep, i + 1, *c) for i, c in enumerate(cues)], columns=["ep", "idx", "start", "end", "text"])


def _pieces(pdf: pd.DataFrame, order: str) -> list[Cue]:
    pdf = pdf.sort_values(order)
    return list(zip(pdf.start, pdf.end, pdf.text.fillna("")))


def _merged(rule: Callable[[Track], list[int]], cues: DataFrame) -> DataFrame:
    def run(own: list[Cue], _: list[str]) -> list[Cue]:
        track = Track(own)
        return track.cues(rule(track))

    return _retimed(cues, None, {"ep": "long"}, run, "idx")


def absorb_fragments(cues: DataFrame) -> DataFrame:
    """Cues narrower than 2 join the next one where that begins their sentence, else the one before."""
    return _merged(episodes.without_fragments, cues)


def merge_unreadable(cues: DataFrame) -> DataFrame:
    """Cues shorter than half a second join the nearer neighbour."""
    return _merged(episodes.without_unreadable, cues)


def merge_short(cues: DataFrame) -> DataFrame:
    """Cues grow until a sentence ends, or a soft mark at width 16."""
    return _merged(episodes.without_short, cues)


def _held(cues: list[Cue], words: list[Cue], shortest: float, longest: float) -> list[Cue]:
    track = Track(words)
    return episodes.stretch_short([part for c in cues for part in episodes.split_long(c, track, longest)], shortest)


def enforce_duration(cues: DataFrame, words: DataFrame, shortest: float = 0.5, longest: float = 12.0) -> DataFrame:
    """Cuts long cues at pauses between the words, then stretches short ones."""

    def run(cue_pdf: pd.DataFrame, word_pdf: pd.DataFrame) -> pd.DataFrame:
        ep = (cue_pdf if len(cue_pdf) else word_pdf).ep.iloc[0]
        return _frame(ep, _held(_pieces(cue_pdf, "idx"), _pieces(word_pdf, "pos"), shortest, longest))

    return _each(cues.select("ep", "idx", "start", "end", "text"), "ep").cogroup(_each(words.select("ep", "pos", "start", "end", "text"), "ep")).applyInPandas(run, CUE)


def segmented(words: list[Cue], most: float = 20.0, gap: float = 0.6) -> list[Cue]:
    """Cues of ``episodes.by_width`` without space around them; those of space alone go."""
    track = Track(words)
    return [(start, end, text.strip()) for start, end, text in track.cues(episodes.by_width(track, most, gap)) if text.strip()]


def raw_segments(words: DataFrame) -> DataFrame:
    """Cues from words by pause and width."""

    return _retimed(words, None, {"ep": "long"}, lambda own, _: segmented(own))


def punctuated_cues(words: DataFrame, texts: DataFrame) -> DataFrame:
    """Cues of each episode's punctuated text (ep, text), timed by its words."""

    def run(word_pdf: pd.DataFrame, text_pdf: pd.DataFrame) -> pd.DataFrame:
        if word_pdf.empty or text_pdf.empty:
            return _frame(None, [])
        return _frame(word_pdf.ep.iloc[0], episodes.punctuated(_pieces(word_pdf, "pos"), text_pdf.text.iloc[0] or ""))

    return _each(words.select("ep", "pos", "start", "end", "text"), "ep").cogroup(_each(texts, "ep")).applyInPandas(run, CUE)


def _retimed(words: DataFrame, lines: DataFrame | None, keys: dict[str, str], rule: Callable[[list[Cue], list[str]], list[Cue]], order: str = "pos") -> DataFrame:
    """Cues that ``rule`` makes of the words (or cues) and the lines (pos, text) of each key (names and types), in order; none where there are no words.

    A key's words and lines are one row each, and a task goes through its rows in turn.
    """
    own = words.select(*keys, F.struct(order, "start", "end", "text").alias("word"))
    line = F.struct("pos", "text").alias("line")
    both = own.withColumn("line", F.lit(None).cast("struct<pos: int, text: string>")) if lines is None else own.unionByName(lines.select(*keys, line), allowMissingColumns=True)
    ordered = lambda c: F.array_sort(F.collect_list(c)).alias(f"{c}s")
    lists = _each(both, *keys).agg(ordered("word"), ordered("line")).where(F.size("words") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, fields = [], []
            for name in ("words", "lines"):
                lists_ = batch.column(name)
                ends = np.cumsum(pc.list_value_length(lists_).to_numpy(zero_copy_only=False)).tolist()
                spans.append(list(zip([0, *ends], ends)))
                flat = lists_.flatten()
                fields.append({f: flat.field(f).to_pylist() for f in ("start", "end", "text") if flat.type.get_field_index(f) >= 0})
            spoken = fields[0]
            texts, corrected = ([t or "" for t in f["text"]] for f in fields)
            out: list[tuple[int, int, float, float, str]] = []
            for row, ((a, b), (m, n)) in enumerate(zip(*spans)):
                found = rule(list(zip(spoken["start"][a:b], spoken["end"][a:b], texts[a:b])), corrected[m:n])
                out += [(row, i + 1, *c) for i, c in enumerate(found)]
            row, *columns = zip(*out) if out else [()] * 5
            at = pa.array(row, pa.int64())
            told = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), *told], [*keys, "idx", "start", "end", "text"])

    cast = [F.col(k).cast(t).alias(k) for k, t in keys.items()]
    return lists.select(*cast, "words", "lines").mapInArrow(run, ", ".join(f"{k} {t}" for k, t in keys.items()) + ", idx int, start double, end double, text string")


def align_lines(words: DataFrame, lines: DataFrame) -> DataFrame:
    """Cues of each episode's corrected lines (ep, pos, text), timed by its words; none for an episode that cannot be aligned as a whole."""
    return _retimed(words, lines, {"ep": "long"}, lambda own, texts: episodes.aligned(own, texts) or [])


def wrapped(text: str, most: float = 18.0, target: float = 20.0) -> str:
    """A text wider than ``most`` is cut nearest its middle, again while a part is wider than ``target``.

    Places are after soft marks; without any, at spaces; without these, between characters that are not both ASCII letters or digits.
    """
    if width(text) <= most or "\n" in text:
        return text
    inner = range(1, len(text))
    places = [i for i in inner if text[i - 1] in SOFT_BREAK] or [i for i in inner if text[i] == " " and i < len(text) - 1]
    places = places or [i for i in inner if not (text[i - 1 : i + 1].isascii() and text[i - 1 : i + 1].isalnum())]
    if not places:
        return text
    at = min(places, key=lambda i: abs(width(text[:i]) - width(text) / 2))
    return "\n".join(wrapped(x.strip(" "), target, target) if width(x) > target else x.strip(" ") for x in (text[:at], text[at:]))


def wrap_lines(cues: DataFrame) -> DataFrame:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else wrapped(t))

    return cues.withColumn("text", run("text"))


def chunks(words: DataFrame, size: int = 1500, hard: int = 3000, pause: float = 0.5) -> DataFrame:
    """ep, chunk, text: words joined with a line break at each pause; a chunk closes at a pause from ``size`` characters of words, anywhere from ``hard``. Without space around it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pieces = _pieces(pdf, "pos")
        out, held, n = [], "", 0
        for k, (start, _, text) in enumerate(pieces):
            rest = k > 0 and start - pieces[k - 1][1] >= pause
            if n >= hard or (rest and n >= size):
                out.append(held.strip())
                held, n = "", 0
            held += "\n" + text if rest and n else text
            n += len(text)
        found = [t for t in [*out, held.strip()] if t]
        return pd.DataFrame([(pdf.ep.iloc[0], i, t) for i, t in enumerate(found)], columns=["ep", "chunk", "text"])

    return _each(words.select("ep", "pos", "start", "end", "text"), "ep").applyInPandas(run, "ep long, chunk int, text string")


def polish_windows(words: DataFrame, size: int = 1800) -> DataFrame:
    """``words`` with window, from 0: windows follow each other without overlap, and one closes with the word that brings its characters to ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, out = batch.column("words"), []
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
            sizes = pc.fill_null(pc.utf8_length(lists.flatten().field("text")), 0).to_numpy(zero_copy_only=False)
            for a, b in zip([0, *ends], ends):
                upto = np.cumsum(sizes[a:b])
                opens, at = np.zeros(b - a, bool), 0
                while at < b - a:
                    opens[at] = True
                    at = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size)) + 1
                out.append(np.cumsum(opens) - 1)
            windows = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(np.concatenate(out) if out else [], pa.int32()))
            yield pa.RecordBatch.from_arrays([lists, windows], ["words", "windows"])

    row = F.struct("pos", *[c for c in words.columns if c != "pos"])
    lists = _each(words.select("ep", row.alias("word")), "ep").agg(F.array_sort(F.collect_list("word")).alias("words")).select("words")
    told = lists.mapInArrow(run, f"words {lists.schema['words'].dataType.simpleString()}, windows array<int>")
    each = told.select(F.explode(F.arrays_zip("words", "windows")).alias("x"))
    return each.select(*[F.col("x.words")[c].alias(c) for c in words.columns], F.col("x.windows").alias("window"))


def stitched(words: DataFrame, answers: DataFrame) -> DataFrame:
    """Cues of the words (with window) of each episode: the corrected lines of the answers (ep, window, pos, text) where a window has some that can be aligned with it, else cues by pause and width.

    Windows stand for themselves, so that an episode is no larger than its largest window here; one whose answer was refused has
    no lines. Cues are numbered through the episode, in order of windows.
    """

    def rule(own: list[Cue], lines: list[str]) -> list[Cue]:
        found = episodes.aligned(own, lines) if lines else None
        return segmented(own) if found is None else found

    cues = _retimed(words, answers, {"ep": "long", "window": "int"}, rule)
    number = F.row_number().over(W.partitionBy("ep").orderBy("window", "idx"))
    return cues.select("ep", number.alias("idx"), "start", "end", "text")


def _finished(cues: list[Cue], words: list[Cue]) -> list[Cue]:
    track = Track(cues)
    held = Track(_held(track.cues(episodes.without_fragments(track)), words, 0.5, 12.0))
    return [(s, e, wrapped(t)) for s, e, t in held.cues(episodes.without_unreadable(held))]


def episode_parts(words: DataFrame, size: int) -> DataFrame:
    """``words`` with part: runs of about ``size`` words that begin where no rule of cue_pipeline looks to the other side.

    Such a place has a pause longer than every rule's limit before it, by the latest end so far; nothing that comes later starts
    or ends earlier than its word; the words on both sides are no fragments, do not make up one word, and the one after
    it is long enough to be read. Then the cue before it and the one that begins there are neither merged nor given time from
    each other. A part is longer than ``size`` only where there is no such place.
    """
    w = W.partitionBy("ep").orderBy("pos")
    before, after = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(0, W.unboundedFollowing)
    bare = lambda c: display_width(F.trim(F.coalesce(c, F.lit("")))) >= episodes.FRAGMENT
    last = F.lag("text").over(w)
    glued = last.rlike(r"[A-Za-z0-9]\z") & F.col("text").rlike(r"\A[A-Za-z0-9]")
    apart = (F.col("start") - F.max("end").over(before) > PART_PAUSE) & (F.min("start").over(after) == F.col("start")) & (F.min("end").over(after) == F.col("end"))
    safe = F.coalesce(apart & ~glued & bare(last) & bare(F.col("text")) & (F.col("end") - F.col("start") >= 0.5), F.lit(False))
    marked = words.withColumns({"_safe": safe, "_n": F.row_number().over(w)})
    opens = F.when(F.col("_safe"), F.floor(F.col("_n") / size)).otherwise(0)
    # of the safe places inside one stretch of ``size`` words the first one opens a part
    return marked.withColumn("part", F.max(opens).over(w).cast("int")).drop("_safe", "_n")


def cue_pipeline(words: DataFrame, texts: DataFrame | None = None, part_words: int = PART_WORDS) -> DataFrame:
    """Words to cues: cut by pause and width, or by the punctuated text (ep, text) if there is one; fragments absorbed, durations held, unreadable ones merged, lines wrapped.

    An episode goes through in parts of about ``part_words`` words, with the cues of the whole; with a text it is one part.
    """
    own = words.select("ep", "pos", "start", "end", "text")
    if texts is None:
        def alone(pdf: pd.DataFrame) -> pd.DataFrame:
            pieces = _pieces(pdf, "pos")
            return _frame(pdf.ep.iloc[0], _finished(segmented(pieces), pieces)).assign(part=pdf.part.iloc[0])

        cues = _each(episode_parts(own, part_words), "ep", "part").applyInPandas(alone, f"{CUE}, part int")
        number = F.row_number().over(W.partitionBy("ep").orderBy("part", "idx"))
        return cues.select("ep", number.alias("idx"), "start", "end", "text")

    def run(word_pdf: pd.DataFrame, text_pdf: pd.DataFrame) -> pd.DataFrame:
        if word_pdf.empty or text_pdf.empty:
            return _frame(None, [])
        pieces = _pieces(word_pdf, "pos")
        return _frame(word_pdf.ep.iloc[0], _finished(episodes.punctuated(pieces, text_pdf.text.iloc[0] or ""), pieces))

    return _each(own, "ep").cogroup(_each(texts.select("ep", "text"), "ep")).applyInPandas(run, CUE)


def validate(cues: DataFrame, length: DataFrame) -> DataFrame:
    """ep, idx and rule of each breach; ``length``: ep and audio seconds.

    empty, interval, overlap (with the next), bounds (first start and last end only), line_width (> 20),
    duration (0.5 to 12), speed (> 9 a second over the whole text) and index (from 1 without gaps).
    """
    w = W.partitionBy("ep").orderBy("idx")
    rows = cues.join(length, "ep").withColumn("n", F.row_number().over(w)).withColumn("next", F.lead("start").over(w))
    rows = rows.withColumn("final", F.col("next").isNull())
    seconds = F.col("end") - F.col("start")
    lines = F.transform(F.split("text", "\n"), display_width)
    rules = {
        "empty": F.trim("text") == "",
        "interval": F.col("start") >= F.col("end"),
        "overlap": F.col("end") > F.col("next"),
        "bounds": ((F.col("n") == 1) & (F.col("start") < 0)) | (F.col("final") & (F.col("end") > F.col("seconds"))),
        "line_width": F.array_max(lines) > 20,
        "duration": (seconds < 0.5) | (seconds > 12),
        "speed": (seconds > 0) & (display_width(F.col("text")) / seconds > 9),
        "index": F.col("idx") != F.col("n"),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return rows.select("ep", "idx", F.explode(broken).alias("rule"))


def coverage(words: DataFrame, cues: DataFrame) -> DataFrame:
    """ep and share of the words' letters and digits that cues hold, at most 1; 1 where words have none."""
    size = lambda name: F.sum(F.length(F.regexp_replace("text", r"[^\p{L}\p{N}]", ""))).alias(name)
    both = words.groupBy("ep").agg(size("w")).join(cues.groupBy("ep").agg(size("c")), "ep", "left")
    return both.select("ep", F.coalesce(F.least(F.lit(1.0), F.coalesce("c", F.lit(0)) / F.nullif("w", F.lit(0))), F.lit(1.0)).alias("coverage"))
