"""Rows from HTML, wiki text, file names and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def html_rows(pages: DataFrame, key: str, html: str, pattern: str, names: list[str]) -> DataFrame:
    """key, pos and one column per group for each match of ``pattern``."""
    groups = [F.regexp_extract_all(html, F.lit(pattern), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    return pages.select(key, F.posexplode(F.arrays_zip(*groups)).alias("pos", "m")).select(key, "pos", *[f"m.{n}" for n in names])


def unescape(text):
    """The five named entities and the hard space."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def transcript_lines(pages: DataFrame, key: str, wikitext: str) -> DataFrame:
    """key, pos, speaker and line of ``* '''Name:''' words``, with links unwrapped and quote marks gone."""
    text = F.regexp_replace(wikitext, r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1")
    found = F.regexp_extract_all(text, F.lit(r"(?m)^\*+[ \t]*'''([^':]+):?'''[ \t]*:?[ \t]*(.*)$"), F.lit(1)), F.regexp_extract_all(text, F.lit(r"(?m)^\*+[ \t]*'''([^':]+):?'''[ \t]*:?[ \t]*(.*)$"), F.lit(2))
    rows = pages.select(key, F.posexplode(F.arrays_zip(found[0].alias("speaker"), found[1].alias("line"))).alias("pos", "m"))
    return rows.select(key, "pos", F.trim("m.speaker").alias("speaker"), F.trim(F.regexp_replace("m.line", "''+", "")).alias("line"))


def url_parts(url):
    """host, path and page number of an address."""
    return [
        F.regexp_extract(url, r"^https?://([^/?#]+)", 1).alias("host"),
        F.regexp_extract(url, r"^https?://[^/?#]+([^?#]*)", 1).alias("path"),
        F.regexp_extract(url, r"[?&]page=(\d+)", 1).alias("page"),
    ]


def single_source(text, patterns: list[str]):
    """The one distinct identifier that the patterns find, with an error column otherwise; as (id, error)."""
    found = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns])))
    error = F.when(F.size(found) == 0, F.lit("none")).when(F.size(found) > 1, F.concat(F.lit("several: "), F.array_join(found, ", ")))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0))), error


def episode_name(name):
    """season, episode and title of ``.._S1_ep2_(title)..``; null where the name has another form."""
    form = r"_S(\d+)_ep(\d+)_\(?([^().]+)\)?"
    got = lambda i: F.nullif(F.regexp_extract(name, form, i), F.lit(""))
    return got(1).cast("int").alias("season"), got(2).cast("int").alias("episode"), F.replace(got(3), F.lit("_"), F.lit("／")).alias("title")


def preflight(files: DataFrame, most: int = 8 * 1024**3) -> DataFrame:
    """Adds ok: a video of at most ``most`` bytes."""
    return files.withColumn("ok", F.coalesce(F.startswith("mimeType", F.lit("video/")) & (F.col("size") <= most), F.lit(False)))
