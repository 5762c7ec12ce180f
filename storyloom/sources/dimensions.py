"""Small configuration tables from YAML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def glossary(spark: SparkSession, path: str) -> DataFrame:
    """pos, correct, wrong (array), hint and note of the ordered terms of a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        terms = (yaml.safe_load(f) or {}).get("terms") or []
    rows = [(i, t["correct"], [str(w) for w in t.get("wrong") or []], bool(t.get("whisper_hint")), t.get("note")) for i, t in enumerate(terms)]
    return spark.createDataFrame(rows, "pos int, correct string, wrong array<string>, hint boolean, note string")


def taxonomy(spark: SparkSession, path: str, facets: tuple[str, ...]) -> DataFrame:
    """facet and name of a YAML file that has exactly ``facets``, each a list of unique, non-empty strings; anything else is an error."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    if set(data) != set(facets):
        raise ValueError(f"facets must be {facets}")
    for facet, names in data.items():
        if not names or any(not isinstance(n, str) or not n.strip() for n in names) or len(set(names)) != len(names):
            raise ValueError(f"names of {facet} must be unique, non-empty strings")
    return spark.createDataFrame([(f, n) for f in facets for n in data[f]], "facet string, name string")


def hint_terms(terms: DataFrame, limit: int = 224) -> DataFrame:
    """The leading hinted terms whose estimated tokens (2 a wide character, a third any other, a comma each) stay within ``limit``."""
    from ..functions.text import wide_class

    wide = F.length(F.regexp_replace("correct", f"[^{wide_class()}]", ""))
    cost = wide * 2.0 + (F.length("correct") - wide + 1) / 3.0
    run = F.sum(cost).over(W.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    return terms.where("hint").withColumn("_run", run).where(F.col("_run") <= limit).drop("_run")


def dropped_phrases(spark: SparkSession, path: str) -> DataFrame:
    """pos and phrase of the ``hallucinations`` of a glossary file, in order."""
    import yaml

    with open(path, encoding="utf-8") as f:
        phrases = (yaml.safe_load(f) or {}).get("hallucinations") or []
    return spark.createDataFrame([(i, str(p)) for i, p in enumerate(phrases)], "pos int, phrase string")


def hint_pairs(terms: DataFrame) -> DataFrame:
    """pos and hint, ``correct<-wrong/wrong`` with the first two wrong spellings, of the terms that have any."""
    return terms.where(F.size("wrong") > 0).select("pos", F.concat("correct", F.lit("<-"), F.array_join(F.slice("wrong", 1, 2), "/")).alias("hint"))


def phrases(lists: DataFrame, json: str, known: DataFrame | None = None) -> DataFrame:
    """phrase, kind and source of the entries of JSON lists; blank phrases go, and of one phrase the greatest entry stays, before ``known`` ones."""
    entry = F.from_json(json, "array<struct<phrase: string, kind: string, source: string>>")
    each = lists.select(F.inline(entry)).where(F.trim("phrase") != "")
    new = each.groupBy("phrase").agg(F.max(F.struct("kind", "source")).alias("e")).select("phrase", "e.kind", "e.source")
    return new if known is None else new.unionByName(known.join(new.select("phrase"), "phrase", "left_anti").select("phrase", "kind", "source"))
