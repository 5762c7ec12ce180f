"""Quotation linking: replies are attached to the messages that they quote.

A line's quote level is the number of ``>`` marks it begins with. Consecutive lines of one level form a
passage. Passages are normalised (lower case, runs of white space as one space, trimmed) and hashed. What a
message says itself (level 0) is hashed likewise: as a whole, by run between quotes, by paragraph and by line.
A quoted passage links to the first turn of its conversation that has the same hash and comes earlier; the query
links a passage that has none, such as a trimmed quote, to the first turn that says all its parts. A
message replies to its outermost quote, the latest turn if there are several. Quotes and the "wrote:" line before
them are then left out, and each conversation is put in reply order: thread by thread, in a thread by
depth, then by turn, so that a message never comes before the one it replies to.

Everything is DataFrame operations. Originals are reduced to one row per conversation and hash before
the join, so that a passage that everyone repeats adds no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordering import with_position
from .scratch import forget, materialize

MARKS = r"^(?:[ \t]*>)+"
BLANK = r"[\x20\x09-\x0D]+"


def _norm(text) -> F.Column:
    return F.trim(F.regexp_replace(F.lower(text), BLANK, " "))


def passages(messages: DataFrame) -> DataFrame:
    """mid, conv_id, turn, run, depth and text of each run of lines of one level; ``messages`` has mid, conv_id, turn, text."""
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\r\n"), F.lit("\n"))
    lines = messages.select("mid", "conv_id", "turn", F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    marks = F.regexp_extract("line", MARKS, 0)
    lines = lines.select("mid", "conv_id", "turn", "pos", (F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).alias("depth"), F.regexp_replace("line", MARKS + " ?", "").alias("line"))
    within = W.partitionBy("mid").orderBy("pos")
    named = F.col("line").rlike(r"wrote:[ \t]*$") & (F.col("depth") == 0) & (F.lead("depth").over(within) > 0)
    lines = lines.withColumn("named", F.coalesce(named, F.lit(False))).where("NOT named")
    begins = F.when(F.col("depth") == F.lag("depth").over(within), 0).otherwise(1)
    lines = lines.withColumn("begins", begins).withColumn("run", F.sum("begins").over(within))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("mid", "conv_id", "turn", "run").agg(F.first("depth").alias("depth"), joined.alias("text"))


def units(runs: DataFrame) -> DataFrame:
    """conv_id, turn and hash of all that messages say themselves."""
    own = runs.where("depth = 0")
    whole = own.groupBy("mid", "conv_id", "turn").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "\n").alias("text"))
    parts = F.array_distinct(F.concat(F.array("text"), F.split("text", r"\n[ \t]*\n"), F.split("text", r"\n")))
    units = own.select("conv_id", "turn", F.explode(parts).alias("unit")).unionByName(whole.select("conv_id", "turn", F.col("text").alias("unit")))
    units = units.select("conv_id", "turn", _norm(F.col("unit")).alias("unit")).where("unit <> ''")
    return units.select("conv_id", "turn", F.sha2("unit", 256).alias("hash"))


def originals(runs: DataFrame) -> DataFrame:
    """conv_id, hash and first turn of all that messages say themselves."""
    return units(runs).groupBy("conv_id", "hash").agg(F.min("turn").alias("source_turn"))


def links(runs: DataFrame) -> DataFrame:
    """mid, conv_id, turn, run, depth, hash and source_turn (null if unknown) of each quoted passage that is not blank."""
    quoted = runs.where("depth > 0").select("mid", "conv_id", "turn", "run", "depth", _norm(F.col("text")).alias("passage")).where("passage <> ''")
    quoted = quoted.select("mid", "conv_id", "turn", "run", "depth", F.sha2("passage", 256).alias("hash"))
    joined = quoted.join(originals(runs), ["conv_id", "hash"], "left")
    return joined.select("mid", "conv_id", "turn", "run", "depth", "hash", F.when(F.col("source_turn") < F.col("turn"), F.col("source_turn")).alias("source_turn"))


def link_parts(runs: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (links) where a passage without a source also links to the first turn that says all its paragraphs, each as a paragraph or line by line, if that turn comes earlier.

    Passages of the same lines are looked up once per conversation. Turns to be tried are those that say the
    passage's rarest paragraph or that paragraph's rarest line; all its parts are then looked up by turn.
    """
    open_ = found.where("source_turn IS NULL AND turn IS NOT NULL AND conv_id IS NOT NULL")
    if open_.isEmpty():
        return found
    lines = F.transform(F.split("text", "\n"), _norm)
    rest = runs.join(open_.select("mid", "run"), ["mid", "run"]).where(F.size(F.filter(lines, lambda x: x != "")) > 1)
    rest = materialize(rest.select("mid", "run", "conv_id", F.sha2(F.array_join(lines, "\n"), 256).alias("form"), "text"), "quote-forms")
    parts = rest.dropDuplicates(["conv_id", "form"]).select("conv_id", "form", F.posexplode(F.split("text", r"\n[ \t]*\n")).alias("part", "text"))
    own = F.transform(F.filter(F.array_distinct(lines), lambda x: x != ""), lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("hash")))
    all_ = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.sha2(_norm(F.col("text")), 256).alias("hash"))), own)
    parts = materialize(parts.where(_norm(F.col("text")) != "").select("conv_id", "form", "part", F.inline(all_)), "quote-parts")
    wanted = parts.select("conv_id", "hash").distinct()
    said = materialize(units(runs).where("turn IS NOT NULL").distinct().join(wanted, ["conv_id", "hash"], "left_semi"), "quote-units")
    known = said.groupBy("conv_id", "hash").agg(F.count("*").alias("n"))
    rated = parts.join(known, ["conv_id", "hash"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    line = F.min(F.when(~F.col("whole"), F.struct("n", "hash")))
    rated = rated.groupBy("conv_id", "form", "part").agg(F.min(F.when(F.col("whole"), F.struct("n", "hash"))).alias("a"), line.alias("b"))
    rarest = rated.groupBy("conv_id", "form").agg(F.min(F.struct((F.col("a.n") + F.col("b.n")).alias("n"), "a", "b")).alias("r")).where("r.n > 0")
    anchors = rarest.select("conv_id", "form", F.explode(F.array_distinct(F.array("r.a.hash", "r.b.hash"))).alias("hash"))
    tried = materialize(anchors.join(said, ["conv_id", "hash"]).select("conv_id", "form", "turn").distinct(), "quote-tried")
    met = tried.join(parts, ["conv_id", "form"]).join(said.withColumn("found", F.lit(True)), ["conv_id", "hash", "turn"], "left").withColumn("found", F.col("found").isNotNull())
    held = F.bool_or(F.col("whole") & F.col("found")) | F.bool_and(F.col("whole") | F.col("found"))
    held = met.groupBy("conv_id", "form", "turn", "part").agg(held.alias("held")).groupBy("conv_id", "form", "turn").agg(F.bool_and("held").alias("held"))
    first = held.where("held").groupBy("conv_id", "form").agg(F.min("turn").alias("by_parts"))
    more = rest.select("mid", "run", "conv_id", "form").join(first, ["conv_id", "form"]).select("mid", "run", "by_parts")
    earlier = F.when(F.col("by_parts") < F.col("turn"), F.col("by_parts"))
    return materialize(found.join(more, ["mid", "run"], "left").withColumn("source_turn", F.coalesce("source_turn", earlier)).drop("by_parts"), "quote-links")


def threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn, reply_depth of every reply (conv_id, turn, parent_turn), by doubling the way to the root each round."""
    state = materialize(replies.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("reply_depth")), "threads")
    written = state
    while True:
        up = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("reply_depth").alias("more"))
        moved = materialize(
            state.join(up, ["conv_id", "root_turn"], "left").select(
                "conv_id", "turn", F.coalesce("next", "root_turn").alias("root_turn"), (F.col("reply_depth") + F.coalesce("more", F.lit(0))).alias("reply_depth"), F.col("next").isNotNull().alias("moved")
            ),
            "threads",
        )
        done = moved.where("moved").isEmpty()
        forget(written)
        written, state = moved, moved.drop("moved")
        if done:
            return state


def link_quotes(messages: DataFrame, parts: bool = False) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text): conv_id, turn, role, body, n_quotes, n_linked, parent_turn, root_turn, reply_depth, position.

    body is the text without quotes, trimmed; n_quotes counts passages, n_linked those whose original is
    known. A message that quotes nothing known is the root of its own thread (parent_turn null, reply_depth
    0). Rows that share conv_id and turn are one message for replies and keep a row each. A null text is
    empty; a null conv_id or turn links to nothing; blank passages do not count; position is from 1 in each
    conversation, ties by role and body. An empty table gives no rows. With ``parts``, trimmed quotes are linked too
    (``link_parts``); without, links are those of ``ORACLE``, which knows whole passages alone.
    """
    rows = materialize(messages.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("mid")), "quote-messages")
    runs = materialize(passages(rows), "quote-passages")
    found = materialize(links(runs), "quote-links")
    found = link_parts(runs, found) if parts else found
    per = found.groupBy("mid").agg(F.count("*").alias("n_quotes"), F.count("source_turn").alias("n_linked"))
    known = found.where("source_turn IS NOT NULL")
    replies = known.groupBy("conv_id", "turn").agg(F.max_by("source_turn", F.struct(-F.col("depth"), F.col("source_turn"))).alias("parent_turn"))
    way = threads(replies)
    placed = replies.join(way, ["conv_id", "turn"])
    own = runs.where("depth = 0").groupBy("mid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "\n").alias("own"))
    body = F.regexp_replace(F.coalesce("own", F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    out = rows.select("mid", "conv_id", "turn", "role").join(own, "mid", "left").join(per, "mid", "left").join(placed, ["conv_id", "turn"], "left")
    out = out.select(
        "conv_id", "turn", "role", body.alias("body"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("reply_depth", F.lit(0)).alias("reply_depth"),
    )
    return with_position(out, "conv_id", ["root_turn", "reply_depth", "turn", "role", "body"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"), parts=True)


ORACLE = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS mid, conv_id, turn, role, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM conversations),
l0 AS (SELECT mid, conv_id, turn, unnest(ls) AS raw, unnest(range(len(ls))) AS pos FROM m),
l1 AS (
  SELECT mid, conv_id, turn, pos, len(regexp_extract(raw, '^(?:[ \t]*>)+')) - len(replace(regexp_extract(raw, '^(?:[ \t]*>)+'), '>', '')) AS depth,
         regexp_replace(raw, '^(?:[ \t]*>)+ ?', '') AS line FROM l0),
l2 AS (SELECT *, coalesce(regexp_matches(line, 'wrote:[ \t]*$') AND depth = 0 AND lead(depth) OVER w > 0, false) AS named FROM l1 WINDOW w AS (PARTITION BY mid ORDER BY pos)),
l3 AS (SELECT *, CASE WHEN depth = lag(depth) OVER w THEN 0 ELSE 1 END AS begins FROM l2 WHERE NOT named WINDOW w AS (PARTITION BY mid ORDER BY pos)),
l4 AS (SELECT *, sum(begins) OVER (PARTITION BY mid ORDER BY pos) AS run FROM l3),
runs AS (SELECT mid, conv_id, turn, run, first(depth) AS depth, string_agg(line, chr(10) ORDER BY pos) AS text FROM l4 GROUP BY ALL),
own AS (SELECT mid, conv_id, turn, string_agg(text, chr(10) ORDER BY run) AS text FROM runs WHERE depth = 0 GROUP BY ALL),
units AS (
  SELECT conv_id, turn, text AS unit FROM own
  UNION ALL SELECT conv_id, turn, text FROM runs WHERE depth = 0
  UNION ALL SELECT conv_id, turn, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) FROM runs WHERE depth = 0
  UNION ALL SELECT conv_id, turn, unnest(string_split(text, chr(10))) FROM runs WHERE depth = 0),
originals AS (
  SELECT conv_id, trim(regexp_replace(lower(unit), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm, min(turn) AS source_turn
  FROM units GROUP BY 1, 2 HAVING norm <> ''),
quoted AS (SELECT *, trim(regexp_replace(lower(text), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm FROM runs WHERE depth > 0),
links AS (
  SELECT q.mid, q.conv_id, q.turn, q.depth, CASE WHEN o.source_turn < q.turn THEN o.source_turn END AS source_turn
  FROM quoted q LEFT JOIN originals o ON q.conv_id = o.conv_id AND q.norm = o.norm WHERE q.norm <> ''),
per AS (SELECT mid, count(*) AS n_quotes, count(source_turn) AS n_linked FROM links GROUP BY mid),
replies AS (
  SELECT conv_id, turn, source_turn AS parent_turn FROM links WHERE source_turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY depth, source_turn DESC) = 1),
way AS (
  SELECT conv_id, turn, parent_turn AS root_turn, 1::BIGINT AS reply_depth FROM replies
  UNION ALL SELECT w.conv_id, w.turn, r.parent_turn, w.reply_depth + 1 FROM way w JOIN replies r ON w.conv_id = r.conv_id AND w.root_turn = r.turn),
ends AS (SELECT conv_id, turn, max(reply_depth) AS reply_depth, arg_max(root_turn, reply_depth) AS root_turn FROM way GROUP BY ALL),
f AS (
  SELECT m.conv_id, m.turn, m.role, regexp_replace(regexp_replace(coalesce(own.text, ''), '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS body,
         coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, parent_turn, coalesce(root_turn, m.turn) AS root_turn, coalesce(reply_depth, 0) AS reply_depth
  FROM m LEFT JOIN own USING (mid) LEFT JOIN per USING (mid)
  LEFT JOIN replies r ON r.conv_id = m.conv_id AND r.turn = m.turn LEFT JOIN ends e ON e.conv_id = m.conv_id AND e.turn = m.turn)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY root_turn NULLS FIRST, reply_depth, turn NULLS FIRST, role NULLS FIRST, body) AS position FROM f
"""
