"""The registered queries over the driver's tables, each with the SQL that gives the same rows where SQL can.

Tables stand in for transcripts: ``conversations`` for cues (conv_id: episode, turn: index), ``events`` for timed words
(user_id: episode), ``documents`` and ``embeddings`` for the passage library, ``benchmark`` for queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns
from ..functions import text as T
from ..functions.shared import new_folder, spread
from ..operators import audit, index, search, segments, spans, store, versions
from ..sources import dimensions, pages, srt, subtitles

QUERIES: dict = {}
ORACLE: dict = {}
WORD = r"[^\p{L}\p{N}]+"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def words(spark: SparkSession, d: str) -> DataFrame:
    """events as words: ep, pos, text, start and end in seconds since the first event of all; a word lasts value seconds, at most 5."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    seconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)") / 1e6
    start = F.bround(seconds / 600, 3)
    pos = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("ep"), pos.alias("pos"), F.col("event_type").alias("text"), start.alias("start"), (start + F.bround(F.least("value", F.lit(50.0)) / 10, 3)).alias("end"))


WORDS_SQL = """
words AS (
  SELECT user_id AS ep, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS pos, event_type AS text, start, start + round_even(least(value, 50.0) / 10, 3) AS "end"
  FROM (SELECT *, round_even(date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6 / 600, 3) AS start FROM events))"""


def cues(spark: SparkSession, d: str) -> DataFrame:
    """conversations as cues: two cues a minute, each as long as its text at 10 characters a second, at most 30 seconds."""
    c = table(spark, d, "conversations")
    start = F.col("turn") * 30.0
    return c.select(F.col("conv_id").alias("ep"), (F.col("turn") + 1).cast("int").alias("idx"), start.alias("start"), (start + F.least(F.length("text") / 10.0, F.lit(30.0))).alias("end"), "text")


CUES_SQL = """
cues AS (
  SELECT conv_id AS ep, (turn + 1)::INT AS idx, turn * 30.0::DOUBLE AS start, turn * 30.0::DOUBLE + least(len(text) / 10.0, 30.0)::DOUBLE AS "end", text FROM conversations)"""


# --- search ----------------------------------------------------------------------------------------

WORDS_OF = "list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
BM25_SQL = f"""
WITH lists AS (SELECT doc_id AS id, {WORDS_OF} AS g FROM documents),
q AS (SELECT DISTINCT item_id AS query_id, unnest({WORDS_OF}) AS term FROM benchmark),
st AS (SELECT count(*) AS n, avg(len(g)) AS mean FROM lists),
tf AS (SELECT id, len(g) AS l, unnest(g) AS term FROM lists),
tc AS (SELECT id, l, term, count(*) AS tf FROM tf WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tc GROUP BY 1),
sc AS (SELECT query_id, id, round(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score
  FROM tc JOIN df USING (term) JOIN q USING (term), st GROUP BY 1, 2)
SELECT query_id, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM sc) WHERE rank <= 10"""


@query("bm25_topk", BM25_SQL)
def bm25_topk(spark, d, k=10):
    """Every benchmark text as a query, by words, against all documents."""
    questions = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.bm25(table(spark, d, "documents"), questions, k=k, terms_of=T.words)


@query("bm25_indexed", BM25_SQL)
def bm25_indexed(spark, d):
    """bm25_topk from a stored index, which is first that of other texts and documents and then brought up to date."""
    docs, root = table(spark, d, "documents").select("doc_id", "text"), new_folder(spark, "index")
    old = docs.select(F.when(F.col("doc_id") % 5 == 1, F.col("doc_id") + 1_000_000).otherwise(F.col("doc_id")).alias("doc_id"), F.when(F.col("doc_id") % 4 == 0, F.reverse("text")).otherwise(F.col("text")).alias("text"))
    index.update(spark, root, old, terms_of=T.words)
    index.update(spark, root, docs, terms_of=T.words)
    questions = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return index.search(spark, root, questions, terms_of=T.words)


@query("term_document_frequency", """
WITH c AS (SELECT doc_id, string_split(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'), '') AS c FROM documents),
t AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(c) > 1 THEN list_transform(list_zip(c[:-2], c[2:]), lambda p: p[1] || p[2]) ELSE c END) AS term FROM c)
SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM documents) - count(*) + 0.5) / (count(*) + 0.5) + 1), 6) AS idf FROM t WHERE term <> '' GROUP BY 1""")
def term_document_frequency(spark, d):
    """Pairs of characters, with their inverse document frequency."""
    docs = table(spark, d, "documents")
    terms = docs.select(F.explode(F.array_distinct(T.bigrams(F.col("text")))).alias("term"))
    n = docs.agg(F.count("*").alias("n"))
    counts = terms.groupBy("term").agg(F.count("*").alias("df"))
    return counts.crossJoin(F.broadcast(n)).select("term", "df", F.round(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), 6).alias("idf"))


VEC_SQL = """
parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
means AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY 1, 2),
centers AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM means GROUP BY 1),
sims AS (SELECT query_id, vec_id AS id, round(1 - list_cosine_similarity(q, list_transform(embedding, lambda x: x::DOUBLE)), 6) AS distance FROM centers, embeddings),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS rank FROM sims)"""


@query("vector_nearest", f"WITH {VEC_SQL} SELECT * FROM near WHERE rank <= 10")
def vector_nearest(spark, d, k=10):
    """The mean vector of each label as a query against all vectors."""
    e = table(spark, d, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centers = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("q"))
    return search.nearest(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), centers.select(F.col("label").alias("query_id"), "q"), k)


@query("hybrid_search", BM25_SQL.replace("SELECT query_id, id, score, rank FROM (", f", lex AS (SELECT query_id, id, rank FROM (") + ")," + VEC_SQL.lstrip().replace("WITH", "") + """,
l AS (SELECT query_id, 0 AS list, rank, id FROM near WHERE rank <= 10 UNION ALL SELECT query_id, 1, rank, id FROM lex),
f AS (SELECT query_id, id, round(sum(1 / (10 + rank)), 9) AS score, min((list, rank)) AS first FROM l GROUP BY 1, 2)
SELECT query_id, id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first)::INT AS place FROM f) WHERE place <= 10""")
def hybrid_search(spark, d):
    """Words and vectors fused; numbers of queries, documents and vectors are one space each here."""
    return search.hybrid(bm25_topk(spark, d), vector_nearest(spark, d))


@query("hybrid_candidates", ORACLE["hybrid_search"].replace("WHERE rank <= 10", "WHERE rank <= 100"))
def hybrid_candidates(spark, d):
    """hybrid_search with 100 candidates of each list before the fusion, where hybrid_search takes 10."""
    return search.hybrid(bm25_topk(spark, d, 100), vector_nearest(spark, d, 100))


@query("rrf_fusion", """
WITH d AS (SELECT lang AS query_id, doc_id AS id, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id)),
l AS (SELECT query_id, 0 AS list, id, row_number() OVER (PARTITION BY query_id ORDER BY n_chars DESC, id) AS rank FROM d
  UNION ALL SELECT query_id, 1, id, row_number() OVER (PARTITION BY query_id ORDER BY quality DESC NULLS LAST, id) FROM d),
f AS (SELECT query_id, id, round(sum(1 / (60 + rank)), 9) AS score, min((list, rank)) AS first FROM l WHERE rank <= 50 GROUP BY 1, 2)
SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first)::INT AS place FROM f""")
def rrf_fusion(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select(F.col("lang").alias("query_id"), F.col("doc_id").alias("id"), "n_chars", "quality")
    a = search.top_k(docs, "query_id", [F.desc("n_chars"), F.col("id")], 50).select("query_id", F.lit(0).alias("list"), "rank", "id")
    b = search.top_k(docs, "query_id", [F.desc_nulls_last("quality"), F.col("id")], 50).select("query_id", F.lit(1).alias("list"), "rank", "id")
    return search.fuse(a.unionByName(b))


@query("fetch_in_order", """
WITH w AS (SELECT user_id, list(event_id ORDER BY value DESC, event_id) AS ids FROM events GROUP BY 1)
SELECT user_id, pos, event_id, event_type FROM (SELECT user_id, unnest(ids) AS event_id, unnest(range(len(ids)))::INT AS pos FROM w) JOIN events e USING (user_id, event_id)""")
def fetch_in_order(spark, d):
    e = table(spark, d, "events")
    wanted = e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "event_id"))), lambda x: x["event_id"]).alias("ids"))
    return wanted.select("user_id", F.posexplode("ids").alias("pos", "event_id")).join(e.select("user_id", "event_id", "event_type"), ["user_id", "event_id"])


# --- lookups and joins over cues --------------------------------------------------------------------


@query("grep_any_term", """
SELECT conv_id, turn FROM conversations WHERE contains(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'that the') OR contains(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'de la')""")
def grep_any_term(spark, d):
    return spans.grep(table(spark, d, "conversations"), "text", ["That The", "de la"]).select("conv_id", "turn")


@query("grep_literal_percent", "SELECT doc_id FROM documents WHERE contains(text, '%%%')")
def grep_literal_percent(spark, d):
    return spans.grep(table(spark, d, "documents"), "text", ["%%%"]).select("doc_id")


@query("time_context", f"""
WITH {WORDS_SQL}, c AS (SELECT ep, (min(start) + max(start)) / 2 AS mid FROM words GROUP BY 1),
m AS (SELECT ep, pos, text, mid, start FROM words JOIN c USING (ep) WHERE start BETWEEN mid - 300 AND mid + 300)
SELECT ep, pos, text, coalesce(start = max(CASE WHEN start < mid + 1 THEN start END) OVER (PARTITION BY ep, mid), false) AS current FROM m""")
def time_context(spark, d):
    w = words(spark, d)
    at = w.groupBy("ep").agg(((F.min("start") + F.max("start")) / 2).alias("at"))
    return spans.time_context(w, at, "ep", "start", 300).select("ep", "pos", "text", "current")


@query("neighbour_context", """
SELECT conv_id, turn, coalesce(string_agg(role, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(role, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 1 FOLLOWING AND 3 FOLLOWING), '') AS after FROM conversations""")
def neighbour_context(spark, d):
    return spans.neighbours(table(spark, d, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "before", "after")


@query("span_text", """
WITH s AS (SELECT conv_id, turn AS lo, turn + 2 AS hi FROM conversations)
SELECT s.conv_id, lo, hi, string_agg(text, chr(10) ORDER BY turn) AS text, count(*) AS n FROM s JOIN conversations c ON s.conv_id = c.conv_id AND turn BETWEEN lo AND hi GROUP BY 1, 2, 3""")
def span_text(spark, d):
    c = table(spark, d, "conversations")
    wanted = c.select("conv_id", F.col("turn").alias("lo"), (F.col("turn") + 2).alias("hi"))
    return spans.span_text(wanted, c, "conv_id", "turn", "text")


@query("cross_row_match", """
WITH n AS (SELECT conv_id, turn, translate(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n FROM conversations),
o AS (SELECT *, coalesce(sum(len(n)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM n),
a AS (SELECT conv_id, strpos(string_agg(n, '' ORDER BY turn), 'thatthe') - 1 AS p FROM n GROUP BY 1)
SELECT conv_id, turn FROM o JOIN a USING (conv_id) WHERE p >= 0 AND s < p + 7 AND s + len(n) > p""")
def cross_row_match(spark, d):
    return spans.match_across(table(spark, d, "conversations"), "thatthe", "conv_id", "turn", "text").select("conv_id", "turn")


@query("nearest_row", f"""
WITH {WORDS_SQL}, c AS (SELECT ep, floor((min(start) + max("end")) * 500) / 1000 AS mid FROM words GROUP BY 1)
SELECT ep, mid AS "at", pos, text FROM words JOIN c USING (ep)
QUALIFY row_number() OVER (PARTITION BY ep ORDER BY CASE WHEN start <= mid AND mid < "end" THEN 0 ELSE 1 END, abs(start - mid), start) = 1""")
def nearest_row(spark, d):
    w = words(spark, d)
    at = w.groupBy("ep").agg((F.floor((F.min("start") + F.max("end")) * 500) / 1000).alias("at"))
    return spans.nearest_row(w, at, "ep", "start", "end").select("ep", "at", "pos", "text")


@query("interval_overlap", f"""
WITH {WORDS_SQL}, v AS (SELECT ep, pos, start AS b0, "end" AS b1 FROM words WHERE text = 'view')
SELECT w.ep, w.pos, count(*) AS n FROM words w JOIN v ON w.ep = v.ep AND start <= b1 AND b0 <= "end" WHERE w.text = 'click' GROUP BY 1, 2""")
def interval_overlap(spark, d):
    w = words(spark, d)
    a = w.where("text = 'click'").select("ep", "pos", F.col("start").alias("a0"), F.col("end").alias("a1"))
    b = w.where("text = 'view'").select("ep", F.col("start").alias("b0"), F.col("end").alias("b1"))
    return spans.overlaps(a, b, "ep", 60.0).groupBy("ep", "pos").agg(F.count("*").alias("n"))


@query("number_range_join", """
WITH r AS (SELECT n_nationkey, n_nationkey * 2 AS lo, n_nationkey * 2 + 3 AS hi FROM nation)
SELECT p_partkey, n_nationkey FROM part JOIN r ON p_size BETWEEN lo AND hi""")
def number_range_join(spark, d):
    r = table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") * 2).alias("lo"), (F.col("n_nationkey") * 2 + 3).alias("hi"))
    return spans.contained(table(spark, d, "part").select("p_partkey", "p_size"), r, "p_size", "lo", "hi", 8).select("p_partkey", "n_nationkey")


@query("equi_join", """
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')""")
def equi_join(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW"))
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name")


@query("left_join_digest", "SELECT d.doc_id, md5(text) AS digest, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def left_join_digest(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", F.md5("text").alias("digest"), "quality")


@query("existence_semi_join", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) ORDER BY doc_id")
def existence_semi_join(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi").select("doc_id", "lang").orderBy("doc_id")


@query("pending_anti_join", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti_join(spark, d):
    return store.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("stale_digest", """
SELECT d.doc_id, md5('model' || chr(10) || text) AS digest FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE md5('model' || chr(10) || text) IS DISTINCT FROM CASE WHEN quality = 1 THEN md5('model' || chr(10) || text) WHEN quality = 0 THEN 'old' END""")
def stale_digest(spark, d):
    now = table(spark, d, "documents").select("doc_id", store.doc_digest("model", F.col("text")).alias("digest"))
    old = now.join(table(spark, d, "labels"), "doc_id").select("doc_id", F.when(F.col("quality") == 1, F.col("digest")).otherwise("old").alias("digest"))
    return store.changed(now, old, "doc_id", "digest")


# --- segments, runs, validation ---------------------------------------------------------------------


@query("gap_segments", f"""
WITH {WORDS_SQL},
f AS (SELECT *, CASE WHEN start - max("end") OVER (PARTITION BY ep ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 20 THEN 1 ELSE 0 END AS f FROM words),
s AS (SELECT *, sum(f) OVER (PARTITION BY ep ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS segment FROM f)
SELECT ep, segment::BIGINT AS segment, count(*) AS n, round(min(start), 3) AS first, round(max("end"), 3) AS last FROM s GROUP BY 1, 2""")
def gap_segments(spark, d):
    s = segments.gap_segments(words(spark, d), "ep", "start", "end", 20.0)
    return s.groupBy("ep", "segment").agg(F.count("*").alias("n"), F.round(F.min("start"), 3).alias("first"), F.round(F.max("end"), 3).alias("last"))


@query("session_segments", """
WITH f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM f)
SELECT user_id, min(ts) AS first, count(*) AS n FROM s GROUP BY user_id, s""")
def session_segments(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.min("ts").alias("first"), F.count("*").alias("n")).select("user_id", "first", "n")


@query("collapse_runs", """
WITH f AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM f),
n AS (SELECT *, count(*) OVER (PARTITION BY user_id, run) AS size, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) AS k FROM r)
SELECT user_id, event_id, run::BIGINT AS run, size FROM n WHERE k <= 2""")
def collapse_runs(spark, d):
    return segments.collapse_runs(table(spark, d, "events"), "user_id", "event_id", "event_type", 2).select("user_id", "event_id", "run", "size")


@query("collapse_repeats", """
WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(len(text))) AS i FROM documents),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, c ORDER BY i) AS g FROM c), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, c, g ORDER BY i) AS k FROM r),
j AS (SELECT doc_id, string_agg(c, '' ORDER BY i) AS t FROM k WHERE k <= 6 GROUP BY 1)
SELECT doc_id, md5(coalesce(t, '')) AS digest FROM documents LEFT JOIN j USING (doc_id)""")
def collapse_repeats(spark, d):
    """A backreference; the SQL, whose engine has none, goes by islands of characters."""
    return table(spark, d, "documents").select("doc_id", F.md5(segments.collapse_repeats(F.col("text"), 6)).alias("digest"))


@query("collapse_word_repeats")
def collapse_word_repeats(spark, d):
    """Runs over the turns of a conversation; words without content are left out, their dropped characters counted; covered by tests."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("ep"), F.col("turn").alias("pos"), "text")
    return segments.collapse_word_repeats(c).select("ep", "pos", F.when(F.col("content"), F.md5("text")).alias("digest"), "dropped")


WIDTH_SQL = "(len(text) + len(regexp_replace(text, '[^WIDE]', '', 'g'))) / 2.0".replace("WIDE", T.wide_class())


@query("display_width", f"SELECT doc_id, {WIDTH_SQL}::DOUBLE AS width FROM documents")
def display_width(spark, d):
    return table(spark, d, "documents").select("doc_id", T.display_width(F.col("text")).cast("double").alias("width"))


@query("validate_cues", f"""
WITH {CUES_SQL}, l AS (SELECT ep, max("end") - 1 AS seconds FROM cues GROUP BY 1),
r AS (SELECT *, row_number() OVER w AS n, lead(start) OVER w AS nxt, ("end" - start) AS s, {WIDTH_SQL} AS width FROM cues JOIN l USING (ep) WINDOW w AS (PARTITION BY ep ORDER BY idx)),
x AS (SELECT ep, idx, unnest(list_filter([
  CASE WHEN trim(text) = '' THEN 'empty' END, CASE WHEN start >= "end" THEN 'interval' END, CASE WHEN "end" > nxt THEN 'overlap' END,
  CASE WHEN (n = 1 AND start < 0) OR (nxt IS NULL AND "end" > seconds) THEN 'bounds' END,
  CASE WHEN list_max(list_transform(string_split(text, chr(10)), lambda y: (len(y) + len(regexp_replace(y, '[^WIDE]', '', 'g'))) / 2.0)) > 20 THEN 'line_width' END,
  CASE WHEN s < 0.5 OR s > 12 THEN 'duration' END, CASE WHEN s > 0 AND width / s > 9 THEN 'speed' END, CASE WHEN idx <> n THEN 'index' END], lambda z: z IS NOT NULL)) AS rule FROM r)
SELECT ep, idx, rule FROM x""".replace("WIDE", T.wide_class()))
def validate_cues(spark, d):
    c = cues(spark, d)
    return segments.validate(c, c.groupBy("ep").agg((F.max("end") - 1).alias("seconds")))


@query("coverage", """
WITH w AS (SELECT conv_id AS ep, sum(len(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'))) AS w, sum(CASE WHEN role = 'user' THEN len(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) END) AS c FROM conversations GROUP BY 1)
SELECT ep, coalesce(least(1.0, coalesce(c, 0) / nullif(w, 0)), 1.0)::DOUBLE AS coverage FROM w""")
def coverage(spark, d):
    c = cues(spark, d)
    user = table(spark, d, "conversations").where("role = 'user'").select(F.col("conv_id").alias("ep"), "text")
    return segments.coverage(c, user)


@query("srt_timestamp", f"""
WITH {WORDS_SQL}, m AS (SELECT ep, pos, round_even(start * 1000, 0)::BIGINT AS ms FROM words)
SELECT ep, pos, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS stamp FROM m""")
def srt_timestamp(spark, d):
    return words(spark, d).select("ep", "pos", T.srt_timestamp(F.col("start")).alias("stamp"))


SRT_SQL = f"""{CUES_SQL}, b AS (
  SELECT ep, idx, list_transform([start, "end"], lambda t: printf('%02d:%02d:%02d,%03d', round_even(t * 1000, 0)::BIGINT // 3600000, round_even(t * 1000, 0)::BIGINT // 60000 % 60, round_even(t * 1000, 0)::BIGINT // 1000 % 60, round_even(t * 1000, 0)::BIGINT % 1000)) AS t, text FROM cues),
s AS (SELECT ep, string_agg(idx || chr(10) || t[1] || ' --> ' || t[2] || chr(10) || text, chr(10) || chr(10) ORDER BY idx) || chr(10) AS srt FROM b GROUP BY 1)"""


@query("srt_render", f"WITH {SRT_SQL} SELECT ep, srt FROM s")
def srt_render(spark, d):
    return subtitles.render_srt(cues(spark, d), "ep")


@query("srt_round_trip", f"""WITH {CUES_SQL} SELECT ep, idx, round(start, 3) AS start, round(round_even("end" * 1000, 0) / 1000, 3) AS "end", text FROM cues""")
def srt_round_trip(spark, d):
    out = subtitles.parse_srt(subtitles.render_srt(cues(spark, d), "ep"), "ep", "srt")
    return out.select("ep", "idx", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "text")


@query("srt_files", """
WITH t AS (SELECT 'conv-' || conv_id AS stem, turn::INT AS idx, turn * 2.5 AS start, turn * 2.5 + 1.25 AS "end", regexp_replace(text, '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text FROM conversations)
SELECT stem, idx, start::DOUBLE AS start, "end"::DOUBLE AS "end", text FROM t WHERE starts_with(stem, 'conv-1')""")
def srt_files(spark, d):
    """Conversations as a folder of SRT files, of which those are read again whose name begins with conv-1; no other file is opened."""
    c = table(spark, d, "conversations").where("turn IS NOT NULL AND conv_id IS NOT NULL")
    text = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    cues = c.select(F.concat(F.lit("conv-"), "conv_id").alias("stem"), F.col("turn").alias("idx"), (F.col("turn") * 2.5).alias("start"), (F.col("turn") * 2.5 + 1.25).alias("end"), text.alias("text"))
    folder = new_folder(spark, "srt")
    srt.write_srt(cues, folder)
    return srt.read(spark, folder, "conv-1")


@query("words_from_json", f"WITH {WORDS_SQL} SELECT ep, (pos - 1)::INT AS pos, text, round(start, 3) AS start FROM words")
def words_from_json(spark, d):
    """Word lists written as JSON, one per episode, and parsed again."""
    w = words(spark, d)
    lists = w.groupBy("ep").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text", "start", "end"))), lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["end"].alias("end")))).alias("json"))
    return subtitles.parse_words(lists, "ep", "json").select("ep", "pos", "text", F.round("start", 3).alias("start"))


@query("cue_pipeline")
def cue_pipeline(spark, d):
    return segments.cue_pipeline(words(spark, d))


SPACED_SQL = f"""RECURSIVE {WORDS_SQL},
t AS (SELECT ep, pos, start / 100 AS start, start / 100 + 0.05::DOUBLE AS "end", CASE WHEN text IN ('view', 'error') THEN text || ' ' ELSE text END AS text FROM words)"""


def spaced(spark: SparkSession, d: str) -> DataFrame:
    """Words a hundred times as dense, of which some end in a space, so that the others are parts of longer ones."""
    w = words(spark, d).withColumn("start", F.col("start") / 100).withColumn("end", F.col("start") + 0.05)
    return w.withColumn("text", F.when(F.col("text").isin("view", "error"), F.concat("text", F.lit(" "))).otherwise(F.col("text")))


@query("width_segments", f"""
WITH {SPACED_SQL}, g AS (SELECT *, text NOT LIKE '% ' AS open, sum(len(text) / 2) OVER w AS upto, start - lag("end") OVER w > 0.6 AS late FROM t WINDOW w AS (PARTITION BY ep ORDER BY pos)),
p AS (SELECT *, coalesce(max(CASE WHEN NOT glued THEN pos END) OVER (PARTITION BY ep ORDER BY pos), 1) AS run FROM (SELECT *, coalesce(lag(open) OVER (PARTITION BY ep ORDER BY pos), false) AS glued FROM g)),
rec(ep, pos, a) AS (SELECT ep, 1, 1 FROM p WHERE pos = 1 UNION ALL
  SELECT p.ep, p.pos, CASE WHEN p.late OR p.upto - o.upto + len(o.text) / 2 > 20 THEN CASE WHEN p.run > a THEN p.run ELSE p.pos END ELSE a END FROM rec JOIN p ON p.ep = rec.ep AND p.pos = rec.pos + 1 JOIN p o ON o.ep = rec.ep AND o.pos = a),
c AS (SELECT ep, a, row_number() OVER (PARTITION BY ep ORDER BY a)::INT AS idx, lead(a, 1, 1000000000) OVER (PARTITION BY ep ORDER BY a) AS b FROM (SELECT DISTINCT ep, a FROM rec))
SELECT c.ep, idx, min(start) AS start, arg_max("end", pos) AS "end", trim(string_agg(text, '' ORDER BY pos)) AS text FROM c JOIN t ON t.ep = c.ep AND pos >= a AND pos < b GROUP BY c.ep, idx""")
def width_segments(spark, d):
    """Words as cues by pause and width; the SQL goes from word to word."""
    return segments.raw_segments(spaced(spark, d))


WINDOWS_SQL = f"""{SPACED_SQL},
wr(ep, pos, win, n) AS (SELECT ep, pos, 0, len(text) FROM t WHERE pos = 1 UNION ALL
  SELECT t.ep, t.pos, CASE WHEN n >= 120 THEN win + 1 ELSE win END, CASE WHEN n >= 120 THEN len(t.text) ELSE n + len(t.text) END FROM wr JOIN t ON t.ep = wr.ep AND t.pos = wr.pos + 1),
x AS (SELECT t.*, win, row_number() OVER (PARTITION BY t.ep, win ORDER BY t.pos) AS k FROM t JOIN wr ON t.ep = wr.ep AND t.pos = wr.pos)"""


@query("polish_windows", f"WITH {WINDOWS_SQL} SELECT ep, win AS \"window\", count(*) AS n, string_agg(text, '' ORDER BY pos) AS text FROM x GROUP BY 1, 2")
def polish_windows(spark, d):
    """Words in windows of 120 characters."""
    w = segments.polish_windows(spaced(spark, d), 120)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "")
    return w.groupBy("ep", "window").agg(F.count("*").alias("n"), joined.alias("text"))


@query("stitched_cues", f"""
WITH {WINDOWS_SQL},
g AS (SELECT *, text NOT LIKE '% ' AS open, sum(len(text) / 2) OVER w AS upto, start - lag("end") OVER w > 0.6 AS late FROM x WHERE win % 2 = 1 WINDOW w AS (PARTITION BY ep, win ORDER BY k)),
p AS (SELECT *, coalesce(max(CASE WHEN NOT glued THEN k END) OVER (PARTITION BY ep, win ORDER BY k), 1) AS run FROM (SELECT *, coalesce(lag(open) OVER (PARTITION BY ep, win ORDER BY k), false) AS glued FROM g)),
rec(ep, win, k, a) AS (SELECT ep, win, 1::BIGINT, 1::BIGINT FROM p WHERE k = 1 UNION ALL
  SELECT p.ep, p.win, p.k, CASE WHEN p.late OR p.upto - o.upto + len(o.text) / 2 > 20 THEN CASE WHEN p.run > a THEN p.run ELSE p.k END ELSE a END
  FROM rec JOIN p ON p.ep = rec.ep AND p.win = rec.win AND p.k = rec.k + 1 JOIN p o ON o.ep = rec.ep AND o.win = rec.win AND o.k = a),
c AS (SELECT ep, win, a, lead(a, 1, 1000000000) OVER (PARTITION BY ep, win ORDER BY a) AS b FROM (SELECT DISTINCT ep, win, a FROM rec)
  UNION ALL SELECT DISTINCT ep, win, (k - 1) // 5 * 5 + 1, (k - 1) // 5 * 5 + 6 FROM x WHERE win % 2 = 0),
j AS (SELECT c.ep, c.win, a, min(start) AS start, arg_max("end", k) AS "end", string_agg(text, '' ORDER BY k) AS text FROM c JOIN x ON x.ep = c.ep AND x.win = c.win AND k >= a AND k < b GROUP BY 1, 2, 3)
SELECT ep, row_number() OVER (PARTITION BY ep ORDER BY win, a)::INT AS idx, round(start, 5) AS start, round("end", 5) AS "end", CASE WHEN win % 2 = 1 THEN trim(text) ELSE text END AS text FROM j""")
def stitched_cues(spark, d):
    """Every second window came back in lines of five words, the others were refused."""
    w = segments.polish_windows(spaced(spark, d), 120)
    k = F.row_number().over(W.partitionBy("ep", "window").orderBy("pos"))
    each = w.where("window % 2 = 0").select("ep", "window", F.floor((k - 1) / 5).cast("int").alias("line"), F.struct("pos", "text").alias("x"))
    lines = each.groupBy("ep", "window", F.col("line").alias("pos")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["text"]), "").alias("text"))
    return segments.stitched(w, lines).select("ep", "idx", F.round("start", 5).alias("start"), F.round("end", 5).alias("end"), "text")


@query("merge_short_cues")
def merge_short_cues(spark, d):
    return segments.merge_short(segments.raw_segments(words(spark, d)))


@query("punctuated_cues")
def punctuated_cues(spark, d):
    w = words(spark, d)
    marks = F.when(F.col("text") == "error", "。").when(F.col("text") == "view", "，").otherwise("")
    texts = w.groupBy("ep").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat("text", marks).alias("t")))), lambda x: x["t"]), "").alias("text"))
    return segments.punctuated_cues(w, texts)


@query("text_chunks", f"""
WITH RECURSIVE {WORDS_SQL}, t AS (SELECT *, coalesce(start - lag("end") OVER (PARTITION BY ep ORDER BY pos) >= 5.0, false) AS rest FROM words),
rec(ep, pos, chunk, n) AS (SELECT ep, pos, 0, len(text) FROM t WHERE pos = 1 UNION ALL
  SELECT t.ep, t.pos, CASE WHEN n >= 400 OR (rest AND n >= 200) THEN chunk + 1 ELSE chunk END, CASE WHEN n >= 400 OR (rest AND n >= 200) THEN len(text) ELSE n + len(text) END FROM rec JOIN t ON t.ep = rec.ep AND t.pos = rec.pos + 1),
x AS (SELECT t.*, chunk, row_number() OVER (PARTITION BY t.ep, chunk ORDER BY t.pos) AS k FROM t JOIN rec ON t.ep = rec.ep AND t.pos = rec.pos)
SELECT ep, chunk, string_agg(CASE WHEN rest AND k > 1 THEN chr(10) || text ELSE text END, '' ORDER BY pos) AS text FROM x GROUP BY 1, 2""")
def text_chunks(spark, d):
    return segments.chunks(words(spark, d), 200, 400, 5.0)


@query("drop_phrases", f"""
WITH {WORDS_SQL} SELECT * FROM words WINDOW w AS (PARTITION BY ep ORDER BY pos) QUALIFY NOT coalesce((text = 'click' AND lead(text) OVER w = 'view') OR (text = 'view' AND lag(text) OVER w = 'click')
  OR (text = 'error' AND lead(text) OVER w = 'purchase') OR (text = 'purchase' AND lag(text) OVER w = 'error'), false)""")
def drop_phrases(spark, d):
    return segments.drop_phrases(words(spark, d), ["click view", "Error, purchase"])


# --- text functions ----------------------------------------------------------------------------------


@query("slugify", """
WITH s AS (SELECT page_id, regexp_replace(regexp_replace(url, '[\\p{P}\\p{S}\\p{C}\\p{Z}]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM pages)
SELECT page_id, coalesce(nullif(regexp_replace(left(s, 80), '-+$', ''), ''), 'untitled') AS slug FROM s""")
def slugify(spark, d):
    return table(spark, d, "pages").select("page_id", T.slugify(F.col("url")).alias("slug"))


@query("glossary_replace", """
WITH a AS (SELECT doc_id, text, replace(text, 'tion', 'sion') AS b FROM documents)
SELECT doc_id, md5(replace(b, 'ing', 'in')) AS digest, ((len(text) - len(replace(text, 'tion', ''))) // 4 + (len(b) - len(replace(b, 'ing', ''))) // 3)::INT AS n FROM a""")
def glossary_replace(spark, d):
    text, n = T.replace_terms(F.col("text"), [("ing", "in"), ("tion", "sion")], passes=1)
    return table(spark, d, "documents").select("doc_id", F.md5(text).alias("digest"), n.alias("n"))


@query("glossary_many", """
WITH RECURSIVE w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{3,}')) AS w FROM benchmark),
t AS (SELECT row_number() OVER (ORDER BY len(w) DESC, w) AS i, w, reverse(w) AS r FROM w WHERE w <> reverse(w)), n AS (SELECT count(*) AS n FROM t),
rec(doc_id, k, text, n) AS (SELECT doc_id, 0, text, 0 FROM documents UNION ALL
  SELECT doc_id, k + 1, replace(rec.text, w, r), rec.n + (len(rec.text) - len(replace(rec.text, w, ''))) // len(w) FROM rec JOIN t ON i = k + 1)
SELECT doc_id, md5(text) AS digest, rec.n::BIGINT AS n FROM rec, n WHERE k = n.n""")
def glossary_many(spark, d):
    """Every word of the benchmark turned round in all documents, one pass."""
    lists = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{3,}"), F.lit(0))).alias("w")).distinct()
    terms = [r.w for r in lists.orderBy("w").collect()]  # a glossary, which is a configuration
    out = patterns.replace_glossary(table(spark, d, "documents").select("doc_id", "text"), "text", [(w, w[::-1]) for w in terms], passes=1)
    return out.select("doc_id", F.md5("text").alias("digest"), F.col("replaced").alias("n"))


CLEAN_SQL = "trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"
for _ in range(2):  # two places in a row share a character
    CLEAN_SQL = f"regexp_replace({CLEAN_SQL}, '([{T.wide_class()}]) ([{T.wide_class()}])', '\\1\\2', 'g')"
for _half, _full in T.FULL_WIDTH.items():
    CLEAN_SQL = f"regexp_replace({CLEAN_SQL}, '([\\x{{3400}}-\\x{{9FFF}}])[{_half}]', '\\1{_full}', 'g')"


@query("full_width_marks", f"SELECT doc_id, md5({CLEAN_SQL.replace('text', 'marked', 1)}) AS digest FROM (SELECT doc_id, translate(text, 'aeiou', '字ー界，한') AS marked FROM documents)")
def full_width_marks(spark, d):
    """Look-behind, in texts whose vowels are written as wide characters."""
    return table(spark, d, "documents").select("doc_id", F.md5(T.full_width(T.clean_spaces(F.translate("text", "aeiou", "字ー界，한")))).alias("digest"))


@query("fold_text")
def fold_text(spark, d):
    n = table(spark, d, "conversations").select("conv_id", "turn", T.normalized("text").alias("n"))
    return n.select("conv_id", "turn", "n.norm", F.size("n.at").alias("size"))


@query("sequence_ratio")
def sequence_ratio(spark, d):
    """Similarity of each page's address to the one before."""
    p = table(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))
    near = p.withColumn("before", F.lag("url").over(W.partitionBy("lang").orderBy("page_id")))
    return near.select("page_id", F.round(T.similarity_ratio("before", "url"), 6).alias("ratio"))


@query("edit_budget")
def edit_budget(spark, d):
    """What folding a title's letters and entities adds and takes away."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    b = table(spark, d, "pages").select("page_id", T.edit_budget(title, T.ascii_lower(pages.unescape(title))).alias("b"))
    return b.select("page_id", "b.deleted", "b.inserted")


@query("turn_changes")
def turn_changes(spark, d):
    """Each whole turn beside the one before it in its conversation: similarity, and shares deleted and inserted."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    near = c.withColumn("before", F.lag("text").over(W.partitionBy("conv_id").orderBy("turn"))).where("before IS NOT NULL")
    near = spread(near, "conv_id", "turn")
    b = near.select("conv_id", "turn", F.round(T.similarity_ratio("before", "text"), 6).alias("ratio"), T.edit_budget("before", "text").alias("b"))
    return b.select("conv_id", "turn", "ratio", F.round("b.deleted", 6).alias("deleted"), F.round("b.inserted", 6).alias("inserted"))


LEAKS_SQL = """
WITH q AS (SELECT item_id, translate(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS q FROM benchmark),
a AS (SELECT doc_id, translate(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS a FROM documents),
qw AS (SELECT DISTINCT item_id, substr(q, i, 12) AS w FROM (SELECT item_id, q, unnest(range(1, len(q) - 10)) AS i FROM q)),
aw AS (SELECT doc_id, substr(a, i, 12) AS w FROM (SELECT doc_id, a, unnest(range(1, len(a) - 10)) AS i FROM a)),
l AS (SELECT DISTINCT doc_id, item_id FROM aw JOIN qw USING (w))"""


@query("leak_ngrams", f"{LEAKS_SQL} SELECT doc_id, item_id FROM l")
def leak_ngrams(spark, d):
    """Pairs of a document and a benchmark item of which it holds 12 letters or digits in a row."""
    return audit.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"), 12)


@query("leak_pairs", f"{LEAKS_SQL} SELECT doc_id, coalesce((SELECT list(item_id ORDER BY item_id) FROM l WHERE l.doc_id = d.doc_id), []) AS items FROM documents d")
def leak_pairs(spark, d):
    """Each document with all benchmark items of which it holds 12 letters or digits in a row."""
    lists = leak_ngrams(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return table(spark, d, "documents").select("doc_id").join(lists, "doc_id", "left").select("doc_id", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


@query("clock_text", f"""WITH {WORDS_SQL} SELECT ep, pos, floor(floor(start) / 60)::BIGINT || ':' || lpad((floor(start)::BIGINT % 60)::VARCHAR, 2, '0') AS clock FROM words""")
def clock_text(spark, d):
    return words(spark, d).select("ep", "pos", T.clock_text(F.col("start")).alias("clock"))


# --- pages and names -----------------------------------------------------------------------------------


@query("html_rows", """
WITH m AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages)
SELECT page_id, unnest(range(len(h)))::INT AS pos, unnest(h) AS href, unnest(t) AS label FROM m""")
def html_rows(spark, d):
    return pages.html_rows(table(spark, d, "pages"), "page_id", "html", '<a href="([^"]*)">([^<]*)</a>', ["href", "label"])


@query("url_parts", """
SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '[?&]page=(\\d+)', 1) AS page FROM pages""")
def url_parts(spark, d):
    return table(spark, d, "pages").select("page_id", *pages.url_parts(F.col("url")))


@query("single_source", """
WITH f AS (SELECT page_id, list_distinct(regexp_extract_all(html, '<a href="/([a-z]+)">', 1)) AS f FROM pages)
SELECT page_id, CASE WHEN len(f) = 1 THEN f[1] END AS id, len(f) = 1 AS ok FROM f""")
def single_source(spark, d):
    found, error = pages.single_source(F.col("html"), ['<a href="/([a-z]+)">'])
    return table(spark, d, "pages").select("page_id", found.alias("id"), error.isNull().alias("ok"))


@query("unescape_titles", """
SELECT page_id, replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS title FROM pages""")
def unescape_titles(spark, d):
    return table(spark, d, "pages").select("page_id", pages.unescape(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


# --- audit, evaluation, tables ---------------------------------------------------------------------------


@query("audit_rollup", """SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS n FROM lineitem WHERE l_discount > 0.02 GROUP BY 1, 2, 3 ORDER BY n DESC, 1, 2, 3 LIMIT 30""")
def audit_rollup(spark, d):
    return audit.rollup(table(spark, d, "lineitem").where("l_discount > 0.02"), ["l_returnflag", "l_linestatus", "l_quantity"], 30)


@query("row_counts", "SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'conversations', count(*) FROM conversations")
def row_counts(spark, d):
    one = lambda n: table(spark, d, n).agg(F.lit(n).alias("name"), F.count("*").alias("n"))
    return one("documents").unionByName(one("events")).unionByName(one("conversations"))


@query("hit_at_k_mrr", """
WITH r AS (SELECT lang, CASE WHEN quality IS NULL THEN NULL ELSE 1 + n_chars % 40 END AS rank FROM documents LEFT JOIN labels USING (doc_id))
SELECT coalesce(lang, 'all') AS lang, count(*) AS n, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS hit_1, round(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS hit_5,
  round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS hit_10, round(avg(CASE WHEN rank <= 30 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS hit_30, round(avg(coalesce(1 / rank, 0)), 6)::DOUBLE AS mrr
FROM r GROUP BY ROLLUP (lang)""")
def hit_at_k_mrr(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return audit.hit_rates(docs.select("lang", F.when(F.col("quality").isNotNull(), 1 + F.col("n_chars") % 40).alias("rank")), "lang")


@query("stratified_sample", """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id), doc_id) AS k FROM documents)
SELECT doc_id, source FROM o WHERE k = 1 ORDER BY md5('8:' || doc_id), doc_id LIMIT 10""")
def stratified_sample(spark, d):
    return audit.stratified_sample(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 10, 7)


@query("accept_spans", """
WITH s AS (SELECT conv_id, turn AS pos, turn // 2 * 2 AS lo, turn // 2 * 2 + turn % 3 AS hi, CASE WHEN turn % 5 = 4 THEN NULL ELSE turn % 4 + 2 END AS score, [role] AS tags FROM conversations),
g AS (SELECT s.*, (SELECT count(*) FROM conversations c WHERE c.conv_id = s.conv_id AND c.turn BETWEEN lo AND hi) AS n FROM s),
m AS (SELECT *, CASE WHEN NOT (lo <= hi AND hi - lo < 8 AND n = hi - lo + 1 AND tags[1] IN ('user', 'assistant')) THEN 'rejected' WHEN score IS NULL OR score < 3 THEN 'low' ELSE 'ok' END AS status FROM g)
SELECT conv_id, pos, lo, hi, CASE WHEN status = 'ok' AND row_number() OVER (PARTITION BY conv_id, lo, hi, status ORDER BY pos) > 1 THEN 'repeated' ELSE status END AS status FROM m""")
def accept_spans(spark, d):
    c = table(spark, d, "conversations")
    lo = F.floor(F.col("turn") / 2) * 2
    s = c.select("conv_id", F.col("turn").alias("pos"), lo.alias("lo"), (lo + F.col("turn") % 3).alias("hi"), F.when(F.col("turn") % 5 != 4, F.col("turn") % 4 + 2).alias("score"), F.array("role").alias("tags"))
    return audit.accept_spans(s, c, "conv_id", "turn", ["user", "assistant"]).select("conv_id", "pos", "lo", "hi", "status")


@query("vote_join", """
WITH d AS (SELECT doc_id AS row_id, regexp_split_to_array(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS u FROM documents),
b AS (SELECT item_id AS ref_id, regexp_split_to_array(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS u FROM benchmark),
du AS (SELECT row_id, len(u) AS l, unnest(u) AS unit, unnest(range(len(u))) AS i FROM d), bu AS (SELECT ref_id, len(u) AS n, unnest(u) AS unit, unnest(range(len(u))) AS j FROM b WHERE len(u) >= 4),
v AS (SELECT row_id, ref_id, i - j AS p, n, count(*) AS votes FROM du JOIN bu USING (unit) WHERE i - j >= 0 AND i - j + n <= l GROUP BY ALL HAVING count(*) * 2 >= n)
SELECT row_id, ref_id, p::INT AS "at", votes FROM v QUALIFY row_number() OVER (PARTITION BY row_id, ref_id ORDER BY votes DESC, p) = 1""")
def vote_join(spark, d):
    """Whole benchmark texts as references against all documents."""
    units = lambda c: F.split(F.trim(F.regexp_replace(T.ascii_lower(F.col(c)), WORD, " ")), " ")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), units("text").alias("units"))
    refs = table(spark, d, "benchmark").select(F.col("item_id").alias("ref_id"), units("text").alias("units"))
    return audit.best_window(audit.votes(rows, refs)).select("row_id", "ref_id", "at", "votes")


@query("homophone_groups", """
WITH d AS (SELECT regexp_split_to_array(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS u FROM documents),
w AS (SELECT unnest(flatten(list_transform([1, 2], lambda k: list_transform(range(1, greatest(len(u) - k + 2, 1)), lambda i: u[i:i + k - 1])))) AS r FROM d),
c AS (SELECT array_to_string(list_transform(r, lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^zh', 'z'), '^ch', 'c'), '^sh', 's'), 'ing$', 'in'), 'eng$', 'en')), ' ') AS sound,
  array_to_string(r, ' ') AS text, count(*) AS n FROM w GROUP BY 1, 2),
t AS (SELECT sound, arg_max(text, (n, text)) AS major, max(n) AS major_n FROM c GROUP BY 1 HAVING count(*) > 1)
SELECT sound, text, n, major, major_n, round(major_n / (major_n + n), 3) AS score FROM c JOIN t USING (sound) WHERE major_n >= 10 AND n <= 3 AND major_n >= 10 * n AND text <> major""")
def homophone_groups(spark, d):
    """Words and pairs of words of all documents, by merged sounds."""
    rows = table(spark, d, "documents").select(F.split(F.trim(F.regexp_replace(T.ascii_lower(F.col("text")), WORD, " ")), " ").alias("units"))
    return audit.homophones(rows, T.sound_key, (1, 2))


@query("homophone_suspects", """
WITH d AS (SELECT doc_id, regexp_split_to_array(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS u FROM documents),
w AS (SELECT doc_id, unnest(flatten(list_transform([3, 4, 5], lambda k: list_transform(range(1, greatest(len(u) - k + 2, 1)), lambda i: u[i:i + k - 1])))) AS r FROM d),
c AS (SELECT array_to_string(list_transform(r, lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^zh', 'z'), '^ch', 'c'), '^sh', 's'), 'ing$', 'in'), 'eng$', 'en')), ' ') AS sound,
  array_to_string(r, ' ') AS text, count(*) AS n FROM w GROUP BY 1, 2),
t AS (SELECT sound, arg_max(text, (n, text)) AS major, max(n) AS major_n FROM c GROUP BY 1 HAVING count(*) > 1),
m AS (SELECT text, n, major, major_n, round(major_n / (major_n + n), 3) AS score FROM c JOIN t USING (sound) WHERE major_n >= 10 AND n <= 3 AND major_n >= 10 * n AND text <> major),
o AS (SELECT DISTINCT doc_id AS row_id, m.* FROM (SELECT doc_id, array_to_string(r, ' ') AS text FROM w) JOIN m USING (text))
SELECT * FROM o a WHERE NOT EXISTS (SELECT 1 FROM o b WHERE a.row_id = b.row_id AND contains(b.text, a.text) AND len(b.text) > len(a.text))""")
def homophone_suspects(spark, d):
    """Runs of three to five words of all documents, by merged sounds."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), F.split(F.trim(F.regexp_replace(T.ascii_lower(F.col("text")), WORD, " ")), " ").alias("units"))
    return audit.homophone_suspects(rows, T.sound_key)


@query("nested_drop", """
WITH t AS (SELECT DISTINCT page_id AS k, unnest(regexp_extract_all(url, '[a-z]+', 0)) AS t FROM pages)
SELECT k, t FROM t a WHERE NOT EXISTS (SELECT 1 FROM t b WHERE a.k = b.k AND contains(b.t, a.t) AND (len(b.t) > len(a.t)))""")
def nested_drop(spark, d):
    t = table(spark, d, "pages").select(F.col("page_id").alias("k"), F.explode(F.regexp_extract_all("url", F.lit("[a-z]+"), F.lit(0))).alias("t")).distinct()
    return audit.drop_nested(t, "k", "t", "t")


@query("first_wins", "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_wins(spark, d):
    return audit.first_wins(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("union_and_difference", """
SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier EXCEPT ALL SELECT n_nationkey FROM nation""")
def union_and_difference(spark, d):
    both = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).unionByName(table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")))
    return both.exceptAll(table(spark, d, "nation").select(F.col("n_nationkey").alias("nation")))


@query("latest_upsert", """
WITH b AS (SELECT user_id, event_type, value, event_id, 0 AS n FROM events UNION ALL SELECT user_id, event_type, value + 1, event_id, 1 FROM events WHERE event_type = 'click')
SELECT user_id, event_type, value, event_id FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC, n DESC) = 1""")
def latest_upsert(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "value", "event_id")
    return store.upsert(e, e.where("event_type = 'click'").withColumn("value", F.col("value") + 1), ["user_id", "event_type"], "event_id")


@query("insert_missing", """
SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def insert_missing(spark, d):
    return store.insert_missing(table(spark, d, "labels").select("doc_id", "quality"), table(spark, d, "documents").select("doc_id", F.lit(-1).alias("quality")), ["doc_id"])


@query("replace_partition", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%') UNION ALL SELECT o_orderkey, 'N' FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderstatus = 'F'""")
def replace_partition(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = o.where("o_orderpriority LIKE '1%' AND o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("N"))
    return store.replace_partition(o, new, "o_orderpriority").select("o_orderkey", "o_orderstatus")


@query("retention_keep_n", """
WITH f AS (SELECT event_id, 'backup-' || strftime(ts, '%Y-%m-%d') || '.db' AS name FROM events)
SELECT name, count(*) AS n FROM f WHERE name NOT IN (SELECT DISTINCT name FROM f ORDER BY 1 DESC LIMIT 8) GROUP BY 1""")
def retention_keep_n(spark, d):
    f = table(spark, d, "events").select(F.concat(F.lit("backup-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".db")).alias("name"))
    return store.retired(f, "name", r"^backup-\d{4}-\d\d-\d\d\.db$", 8).groupBy("name").agg(F.count("*").alias("n"))


@query("keyset_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 2000")
def keyset_page(spark, d):
    """One page of a keyed read: the limit is the feature."""
    return store.page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500, 2000)


@query("grouped_lookup", "SELECT source, doc_id // 1000 AS part, count(*) AS n, md5(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS ids FROM documents GROUP BY 1, 2")
def grouped_lookup(spark, d):
    """Lists in parts of a thousand numbers, so that a hot source is no single list."""
    g = store.lookup_lists(table(spark, d, "documents"), "source", "doc_id", part=F.floor(F.col("doc_id") / 1000))
    return g.select("source", "part", F.size("items").cast("long").alias("n"), F.md5(F.array_join(F.transform("items", lambda x: x["doc_id"].cast("string")), ",")).alias("ids"))


@query("failure_breaker", """
WITH r AS (SELECT user_id, event_id, event_type = 'error' AS bad FROM events),
s AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM r),
n AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, s ORDER BY event_id) AS n FROM s),
t AS (SELECT *, min(CASE WHEN n >= 3 THEN event_id END) OVER (PARTITION BY user_id) AS stop FROM n)
SELECT user_id, event_id FROM t WHERE stop IS NULL OR event_id <= stop""")
def failure_breaker(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("bad"))
    return store.breaker(e, "user_id", "event_id", "bad").select("user_id", "event_id")


@query("token_cost", "SELECT lang, round(sum(n_chars / 1e6 * 0.14 + len(source) / 1e6 * 0.28), 6) AS cost FROM documents GROUP BY 1")
def token_cost(spark, d):
    return store.token_cost(table(spark, d, "documents").withColumn("answer", F.length("source")), ["lang"], "n_chars", "answer")


@query("chunk_plan", f"""
WITH {WORDS_SQL}, l AS (SELECT ep, max("end") AS total, ceil(max("end") / 1000)::INT AS n FROM words GROUP BY 1),
g AS (SELECT ep, total, unnest(range(1, n)) * total / n AS target FROM l),
c AS (SELECT DISTINCT g.ep, total, arg_min(w.start, (abs(w.start - target), w.start)) AS cut FROM g JOIN words w USING (ep) GROUP BY g.ep, total, target)
SELECT ep, round(cut, 3) AS lo, round(lead(cut, 1, total) OVER (PARTITION BY ep ORDER BY cut), 3) AS hi FROM (SELECT * FROM c UNION SELECT ep, total, 0.0 FROM l)""")
def chunk_plan(spark, d):
    """Parts of at most about 1000 seconds, each ideal cut moved to the nearest word start."""
    w = words(spark, d)
    total = w.groupBy("ep").agg(F.max("end").alias("total"))
    n = F.ceil(F.col("total") / 1000)
    goals = total.where(n > 1).select("ep", "total", F.explode(F.transform(F.sequence(F.lit(1), (n - 1).cast("int")), lambda i: i * F.col("total") / n)).alias("target"))
    cuts = goals.join(w, "ep").groupBy("ep", "total", "target").agg(F.min_by("start", F.struct(F.abs(F.col("start") - F.col("target")), "start")).alias("cut")).select("ep", "total", "cut")
    cuts = cuts.unionByName(total.select("ep", "total", F.lit(0.0).alias("cut"))).distinct()
    return cuts.select("ep", F.round("cut", 3).alias("lo"), F.round(F.coalesce(F.lead("cut").over(W.partitionBy("ep").orderBy("cut")), "total"), 3).alias("hi"))


@query("frame_times", f"""
WITH {WORDS_SQL}, x AS (SELECT ep, pos, start AS s, start + ("end" - start) / 3 AS e FROM words),
f AS (SELECT *, greatest(s - 0.5::DOUBLE, 0.0::DOUBLE) AS lo, e + 0.5::DOUBLE AS hi FROM x), c AS (SELECT *, least(0.4::DOUBLE, (hi - lo) / 5) AS c FROM f),
g AS (SELECT *, least(greatest((s + e) / 2 - c * 5 / 2, lo), hi - c * 5) AS first FROM c)
SELECT ep, pos, list_transform(range(6), lambda i: CASE WHEN e - s > 6 * 0.4::DOUBLE THEN floor((s + (i + 0.5::DOUBLE) * (e - s) / 6) * 100 + 0.5::DOUBLE) / 100 ELSE floor((first + i * c) * 100 + 0.5::DOUBLE) / 100 END) AS times FROM g""")
def frame_times(spark, d):
    """Six times in or around a third of each word, inside half a second of it."""
    w = words(spark, d).withColumn("end", F.col("start") + (F.col("end") - F.col("start")) / 3)
    return w.select("ep", "pos", T.frame_times(F.col("start"), F.col("end"), 6, 0.4, 0.5).alias("times"))


@query("offset_merge", f"""WITH {WORDS_SQL} SELECT ep, pos, round_even(start + ep * 1000.0, 3) AS start FROM words""")
def offset_merge(spark, d):
    return words(spark, d).select("ep", "pos", F.bround(F.col("start") + F.col("ep") * 1000.0, 3).alias("start"))


@query("windowed_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    from ..streaming.incremental import windowed_counts as counts

    return counts(table(spark, d, "events"), "ts", "event_type").select(F.col("window.start").alias("hour"), "event_type", "n")


# --- lines, corrections, alignment ------------------------------------------------------------------------

BARE = "translate(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("split_at_pause", """
WITH p AS (SELECT conv_id, turn, text, list_filter(range(len(text)), lambda i: substr(text, i + 1, 1) = chr(10)) AS p FROM conversations),
b AS (SELECT *, CASE WHEN len(text) >= 200 AND len(p) > 0 THEN list_min(list_transform(p, lambda i: {'far': abs(i - len(text) / 2), 'at': i})).at END AS b FROM p)
SELECT conv_id, turn, substr(text, 1, b) AS "left", CASE WHEN b IS NOT NULL THEN substr(text, b + 1) END AS "right" FROM b""")
def split_at_pause(spark, d):
    s = table(spark, d, "conversations").select("conv_id", "turn", segments.split_at_pause(F.col("text")).alias("s"))
    return s.select("conv_id", "turn", "s.left", "s.right")


@query("strip_echo", f"""
WITH n AS (SELECT conv_id, turn, string_split(text, chr(10)) AS l, {BARE.format("coalesce(lag(text) OVER w, '')")} AS p, {BARE.format("coalesce(lead(text) OVER w, '')")} AS q
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
e AS (SELECT *, coalesce(list_position(list_transform(l, lambda x: contains(p, {BARE.format("x")})), false), 0) AS head,
  coalesce(list_position(list_reverse(list_transform(l, lambda x: contains(q, {BARE.format("x")}))), false), 0) AS tail FROM n)
SELECT conv_id, turn, CASE WHEN head = 0 OR tail = 0 OR len(l) - tail + 1 < head THEN '' ELSE array_to_string(l[head:len(l) - tail + 1], chr(10)) END AS text FROM e""")
def strip_echo(spark, d):
    """Lines of a turn that do not repeat the end of the turn before or the beginning of the next."""
    w = W.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("lines"), F.lag("text").over(w).alias("before"), F.lead("text").over(w).alias("after"))
    return c.select("conv_id", "turn", F.array_join(segments.strip_echo(F.col("lines"), F.col("before"), F.col("after")), "\n").alias("text"))


@query("dedupe_lines", f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
e AS (SELECT doc_id, (unnest(range(len(l))))::INT AS pos, unnest(l) AS line FROM l),
n AS (SELECT *, {BARE.format("line")} AS bare FROM e WHERE trim(line) <> '')
SELECT doc_id, pos, md5(line) AS digest FROM n QUALIFY row_number() OVER (PARTITION BY doc_id, bare ORDER BY pos) = 1 OR len(bare) < 8""")
def dedupe_lines(spark, d):
    return segments.dedupe_lines(table(spark, d, "documents"), ["doc_id"], "text").select("doc_id", "pos", F.md5("line").alias("digest"))


@query("align_lines")
def align_lines(spark, d):
    """Words of an episode, five a line and one letter of each seventh changed, with their times again; checked by value in the tests."""
    w = words(spark, d)
    changed = F.when(F.col("pos") % 7 == 0, F.concat(F.lit("x"), F.substr("text", F.lit(2)))).otherwise(F.col("text"))
    each = w.select("ep", F.floor((F.col("pos") - 1) / 5).cast("int").alias("pos"), F.struct(F.col("pos").alias("i"), changed.alias("t")).alias("x"))
    lines = each.groupBy("ep", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("text"))
    return segments.align_lines(w, lines)


@query("correct_words", f"""
WITH {WORDS_SQL}, n AS (SELECT *, coalesce(text = 'click' AND lead(text) OVER w = 'view', false) AS a, coalesce(text = 'view' AND lag(text) OVER w = 'click', false) AS b, coalesce(text = 'error' AND lead(text) OVER w = 'purchase', false) AS c FROM words WINDOW w AS (PARTITION BY ep ORDER BY pos))
SELECT ep, pos, CASE WHEN a OR b THEN upper(text) WHEN c THEN 'err-r' ELSE text END AS text, start, "end", (CASE WHEN a OR c THEN 1 ELSE 0 END)::BIGINT AS hits FROM n""")
def correct_words(spark, d):
    """Spellings of one length over the borders of words; checked by value in the tests."""
    return segments.correct_words(words(spark, d), [("clickview", "CLICKVIEW"), ("rorp", "r-rp")])


@query("reading_speed", f"""WITH {CUES_SQL} SELECT ep, idx, round({WIDTH_SQL} / ("end" - start), 6)::DOUBLE AS speed FROM cues WHERE "end" > start""")
def reading_speed(spark, d):
    c = cues(spark, d).where(F.col("end") > F.col("start"))
    return c.select("ep", "idx", F.round(T.display_width(F.col("text")) / (F.col("end") - F.col("start")), 6).alias("speed"))


@query("numbered_lines", f"""
WITH {CUES_SQL}, l AS (SELECT ep, idx, idx || '|' || (floor(start / 60)::BIGINT || ':' || lpad((floor(start)::BIGINT % 60)::VARCHAR, 2, '0')) || '|' || replace(text, chr(10), ' ') AS line FROM cues)
SELECT ep, string_agg(line, chr(10) ORDER BY idx) AS lines FROM l GROUP BY 1""")
def numbered_lines(spark, d):
    c = cues(spark, d).select("ep", F.struct("idx", T.numbered_line(F.col("idx"), F.col("start"), F.col("text")).alias("line")).alias("x"))
    return c.groupBy("ep").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n").alias("lines"))


UNITS_OF = "regexp_split_to_array(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"


@query("suspects", f"""
WITH d AS (SELECT doc_id AS row_id, {UNITS_OF} AS u FROM documents), b AS (SELECT item_id AS ref_id, {UNITS_OF} AS u FROM benchmark),
r AS (SELECT ref_id, [CASE WHEN i % 3 = 0 THEN translate(u[i], 'ei', 'ie') ELSE u[i] END for i in range(1, len(u) + 1)] AS u, len(u) AS n FROM b WHERE len(u) >= 4),
rs AS (SELECT *, list_transform(u, lambda x: replace(x, 'i', 'e')) AS s FROM r), w AS (SELECT row_id, u, unnest(range(1, len(u) + 1)) AS i FROM d),
m AS (SELECT row_id, ref_id, (w.i - 1)::INT AS "at", w.u[w.i:w.i + n - 1] AS own, rs.u AS ref FROM w JOIN rs ON replace(w.u[w.i], 'i', 'e') = rs.s[1] AND list_transform(w.u[w.i:w.i + n - 1], lambda x: replace(x, 'i', 'e')) = s),
c AS (SELECT *, count(*) OVER (PARTITION BY ref_id, own) AS c, bool_or(own = ref) OVER (PARTITION BY row_id, ref_id) AS held FROM m)
SELECT row_id, ref_id, "at", md5(array_to_string(own, ' ')) AS heard, 1.0::DOUBLE AS score FROM c WHERE c <= 8 AND NOT held QUALIFY row_number() OVER (PARTITION BY row_id, ref_id ORDER BY "at") = 1""")
def suspects(spark, d):
    """Runs of words in documents that sound like a benchmark text in which every third word has e and i exchanged, which sound alike."""
    units = lambda c: F.split(F.trim(F.regexp_replace(T.ascii_lower(F.col(c)), WORD, " ")), " ")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), units("text").alias("units"))
    misheard = F.transform(units("text"), lambda x, i: F.when(i % 3 == 2, F.translate(x, "ei", "ie")).otherwise(x))
    refs = table(spark, d, "benchmark").select(F.col("item_id").alias("ref_id"), misheard.alias("units"))
    return audit.suspects(rows, refs, lambda x: F.replace(x, F.lit("i"), F.lit("e")), ratio=1.0).select("row_id", "ref_id", "at", F.md5("heard").alias("heard"), "score")


@query("apply_fixes", """
WITH c AS (SELECT conv_id || ':' || turn AS id, text, regexp_extract(text, '^(\\p{L}{4,})', 1) AS w FROM conversations), t AS (SELECT *, left(w, len(w) - 2) || reverse(right(w, 2)) AS r FROM c)
SELECT id, md5(CASE WHEN w <> '' AND w <> r THEN replace(text, w, r) ELSE text END) AS digest, (CASE WHEN w <> '' THEN CASE WHEN w <> r THEN 1 ELSE 0 END END)::BIGINT AS applied FROM t""")
def apply_fixes(spark, d):
    """Each turn's first word, proposed as its ending turned round, with and without a mark; checked by value in the tests."""
    c = table(spark, d, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("id"), "text")
    first = F.regexp_extract("text", r"^(\p{L}{4,})", 1)
    turned = F.concat(F.expr("substr(w, 1, length(w) - 2)"), F.reverse(F.expr("substr(w, length(w) - 1)")))
    p = c.select("id", first.alias("w")).where("w <> ''").select("id", F.posexplode(F.array(F.struct(F.col("w").alias("wrong"), turned.alias("right")), F.struct(F.col("w").alias("wrong"), F.concat("w", F.lit("!")).alias("right")))).alias("pos", "x")).select("id", "pos", "x.*")
    fixed, done = audit.apply_fixes(c, p, T.ascii_lower)
    return fixed.join(done.groupBy("id").agg(F.sum(F.col("applied").cast("int")).alias("applied")), "id", "left").select("id", F.md5("text").alias("digest"), "applied")


# --- records and small checks -------------------------------------------------------------------------------


@query("taxonomy_check", """
WITH t AS (SELECT 'lang' AS facet, lang AS name FROM documents UNION ALL SELECT 'role', role FROM conversations)
SELECT facet, name, count(*) AS n FROM t WHERE (facet, name) NOT IN (('lang', 'en'), ('lang', 'de'), ('role', 'user')) GROUP BY 1, 2""")
def taxonomy_check(spark, d):
    """Names that a closed list of each facet lacks, with their number."""
    allowed = spark.createDataFrame([("lang", "en"), ("lang", "de"), ("role", "user")], "facet string, name string")
    used = table(spark, d, "documents").select(F.lit("lang").alias("facet"), F.col("lang").alias("name")).unionByName(table(spark, d, "conversations").select(F.lit("role").alias("facet"), F.col("role").alias("name")))
    return used.groupBy("facet", "name").agg(F.count("*").alias("n")).join(F.broadcast(allowed), ["facet", "name"], "left_anti")


@query("bridge_rows", """
WITH t AS (SELECT DISTINCT 'lang' AS facet, lang AS name FROM documents UNION SELECT DISTINCT 'source', source FROM documents),
q AS (SELECT doc_id, 'lang' AS facet, lang AS name FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents)
SELECT doc_id, md5(t.facet || ':' || t.name) AS tag FROM q, t WHERE q.facet = t.facet AND q.name = t.name""")
def bridge_rows(spark, d):
    """Rows between documents and tags, by facet and name."""
    facets = table(spark, d, "documents").select("doc_id", F.inline(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("name")) for c in ("lang", "source")])))
    tags = facets.select("facet", "name").distinct().withColumn("tag", F.md5(F.concat("facet", F.lit(":"), "name")))
    return facets.join(tags, ["facet", "name"]).select("doc_id", "tag")


@query("one_by_fragment", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = (SELECT min(o_orderpriority) FROM orders WHERE contains(o_orderpriority, '1-UR'))")
def one_by_fragment(spark, d):
    return spans.one_by_fragment(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "1-UR")


@query("valid_tokens", """SELECT page_id, regexp_full_match(trim(split_part(url, '/', -1)), '[A-Za-z0-9_-]{10,100}') AS last, regexp_full_match(trim(regexp_extract(url, '([a-z]+)[.]example', 1)) || '-folder_1', '[A-Za-z0-9_-]{10,100}') AS host FROM pages""")
def valid_tokens(spark, d):
    return table(spark, d, "pages").select("page_id", T.valid_token(F.element_at(F.split("url", "/"), -1)).alias("last"), T.valid_token(F.concat(F.trim(F.regexp_extract("url", "([a-z]+)[.]example", 1)), F.lit("-folder_1"))).alias("host"))


@query("utc_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events")
def utc_stamps(spark, d):
    return table(spark, d, "events").select("event_id", T.utc_stamp(F.col("ts")).alias("stamp"))


@query("reference_phrases", """
WITH p AS (SELECT substr(text, 1, 20) AS phrase, 'benchmark' AS kind, item_id::VARCHAR AS source FROM benchmark UNION ALL SELECT ' ', 'blank', '0' FROM benchmark UNION ALL SELECT substr(text, 1, 20), 'again', '1' FROM benchmark)
SELECT phrase, max(e).kind AS kind, max(e).source AS source FROM (SELECT phrase, {'kind': kind, 'source': source} AS e FROM p WHERE trim(phrase) <> '') GROUP BY 1""")
def reference_phrases(spark, d):
    """Lists of phrases as JSON, a blank and a repeated one in each."""
    head = F.substring("text", 1, 20)
    entry = lambda phrase, kind, source: F.struct(phrase.alias("phrase"), F.lit(kind).alias("kind"), source.alias("source"))
    lists = table(spark, d, "benchmark").select(F.to_json(F.array(entry(head, "benchmark", F.col("item_id").cast("string")), entry(F.lit(" "), "blank", F.lit("0")), entry(head, "again", F.lit("1")))).alias("json"))
    return dimensions.phrases(lists, "json")


REFRESH_SQL = f"""
WITH {CUES_SQL}, b AS (SELECT ep, idx, CASE WHEN ep % 3 = 1 AND idx = 1 THEN start + 1 ELSE start END AS start, "end", CASE WHEN ep % 2 = 1 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE text END AS text FROM cues WHERE ep <> 5 AND NOT (ep = 6 AND idx = 1)),
f AS (SELECT coalesce(c.ep, b.ep) AS ep, count(c.ep) AS na, count(b.ep) AS nb, bool_and(c.ep IS NOT DISTINCT FROM b.ep AND c.start IS NOT DISTINCT FROM b.start AND c."end" IS NOT DISTINCT FROM b."end") AS timed, bool_and(c.text IS NOT DISTINCT FROM b.text) AS said
  FROM cues c FULL JOIN b ON c.ep = b.ep AND c.idx = b.idx GROUP BY 1),
s AS (SELECT ep, CASE WHEN na = 0 THEN 'new' WHEN nb = 0 THEN 'gone' WHEN NOT timed THEN 'times' WHEN NOT said THEN 'text' ELSE 'same' END AS status FROM f)"""


def _revised(c: DataFrame, upper=lambda text: F.translate(text, T.LOWER, T.UPPER)) -> DataFrame:
    """cues with other texts in some episodes, another time in some, one episode and one cue missing."""
    c = c.where((F.col("ep") != 5) & ~((F.col("ep") == 6) & (F.col("idx") == 1)))
    c = store.set_where(c, "start", (F.col("ep") % 3 == 1) & (F.col("idx") == 1), F.col("start") + 1)
    return store.set_where(c, "text", F.col("ep") % 2 == 1, upper("text"))


@query("refresh_status", f"{REFRESH_SQL} SELECT ep, status FROM s")
def refresh_status(spark, d):
    """What a second run over changed cues has to do with each episode."""
    c = cues(spark, d)
    return store.refresh_status(c, _revised(c), "ep", "idx", ["start", "end"], "text")


UPPER_SQL = REFRESH_SQL.replace("translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')", "upper(text)")


@query("refresh_text", f"{UPPER_SQL} SELECT ep, idx, md5(CASE WHEN status = 'text' THEN upper(text) ELSE text END) AS digest FROM cues JOIN s USING (ep)")
def refresh_text(spark, d):
    c = cues(spark, d)
    return store.refresh_text(c, _revised(c, T.one_upper), "ep", "idx", ["start", "end"], "text").select("ep", "idx", F.md5("text").alias("digest"))


@query("set_where", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def set_where(spark, d):
    return store.set_where(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", F.col("o_orderstatus") == "F", F.lit("done"))


@query("append_log", "SELECT event_id, event_type, NULL AS at FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, 'fixed', strftime(ts, '%Y-%m-%dT%H:%M:%SZ') FROM events WHERE event_type = 'error'")
def append_log(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "ts")
    log = e.where("event_type <> 'error'").select("event_id", "event_type", F.lit(None).cast("string").alias("at"))
    fixed = e.where("event_type = 'error'").select("event_id", F.lit("fixed").alias("event_type"), T.utc_stamp(F.col("ts")).alias("at"))
    return store.append_log(log, fixed)


@query("manifest_round_trip", "SELECT conv_id, turn, true AS same, role = 'user' AS done FROM conversations")
def manifest_round_trip(spark, d):
    """A record of digests by stage as JSON, read again; one stage's key is that of the role 'user'."""
    key = store.stage_key(F.col("role"))
    record = store.manifest({"text": F.md5("text"), "role": key}, version=F.lit(1))
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", record.alias("record"), F.md5("text").alias("digest"))
    user = store.stage_key(F.lit("user").alias("role"))
    return c.select("conv_id", "turn", store.stage_done(F.col("record"), "text", F.col("digest")).alias("same"), store.stage_done(F.col("record"), "role", user).alias("done"))


@query("run_report", """
SELECT 'U' || lpad(user_id::VARCHAR, 4, '0') AS label, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS ok, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS failed,
  sum(CASE WHEN event_type NOT IN ('purchase', 'error') THEN 1 ELSE 0 END)::BIGINT AS not_started, round(sum(value), 2) AS cost FROM events GROUP BY ROLLUP (user_id)""")
def run_report(spark, d):
    """Runs by user and in total."""
    kind = F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "error", "failed").otherwise("not_started")
    r = store.run_report(table(spark, d, "events").select("user_id", kind.alias("status"), "value"), "user_id", "status", "value")
    return r.select(F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("label"), "ok", "failed", "not_started", F.round("cost", 2).alias("cost"))


@query("answer_schema", """
SELECT event_id, regexp_extract(props, '"k": (\\d+)', 1)::INT AS k, event_type IN ('click', 'view', 'purchase') AND regexp_extract(props, '"k": (\\d+)', 1)::INT BETWEEN 1 AND 50 AS ok FROM events""")
def answer_schema(spark, d):
    """Answers as JSON by their schema, with a closed list and bounds."""
    e = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))
    return e.select("event_id", "k", (F.col("event_type").isin("click", "view", "purchase") & F.coalesce(F.col("k").between(1, 50), F.lit(False))).alias("ok"))


# --- tables replaced together, intervals of two sides, runs -------------------------------------------------


@query("replace_library", """
WITH t AS (SELECT conv_id AS ep, turn AS idx, text, role FROM conversations),
n AS (SELECT ep, idx, CASE WHEN ep % 3 = 0 THEN 'new: ' || text ELSE text END AS text FROM t WHERE NOT (ep % 3 = 0 AND role = 'user') AND ep % 7 <> 3),
e AS (SELECT ep, count(*) AS turns FROM t WHERE ep % 7 <> 3 GROUP BY 1)
SELECT ep, turns, count(idx) AS n, md5(coalesce(string_agg(text, chr(10) ORDER BY idx), '')) AS digest FROM e LEFT JOIN n USING (ep) GROUP BY 1, 2""")
def replace_library(spark, d):
    """Conversations and their turns as two tables; every third one is replaced in both, every seventh deleted from both, and both are read again."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("ep"), F.col("turn").alias("idx"), "text", "role")
    eps = c.groupBy("ep").agg(F.count("*").alias("turns"))
    root = new_folder(spark, "library")
    versions.replace(spark, root, {"episodes": eps, "turns": c.drop("role")}, "ep")
    new = c.where("ep % 3 = 0 AND role <> 'user'").select("ep", "idx", F.concat(F.lit("new: "), "text").alias("text"))
    versions.replace(spark, root, {"episodes": eps.where("ep % 3 = 0"), "turns": new}, "ep")
    now = versions.replace(spark, root, {}, "ep", keys=eps.where("ep % 7 = 3"))
    lists = now.table("turns").groupBy("ep").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "text"))).alias("x"))
    joined = now.table("episodes").join(lists, "ep", "left")
    digest = F.md5(F.coalesce(F.array_join(F.transform("x", lambda x: x["text"]), "\n"), F.lit("")))
    return joined.select("ep", "turns", F.coalesce("n", F.lit(0)).cast("long").alias("n"), digest.alias("digest"))


@query("refresh_quotes", f"""{REFRESH_SQL}, q AS (SELECT ep, idx AS lo, idx + 1 AS hi, 'q' || idx AS tag FROM cues WHERE idx % 2 = 0),
p AS (SELECT q.ep, lo, hi, tag, string_agg(CASE WHEN status = 'text' THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE text END, chr(10) ORDER BY idx) AS text
  FROM q JOIN cues c ON q.ep = c.ep AND idx BETWEEN lo AND hi JOIN s ON s.ep = q.ep GROUP BY ALL)
SELECT ep, lo, hi, tag, md5(text) AS digest FROM p""")
def refresh_quotes(spark, d):
    """Quotes of two cues keep what is known of them; those of refreshed episodes are cut anew."""
    c = cues(spark, d)
    ranges = c.where("idx % 2 = 0").select("ep", F.col("idx").alias("lo"), (F.col("idx") + 1).alias("hi"), F.concat(F.lit("q"), "idx").alias("tag"))
    quotes = ranges.join(spans.span_text(ranges.select("ep", "lo", "hi"), c, "ep", "idx", "text"), ["ep", "lo", "hi"])
    done = store.refresh_quotes(quotes.select("ep", "lo", "hi", "tag", "text"), c, _revised(c), "ep", "idx", ["start", "end"], "text")
    return done.select("ep", "lo", "hi", "tag", F.md5("text").alias("digest"))


TWO_SIDES_SQL = f"""{WORDS_SQL}, a AS (SELECT ep, start AS s, "end" AS e FROM words WHERE text IN ('click', 'error')), b AS (SELECT ep, start AS s, start + ("end" - start) * 3 AS e FROM words WHERE text NOT IN ('click', 'error'))"""


def two_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    w, one = words(spark, d).select("ep", "start", "end", "text"), F.col("text").isin("click", "error")
    return w.where(one).drop("text"), w.where(~one).select("ep", "start", (F.col("start") + (F.col("end") - F.col("start")) * 3).alias("end"))


@query("span_coverage", f"""
WITH {TWO_SIDES_SQL}, u AS (SELECT 'a' AS side, * FROM a UNION ALL SELECT 'b', * FROM b),
o AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY side, ep ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS o FROM u),
m AS (SELECT side, ep, min(s) AS s, max(e) AS e FROM (SELECT *, sum(o) OVER (PARTITION BY side, ep ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS r FROM o) GROUP BY side, ep, r),
w AS (SELECT x.ep, sum(least(x.e, y.e) - greatest(x.s, y.s)) AS t FROM m x JOIN m y ON x.ep = y.ep AND x.side = 'a' AND y.side = 'b' AND x.s < y.e AND y.s < x.e GROUP BY 1)
SELECT ep, round(coalesce(sum(CASE WHEN side = 'a' THEN e - s END), 0), 3)::DOUBLE AS a_seconds, round(coalesce(sum(CASE WHEN side = 'b' THEN e - s END), 0), 3)::DOUBLE AS b_seconds, round(coalesce(any_value(t), 0), 3)::DOUBLE AS both_seconds
FROM m LEFT JOIN w USING (ep) GROUP BY ep""")
def span_coverage(spark, d):
    """How long two kinds of words last, each moment once, and how long both do."""
    a, b = two_sides(spark, d)
    return spans.covered(a, b, "ep", "start", "end").select("ep", *[F.round(c, 3).alias(c) for c in ("a_seconds", "b_seconds", "both_seconds")])


@query("spans_met", f"""
WITH {TWO_SIDES_SQL}, x AS (SELECT DISTINCT * FROM a), y AS (SELECT DISTINCT * FROM b),
p AS (SELECT ep, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM y WHERE y.ep = x.ep AND y.s <= x.e AND x.s <= y.e)) AS met FROM x GROUP BY 1),
q AS (SELECT ep, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM x WHERE y.ep = x.ep AND y.s <= x.e AND x.s <= y.e)) AS met FROM y GROUP BY 1)
SELECT ep, coalesce(p.n, 0) AS a_n, coalesce(p.met, 0) AS a_met, coalesce(q.n, 0) AS b_n, coalesce(q.met, 0) AS b_met FROM p FULL JOIN q USING (ep)""")
def spans_met(spark, d):
    """How many intervals of either side meet one of the other."""
    a, b = two_sides(spark, d)
    named = lambda df, x: df.select("ep", F.col("start").alias(f"{x}0"), F.col("end").alias(f"{x}1"))
    return spans.met_either_way(named(a, "a"), named(b, "b"), "ep", 30.0)


@query("run_budget", """
SELECT user_id, event_id, coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 1500 AS started FROM events""")
def run_budget(spark, d):
    """Which of a user's events begin within 1,500 seconds of work."""
    return store.within_budget(table(spark, d, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", 1500.0).select("user_id", "event_id", "started")


@query("pending_cached", """
SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN md5(text) END AS digest FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def pending_cached(spark, d):
    """Documents that have no label, with what an earlier stage left for the even ones."""
    docs = table(spark, d, "documents")
    return store.pending(docs.select("doc_id"), table(spark, d, "labels"), "doc_id", cached=docs.where("doc_id % 2 = 0").select("doc_id", F.md5("text").alias("digest")))


@query("reused_stage", """
SELECT conv_id * 1000 + turn AS id, role <> 'user' AS fresh, CASE WHEN role = 'user' THEN md5(text) END AS digest FROM conversations""")
def reused_stage(spark, d):
    """Results of a stage under the key of its inputs; those of other turns than users' were made from another text."""
    c = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text")
    key = store.stage_key(F.col("id"), F.col("text"))
    old = c.select("id", store.stage_key(F.col("id"), F.when(F.col("role") == "user", F.col("text")).otherwise("x").alias("text")).alias("key"), F.md5("text").alias("digest"))
    return store.reused(c.select("id", key.alias("key")), old, "id", "key").select("id", "fresh", "digest")


# --- small rules ---------------------------------------------------------------------------------------------


@query("caption_lines", """
WITH l AS (SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS l FROM conversations)
SELECT conv_id, turn, CASE WHEN len(l) > 0 THEN md5('「' || array_to_string(l, chr(10) || '　') || '」') END AS digest FROM l""")
def caption_lines(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(T.caption_lines(F.col("text"))).alias("digest"))


@query("source_lines", """
SELECT conv_id, turn, '—— ' || CASE WHEN role = 'user' THEN '' ELSE role || '｜' END || '《Show》' || printf('S%02d ep%03d', conv_id % 9, conv_id) || '〈' || left(text, 5) || '〉' || (turn * 95 // 60) || ':' || lpad((turn * 95 % 60)::VARCHAR, 2, '0') AS line FROM conversations""")
def source_lines(spark, d):
    who = F.when(F.col("role") != "user", F.col("role"))
    line = T.source_line(who, F.lit("Show"), F.col("conv_id") % 9, F.col("conv_id"), F.substring("text", 1, 5), F.col("turn") * 95)
    return table(spark, d, "conversations").select("conv_id", "turn", line.alias("line"))


@query("strip_leading", f"""
WITH {CUES_SQL}, b AS (SELECT ep, idx, start, "end", regexp_replace(CASE WHEN idx % 2 = 0 THEN '，！ ' || text WHEN idx % 3 = 0 THEN '?!' ELSE text END, '^[，,、；;：:。！？!?]+\\s*', '') AS text FROM cues)
SELECT ep, row_number() OVER (PARTITION BY ep ORDER BY start, "end", idx)::INT AS idx, start, md5(text) AS digest FROM b WHERE trim(text) <> ''""")
def strip_leading(spark, d):
    """Cues of which every second begins with marks and some are marks alone."""
    marked = F.when(F.col("idx") % 2 == 0, F.concat(F.lit("，！ "), "text")).when(F.col("idx") % 3 == 0, F.lit("?!")).otherwise(F.col("text"))
    return segments.strip_leading(cues(spark, d).withColumn("text", marked)).select("ep", "idx", "start", F.md5("text").alias("digest"))


VARIANTS_SQL = "translate(text, 'aeiou', '她牠得妳哪')"


@query("canonical_variants", f"SELECT doc_id, md5(translate({VARIANTS_SQL}, '她牠得妳哪', '他他的你那')) AS digest FROM documents")
def canonical_variants(spark, d):
    """Texts whose vowels are written as Han variants, each as the first of its set."""
    return table(spark, d, "documents").select("doc_id", F.md5(T.canonical_variants(F.translate("text", "aeiou", "她牠得妳哪"))).alias("digest"))


@query("close_syllables", """
WITH w AS (SELECT event_id, event_type AS a, lead(event_type) OVER (ORDER BY event_id) AS b FROM events), i AS (SELECT *, '^(zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?' AS first FROM w)
SELECT event_id, a = b OR regexp_extract(a, first) = regexp_extract(b, first) OR regexp_replace(a, first, '') = regexp_replace(b, first, '') AS close FROM i WHERE b IS NOT NULL""".replace("OVER (ORDER BY event_id)", "OVER (PARTITION BY user_id ORDER BY event_id)"))
def close_syllables(spark, d):
    """Whether a user's events and the next ones have the same beginning or the same rest."""
    e = table(spark, d, "events").withColumn("b", F.lead("event_type").over(W.partitionBy("user_id").orderBy("event_id"))).where("b IS NOT NULL")
    return e.select("event_id", T.close_syllables(F.col("event_type"), F.col("b")).alias("close"))


@query("quoted_fragment", """
WITH f AS (SELECT conv_id, turn, text, split_part(text, ' ', 2) AS q, CASE WHEN turn % 3 = 0 THEN 'unheard of' ELSE split_part(text, ' ', 3) END AS s FROM conversations)
SELECT conv_id, turn, md5(CASE WHEN q <> '' AND NOT regexp_matches(q, '[「」『』"“”]') AND q <> s THEN q WHEN contains(text, s) THEN NULL ELSE text END) AS digest FROM f""")
def quoted_fragment(spark, d):
    """What a remark on a turn quotes from it: here its second word, in corner brackets."""
    c = table(spark, d, "conversations").withColumn("q", F.split_part("text", F.lit(" "), F.lit(2)))
    c = c.withColumn("detail", F.concat(F.lit("should be 「"), "q", F.lit("」"))).withColumn("s", F.when(F.col("turn") % 3 == 0, "unheard of").otherwise(F.split_part("text", F.lit(" "), F.lit(3))))
    return c.select("conv_id", "turn", F.md5(audit.quoted_fragment("text", "detail", "s")).alias("digest"))


@query("preflight", """
SELECT doc_id, lang <> 'de' AND n_chars * 4000000 <= 8 * 1024 * 1024 * 1024::BIGINT AS ok FROM documents""")
def preflight(spark, d):
    """Documents as files of some megabytes a character, German ones as no videos."""
    files = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "de", "audio/mp3").otherwise("video/mp4").alias("mimeType"), (F.col("n_chars") * 4000000).alias("size"))
    return pages.preflight(files).select("doc_id", "ok")


@query("episode_names", """
SELECT conv_id, turn, CASE WHEN turn % 4 <> 3 THEN conv_id % 9 + 1 END::INT AS season, CASE WHEN turn % 4 <> 3 THEN conv_id + 1 END::INT AS episode, CASE WHEN turn % 4 <> 3 THEN role || '／' || turn END AS title FROM conversations""")
def episode_names(spark, d):
    """Names of files by season, episode and title; those of another form have none."""
    name = F.concat(F.lit("Show_S"), F.col("conv_id") % 9 + 1, F.when(F.col("turn") % 4 == 3, "_e").otherwise("_ep"), F.col("conv_id") + 1, F.lit("_("), "role", F.lit("_"), "turn", F.lit(").srt"))
    return table(spark, d, "conversations").select("conv_id", "turn", *pages.episode_name(name))
