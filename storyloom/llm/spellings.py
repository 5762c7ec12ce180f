"""Words that are one insertion, deletion or replacement apart, found by an index of variable-length grams.

The gram dictionary starts with all grams of ``SHORTEST`` code points of the words (each word between two marks). A
gram is lengthened by one code point only where it is frequent, up to ``LONGEST``, so that the dictionary is pruned by
frequency and closed under prefixes. A word is decomposed into the longest dictionary gram at each of its places.

An edit at a place changes only the grams over that place and the gram that ends right before it, and this one only if
the dictionary has a longer gram that begins with it. The largest number of such grams over all places is the word's
bound b. Two near words thus share all but b grams of either one, at places that differ by the edit alone, and the
rarest gram that they share is among the first b + 1 of both in any common order. So only b + 1 grams of a word, the
rarest, enter the lists; lists are merged by gram, place and length of the word; what meets is verified as a whole.
A word of 6 letters has 7 grams and a bound of at most 4, so that no word is without a shared gram.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import forget, materialize

LETTERS = "[A-Za-zÀ-ÿ]"
SHORTEST, LONGEST = 2, 4
#: A gram is lengthened if it stands for at least this share of all places. At most 1 / SHARE grams of a length do so.
SHARE = 1 / 20_000
LEAST_POINTS, LEAST_COUNT, FACTOR, NOISE = 6, 5, 5, 199
FIRST, LAST = "\x02", "\x03"
A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """word and n: the runs of letters of all texts, A-Z in lower case, of LEAST_POINTS code points that come LEAST_COUNT times.

    Where ``noise`` divides the checksum of ``<doc_id>:<run>``, the run loses one code point first. A null doc_id counts
    as an empty one, a null text has no runs; repeated rows count as often as they come. Runs are counted before they are moved.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{LEAST_POINTS},}}"), F.lit(0)))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), run.alias("w")).select("d", F.translate("w", *A_TO_Z).alias("w"))
    h = F.crc32(F.concat("d", F.lit(":"), "w").cast("binary"))
    at = (F.col("h") % F.length("w")).cast("int")
    less = F.concat(F.substr("w", F.lit(1), at), F.substr("w", at + 2))
    told = each.select("w", h.alias("h")).select(F.when(F.col("h") % noise == 0, less).otherwise(F.col("w")).alias("word"))
    return told.where(F.length("word") >= LEAST_POINTS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: Counter = Counter()
        for w in b.column(0).to_pylist():
            w = FIRST + w + LAST
            for size in range(SHORTEST, LONGEST + 1):
                counts.update(w[p : p + size] for p in range(len(w) - size + 1))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["gram", "n"])


def dictionary(found: DataFrame) -> dict[str, tuple[int, bool]]:
    """Gram -> how many places have it, and whether the dictionary has longer ones that begin with it.

    Grams are counted where the words are. Of each length at most 1 / SHARE grams are lengthened, each by a code point of
    the alphabet, which bounds what the driver gets: it takes the shortest grams and those whose beginning is frequent.
    """
    counts = materialize(found.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    size = F.length("gram")
    total = counts.where(size == SHORTEST).agg(F.sum("n")).first()[0] or 0
    frequent = counts.where((size < LONGEST) & (F.col("n") >= max(2.0, total * SHARE))).select(F.col("gram").alias("head"))
    longer = counts.where(size > SHORTEST).withColumn("head", F.expr("substr(gram, 1, length(gram) - 1)")).join(frequent, "head", "left_semi")
    kept = {r.gram: (r.n, False) for r in counts.where(size == SHORTEST).unionByName(longer.select("gram", "n")).collect()}
    forget(counts)
    for head in {g[:-1] for g in kept if len(g) > SHORTEST}:
        kept[head] = (kept[head][0], True)
    return kept


def decomposed(word: str, grams: dict[str, tuple[int, bool]]) -> tuple[list[str], int]:
    """The longest gram at each place of the marked word, and the largest number of them that one edit changes."""
    w = FIRST + word + LAST
    out = []
    for p in range(len(w) - SHORTEST + 1):
        size = SHORTEST
        while size < LONGEST and p + size < len(w) and w[p : p + size + 1] in grams:
            size += 1
        out.append(w[p : p + size])
    changed = [0] * (len(w) + 1)
    for p, g in enumerate(out):
        end = p + len(g)
        longer = grams.get(g, (0, False))[1]
        for i in range(max(p, 1), min(end + longer, len(w) - 1)):
            changed[i] += 1
        # an insertion right before the last mark
        if p < len(w) - 1 < end or (longer and end == len(w) - 1):
            changed[len(w)] += 1
    return out, max(changed)


def listed(word: str, grams: dict[str, tuple[int, bool]]) -> list[tuple[str, int]]:
    """The (gram, place) of a word that enter the lists: as many of the rarest as its bound, and one more."""
    own, bound = decomposed(word, grams)
    ranked = sorted((grams.get(g, (0, False))[0], g, p) for p, g in enumerate(own))
    return [(g, p) for _, g, p in ranked[: bound + 1]]


def near_pairs(found: DataFrame) -> DataFrame:
    """a, na, b and nb of all pairs of ``found`` (word, n; distinct words of LEAST_POINTS at least) with edit distance 1, in both orders."""
    shared = found.sparkSession.sparkContext.broadcast(dictionary(found))
    names = ["word", "n", "gram", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        for b in batches:
            rows = [(w, n, g, p) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for g, p in listed(w, grams)]
            columns = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int32()))], names=names)

    lists = found.select("word", "n").mapInArrow(run, "word string, n long, gram string, place int")
    size = F.length("word")
    key = lambda place, length: F.xxhash64("gram", place, length)
    # a word meets words of its length at the same place, and longer ones at the same place or the next
    left = lists.select(F.col("word").alias("a"), F.col("n").alias("na"), key(F.col("place"), size).alias("k"))
    at = lambda d, grow: F.struct(key(F.col("place") - d, size - grow).alias("k"), F.lit(grow).alias("grow"))
    right = lists.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.inline(F.array(at(0, 0), at(0, 1), at(1, 1))))
    fit = (F.length("b") - F.length("a") == F.col("grow")) & ((F.col("grow") == 1) | (F.col("a") < F.col("b")))
    once = left.join(right, "k").where(fit & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb").distinct()
    return once.unionByName(once.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the end of the chain of forms from it, for the rows of ``forms`` (word, form). Chains are doubled; n grows along them, so that they end."""
    path = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = path.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(path.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forget(path)
        path = longer
        if path.where("moved").isEmpty():
            return path.select("word", "root")


def group(docs: DataFrame) -> DataFrame:
    """word, n, form, form_n, n_near and root of each word of ``docs`` (doc_id, text).

    A word's form is its near word of largest n, the first in code-point order on a tie, if that is FACTOR times its own;
    else null. The root is where forms lead, the word itself if it has none. An empty table, or one whose texts are null,
    empty or too rare, gives no rows. Other columns are not looked at, whatever their names.
    """
    found = materialize(words(docs), "words")
    pairs = near_pairs(found)
    best = F.min_by(F.struct("b", "nb"), F.struct(-F.col("nb"), F.col("b")))
    near = materialize(pairs.groupBy("a", "na").agg(F.count("*").alias("n_near"), best.alias("best")), "near")
    larger = F.col("best.nb") >= FACTOR * F.col("na")
    told = near.select(F.col("a").alias("word"), "n_near", F.when(larger, F.col("best.b")).alias("form"), F.when(larger, F.col("best.nb")).alias("form_n"))
    ends = roots(told.where("form IS NOT NULL"))
    out = found.join(told, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


#: Pairs by the words that remain when one code point is left out, and the checksum bit by bit from its polynomial.
ORACLE = r"""
WITH RECURSIVE bits(i, c, k) AS (SELECT i, i, 0 FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents),
low AS (SELECT doc_id::VARCHAR AS d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM runs WHERE len(r) >= 6),
one AS (SELECT d, w, count(*) AS n FROM low GROUP BY 1, 2),
sums AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(d, '') || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM one, crc),
told AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % len(w))::INT) || substr(w, (h % len(w))::INT + 2) ELSE w END AS word, n FROM sums),
v AS (SELECT word, sum(n)::BIGINT AS n FROM told WHERE len(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS x FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
pairs AS (SELECT a.word AS a, b.word AS b, b.n AS nb FROM less a JOIN less b ON a.i = b.i AND a.x = b.x AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN v b ON a.x = b.word UNION SELECT b.word, a.word, a.n FROM less a JOIN v b ON a.x = b.word),
best AS (SELECT a AS word, count(*) AS n_near, arg_min({'b': b, 'nb': nb}, (-nb, b)) AS top FROM pairs GROUP BY 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top.nb >= 5 * v.n THEN top.b END AS form, CASE WHEN top.nb >= 5 * v.n THEN top.nb END AS form_n FROM v LEFT JOIN best USING (word)),
chain(word, last, k) AS (SELECT word, word, 0 FROM f UNION ALL SELECT chain.word, f.form, k + 1 FROM chain JOIN f ON chain.last = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near::BIGINT AS n_near, form_n FROM f JOIN (SELECT word, arg_max(last, k) AS root FROM chain GROUP BY 1) USING (word)"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(spark.read.parquet(f"{sf_dir}/documents.parquet"))
