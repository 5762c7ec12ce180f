"""The stored index against search without one."""

import random

import pytest

from storyloom.functions import text as T
from storyloom.operators import index, search


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def ranked(df):
    return sorted((r.query_id, r.rank, r.id, r.score) for r in df.collect())


def test_index_follows_its_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "RANGE", 4)
    monkeypatch.setattr(index, "FIRST_RANGES", 2)
    monkeypatch.setattr(index, "BUCKETS", 4)
    rnd = random.Random(21)
    vocabulary = [f"w{i}" for i in range(40)]
    text = lambda: " ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(40)], k=rnd.randint(0, 30)))
    docs = {i: text() for i in range(-6, 90)} | {200: None, 201: ""}
    queries = spark.createDataFrame([(q, " ".join(rnd.choices(vocabulary, k=3))) for q in range(12)] + [(12, "nothing here"), (13, None), (14, "")], "query_id long, query string")
    frame = lambda rows: spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    root = f"file://{tmp_path}/index"

    def same():
        assert ranked(index.search(spark, root, queries, terms_of=T.words)) == ranked(search.bm25(frame(docs), queries, terms_of=T.words))

    assert index.update(spark, root, frame(docs), terms_of=T.words) == len(docs)
    same()
    ranges, rows = index.candidates(spark, root, queries, 3, T.words)
    assert ranges.count() < rows.select("query_id", "range").distinct().count()
    assert index.update(spark, root, frame(docs), terms_of=T.words) == 0 and len(index.segments(spark, root)) == 1
    for i in (3, 4, 50):
        docs[i] = text() + " w1"
    docs[500] = "w1 w2 w3"
    assert index.update(spark, root, frame({i: docs[i] for i in (3, 4, 50, 500, 7)}), terms_of=T.words, complete=False) == 4
    del docs[4], docs[10]
    docs[3] = "w39 w39"
    assert index.update(spark, root, frame(docs), terms_of=T.words) == 1
    same()
    assert index.documents(spark, root).count() == len(docs)
    index.merge(spark, root)
    assert len(index.segments(spark, root)) == 1
    same()


def test_a_failed_update_leaves_the_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "BUCKETS", 4)
    root = f"file://{tmp_path}/index"
    queries = spark.createDataFrame([(0, "red fox")], "query_id long, query string")
    assert index.search(spark, root, queries, terms_of=T.words).count() == 0
    index.update(spark, root, spark.createDataFrame([(1, "red fox"), (2, "blue")], "doc_id long, text string"), terms_of=T.words)
    new = spark.createDataFrame([(1, "x"), (3, "red fox fox")], "doc_id long, text string")
    before = ranked(index.search(spark, root, queries, terms_of=T.words))

    def fail(self, name, text):
        raise OSError("lost")

    monkeypatch.setattr(index.Files, "write", fail)
    try:
        index.update(spark, root, new, terms_of=T.words)
    except OSError:
        pass
    monkeypatch.undo()
    monkeypatch.setattr(index, "BUCKETS", 4)
    assert ranked(index.search(spark, root, queries, terms_of=T.words)) == before and before[0][2] == 1
    index.update(spark, root, new, terms_of=T.words)
    assert [r[2] for r in ranked(index.search(spark, root, queries, terms_of=T.words))] == [3]


def test_terms_are_counted_and_scored_where_their_range_is(spark, tmp_path, monkeypatch):
    """No row per document and term goes through a shuffle, ids of any sign and size keep their range, and what a change takes away is left out."""
    monkeypatch.setattr(index, "BUCKETS", 4)
    ids = [-(1 << 62) - 1, -513, -512, -1, 0, 511, 512, (1 << 62) + 3]
    docs = spark.createDataFrame([(i, f"red fox {'x ' * (k % 3)}") for k, i in enumerate(ids)] + [(7000, None)], "doc_id long, text string")
    queries = spark.createDataFrame([("a", "fox x"), ("b", "red"), ("c", "zz")], "query_id string, query string")
    root = f"file://{tmp_path}/index"
    index.update(spark, root, docs.withColumn("text", index.F.concat("text", index.F.lit(" fox"))), terms_of=T.words)
    assert index.update(spark, root, docs, terms_of=T.words) == len(ids)
    got = index.search(spark, root, queries, 5, T.words)
    assert ranked(got) == ranked(search.bm25(docs, queries, k=5, terms_of=T.words)) and len(got.collect()) == 10
    postings, asked, few = index._found(spark, root, queries, T.words)
    assert few and {f.name for f in postings.schema} == set(index.COLUMNS)
    pairs = postings.join(asked, "term").select("query_id", "range").distinct()
    assert index._scored(pairs, postings, asked, True, 1).count() <= 2 * len(ids)  # the best of tasks alone
    monkeypatch.setattr(index, "BROADCAST_ROWS", 0)
    assert ranked(index.search(spark, root, queries, 5, T.words)) == ranked(got)
