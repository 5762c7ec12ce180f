"""Results and work of queries on cases that grow: sums at a border, long texts, many copies."""

import random

import duckdb
from pyspark.sql import functions as F

from storyloom.functions import patterns
from storyloom.functions.text import clean_spaces, full_width, one_upper, sound_key, words
from storyloom.operators import audit, search, store


def test_budget_is_reached_exactly(spark):
    """Ten times 0.1 is no less than 1, whatever the order of the additions."""
    rows = [(1, i, 0.1) for i in range(12)] + [(2, 0, float("nan")), (2, 1, 0.1), (3, 0, None), (3, 1, 0.25), (3, 2, 1.0), (4, 0, 1e300), (4, 1, 0.0)]
    got = store.within_budget(spark.createDataFrame(rows, "k int, o int, s double"), "k", "o", "s", 1.0)
    started = {(r.k, r.o): r.started for r in got.collect()}
    assert [started[1, i] for i in range(12)] == [True] * 10 + [False] * 2
    assert [started[k] for k in [(2, 0), (2, 1), (3, 0), (3, 1), (3, 2), (4, 0), (4, 1)]] == [True, False, True, True, True, True, False]


def one_by_one(text, pairs, passes):
    total = 0
    for _ in range(passes):
        before = text
        for wrong, right in sorted(((w, r) for w, r in pairs if w and w != r), key=lambda p: -len(p[0])):
            parts = text.split(right) if wrong in right else [text]
            total += sum(p.count(wrong) for p in parts)
            text = right.join(p.replace(wrong, right) for p in parts)
        if text == before:
            break
    return text, total


def test_glossary_of_any_terms_is_that_of_one_after_the_other():
    rng = random.Random(7)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    for letters in ("ab", "abc ", "ab\n]-^\\"):
        for _ in range(400):
            pairs = [(word(letters, rng.randint(0, 4)), word(letters, rng.randint(0, 5))) for _ in range(rng.randint(0, 7))]
            text, passes = word(letters + "xy", rng.randint(0, 60)), rng.randint(1, 3)
            assert patterns.Glossary(pairs).apply(text, passes) == one_by_one(text, pairs, passes), (text, pairs, passes)


def test_glossary_looks_around_replacements_alone():
    """A long run of terms is gone through once, and not once more for each term in it."""
    terms = [f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "xyz"]
    glossary, seen = patterns.Glossary([(t, t[::-1]) for t in terms]), []
    look = glossary.patterns.present
    glossary.patterns.present = lambda text: seen.append(len(text)) or look(text)
    text = "".join(terms) * 20
    assert glossary.once(text) == one_by_one(text, glossary.pairs, 1)
    assert sum(seen) < 20 * len(text)


def test_runs_that_can_be_no_homophone_are_not_made(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = ["shell", "sell", "ching", "cin", "cing", "apple", "pear", "a b", "sa b", "", None, *(f"w{i}" for i in range(40))]
    lists = [(i, [rng.choice(vocabulary[: rng.choice((4, 11, 51))]) for _ in range(rng.randint(0, 60))]) for i in range(80)] + [(90, None), (91, [])]
    lists += [(100 + i, f"x my {'sell' if i == 5 else 'shell'} is full".split()) for i in range(14)] + [(200 + i, ["y", f"{'sh' if i else 's'}ip a", None, "z"]) for i in range(12)]
    rows = spark.createDataFrame(lists, "row_id long, units array<string>").cache()
    for lengths in ((1, 2), (3, 4, 5)):
        expected = sorted(map(tuple, audit.minorities(audit.spellings(rows, sound_key, lengths)).collect()))
        assert expected and sorted(map(tuple, audit.homophones(rows, sound_key, lengths).collect())) == expected
    few = audit.confusable_runs(rows, sound_key, (3,)).count()
    monkeypatch.setattr(audit, "BROADCAST_ROWS", 1)
    assert 0 < few < audit.confusable_runs(rows, sound_key, (3,)).count()
    assert sorted(map(tuple, audit.homophones(rows, sound_key, (3, 4, 5)).collect())) == expected


def test_runs_of_doubtful_sounds_alone_are_made(spark, monkeypatch):
    """Texts are made of the runs whose sound has a rare spelling beside a common one; the others are hashes and counts."""
    rng = random.Random(4)
    vocabulary = ["shell", "sell", "ching", "cin", "a b", "sa b", "sha", "b", "", None, *(f"w{i}" for i in range(9))]
    lists = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))]) for i in range(150)] + [(900, None), (901, [])]
    lists += [(1000 + i, f"x my {'sell' if i == 5 else 'shell'} is full".split()) for i in range(14)] + [(2000 + i, ["y", "sha b" if i else "sa b", "z", "z"]) for i in range(12)]
    rows = spark.createDataFrame(lists, "row_id long, units array<string>").repartition(3).cache()
    counted = audit.spellings(rows, sound_key, (3, 4, 5)).cache()
    expected = sorted(map(tuple, audit.minorities(counted).collect()))
    sounds = {r[0] for r in expected}
    of_them = sum(r.n for r in counted.collect() if r.sound in sounds)
    runs, few = audit.doubtful_runs(rows, sound_key, (3, 4, 5))
    assert {"x my sell", "y sa b z z"} <= {r[1] for r in expected}
    assert few and runs.count() == of_them < audit.confusable_runs(rows, sound_key, (3, 4, 5)).count() / 10
    assert sorted(map(tuple, audit._minor_runs(runs, sound_key).collect())) == expected
    monkeypatch.setattr(audit, "RUN_UNITS", 40)  # more ranges of hashes
    assert audit.doubtful_runs(rows, sound_key, (3, 4, 5))[0].count() == of_them
    batch = rows.where("units IS NOT NULL").toArrow().combine_chunks().to_batches()[0]
    parts = list(audit._blocks(batch))
    assert len(parts) > 9 and sum((p.to_pylist() for p in parts), []) == batch.to_pylist()
    monkeypatch.setattr(audit, "SOUNDS", 0)
    runs, few = audit.doubtful_runs(rows, sound_key, (3, 4, 5))
    assert not few and sorted(map(tuple, audit._minor_runs(runs, sound_key).collect())) == expected


def test_bm25_sends_on_the_best_of_a_task_alone(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    docs = [(i, text(rng.randint(0, 9))) for i in range(300)] + [(1000 - i, "a b c d") for i in range(200)] + [(2000, None), (2001, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    queries = spark.createDataFrame([("q1", "a b c d"), ("q2", "p o a"), ("q3", "zz"), ("q4", None), ("q5", "e e f")], "query_id string, query string")
    sent, best = [], search._best_of_tasks
    monkeypatch.setattr(search, "_best_of_tasks", lambda *a: sent.append(best(*a)) or sent[-1])
    monkeypatch.setattr(search, "BLOCK_SCORES", 100)
    got = sorted(map(tuple, search.bm25(docs, queries, k=7, terms_of=words).select("query_id", "id", "score", "rank").collect()))
    assert {r[0] for r in got} == {"q1", "q2", "q5"} and [r[1] for r in got if r[0] == "q1"][:7] != []
    assert sent[0].count() < 4 * 3 * 7 * 3  # tasks, queries, k, and what lies close
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    assert got == sorted(map(tuple, search.bm25(docs, queries, k=7, terms_of=words).select("query_id", "id", "score", "rank").collect()))


def test_refreshed_texts_have_every_letter_in_upper_case(spark):
    texts = ["".join(map(chr, range(1, 0x180))), "Straße, déjà, ÿ ŉ ǰ ﬁ ᾳ ΐ", "αβγς жщ \U00010428 \U0001f600", "plain", ""]
    got = {r[0]: r[1] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", one_upper("t")).collect()}
    assert [got[t] for t in texts] == [duckdb.execute("select upper(?::varchar)", [t]).fetchall()[0][0] for t in texts]


def test_wide_neighbours_are_looked_at_beside_spaces_and_marks_alone(spark):
    """Patterns begin with the rare character, not with what stands before it at every place."""
    texts = ["字 字 字,a 字， b ,字 ,字?!", "ー 界 x 界 ， 한 :字:", " , a, 字", ""]
    want = ["字字字，a 字， b ,字 ,字？!", "ー界 x 界，한 :字：", ", a, 字", ""]
    got = {r[0]: r[1] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", full_width(clean_spaces("t"))).collect()}
    assert [got[t] for t in texts] == want
