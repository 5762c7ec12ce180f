"""Every registered query over the smallest tables, against its SQL in DuckDB."""

import datetime
import hashlib
import math
import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from storyloom.operators import audit
from storyloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, views, name):
    df = catalogue.QUERIES[name](spark, SF)
    rows = sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)
    if name not in catalogue.ORACLE:
        assert df.columns
        return
    rel = views.sql(catalogue.ORACLE[name])
    assert sorted(rel.columns) == sorted(df.columns)
    order = [rel.columns.index(c) for c in df.columns]
    assert rows == sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["refresh_text", "refresh_quotes", "caption_lines", "canonical_variants", "glossary_replace", "slugify"])
def test_query_on_more_rows(spark, name):
    """Letters and marks that the smallest tables lack."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF.replace('0.001', '0.01')}/{t}.parquet'")
    df, rel = catalogue.QUERIES[name](spark, SF.replace("0.001", "0.01")), con.sql(catalogue.ORACLE[name])
    order = [rel.columns.index(c) for c in df.columns]
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr)


def test_hybrid_finds_items_beyond_rank_ten(spark, tmp_path):
    docs = [(i, "x" + " pad" * (i + 1)) for i in range(40)]
    vectors = [(11 if (j, sign) == (5, 1) else 100 + 2 * j + (sign > 0), 0, [math.cos(0.05 * j + 0.1), sign * math.sin(0.05 * j + 0.1)]) for j in range(20) for sign in (-1, 1)]
    spark.createDataFrame([(0, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    near = [i for i, _, v in sorted(vectors, key=lambda r: (round(1 - r[2][0], 6), r[0]))]
    score = {i: sum(1 / (11 + order.index(i)) for order in ([i for i, _ in docs], near) if i in order) for i in {*near, *(i for i, _ in docs)}}
    got = {r.id: r.score for r in catalogue.QUERIES["hybrid_candidates"](spark, str(tmp_path)).collect()}
    assert max(got, key=got.get) == 11 and len(got) == 10
    assert sorted(got.values()) == pytest.approx(sorted(score.values())[-10:], abs=1e-8)
    assert 11 not in {r.id for r in catalogue.QUERIES["hybrid_search"](spark, str(tmp_path)).collect()}


def test_leaks_of_all_items(spark, tmp_path):
    items = [(7, "The quick brown Fox jumps"), (100, "over the lazy dog, again and again"), (101, None), (102, "short"), (103, "1234 5678 9012")]
    docs = [(0, "x quick, brown fox! y"), (1, "the LAZY dog again; quickbrownfox"), (2, None), (3, "quick brown"), (4, "short 123456789012")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r["items"] for r in catalogue.QUERIES["leak_pairs"](spark, str(tmp_path)).collect()}
    plain = lambda x: "".join(c for c in (x or "").lower() if c.isalnum())
    brute = {d: [i for i, q in items if any(plain(q)[k : k + 12] in plain(a) for k in range(len(plain(q)) - 11))] for d, a in docs}
    assert got == brute and got[1] == [7, 100]


def test_entry_has_queries():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def tables(views):
    def rows(sql):
        return views.sql(sql).fetchall()

    return rows


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def collected(spark, name):
    return Counter(tuple(r) for r in catalogue.QUERIES[name](spark, SF).collect())


def wide(c):
    return unicodedata.east_asian_width(c) in "WF"


def bare(text):
    return "".join(d for c in text for d in unicodedata.normalize("NFKC", c).casefold() if not d.isspace() and unicodedata.category(d)[0] not in "PZ")


def test_text_queries_against_plain_python(spark, tables):
    docs = tables("select doc_id, text from documents")
    short = lambda t: "".join(c * min(6, len(list(g))) for c, g in groupby(t))
    assert collected(spark, "collapse_repeats") == Counter((i, md5(short(t))) for i, t in docs)
    marks = str.maketrans(",?!;:", "，？！；：")
    tidy = lambda t: re.sub(" +", " ", re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" "))
    spaced = lambda t: "".join(c for k, c in enumerate(t) if not (c == " " and 0 < k < len(t) - 1 and wide(t[k - 1]) and wide(t[k + 1])))
    full = lambda t: "".join(c.translate(marks) if k and "\u3400" <= t[k - 1] <= "\u9fff" else c for k, c in enumerate(t))
    assert collected(spark, "full_width_marks") == Counter((i, md5(full(spaced(tidy(t.translate(str.maketrans("aeiou", "字ー界，한"))))))) for i, t in docs)
    turns = tables("select conv_id, turn, text from conversations")
    assert collected(spark, "fold_text") == Counter((c, t, bare(x), len(bare(x))) for c, t, x in turns)
    pages = sorted(tables("select page_id, url, html from pages"))
    before, want = {}, Counter()
    for page, url, _ in pages:
        lang = (re.search("/([a-z]{2})/", url) or ["", ""])[1]
        want[page, round(SequenceMatcher(None, before[lang], url, autojunk=False).ratio(), 6) if lang in before else None] += 1
        before[lang] = url
    assert collected(spark, "sequence_ratio") == want
    changes, last = Counter(), {}
    for c, t, x in sorted(turns):
        if c in last:
            a, b = bare(last[c]), bare(x)
            steps = [(j - i, n - m) for kind, i, j, m, n in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if kind != "equal"]
            share = lambda k: round(sum(max(0, s[k] - s[1 - k]) for s in steps) / len(a), 6) if a else 0.0
            changes[c, t, round(SequenceMatcher(None, last[c], x, autojunk=False).ratio(), 6), share(0), share(1)] += 1
        last[c] = x
    assert collected(spark, "turn_changes") == changes
    for r in catalogue.QUERIES["edit_budget"](spark, SF).collect():
        assert 0 <= r.deleted <= 1 and 0 <= r.inserted


def episode_words(tables):
    sql = f"WITH {catalogue.WORDS_SQL} SELECT ep, pos, text, start, \"end\" FROM words ORDER BY ep, pos"
    return {ep: list(g) for ep, g in groupby(tables(sql), key=lambda r: r[0])}


def test_episode_queries_against_plain_python(spark, tables):
    chunks, kept, fixed = Counter(), Counter(), Counter()
    for ep, ws in episode_words(tables).items():
        parts, n, last = [""], 0, None
        for _, _, text, start, end in ws:
            pause = last is not None and start - last >= 5.0
            if n >= 400 or (pause and n >= 200):
                parts, n = [*parts, ""], 0
            parts[-1] += ("\n" if pause and n else "") + text
            n, last = n + len(text), end
        chunks.update((ep, i, p.strip()) for i, p in enumerate(parts))
        joined, owner = "".join(w[2] for w in ws), [i for i, w in enumerate(ws) for _ in w[2]]
        gone = {owner[k] for phrase in ("clickview", "errorpurchase") for m in re.finditer(phrase, joined) for k in range(*m.span())}
        kept.update((ep, w[1], w[2]) for i, w in enumerate(ws) if i not in gone)
        hits = Counter()
        for wrong, right in (("clickview", "CLICKVIEW"), ("rorp", "r-rp")):
            hits.update(owner[m.start()] for m in re.finditer(wrong, joined.lower()))
            joined = re.sub(wrong, right, joined, flags=re.I)
        at = 0
        for i, w in enumerate(ws):
            fixed[ep, w[1], joined[at : at + len(w[2])], hits[i]] += 1
            at += len(w[2])
    assert collected(spark, "text_chunks") == chunks
    assert Counter((r.ep, r.pos, r.text) for r in catalogue.QUERIES["drop_phrases"](spark, SF).collect()) == kept
    assert Counter((r.ep, r.pos, r.text, r.hits) for r in catalogue.QUERIES["correct_words"](spark, SF).collect()) == fixed


def test_cue_queries_keep_all_text_in_order(spark, tables):
    eps = episode_words(tables)
    texts = {ep: bare("".join(w[2] for w in ws)) for ep, ws in eps.items()}
    for name in ("cue_pipeline", "merge_short_cues", "punctuated_cues", "align_lines"):
        found = {}
        for r in sorted(catalogue.QUERIES[name](spark, SF).collect(), key=lambda r: (r.ep, r.idx)):
            found.setdefault(r.ep, []).append(r)
        for ep, cues in found.items():
            said = bare("".join(c.text for c in cues))
            assert said == texts[ep] if name != "align_lines" else len(said) == len(texts[ep])
            assert [c.idx for c in cues] == list(range(1, len(cues) + 1))
            assert (cues[0].start, cues[-1].end) == pytest.approx((eps[ep][0][3], eps[ep][-1][4]), abs=0.6)
        assert name == "align_lines" or set(found) == set(eps)


def test_suspects(spark):
    key = lambda u: F.regexp_replace(u, "^zh", "z")
    refs = spark.createDataFrame([(1, ["lao", "zhi", "shuo", "xiong"]), (2, ["a", "b", "c"])], "ref_id long, units array<string>")
    said = [["x", "lao", "zi", "shuo", "xiong"], ["lao", "zhi", "shuo", "xiong"], ["lao", "mi", "ta", "ke"], ["lao", "zi", "shuo", "xiang"], ["lao", "zi", "shuo"]]
    rows = spark.createDataFrame(list(enumerate(said)), "row_id long, units array<string>")
    got = sorted(tuple(r) for r in audit.suspects(rows, refs, key).collect())
    assert [r[:4] for r in got] == [(0, 1, 1, "lao zi shuo xiong"), (3, 1, 0, "lao zi shuo xiang")] and got[0][5] == 1.0
    assert audit.suspects(rows, refs, key, common=0).count() == 0


def test_homophone_suspects(spark):
    key = lambda u: F.regexp_replace(u, "^zh", "z")
    said = [["lao", "zhi", "shuo", "xiong", "a"]] * 24 + [["lao", "zi", "shuo", "xiong", "a"], ["x", "lao", "zi", "shuo"], ["lao"], ["lao", "zi"], []]
    rows = spark.createDataFrame(list(enumerate(said)), "row_id long, units array<string>")
    got = sorted(tuple(r) for r in audit.homophone_suspects(rows, key).collect())
    # of the first row's nested spellings the longest stays, the second row has the shortest alone
    assert got == [(24, "lao zi shuo xiong a", 1, "lao zhi shuo xiong a", 24, 0.96), (25, "lao zi shuo", 2, "lao zhi shuo", 24, 0.923)]
    short = spark.createDataFrame([(0, ["a"]), (1, ["a", "b"])], "row_id long, units array<string>")
    assert {(r.text, r.n) for r in audit.spellings(short, key, (1, 2)).collect()} == {("a", 2), ("b", 1), ("a b", 1)}


def test_apply_fixes(spark):
    rows = spark.createDataFrame([(1, "hello wrld, wrld"), (2, "keep"), (3, None)], "id long, text string")
    fixes = [(1, 0, "wrld", "world"), (1, 1, "hello", "hallo"), (1, 2, "hello", "entirely"), (1, 3, "wrld", "wrl,d"), (2, 0, "gone", "gane"), (2, 1, "keep", "keep"), (2, 2, "", "x"), (3, 0, "a", "b"), (9, 0, "a", "b")]
    fixed, done = audit.apply_fixes(rows, spark.createDataFrame(fixes, "id long, pos int, wrong string, right string"), lambda c: c)
    assert sorted(tuple(r) for r in fixed.collect()) == [(1, "hallo world, world"), (2, "keep"), (3, None)]
    assert sorted((r.id, r.pos) for r in done.where("applied").collect()) == [(1, 0), (1, 1)] and done.count() == len(fixes)
    df = spark.createDataFrame([("ab", "abb", "ab, ab"), ("bc", "abc", "abc, bc abc"), ("x", "y", "x x")], "w string, r string, t string")
    assert [r[0] for r in df.select(audit.ambiguous_insertion(F.col("w"), F.col("r"), F.col("t"))).collect()] == [True, False, False]
    wide_ = spark.createDataFrame([("我要去喝咖非上班", "喝咖非", "非", "啡"), ("非！", "非", "非", "啡"), (None, "a", "a", "b")], "c string, h string, w string, r string")
    assert [tuple(r[0]) for r in wide_.select(audit.widen("c", "h", "w", "r")).collect()] == [("咖非上", "咖啡上"), (None, None), (None, None)]
