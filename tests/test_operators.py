import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.functions.patterns import Patterns
from storyloom.operators import audit, episodes, search, segments, spans, store
from storyloom.sources import dimensions, pages, subtitles

CUES = "ep long, idx int, start double, end double, text string"
WORDS = "ep long, pos int, text string, start double, end double"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- folds -----------------------------------------------------------------------------------------


def merged(rule, cues):
    track = episodes.Track(cues)
    return track.cues(rule(track))


def test_fragments_are_absorbed():
    rule = episodes.without_fragments
    assert merged(rule, [(0, 1, "這是一句。"), (1, 2, "紅"), (2.5, 4, "色蘋果來了")]) == [(0, 1, "這是一句。"), (1, 4, "紅色蘋果來了")]
    assert merged(rule, [(0, 1, "這是一句"), (1, 2, "紅"), (9, 10, "色蘋果來了")]) == [(0, 2, "這是一句紅"), (9, 10, "色蘋果來了")]
    assert merged(rule, [(0, 1, "這是一句。"), (1, 2, "紅"), (9, 10, "色蘋果來了")]) == [(0, 2, "這是一句。紅"), (9, 10, "色蘋果來了")]
    assert merged(rule, [(0, 1, "紅"), (9, 10, "色"), (10, 11, "好的")]) == [(0, 10, "紅色"), (10, 11, "好的")]
    assert merged(rule, [(0, 1, "紅")]) == [(0, 1, "紅")]
    assert merged(rule, []) == []


def test_long_cues_are_cut_at_the_widest_pause():
    words = episodes.Track([(0, 1, "aaaa"), (1, 2, "bbbb"), (10, 11, "cccc"), (12, 14, "dddd")])
    assert episodes.split_long((0, 14, "aaaabbbbccccdddd"), words, 12) == [(0, 2, "aaaabbbb"), (10, 14, "ccccdddd")]
    assert episodes.split_long((0, 14, "aaaabbbbccccdddd"), words, 3) == [(0, 2, "aaaabbbb"), (10, 11, "cccc"), (12, 14, "dddd")]
    assert episodes.split_long((0, 14, "I "), words, 12) == [(0, 14, "I ")]


def test_short_cues_take_time_without_overlap():
    stretched = episodes.stretch_short
    assert stretched([(0, 0.2, "a"), (1, 3, "b")])[0] == (0, 0.5, "a")
    assert stretched([(0, 0.2, "a"), (0.2, 3, "b")]) == [(0, 0.5, "a"), (0.5, 3, "b")]
    assert stretched([(0, 2, "a"), (2, 2.25, "b"), (2.25, 2.75, "c")])[:2] == [(0, 1.75, "a"), (1.75, 2.25, "b")]
    assert stretched([(0, 0.25, "a")], limit=0.375) == [(0, 0.375, "a")]
    assert stretched([]) == []


def test_unreadable_cues_join_the_nearer_side():
    rule = episodes.without_unreadable
    assert merged(rule, [(0, 0.3, "啊"), (0.3, 0.6, "喔"), (5, 6, "好")]) == [(0, 0.6, "啊喔"), (5, 6, "好")]
    assert merged(rule, [(0, 1, "a"), (2, 2.1, "b"), (3.1, 4, "c")]) == [(0, 2.1, "ab"), (3.1, 4, "c")]
    assert merged(rule, [(0, 0.1, "a")]) == [(0, 0.1, "a")]


def test_short_cues_grow():
    rule = episodes.without_short
    assert merged(rule, [(0, 1, "好的"), (1.1, 2, "走吧。"), (2.1, 3, "再見")]) == [(0, 2, "好的走吧。"), (2.1, 3, "再見")]
    assert merged(rule, [(0, 1, "好的好的"), (2, 3, "再見再見")]) == [(0, 1, "好的好的"), (2, 3, "再見再見")]


def test_segmented_keeps_ascii_words_whole():
    words = [(0.0, 0.1, "中" * 19), (0.1, 0.2, "ab"), (0.2, 0.3, "cd")]
    assert [c[2] for c in segments.segmented(words)] == ["中" * 19, "abcd"]
    assert [c[2] for c in segments.segmented([(0, 1, "a"), (1.7, 2, "b"), (2.1, 3, "c")])] == ["a", "bc"]
    assert [c[2] for c in segments.segmented([(0, 1, "a "), (1, 2, "pro"), (3, 4, "mpt")])] == ["a", "prompt"]
    assert segments.segmented([]) == [] and segments.segmented([(0, 1, " ")]) == []


def test_votes_by_either_plan(spark, monkeypatch):
    rnd = random.Random(3)
    rows_ = [(i, [rnd.choice("abcdefgh") for _ in range(rnd.choice([0, 3, 40, 300]))]) for i in range(30)] + [(30, None)]
    refs_ = [(i, [rnd.choice("abcdefghxyz") for _ in range(rnd.choice([2, 4, 5, 9]))]) for i in range(12)]
    docs, refs = spark.createDataFrame(rows_, "row_id long, units array<string>"), spark.createDataFrame(refs_, "ref_id long, units array<string>")
    want = set()
    for i, u in rows_:
        for j, r in refs_:
            for at in range(len(u or []) - len(r) + 1):
                n = sum(x == y for x, y in zip(u[at:], r))
                if len(r) >= 4 and 2 * n >= len(r):
                    want.add((i, j, at, n, n / len(r)))
    for limit, block in ((100_000, 2048), (0, 7)):
        monkeypatch.setattr(audit, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(audit, "BLOCK_UNITS", block)
        got = [tuple(r) for r in audit.votes(docs, refs).select("row_id", "ref_id", "at", "votes", "share").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_parts_of_an_episode_give_the_cues_of_the_whole(spark):
    rnd, rows_ = random.Random(31), []
    for ep in range(4):
        at = 0.0
        for k in range(1500):
            at += rnd.choice([0, 0, 0, 0.05, 0.3, 0.5, 0.7, 1.0, 1.6, 2.5, 4.0])
            long_ = rnd.choice([0.05, 0.1, 0.3, 0.6, 1.0, 3.0])
            rows_.append((ep, k, rnd.choice(["中", "一二", "三四五", "ab", "c ", "word ", "。", "好。", "，", " ", None]), round(at, 3), round(at + long_, 3)))
            at += long_ * rnd.choice([1, 1, 1, 1, 0.9])
    df = spark.createDataFrame(rows_, WORDS).repartition(3)
    parts = segments.episode_parts(df, 100).groupBy("ep", "part").count().collect()
    assert len(parts) > 20 and max(r["count"] for r in parts) < 1000
    whole = rows(segments.cue_pipeline(df, part_words=10**9), "ep", "idx")
    assert rows(segments.cue_pipeline(df, part_words=100), "ep", "idx") == whole and len(whole) > 500
    assert rows(segments.cue_pipeline(df, part_words=1), "ep", "idx") == whole


def test_leaks_by_either_plan(spark, monkeypatch):
    rnd = random.Random(6)
    said = lambda n: "".join(rnd.choice("abC, é1") for _ in range(n))
    docs, asked = [(i, said(rnd.choice([0, 5, 90]))) for i in range(40)] + [(40, None)], [(i, said(rnd.choice([2, 9, 30]))) for i in range(9)] + [(9, None)]
    bare = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    want = {(d, q) for d, a in docs for q, t in asked if any(bare(t)[k : k + 4] in bare(a) for k in range(len(bare(t)) - 3))}
    a, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")
    for limit, block in ((100_000, 512), (0, 7)):
        monkeypatch.setattr(audit, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(audit, "BLOCK_CHARS", block)
        got = [tuple(r) for r in audit.leaks(a, q, 4).collect()]
        assert len(got) == len(want) and set(got) == want


def test_similarity_with_a_bound(spark):
    rnd = random.Random(8)
    pairs = [("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))), "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 12)))) for _ in range(300)] + [(None, "a"), ("a", None), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string").select(T.similarity_ratio("a", "b").alias("full"), T.similarity_at_least("a", "b", 0.7).alias("s"))
    found = df.select("full", "s.ratio", "s.matched").collect()
    assert all(r.ratio == (r.full if r.full is not None and r.full >= 0.7 else None) for r in found)
    assert 0 < sum(r.matched for r in found) < len(found) / 2


def test_punctuated():
    words = [(0, 1, "你好"), (1, 2, "再見"), (5, 6, "走")]
    assert episodes.punctuated(words, "。你好。再見，走") == [(0, 1.0, "你好。"), (1.0, 2.0, "再見，"), (5.0, 6.0, "走")]
    assert episodes.punctuated(words, "你／好") == [(0, 0.5, "你"), (0.5, 1.0, "好")]
    # characters that the words lack or have in excess move nothing behind them
    late = [(0.0, 1.5, "白玉米"), (6.5, 8.0, "青椒呢")]
    assert episodes.punctuated(late, "白玉啊米。青椒呢？") == [(0.0, 1.5, "白玉啊米。"), (6.5, 8.0, "青椒呢？")]
    assert episodes.punctuated(late, "白米。青椒呢？") == [(0.0, 1.5, "白米。"), (6.5, 8.0, "青椒呢？")]
    assert episodes.punctuated([(0.0, 1.0, "紅色"), (1.0, 2.0, "蘋果"), (2.0, 3.0, "很好")], "紅色的蘋果很好。") == [(0.0, 3.0, "紅色的蘋果很好。")]
    assert episodes.punctuated([(0.0, 1.0, "Go"), (1.0, 2.0, "on")], "Go on!") == [(0.0, 2.0, "Go on!")]
    assert episodes.punctuated(words, "") == [] == episodes.punctuated([], "好")


def test_aligned():
    words = [(0.0, 2.0, "紅色蘋果"), (2.0, 4.0, "很好吃喔"), (4.0, 7.0, "Apple餅"), (7.0, 8.0, "再來一個")]
    assert episodes.aligned(words, ["紅色蘋果很好", "吃喔Apple餅再來一個"]) == [(0.0, 3.0, "紅色蘋果很好"), (3.0, 8.0, "吃喔Apple餅再來一個")]
    assert episodes.aligned(words, ["紅色頻果很好吃喔", "Apple餅，再來一個"]) == [(0.0, 4.0, "紅色頻果很好吃喔"), (4.0, 8.0, "Apple餅，再來一個")]
    assert episodes.aligned(words, ["今天天氣真好嗎"]) is None and episodes.aligned([], ["紅"]) is None
    assert episodes.aligned(words, []) is None and episodes.aligned(words, ["紅色蘋果很好吃喔", "。"]) is None


@given(st.lists(st.tuples(st.text("abcd紅色", min_size=1, max_size=4), st.floats(0.05, 1), st.floats(0, 0.5)), min_size=1, max_size=12), st.data())
def test_aligned_lines_keep_order_and_text(parts, data):
    at, words = 0.0, []
    for text, length, gap in parts:
        words.append((at, at + length, text))
        at += length + gap
    joined = "".join(w[2] for w in words)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(joined) - 1)), max_size=3)) & set(range(1, len(joined))))
    lines = [joined[a:b] for a, b in zip([0, *cuts], [*cuts, len(joined)])]
    out = episodes.aligned(words, lines)
    assert [c[2] for c in out] == lines and (out[0][0], out[-1][1]) == (0.0, words[-1][1])
    assert all(c[0] < c[1] for c in out) and all(a[1] <= b[0] + 1e-9 for a, b in zip(out, out[1:]))


def test_corrections_in_place(spark):
    def corrected(texts, pairs):
        fit = [(n, right) for n, right in ((T.fold(w)[0], right) for w, right in pairs) if len(n) == len(right)]
        return episodes.corrected(texts, fit, Patterns([n for n, _ in fit]))

    fixed = corrected(["快來", "喝", "，", "咖", "非吧 Coffe"], [("咖非", "咖啡"), ("COFFE", "茶茶茶茶茶"), ("喝", "喝茶")])
    assert fixed == (["快來", "喝", "，", "咖", "啡吧 茶茶茶茶茶"], [0, 0, 0, 1, 1])
    assert corrected(["咖，", "非"], [("咖非", "咖啡")])[0] == ["咖，", "啡"]
    words = spark.createDataFrame([(1, 0, "咖", 0.0, 1.0), (1, 1, "非", 1.0, 2.0), (2, 0, None, 0.0, 1.0)], WORDS)
    assert rows(segments.correct_words(words, [("咖非", "咖啡")]).select("ep", "pos", "text", "end", "hits"), "ep", "pos") == [(1, 0, "咖", 1.0, 1), (1, 1, "啡", 2.0, 0), (2, 0, "", 1.0, 0)]


def test_widened():
    assert episodes.widened("我要去喝咖非上班", "喝咖非", "非", "啡") == ("咖非上", "咖啡上")
    assert episodes.widened("非常想喝咖非啊", "喝咖非", "非", "啡") == ("咖非啊", "咖啡啊")
    assert episodes.widened("喝咖非館", "喝咖非館", "咖非館", "咖啡館") == ("咖非館", "咖啡館")
    assert episodes.widened("非！", "非", "非", "啡") is None and episodes.widened("a", "b", "b", "c") is None


def test_lines(spark):
    text = "a" * 150 + "\n" + "b" * 40 + "\n" + "c" * 160
    df = spark.createDataFrame([(1, text), (2, "a\nb"), (3, "a" * 300), (4, None), (5, "a" * 100 + "\n" + "b" * 100 + "\n" + "c" * 99)], "k int, t string")
    got = rows(df.select("k", segments.split_at_pause(F.col("t")).alias("s")).select("k", "s.left", "s.right"), "k")
    assert got == [(1, "a" * 150 + "\n" + "b" * 40, "\n" + "c" * 160), (2, None, None), (3, None, None), (4, None, None), (5, "a" * 100, "\n" + "b" * 100 + "\n" + "c" * 99)]
    echo = spark.createDataFrame([(1, ["One two", "three", "four"], "x one, TWO y", "four"), (2, ["a", "b"], "", None), (3, ["a", "b"], "ab", "ab"), (4, ["a", "x", "b"], "a", "b"), (5, [], "", "")], "k int, l array<string>, p string, q string")
    assert rows(echo.select("k", segments.strip_echo(F.col("l"), F.col("p"), F.col("q"))), "k") == [(1, ["three"]), (2, ["a", "b"]), (3, []), (4, ["x"]), (5, [])]
    lines = spark.createDataFrame([(1, "yes\nthis is long\nyes\n \nThis is, long!\nthis is long too")], "k int, t string")
    assert [r.line for r in segments.dedupe_lines(lines, ["k"], "t").orderBy("pos").collect()] == ["yes", "this is long", "yes", "this is long too"]


def test_wrapped():
    assert segments.wrapped("短句") == "短句"
    cut = segments.wrapped("一二三四五六七八九，一二三四五六七八九")
    assert cut == "一二三四五六七八九，\n一二三四五六七八九"
    assert segments.wrapped("一" * 22) == "一" * 11 + "\n" + "一" * 11
    assert segments.wrapped("a" * 60) == "a" * 60


@given(st.lists(st.tuples(st.floats(0.05, 3), st.floats(0, 2), st.text("好a。，", min_size=1, max_size=6)), max_size=12))
def test_folds_keep_text_and_order(parts):
    at, cues = 0.0, []
    for length, gap, text in parts:
        cues.append((at, at + length, text))
        at += length + gap
    joined = "".join(c[2] for c in cues)
    for rule in (episodes.without_fragments, episodes.without_unreadable, episodes.without_short, None):
        out = merged(rule, cues) if rule else episodes.stretch_short(cues)
        assert "".join(c[2] for c in out) == joined
        assert all(a[1] <= b[0] + 1e-9 for a, b in zip(out, out[1:]))


def test_folds_on_frames(spark):
    words = spark.createDataFrame([(e, i, "字", i * 0.5, i * 0.5 + 0.4) for e in (1, 2) for i in range(60)], WORDS)
    out = segments.cue_pipeline(words)
    assert out.groupBy("ep").count().count() == 2
    assert out.agg(F.sum(F.length(F.replace("text", F.lit("\n"), F.lit(""))))).first()[0] == 120
    empty = spark.createDataFrame([], WORDS)
    assert segments.cue_pipeline(empty).count() == 0
    assert segments.chunks(words, 10, 20, 5.0).count() == 6


def test_drop_phrases(spark):
    words = spark.createDataFrame([(1, 0, "Hello,", 0.0, 1.0), (1, 1, " World", 1.0, 2.0), (1, 2, "again", 2.0, 3.0)], WORDS)
    assert [r.text for r in segments.drop_phrases(words, ["o w"]).collect()] == ["again"]


def test_validate(spark):
    cues = spark.createDataFrame([(1, 1, -1.0, 0.0, "ok"), (1, 2, 0.0, 20.0, " "), (1, 4, 19.0, 19.2, "太長" * 12)], CUES)
    length = spark.createDataFrame([(1, 19.0)], "ep long, seconds double")
    got = {(r.idx, r.rule) for r in segments.validate(cues, length).collect()}
    assert got == {(1, "bounds"), (2, "empty"), (2, "overlap"), (2, "duration"), (4, "bounds"), (4, "line_width"), (4, "duration"), (4, "speed"), (4, "index")}


def test_collapse_repeats_and_strip(spark):
    df = spark.createDataFrame([("a" * 200 + "b",)], "s string")
    assert df.select(segments.collapse_repeats(F.col("s"), 6)).first()[0] == "aaaaaab"
    cues = spark.createDataFrame([(1, 1, 0.0, 1.0, "，， 好"), (1, 2, 1.0, 2.0, "。")], CUES)
    assert rows(segments.strip_leading(cues).select("idx", "text"), "idx") == [(1, "好")]


def test_collapse_repeats_over_words(spark):
    rng = random.Random(4)
    eps = {0: ["a"] * 8, 1: ["xaaa,", "!", "aa a", None, "aaab", "bb…b"], 2: ["，", "好好好好", "好 好。好好", "好x"]}
    eps |= {e: ["".join(rng.choice("aaaaaab,. ") for _ in range(rng.randint(0, 6))) for _ in range(12)] for e in range(3, 40)}
    words = spark.createDataFrame([(e, i, t) for e, ts in eps.items() for i, t in enumerate(ts)], "ep long, pos long, text string")
    got = {(r.ep, r.pos): (r.text, r.dropped, r.content) for r in segments.collapse_word_repeats(words.repartition(3)).collect()}
    for e, ts in eps.items():
        last, run = "", 0
        for i, t in enumerate(ts):
            kept, gone = "", 0
            for c in t or "":
                if c in ",. !…，。":
                    kept += c
                    continue
                run, last = run + 1 if c == last else 1, c
                kept, gone = (kept, gone + 1) if run > 6 else (kept + c, gone)
            assert got[e, i] == (kept, gone, any(c not in ",. !…，。" for c in kept))
    assert [got[0, i][1:] for i in (5, 6, 7)] == [(0, True), (1, False), (1, False)]


# --- search, spans, audit ------------------------------------------------------------------------------


def test_bm25_and_fuse(spark):
    docs = spark.createDataFrame([(1, "紅色蘋果"), (2, "白玉米"), (3, "紅色"), (4, None), (5, "")], "doc_id long, text string")
    q = spark.createDataFrame([(0, "紅色紅色")], "query_id int, query string")
    assert [r.id for r in search.bm25(docs, q).orderBy("rank").collect()] == [3, 1]
    lists = spark.createDataFrame([(0, 0, 1, 1), (0, 0, 2, 2), (0, 0, 3, 3), (0, 1, 1, 3), (0, 1, 2, 1)], "query_id int, list int, rank int, id int")
    assert [r.id for r in search.fuse(lists).orderBy("place").collect()] == [1, 3, 2]


def test_nearest(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "id long, v array<float>")
    q = spark.createDataFrame([(9, [0.2, 0.9])], "query_id long, q array<float>")
    assert [r.id for r in search.nearest(v, q).orderBy("rank").collect()] == [2, 1, 3]


def test_overlaps_against_brute_force(spark):
    rng = random.Random(1)
    spans_ = lambda: [(rng.randint(0, 2), s := rng.uniform(0, 100), s + rng.uniform(0, 30)) for _ in range(40)]
    a, b = spans_(), spans_()
    got = spans.overlaps(spark.createDataFrame(a, "k int, a0 double, a1 double"), spark.createDataFrame(b, "k int, b0 double, b1 double"), "k", 7.0)
    assert got.count() == sum(x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2] for x in a for y in b)


def test_grep_is_literal_and_ascii_only(spark):
    df = spark.createDataFrame([(1, "100% Sure"), (2, "ÉTÉ"), (3, None)], "i int, t string")
    assert [r.i for r in spans.grep(df, "t", ["0% sURE"]).collect()] == [1]
    assert spans.grep(df, "t", ["été"]).count() == 0


def test_match_across(spark):
    df = spark.createDataFrame([(1, 0, "The qu"), (1, 1, "ick, "), (1, 2, "fox"), (2, 0, "quick")], "k int, i int, t string")
    assert rows(spans.match_across(df, "quickf", "k", "i", "t").select("k", "i"), "i") == [(1, 0), (1, 1), (1, 2)]


def test_votes(spark):
    docs = spark.createDataFrame([(1, list("xabcdx")), (2, list("abxx")), (3, list("ab"))], "row_id int, units array<string>")
    refs = spark.createDataFrame([(7, list("abcd")), (8, list("abc"))], "ref_id int, units array<string>")
    assert rows(audit.best_window(audit.votes(docs, refs)), "row_id") == [(1, 7, 1, 4, 1.0), (2, 7, 0, 2, 0.5)]


def test_minorities(spark):
    counts = spark.createDataFrame([("k", "common", 12), ("k", "rare", 1), ("j", "alone", 20)], "sound string, text string, n long")
    assert rows(audit.minorities(counts), "text") == [("k", "rare", 1, "common", 12, 0.923)]
    runs = spark.createDataFrame([(["a", "b", "a", "b"],)], "units array<string>")
    assert {(r.text, r.n) for r in audit.spellings(runs, lambda c: c, (2, 3)).collect()} == {("a b", 2), ("b a", 1), ("a b a", 1), ("b a b", 1)}


def test_nested_and_fragments(spark):
    df = spark.createDataFrame([(1, "abc", 0), (1, "bc", 1), (1, "abc", 2), (2, "bc", 3)], "k int, t string, o int")
    assert rows(audit.drop_nested(df, "k", "t", "o"), "o") == [(1, "abc", 0), (2, "bc", 3)]
    q = spark.createDataFrame([("他說咖啡", "「咖啡」應為", "咖非"), ("已是咖非", "無", "咖非"), ("其他", "無", "咖非")], "t string, d string, s string")
    assert [r[0] for r in q.select(audit.quoted_fragment("t", "d", "s")).collect()] == ["咖啡", None, "其他"]


def test_hit_rates(spark):
    ranks = spark.createDataFrame([("a", 1), ("a", 3), ("a", 12), ("a", None)], "style string, rank int")
    got = {r.style: r for r in audit.hit_rates(ranks, "style").collect()}
    assert (got["all"].hit_1, got["all"].hit_5, got["all"].hit_10, got["all"].hit_30, got["all"].n) == (0.25, 0.5, 0.5, 0.75, 4)


# --- tables and sources --------------------------------------------------------------------------------


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "c", 2), (2, "d", 4), (3, "e", 1)], "k int, v string, n int")
    once = store.upsert(old, new, ["k"], "n")
    assert rows(once, "k") == [(1, "c", 2), (2, "b", 5), (3, "e", 1)] == rows(store.upsert(once, new, ["k"], "n"), "k")


def test_partitions_and_dump(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, stem string")
    store.write_partitions(df, f"{tmp_path}/t", "stem")
    store.write_partitions(df.where("stem = 'a'").withColumn("v", F.lit(9)), f"{tmp_path}/t", "stem")
    assert rows(spark.read.parquet(f"{tmp_path}/t").select("v", "stem"), "stem") == [(9, "a"), (2, "b")]
    assert store.dump({"x": df}, f"{tmp_path}/dump") == {"x": 2}


def test_breaker_and_retention(spark):
    df = spark.createDataFrame([(1, i, i in (2, 3, 4, 6)) for i in range(8)], "k int, i int, bad boolean")
    assert [r.i for r in store.breaker(df, "k", "i", "bad").orderBy("i").collect()] == [0, 1, 2, 3, 4]
    files = spark.createDataFrame([("copy-2024-01-01.db",), ("copy-2024-01-02.db",), ("other",)], "name string")
    assert rows(store.retired(files, "name", r"^copy-\d{4}-\d\d-\d\d\.db$", 1), "name") == [("copy-2024-01-01.db",)]


def test_srt_round_trip(spark, tmp_path):
    cues = spark.createDataFrame([(1, 1, 0.0, 1.5, "a\nb"), (1, 2, 2.0, 3661.001, "c")], CUES)
    srt = subtitles.render_srt(cues, "ep")
    assert srt.first().srt == "1\n00:00:00,000 --> 00:00:01,500\na\nb\n\n2\n00:00:02,000 --> 01:01:01,001\nc\n"
    assert rows(subtitles.parse_srt(srt, "ep", "srt"), "idx") == rows(cues, "idx")
    (tmp_path / "x.srt").write_text(srt.first().srt)
    assert [r.stem for r in subtitles.read_srt(spark, str(tmp_path / "x.srt")).collect()] == ["x", "x"]


def test_pages(spark):
    df = spark.createDataFrame([(1, "* '''Ann:''' [[Page|Hello]] ''you''\n* '''Pat''': Hi")], "k int, w string")
    assert rows(pages.transcript_lines(df, "k", "w"), "pos") == [(1, 0, "Ann", "Hello you"), (1, 1, "Pat", "Hi")]
    names = spark.createDataFrame([("x_S1_ep12_(a_b).mp4",), ("y",)], "n string")
    assert [tuple(r) for r in names.select(*pages.episode_name(F.col("n"))).collect()] == [(1, 12, "a／b"), (None, None, None)]
    found, error = pages.single_source(F.col("n"), [r"id=(\w+)"])
    ids = spark.createDataFrame([("id=a id=a",), ("id=a id=b",), ("",)], "n string").select(found, error)
    assert [tuple(r) for r in ids.collect()] == [("a", None), (None, "several: a, b"), (None, "none")]


def test_dimensions(spark, tmp_path):
    import pytest

    (tmp_path / "g.yml").write_text("terms:\n- {correct: 咖啡, wrong: [咖非], whisper_hint: true}\n- {correct: abc}\n")
    terms = dimensions.glossary(spark, str(tmp_path / "g.yml"))
    assert [(r.pos, r.correct, r.wrong) for r in terms.orderBy("pos").collect()] == [(0, "咖啡", ["咖非"]), (1, "abc", [])]
    assert dimensions.hint_terms(terms, 5).count() == 1 and dimensions.hint_terms(terms, 3).count() == 0
    (tmp_path / "t.yml").write_text("a: [x, x]\n")
    with pytest.raises(ValueError):
        dimensions.taxonomy(spark, str(tmp_path / "t.yml"), ("a",))
