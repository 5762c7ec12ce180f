from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.functions import text as T


def column(spark, expr, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.select("i", expr(F.col("s")).alias("r")).orderBy("i").select("r").collect()]


def test_display_width(spark):
    assert column(spark, T.display_width, "ab", "中a", "", "中\n文", "😀") == [1.0, 1.5, 0.0, 2.5, 1.0]
    assert [T.width(x) for x in ("ab", "中a", "", "中\n文", "😀")] == [1.0, 1.5, 0.0, 2.5, 1.0]


def test_bigrams(spark):
    assert column(spark, T.bigrams, "紅色，蘋果", "a", "", "!?") == [["紅色", "色蘋", "蘋果"], ["a"], [], []]


def test_spaces_and_marks(spark):
    assert column(spark, T.clean_spaces, "  中  文 a  b ", "中 a") == ["中文 a b", "中 a"]
    assert column(spark, T.full_width, "好,a,b?好!", "a,") == ["好，a,b?好！", "a,"]


def test_slugify(spark):
    assert column(spark, T.slugify, " a/b: 中 文! ", "///", "x" * 90) == ["a-b-中-文", "untitled", "x" * 80]


def test_sound_key_and_closeness(spark):
    assert column(spark, T.sound_key, "zhing", "shen", "cheng", "ba", "sheng") == ["zin", "sen", "cen", "ba", "sen"]
    df = spark.createDataFrame([(["ba", "ma"], ["ba", "na"]), (["ba", "ma"], ["ba", "ma"]), (["ba", "ma"], ["du", "li"]), (["a"], ["a", "b"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(T.sounds_alike(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]


def test_variants(spark):
    assert column(spark, T.canonical_variants, "她的裡", "他得里") == ["他的裡", "他的裡"]


def test_replace_terms(spark):
    text, n = T.replace_terms(F.col("s"), [("cob", "cobby"), ("cat", "dog")])
    df = spark.createDataFrame([("cob and cobby cat cat",)], "s string").select(text, n)
    assert tuple(df.first()) == ("cobby and cobby dog dog", 3)


def test_times(spark):
    df = spark.createDataFrame([(0.0005,), (0.0015,), (3661.5,)], "x double")
    assert [r[0] for r in df.select(T.srt_timestamp(F.col("x"))).collect()] == ["00:00:00,000", "00:00:00,002", "01:01:01,500"]
    assert column(spark, T.clock_seconds, "1:05", "7.5") == [65.0, 7.5]
    assert [r[0] for r in df.select(T.clock_text(F.col("x"))).collect()] == ["0:00", "0:00", "61:01"]


def test_leak_and_ratio(spark):
    df = spark.createDataFrame([("xx abcd", "zzab cdzz"), ("abc", "abc"), (None, "a"), ("", "")], "q string, a string")
    assert [r[0] for r in df.select(T.leak(F.col("q"), F.col("a"))).collect()] == [True, False, False, False]
    ratio = [r[0] for r in df.select(T.similarity_ratio("q", "a")).collect()]
    assert ratio[1:] == [1.0, None, 1.0]
    assert [tuple(r[0]) for r in df.limit(2).select(T.edit_budget("q", "a")).collect()][1] == (0.0, 0.0)


def test_normalized(spark):
    got = column(spark, T.normalized, "Ａ-b ﬁ", None)
    assert (got[0].norm, got[0].at) == ("abfi", [0, 2, 4, 4]) and got[1].norm == ""


@given(st.text(max_size=40))
def test_fold_maps_into_the_text(text):
    norm, at = T.fold(text)
    assert len(norm) == len(at) and at == sorted(at) and all(0 <= i < len(text) for i in at)


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in df.select(T.cosine_distance(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 1.0]
