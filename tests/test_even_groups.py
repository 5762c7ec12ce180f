"""Steps with much work a group stay spread over tasks, whatever their bytes."""

from pyspark.sql import functions as F

from storyloom.operators import episodes, segments


def _words(spark, episodes_: int, n: int):
    w = spark.range(episodes_ * n).select((F.col("id") % episodes_).alias("ep"), F.floor(F.col("id") / episodes_).cast("int").alias("pos"))
    return w.select("ep", "pos", F.element_at(F.array(*map(F.lit, ("view ", "click ", "error "))), (F.col("pos") % 3 + 1).cast("int")).alias("text"), (F.col("pos") * 1.0).alias("start"), (F.col("pos") + 0.5).alias("end"))


def _tasks_with_rows(df) -> int:
    df.count()  # the plan is settled
    return sum(1 for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n)


def test_groups_of_small_episodes_are_not_put_into_one_task(spark):
    words = segments.polish_windows(_words(spark, 40, 12), 20)
    lines = words.where("window = 0").groupBy("ep", "window").agg(F.lit(0).alias("pos"), F.lit("view click error").alias("text"))
    for name, df in {
        "raw": segments.raw_segments(words),
        "short": segments.merge_short(segments.raw_segments(words)),
        "lines": segments.align_lines(words, lines),
        "windows": segments.polish_windows(words.drop("window"), 20),
    }.items():
        assert _tasks_with_rows(df) > 1, name


def test_lines_of_episodes_without_words_and_null_keys(spark):
    words = spark.createDataFrame([(None, 0, "ab", 0.0, 1.0), (1, 1, None, 2.0, 3.0), (1, 0, "abcd", 0.0, 1.5)], "ep long, pos int, text string, start double, end double")
    lines = spark.createDataFrame([(None, 0, "ab"), (1, 0, "abcd"), (2, 0, "abcd")], "ep long, pos int, text string")
    got = {(r.ep, r.idx, r.start, r.end, r.text) for r in segments.align_lines(words, lines).collect()}
    want = {(None, 1, *c) for c in episodes.aligned([(0.0, 1.0, "ab")], ["ab"])} | {(1, 1, *c) for c in episodes.aligned([(0.0, 1.5, "abcd"), (2.0, 3.0, "")], ["abcd"])}
    assert got == want and len(want) == 2
