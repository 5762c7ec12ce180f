from storyloom.streaming.incremental import process_changes


def test_only_changes_are_handled(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []

    def land(rows):
        spark.createDataFrame(rows, "stem string, md5 string, n int").coalesce(1).write.mode("append").parquet(source)

    def run():
        process_changes(spark, source, "stem string, md5 string, n int", str(tmp_path / "state"), str(tmp_path / "checkpoint"), "stem", "md5", "n", lambda df: seen.extend(sorted(r.stem for r in df.collect())))

    land([("a", "1", 1), ("b", "1", 1)])
    run()
    assert seen == ["a", "b"]
    run()
    assert seen == ["a", "b"]
    land([("a", "1", 2), ("b", "2", 2), ("c", "1", 1)])
    run()
    assert seen == ["a", "b", "b", "c"]
