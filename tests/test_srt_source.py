"""SRT files as a data source: what is read, what is skipped, and what a write leaves."""

import os

import pytest

from storyloom.sources import srt, subtitles

COLUMNS = "stem string, idx int, start double, end double, text string"
CUES = [("a", 1, 0.0, 1.5, "x\ny"), ("a", 2, 2.0, 3661.001, ""), ("b", 1, 0.25, 0.5, "中文"), ("c d+%", 1, 1.0, 2.0, "z")]


def rows(df):
    return sorted(tuple(r) for r in df.select("stem", "idx", "start", "end", "text").collect())


def test_round_trip_equals_the_column_functions(spark, tmp_path):
    path = str(tmp_path / "out")
    cues = spark.createDataFrame(CUES, COLUMNS)
    srt.write_srt(cues, path)
    assert sorted(os.listdir(path)) == ["a.srt", "b.srt", "c d+%.srt"]
    assert rows(srt.read(spark, path)) == sorted(CUES) == rows(srt.read(spark, "file://" + path))
    assert {r.stem: r.srt for r in subtitles.render_srt(cues, "stem").collect()} == {n[:-4]: open(f"{path}/{n}").read() for n in os.listdir(path)}
    assert rows(subtitles.read_srt(spark, path)) == sorted(CUES)
    assert rows(srt.read(spark, f"{path}/b.srt")) == [CUES[2]]


def test_files_are_skipped_by_name(spark, tmp_path):
    path = str(tmp_path)
    srt.write_srt(spark.createDataFrame(CUES, COLUMNS), path)
    (tmp_path / "bad.srt").write_text("no block at all")
    (tmp_path / "note.txt").write_text("no block at all")
    (tmp_path / "empty.srt").write_text("\n\n")
    assert rows(srt.read(spark, path, "a")) == sorted(CUES)[:2]  # a file that is opened would be an error
    assert rows(srt.read(spark, path, stems=["b", "a"]).where("idx = 1")) == [CUES[0], CUES[2]]
    assert rows(srt.read(spark, path, "c", ["c d+%", "a"])) == [CUES[3]]
    assert rows(srt.read(spark, path, stems=[])) == rows(srt.read(spark, path, "none")) == rows(srt.read(spark, path, stems=["empty"])) == []
    with pytest.raises(Exception, match="malformed block"):
        srt.read(spark, path).collect()


def test_uses_of_one_frame_do_not_mix(spark, tmp_path):
    srt.write_srt(spark.createDataFrame(CUES, COLUMNS), str(tmp_path))
    df = srt.read(spark, str(tmp_path))
    assert rows(df.where("stem = 'a'").union(df.where("stem = 'b'"))) == sorted(CUES)[:3]
    assert rows(df.where("stem = 'b'")) == [CUES[2]] and rows(df) == sorted(CUES)


def test_files_are_dealt_by_bytes(spark, tmp_path):
    srt.write_srt(spark.createDataFrame([(f"e{i:02d}", 1, 0.0, 1.0, "x" * 100) for i in range(20)], COLUMNS), str(tmp_path))
    reader = srt.Reader(str(tmp_path), 300)
    assert [len(p.paths) for p in reader.partitions()] == [2] * 10
    assert spark.read.format("srt").option("partitionBytes", 300).load(str(tmp_path)).rdd.getNumPartitions() == 10


def test_same_names_are_replaced(spark, tmp_path):
    path = str(tmp_path)
    for n in range(2):
        srt.write_srt(spark.createDataFrame(CUES, COLUMNS), path)
    srt.write_srt(spark.createDataFrame([("b", 7, 0.0, 1.0, "new")], COLUMNS), path)
    assert rows(srt.read(spark, path)) == sorted([CUES[0], CUES[1], ("b", 7, 0.0, 1.0, "new"), CUES[3]])
    srt.write_srt(spark.createDataFrame([("b", 8, 0.0, 1.0, None)], COLUMNS), path, "overwrite")
    assert os.listdir(path) == ["b.srt"] and rows(srt.read(spark, path)) == [("b", 8, 0.0, 1.0, "")]


def test_a_task_that_ran_twice_and_a_job_that_failed(spark, tmp_path):
    row = spark.createDataFrame(CUES, COLUMNS).collect()
    writer = srt.Writer(str(tmp_path), False)
    writer.write(iter(row[:2]))  # an attempt that was lost after its work
    done = writer.write(iter(row[:2]))
    writer.commit([done, None])
    assert os.listdir(tmp_path) == ["a.srt"]
    before = (tmp_path / "a.srt").read_text()
    failed = srt.Writer(str(tmp_path), True)
    failed.write(iter(row[2:]))
    failed.abort([None])
    split = srt.Writer(str(tmp_path), False)
    parts = [split.write(iter([r])) for r in row[:2]]
    with pytest.raises(ValueError, match="several places"):
        split.commit(parts)
    for bad in [("../x", 1, 0.0, 1.0, ""), (None, 1, 0.0, 1.0, ""), ("x", 1, -1.0, 1.0, ""), ("x", None, 0.0, 1.0, "")]:
        with pytest.raises(Exception):
            srt.write_srt(spark.createDataFrame([bad], COLUMNS), str(tmp_path))
    assert os.listdir(tmp_path) == ["a.srt"] and (tmp_path / "a.srt").read_text() == before
