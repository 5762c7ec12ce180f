"""Tables that are replaced together."""

import os

import pytest

from storyloom.operators import versions

PARENT, CHILD = "ep long, title string", "ep long, idx int, text string"


@pytest.fixture
def library(spark, tmp_path):
    root = f"file://{tmp_path}/library"
    eps = spark.createDataFrame([(i, f"t{i}") for i in range(40)] + [(None, "none")], PARENT)
    cues = spark.createDataFrame([(i, k, f"{i}-{k}") for i in range(40) for k in range(3)] + [(None, 0, "n")], CHILD)
    versions.replace(spark, root, {"episodes": eps, "cues": cues}, "ep", buckets=8)
    return root


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_children_go_with_the_parent(spark, library):
    before = versions.current(spark, library)
    new = {"episodes": spark.createDataFrame([(3, "new"), (99, "more")], PARENT), "cues": spark.createDataFrame([(3, 0, "only")], CHILD)}
    now = versions.replace(spark, library, new, "ep")
    assert rows(now.table("cues").where("ep = 3")) == [(3, 0, "only")] and now.table("cues").count() == 40 * 3 + 1 - 2
    assert rows(now.of("episodes", [3, 99, 5])) == [(3, "new"), (5, "t5"), (99, "more")]
    assert rows(before.table("cues").where("ep = 3")) == [(3, k, f"3-{k}") for k in range(3)]  # a reader of the old state
    old, fresh = (s.state["tables"]["cues"]["buckets"] for s in (before, now))
    assert 0 < sum(old[b] != fresh.get(b) for b in old) <= 2  # the buckets of two keys
    gone = versions.replace(spark, library, {"episodes": new["episodes"].limit(0)}, "ep", keys=spark.createDataFrame([(3,), (None,)], "ep long"))
    assert gone.table("episodes").where("ep = 3 OR ep IS NULL").count() == gone.table("cues").where("ep = 3 OR ep IS NULL").count() == 0


def test_a_failed_change_leaves_all_tables(spark, library, monkeypatch):
    before = {t: rows(versions.current(spark, library).table(t)) for t in ("episodes", "cues")}
    new = {"episodes": spark.createDataFrame([(3, "new")], PARENT), "cues": spark.createDataFrame([(3, 0, "only")], CHILD)}
    real = versions.Files.write

    def fail(self, name, text):
        if name.endswith("current"):
            raise OSError("lost")
        real(self, name, text)

    monkeypatch.setattr(versions.Files, "write", fail)
    with pytest.raises(OSError):
        versions.replace(spark, library, new, "ep")
    assert {t: rows(versions.current(spark, library).table(t)) for t in before} == before
    monkeypatch.undo()
    with pytest.raises(ValueError):
        versions.replace(spark, library, {"episodes": new["episodes"], "cues": spark.createDataFrame([(4, 0, "x")], CHILD)}, "ep")
    assert {t: rows(versions.current(spark, library).table(t)) for t in before} == before
    versions.replace(spark, library, new, "ep")
    again = rows(versions.replace(spark, library, new, "ep").table("cues"))
    assert (3, 0, "only") in again and len(again) == len(before["cues"]) - 2
    gone = versions.prune(spark, library, keep=1)
    assert gone and rows(versions.current(spark, library).table("cues")) == again
    assert versions.prune(spark, library, keep=1) == [] and len(os.listdir(library[7:])) > 2


def test_nothing_yet(spark, tmp_path):
    root = f"file://{tmp_path}/none"
    assert versions.current(spark, root) is None and versions.prune(spark, root) == []
    empty = versions.replace(spark, root, {"episodes": spark.createDataFrame([], PARENT)}, "ep")
    assert empty.table("episodes").count() == 0 and versions.current(spark, root).of("episodes", [1]).count() == 0
