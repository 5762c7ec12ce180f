"""Changes by keyed state, over runs that end, fail and start again."""

import glob
import json
import os
import shutil

import pytest

from storyloom.streaming.latest import follow

SCHEMA = "stem string, md5 string, n long, title string"


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

        def land(self, *rows):
            spark.createDataFrame([(*r, f"t{r[0]}") for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

        def run(self, **options):
            follow(spark, self.source, SCHEMA, "stem", "md5", "n", self.out, self.checkpoint, **options)

        def rows(self):
            return sorted((r.stem, r.n, r.kind, r.times, r.title) for r in spark.read.parquet(self.out).collect())

    return Place()


def test_only_changes_are_handed_on(place):
    place.land(("a", "1", 1), ("b", "1", 1), (None, "1", 1), ("z", "1", None))
    place.run()
    first = [("a", 1, "new", 1, "ta"), ("b", 1, "new", 1, "tb")]
    assert place.rows() == first
    place.run()
    assert place.rows() == first
    place.land(("a", "1", 2), ("b", "2", 2), ("b", "9", 1), ("c", None, 1))
    place.run()
    assert place.rows() == sorted([*first, ("b", 2, "changed", 2, "tb"), ("c", 1, "new", 1, "tc")])
    place.land(("b", "1", 1), ("c", "5", 2))  # a late row, and a digest in place of none
    place.run()
    assert place.rows()[-1] == ("c", 2, "changed", 2, "tc") and len(place.rows()) == 5


def test_a_batch_that_is_run_again_adds_nothing(place):
    for n in range(1, 4):
        place.land(("a", str(n), n), (f"k{n}", "1", n))
    place.run(files=1)
    whole = place.rows()
    assert [r[:4] for r in whole if r[0] == "a"] == [("a", 1, "new", 1), ("a", 2, "changed", 2), ("a", 3, "changed", 3)]
    commits = sorted(glob.glob(f"{place.checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])  # as if the run had ended right after its output
    crc = os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    place.run(files=1)
    assert place.rows() == whole


def test_state_follows_the_keys_that_came(place):
    place.land(*[(f"k{i}", "1", 1) for i in range(300)])
    place.run()
    place.land(("k7", "2", 2))
    place.run()
    log = sorted(glob.glob(f"{place.checkpoint}/offsets/[0-9]*"))
    assert len(log) >= 2 and len(place.rows()) == 301
    assert place.rows()[-1][0] == "k99" and ("k7", 2, "changed", 2, "tk7") in place.rows()
