"""The pipeline stage by stage against brute force on a small planted corpus."""

import random
import re

import pytest

import corpus_pipeline
from storyloom.llm import mixing


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng, home = random.Random(11), tmp_path_factory.mktemp("sf")
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(300):
        text = " ".join(word() for _ in range(60))
        rows.append([i, text + (" rotten scoundrel vermin" if i % 10 == 0 else ""), "en", f"s{i % 4}", 1])
    rows += [[300 + k, rows[k][1].replace(" ", "  "), "en", "s0", 1] for k in (1, 2, 3)]
    rows += [[310 + k, re.sub(r"^\S+", "changed", rows[k][1]), "en", "s1", 1] for k in (4, 5, 6)]
    rows += [[320, None, None, None, None], [321, "", "en", "s1", 0]]
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    return f"file://{home}", rows


def test_stages(spark, planted):
    sf, rows = planted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = sorted(r.doc_id for r in docs.collect())
    clean = {r[0] for r in rows} - {i for i in range(0, 300, 10)}
    assert set(kept["toxicity"]) == clean
    assert set(kept["exact_dedup"]) == clean - {301, 302, 303, 321}
    assert set(kept["near_dedup"]) == clean - {301, 302, 303, 321, 314, 315, 316}
    before = {r[0]: r for r in rows if r[0] in kept["near_dedup"]}
    sizes, mixed = {}, {}
    for i, r in before.items():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        sizes[r[3]] = sizes.get(r[3], 0) + n
        mixed[r[3]] = mixed.get(r[3], 0) + n * kept["source_mixing"].count(i)
    targets = mixing.target_sizes(sizes, mixing.weights_by_name(sizes))
    assert all(abs(mixed[s] - targets[s]) <= 60 for s in sizes)
    assert max(map(kept["source_mixing"].count, kept["source_mixing"])) <= 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == len(kept["source_mixing"])


def test_run_gives_the_rows_of_the_stages(spark, planted):
    sf, _ = planted
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "token_bytes"]
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "source_mixing", "byte_bpe"]
