"""Words whose polynomial hashes are equal modulo 2^64 stay apart, and all links of a whole table are found."""

import re
from collections import Counter

import pyarrow as pa

from storyloom.llm import katz, kernels, minhash

SF = "/root/testdata/sf0.01"


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_opposite_letters_have_other_hashes():
    for n in (64, 1024, 2048, 4096, 8192, 1 << 15, 1 << 22):
        a, b = (list(kernels.word_hashes(pa.array([w])))[0][2][0] for w in thue_morse(n))
        assert a != b, n


def test_a_word_has_one_hash_beside_long_ones():
    for long_ in ("", "x" * 4095, "x" * 4097, "é" * 5000, "x" * 20_000):
        hashes = list(kernels.word_hashes(pa.array([f"one {long_} two", "two", "one"])))[0][2]
        assert hashes[0] == hashes[-1] and hashes[-3] == hashes[-2]


def test_operators_keep_such_words_apart(spark):
    a, b = thue_morse(2048)
    df = spark.createDataFrame([(1, f"x {a} y"), (2, f"x {b} y"), (3, f"x {a} y")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 3, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    held = [i for i in range(1, 400) if katz_held_out(i)][:1]
    rows = [(i, a) for i in range(1, 6) if not katz_held_out(i)] + [(held[0], b)]
    scored = {r.doc_id: r.n_known for r in katz.score_documents(spark.createDataFrame([(*r, katz_held_out(r[0])) for r in rows], "doc_id long, text string, held_out boolean")).collect()}
    assert scored[held[0]] == 1  # the end alone


def katz_held_out(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 7 == 2


def test_near_duplicates_of_a_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {}
    for r in df.select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1 :]:
            if 100 * len(sets[i]) < 85 * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    want = Counter((i, len(s), root(i), root(i) == i) for i, s in sets.items())
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.query(spark, SF).collect()) == want
