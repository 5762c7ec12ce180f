"""Cross-tokenizer alignment against the plain definition."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from storyloom.llm import token_alignment as ta

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    byte = ta.byte_of_char()

    def bytes_b(i):
        x = sp.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if sp.is_byte(i) else x.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        a, b = tk.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        sides = [[bytes(map(byte.__getitem__, tk.id_to_token(i))) for i in a], [bytes_b(i) for i in b]]
        if any(b"".join(s) != (" " + text).encode() for s in sides):
            return None
        spans = []
        for s in sides:
            at, out = 0, []
            for x in s:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, j0 = [], 0
        for i, (lo, hi) in enumerate(spans[0]):
            while spans[1][j0][1] <= lo:
                j0 += 1
            j = j0
            while j < len(b) and spans[1][j][0] < hi:
                links.append((a[i], b[j]))
                j += 1
        common = sorted({h for _, h in spans[0]} & {h for _, h in spans[1]})
        groups, ia, ib = [], 0, 0
        for end in common:
            left, right = [], []
            while ia < len(a) and spans[0][ia][1] <= end:
                left.append(a[ia])
                ia += 1
            while ib < len(b) and spans[1][ib][1] <= end:
                right.append(b[ib])
                ib += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def whole(rows):
        told = [one(t) for _, t in rows]
        counts = Counter(p for x in told if x for p in set(x[3]))
        best = defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        out = []
        for (i, _), x in zip(rows, told):
            out.append((i, 0, 0, 0, 0, 0, 0, "") if x is None else (i, *x[:3], len(x[3]), sum(counts[p] == best[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]))
        return out

    return whole


def same(df, want):
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


EDGES = [None, "", " ", "  ", "\n", "\t x", " \n y", "a  b", "x\r\n;\r y", "<s> </s> <unk> <0x41>", "<|endoftext|> a<|endoftext|>", "▁a", "a ▁ b", "中文 字😀é́", "x\x00y", "\x85 \xa0　z", "ab" * 3000, "word " * 20_000, "\r", "(){\r} ();\r", " lead", "trail \n\t ", "don't it's 12345 ...", "don't it's 12345 ..."]


def test_edges_and_noise(spark, plain, monkeypatch):
    rnd = random.Random(4)
    alphabet = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\r", "é", "ß", "中", "😀", ".", ",", ";\r", "'s", "1", "23", "\xa0", " ", "\x00", "_", "  \n "]
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(None, "null id"), (3, "again"), (3, "again")]
    rows += [(100 + k, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60)))) for k in range(300)]
    df = spark.createDataFrame([(i, t, 1, "k", "x") for i, t in rows], "doc_id long, text string, chunk long, kind string, key string")
    same(ta.align(df), plain(rows))
    assert ta.align(df.limit(0)).count() == 0


def test_given_documents(spark, plain):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    same(ta.query(spark, SF), plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]))


def test_chunks_and_forgetting(plain, monkeypatch):
    """Small batches, chunks and memories give the same ids."""
    monkeypatch.setattr(ta, "REMEMBERED", 3)
    monkeypatch.setattr(ta, "JOINED", 2)
    with open(ta.VOCABULARY_A, "rb") as f, open(ta.MODEL_B, "rb") as g:
        pair = ta.Pair(f.read(), g.read())
    texts = [t or "" for t in EDGES]
    first = pair.encode(texts)
    assert [x for t in texts for x in pair.encode([t])] == first
    chunk = ta._Chunk(0, pair.same)
    for x in first:
        chunk.add(ta.Joint([x], pair.lengths_a, pair.lengths_b))
    whole = ta._Chunk(0, pair.same)
    whole.add(ta.Joint(first, pair.lengths_a, pair.lengths_b))
    assert chunk.rows() == whole.rows()
