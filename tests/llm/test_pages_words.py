"""Main text of pages and spelling variants: small tables, edge rows, and brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from storyloom.llm import page_text, spellings

PAGES = "page_id long, url string, html string, text string, n_chars string, pos string, kept string"


def page_frame(spark, sources):
    return spark.createDataFrame([(i, f"u{i}", h, "x", "y", "z", "w") for i, h in enumerate(sources)], PAGES)


def extracted(spark, *sources):
    return [r.text for r in page_text.extract(page_frame(spark, sources)).orderBy("page_id").collect()]


ARTICLE = "<article><h1>Title</h1><p>One <b>bold</b>word &amp; more.<p>Two<br>lines</article>"


def test_examples_are_learnt():
    rows, labels = page_text.examples()
    wrong = sum(page_text.keeps(page_text.trained(), r) != y for r, y in zip(rows, labels))
    assert len(rows) > 120 and wrong <= 2


@pytest.mark.parametrize("part", [
    "<nav><ul><li><a href=x>Menu</a><li><a href=y>Other</a></ul></nav>", "<header><h2>Site</h2><p>A slogan of quite some words for all to read.</p></header>",
    "<footer>&copy; all rights reserved by the owner of this very site, and more words</footer>", "<aside><h3>See also</h3><p>Words at the side that go on for a while here.</p></aside>",
    '<div class="ad">Buy this now, it is cheap and good and new and you will like it a lot.</div>', '<div id="cookieNotice"><p>We use cookies on this page to make it better for you.</p></div>',
    "<form>Your name <input name=n> <button>Send</button><textarea>hello</textarea></form>", "<script>if (a < b) { document.write('<p>no</p>') }</script>", "<style>p > a { color: red }</style>",
    '<section class="comments"><article class="comment"><p>A reader says that this was a good read and thanks the author.</p></article></section>', "<!-- a comment > with <p>marks</p> -->",
])
def test_parts_that_are_no_article(spark, part):
    want = "Title\nOne boldword & more.\nTwo lines"
    inside = "" if "<header>" in part else part  # an article's own header has its title
    assert extracted(spark, f"<html><body>{part}{ARTICLE}{part}</body></html>", f"<body>{ARTICLE[:-10]}{inside}</article>") == [want, want]


def test_pages_without_a_main_part(spark):
    long = "word " * 40
    got = extracted(spark, f"<div><a href=a>Home</a> <a href=b>News</a></div><div><p>{long}</p><p>{long}more</p></div><div><a href=c>Next page</a></div>")
    assert got == [f"{long.strip()}\n{long}more"]


def test_page_edges(spark):
    huge = "<article>" + "<p>" + "long words " * 200_000 + "</article>"
    sources = [None, "", " ", "no tags", "<article>" + "<" * 50, "<article>&#99999999999; &#x1F600; &nbsp; &notanentity; &eacute</article>", "<article>x<p " + 'a="' * 500, huge, "<article></article>", "<title>t</title>", "<article>İ<script>x</script>y</article>"]
    df = page_frame(spark, sources)
    rows = {r.page_id: r for r in page_text.extract(df.unionByName(df.limit(2))).collect()}
    assert [rows[i].text for i in (0, 1, 2, 8, 9)] == [""] * 5 and rows[0].n_chars == 0
    assert rows[4].text == "<" * 50 and rows[5].text == "� 😀 ¬anentity; é" and rows[6].text == "x" and rows[10].text == "İy"
    assert rows[7].n_chars == len("long words " * 200_000) - 1
    assert page_text.extract(df.unionByName(df)).count() == 2 * len(sources)
    assert page_text.extract(df.limit(0)).count() == 0 and page_text.blocks(df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, None, ARTICLE)], "page_id long, url string, html string")
    assert [tuple(r)[:2] for r in page_text.extract(null).collect()] == [(None, None)]


def test_blocks_tell_what_was_kept(spark):
    got = page_text.blocks(page_frame(spark, ["<nav><a href=x>Menu</a></nav>" + ARTICLE])).orderBy("pos").collect()
    assert [(r.text, r.words, r.linked, r.kept) for r in got][:2] == [("Menu", 1, 1, False), ("Title", 1, 0, True)] and len(got) == 4


# --- spellings -----------------------------------------------------------------------------------------


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts):
    near = defaultdict(list)
    ws = sorted(counts)
    for i, a in enumerate(ws):
        for b in ws[i + 1 :]:
            if one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in ws:
        top = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = top if top and counts[top] >= 5 * counts[w] else None
    out = set()
    for w in ws:
        end = w
        while form[end]:
            end = form[end]
        out.add((w, form[w], end, counts[w], len(near[w]), form[w] and counts[form[w]]))
    return out


def brute(rows, noise=199):
    counts = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), r)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= 6
    return grouped({w: n for w, n in counts.items() if n >= 5})


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n long, word long, gram long")


def result(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spellings.group(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_spellings_by_brute_force(spark):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("aabbcé") for _ in range(rnd.randint(6, 9))) for _ in range(40)]
    base += [w[:k] + rnd.choice("abcñ") + w[k + rnd.randint(0, 1) :] for w in base for k in [rnd.randrange(len(w) + 1) for _ in range(4)]]
    rows = [(k, " ".join(rnd.choice([w, w.upper(), w.title()]) for w in rnd.choices(base, [1 + 60 * (i % 17 == 0) for i in range(len(base))], k=400))) for k in range(30)]
    got = result(table(spark, rows))
    assert got == brute(rows) and sum(r[1] is not None for r in got) > 20


def test_lists_hold_every_near_pair():
    """Words that are near share a listed gram at fitting places, whatever the dictionary."""
    rnd = random.Random(2)
    for trial in range(60):
        letters = "ab" if trial % 2 else "abcde"
        words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(6, 10))) for _ in range(60)}
        counts = Counter(m[p : p + k] for w in words for m in [f"\x02{w}\x03"] for k in range(2, 5) for p in range(len(m) - k + 1))
        grams = {g: (n, False) for g, n in counts.items() if len(g) == 2 or all(counts[g[:k]] > 8 * (1 + trial % 3) for k in range(2, len(g)))}
        grams = {g: (n, any(len(h) == len(g) + 1 and h.startswith(g) for h in grams)) for g, (n, _) in grams.items()}
        for a in words:
            own, bound = spellings.decomposed(a, grams)
            assert len(own) > bound
            for b in words:
                if one_apart(a, b) and len(a) <= len(b):
                    d = len(b) - len(a)
                    there = set(spellings.listed(b, grams))
                    assert any((g, p) in there or (d and (g, p + 1) in there) for g, p in spellings.listed(a, grams)), (a, b)


def test_spelling_edges(spark):
    assert result(table(spark, [])) == set()
    assert result(table(spark, [(1, None), (2, ""), (None, " \n"), (3, "kurz")])) == set()
    rows = [(None, "Abcdef abcdef ABCDEF abcdef abcdef")] * 5 + [(7, "abcdeg " * 5), (8, "abcdeh " * 5)] + [(9, "x" * 70_000 + " ")] * 5 + [(10, "ÀÉ×÷ÿÐþ " * 6)]
    assert result(table(spark, rows)) == brute(rows)
    ties = [(1, "aaaaab " * 30 + "aaaaac " * 30), (2, "aaaaad " * 6)]
    assert ("aaaaad", "aaaaab", "aaaaab", 6, 2, 30) in result(table(spark, ties))


def test_spelling_chains(spark):
    rows = [(1, "bcdefg " * 5), (2, "bcdefh " * 25), (3, "bcdeih " * 125), (4, "bcdjih " * 625), (5, "bckjih " * 3125)]
    got = result(table(spark, rows))
    assert got == brute(rows) and ("bcdefg", "bcdefh", "bckjih") in {r[:3] for r in got}
