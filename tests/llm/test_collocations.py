import random
import re
from collections import Counter

import pytest

from tidemark.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, cover=80, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cand = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        best = Counter()
        for g, a in cand.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    best[g[i : i + k]] = max(best[g[i : i + k]], a)
        rank = []
        for g, a in cand.items():
            if 100 * best[g] >= cover * a:
                continue
            s, k = min((2000000 * a // (own[g[:k]] + own[g[k:]]), k) for k in range(1, len(g)))
            rank.append((-s, -a, " ".join(g).encode(), a, own[g[:k]], own[g[k:]], s))
        for r, (_, _, p, a, left, right, s) in enumerate(sorted(rank)[:top], 1):
            out.append((lang, r, p.decode(), a, left, right, n[lang], s))
    return sorted(out)


SCHEMA = "doc_id long, lang string, text string, block string, a long, word string"


def check(spark, rows, least, top=2000, **kw):
    docs = spark.createDataFrame([(k, g, t, "x", 1, None) for k, (g, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in C.phrases(docs, least=least, top=top, **kw).collect())
    assert got == brute(rows, least, top=top)
    return got


def test_equal_to_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["the", "of", "new", "york", "É", "Ab", "ab", "x\x1cy", "naïve", "a b", "漢", "'s", "-", "q\x85q"]
    rows = []
    for k in range(400):
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 8, 40]))
        for _ in range(rng.randint(0, 4)):
            words += rng.choice([["once", "upon", "a", "time", "there"], ["red", "hot", "iron"], ["loop"] * rng.randint(1, 7), ["w%d" % rng.randint(0, 99)]])
        seps = rng.choices([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?", " ; ", ":"], [20, 2, 2, 1, 1, 1, 1, 1, 1, 1], k=len(words))
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), "".join(w + s for w, s in zip(words, seps))))
    rows += [(None, None), ("xx", ""), (None, "..."), ("en", None)] + [("en", "same text here again and again, same text")] * 40
    for least, tokens in ((8, 500), (30, 1 << 21), (2, 3000)):
        got = check(spark, rows, least, block_tokens=tokens, bucket_tokens=2000)
        assert len(got) > 10
    check(spark, rows, 5, top=7, block_tokens=2000)


def test_long_unary_paths_and_a_long_text(spark):
    passage = " ".join(f"p{k}" for k in range(700))
    rows = [("en", passage)] * 4 + [("en", passage + " end")] * 3 + [("de", "start " + passage[:900])] * 9 + [("en", "x y z w " * 60000)]
    check(spark, rows, 3)


def test_a_word_pair_in_a_third_of_all_words(spark):
    rng = random.Random(4)
    rows = [("en", " ".join("hot pair" if rng.random() < 0.3 else f"w{rng.randint(0, 30)}" for _ in range(300))) for _ in range(60)]
    check(spark, rows, 10, block_tokens=3000)


@pytest.mark.parametrize("rows", [[], [("en", None)], [("en", "one two three")], [(None, "a b " * 30)]])
def test_small_tables(spark, rows):
    check(spark, rows, 30)


def test_scores_beyond_64_bits(spark):
    big = 1 << 50
    pair = lambda x, y=0: (x << 31) | y
    rows = [(pair(1), 0, big * 3, 1, "en"), (pair(2), 0, big * 2, 1, "en"), (pair(1, 2), 0, big, 2, None)]
    got = C.ranked(spark.createDataFrame(rows, "a long, b long, f long, k int, lang string"), 80, 10).collect()
    assert [(r.score, r.l, r.r, r.lang) for r in got] == [(2000000 * big // (5 * big), 3 * big, 2 * big, "en")]


def test_paths_are_compacted(spark):
    pair = lambda x, y: (x << 31) | y
    grams = [(1, 2, 3, 4, 5), (2, 3, 4, 5, 5), (3, 4, 5, 6, 5), (4, 5, 6, 0, 5), (5, 6, 0, 0, 5), (6, 0, 0, 0, 5), (9, 2, 3, 0, 2)]
    edges = spark.createDataFrame([(pair(a, b), pair(c, d), n) for a, b, c, d, n in grams], "a long, b long, n long")
    assert [(list(r.words), r.n) for r in C.paths(edges).collect()] == [([1, 2, 3, 4, 5, 6], 5)]
    ended = edges.union(spark.createDataFrame([(pair(2, 3), pair(4, 0), 1)], edges.schema))  # a piece ends at (2, 3, 4)
    assert sorted(list(r.words) for r in C.paths(ended).collect()) == [[1, 2, 3, 4], [2, 3, 4, 5, 6]]
