import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling as S
from tidemark.llm.common import stored

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(n):
    near = {w: sorted((v for v in n if is_near(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: v[0] if v and n[v[0]] >= 5 * n[w] else None for w, v in near.items()}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, word string, n long, near string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, None) for i, t in rows], DOCS).repartition(3)


def texts(rng, n):
    bases = ["".join(rng.choices("aabcdeéÀß", k=rng.randint(5, 9))) for _ in range(60)]
    out = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(0, 80)):
            w = bases[int(rng.random() ** 3 * 60)]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 2])):
                p = rng.randint(0, len(w))
                w = rng.choice([w[:p] + rng.choice("abé÷") + w[p:], w[:p] + w[p + 1 :], w[:p] + rng.choice("abÿ") + w[p + 1 :]])
            words.append(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", "-", "9", ". ", "_"]))
        out.append((k, "".join(words)))
    return out


@pytest.mark.parametrize("kw", [{}, {"shard_words": 20, "pass_bytes": 100, "at_once": 300}])
def test_equal_to_brute_force(spark, kw):
    rows = texts(random.Random(6), 500)
    rows += [(None, None), (None, "wordly " * 9), (3, ""), (9, "aaaaaa aaaaaaa " * 6), (10, "aaaaaaaa " * 50)] + [(77, "repeated repeatd repeated")] * 30
    n = words_of(rows)
    want = brute(n)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] and r[1] != r[2] for r in want)
    got = S.variants(stored(S.vocabulary(S.noisy_words(frame(spark, rows))), "vocabulary"), **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_noise_is_that_of_the_contract(spark):
    rows = [(k, "different " * 3 + "letters") for k in range(1500)]
    got = {r.word: r["count"] for r in S.noisy_words(frame(spark, rows)).groupBy("word").count().collect()}
    n = Counter()
    for i, t in rows:
        for run in t.split():
            h = zlib.crc32(f"{i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    assert got == n and len(n) > 6


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short of it")], [(1, "single " * 7)]])
def test_small_tables(spark, rows):
    assert sorted(map(tuple, S.digest(frame(spark, rows)).collect())) == brute(words_of(rows))


def test_a_chain_of_forms_and_a_long_text(spark):
    text = "abcdef " * 5 + "abcdefg " * 25 + "abcdefgh " * 125 + "abcdefghi " * 625 + "filler " * 300_000 + "x" * 3000 + " " + ("y" * 3000 + " ") * 6
    rows = [(1, text)]
    assert sorted(map(tuple, S.digest(frame(spark, rows)).collect()), key=str) == brute(words_of(rows))


def test_filters_have_no_false_negatives_and_few_false_positives():
    words = ["".join(random.Random(k).choices("abcdefghij", k=8)) for k in range(20000)]
    h = S._hashes(words)
    lanes = S.bloom(h)
    assert len(S.probe(lanes, h)) == len(h)
    other = S._hashes(["".join(random.Random(-k).choices("klmnop", k=8)) for k in range(1, 20000)])
    assert len(S.probe(lanes, other)) < 200
