import random

import pytest
import xxhash

from tidemark.llm import simhash as S
from tidemark.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, label string"


def brute_fp(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), seed=42) for k in range(max(1, len(words) - 3))]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def brute(rows, bits=4):
    fps = [brute_fp(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                label[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted([(i, f"{fps[k]:016x}", least[root(k)]) for k, (i, _) in enumerate(rows)], key=str)


def texts(rng):
    vocab = [f"w{k}é" for k in range(400)]
    rows = [(None, None), (3, ""), (4, " \t\n"), (5, "one"), (5, "one"), (6, "ONE  two\x0bthree"), (None, "nbsp joined word \x1c x")]
    for k in range(12):
        words = rng.choices(vocab, k=rng.choice([5, 40, 300]))
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((1000 + len(rows) * 37 % 1009, " ".join(copy)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y") for i, t in rows], DOCS).repartition(3)


def test_against_brute_force(spark):
    rows = texts(random.Random(8))
    assert sorted(map(tuple, S.digest(frame(spark, rows)).collect()), key=str) == brute(rows)
    kept = S.representatives(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    want = {c for _, _, c in brute(rows)}
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == len(set(got)) == len(want) and set(got) == want


def test_links_between_random_fingerprints(spark):
    rng = random.Random(1)
    fps = [0, (1 << 64) - 1]
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            fps.append(at)
            for b in rng.sample(range(64), rng.choice([1, 3, 4, 5, 6])):
                at ^= 1 << b
    label = {f: f for f in fps}
    for _ in range(50):
        label = {f: min(label[g] for g in fps if (f ^ g).bit_count() <= 4) for f in fps}
    parts = {}
    for f, x in label.items():
        parts.setdefault(x, set()).add(f)
    got = {}
    for r in S.links(spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")).collect():
        got.setdefault(r.label, set()).add(r.fp % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, parts.values()))


def test_thresholds_follow_the_pigeonhole():
    import numpy as np

    sample = np.random.default_rng(0).integers(0, 1 << 63, 300, dtype=np.uint64)
    for rows in (1, 1000, 10**6, 10**9):
        plan = S.choose(sample, rows, 4)
        assert sum(t + 1 for _, _, t in plan) == 5
        bits = [b for _, bs, _ in plan for b in bs]
        assert len(bits) == len(set(bits))


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)] + [(50, 51), (51, 50), (60, 60)]])
def test_components(spark, edges):
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if k in got} and {k for k in label if k not in got} <= {60}


def test_empty(spark):
    assert S.digest(frame(spark, [])).count() == 0 and S.representatives(frame(spark, [])).count() == 0
