import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as S


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def texts(rng, n, shared):
    word = lambda: "".join(rng.choices("abcdeé漢", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(30, 90))) for _ in range(shared)]
    out = []
    for k in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:], " ".join(word() for _ in range(rng.randint(0, 20)))]
        out.append((k, " ".join(parts)))
    return out


DOCS = "doc_id long, text string, block string, key string, text2 string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "b", "k", None) for i, t in rows], DOCS).repartition(3)


def digest(spark, rows, **kw):
    d = S.repeats(frame(spark, rows), **kw).collect()
    return Counter((r.id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in d)


@pytest.mark.parametrize("hot", [3, 1024])
def test_equal_to_brute_force(spark, hot):
    rng = random.Random(hot)
    rows = texts(rng, 120, 6)
    rows += [(500 + k, rows[k][1]) for k in range(5)] + [(7, "x" * 700), (8, "ab" * 300), (9, "x" * 199), (10, "x" * 200), (None, None), (11, ""), (12, None)]
    rows += [(13, rows[0][1])] * 3 + [(14, "lone " * 3)]
    assert digest(spark, rows, hot=hot, block_bytes=3000, bucket_bytes=9000, at_once=500) == brute(rows, 200)


def test_digest_columns_and_short_lengths(spark):
    rows = texts(random.Random(5), 60, 4)
    got = S.digest(frame(spark, rows))
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert Counter(map(tuple, got.collect())) == brute(rows, 200)
    assert digest(spark, rows, length=48, gram=16, block_bytes=2000) == brute(rows, 48)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (1, "")], [(3, "z" * 199)]])
def test_nothing_to_remove(spark, rows):
    assert digest(spark, rows) == brute(rows, 200)


def test_a_passage_that_a_third_of_all_rows_share(spark):
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=400))
    rows = [(k, f"{rng.random()} {passage if k % 3 == 0 else rng.random()} {'tail' * (k % 50)}{rng.random()}") for k in range(300)]
    assert digest(spark, rows, hot=20, block_bytes=5000, bucket_bytes=20000) == brute(rows, 200)


def test_a_text_of_several_megabytes(spark):
    rng = np.random.default_rng(1)
    long = rng.integers(97, 123, 3_000_000).astype(np.uint8).tobytes().decode()
    rows = [(1, long + long[1_000_000:1_000_300]), (2, "start " + long[2_999_000:] + " end")]
    got = {r.id: [(s.start, s.end) for s in r.spans] for r in S.repeats(frame(spark, rows)).collect()}
    a = next(s for s in got[1] if s[0] > 2_000_000)
    assert (1_000_000, 1_000_300) in got[1] and a == (2_999_000, 3_000_300) and got[2] == [(6, 1006)]


def test_sorting_alone():
    rng = np.random.default_rng(2)
    buf = rng.integers(97, 99, 4000).astype(np.uint8)
    buf[3000:3400] = buf[100:500]
    buf[2000:2100] = 97
    starts = np.arange(len(buf) - 64 + 1)
    group = rng.integers(0, 3, len(starts))
    seen = Counter((int(g), buf[s : s + 64].tobytes()) for s, g in zip(starts, group))
    want = [seen[(int(g), buf[s : s + 64].tobytes())] > 1 for s, g in zip(starts, group)]
    for shallow in (8, 16, 32):
        assert S.repeated(buf, starts, group, 64, shallow).tolist() == want
