import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import sharding, token_counts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, size string, k1 string, range string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "k", None) for i, t in rows], DOCS).repartition(3)


def check_shards(got, rows, shards, slack):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r)
    mean = sum(r.size for r in got) / shards
    for s in range(shards):
        assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
        assert abs(sum(r.size for r in by[s]) - mean) <= slack


def test_shards_are_near_equal_with_a_text_of_a_third_of_all_rows(spark):
    rng = random.Random(2)
    rows = [(k, "x" * rng.choice([0, 3, 50, 200])) for k in range(1500)] + [(k, "same text" * 9) for k in range(2000, 3000)]
    rows = [(i, t + str(i % 900) if i < 1500 and t else t) for i, t in rows] + [(None, None)] * 5 + [(7, "repeated")] * 300
    got = sharding.digest(frame(spark, rows)).collect()
    check_shards(got, rows, 40, 2 * 0.002 * 4000 + 2 * 220)
    whole = defaultdict(set)
    for r in got:
        whole[r.text_crc32].add(r.shard)
    assert sum(len(v) > 1 for v in whole.values()) <= 39
    docs = frame(spark, rows)
    out = sharding.shard(docs, 7)
    assert out.columns == [*docs.columns, "shard", "slot"] and out.count() == len(rows)
    # several ranges in a shard
    keyed = sharding.with_keys(docs.select("doc_id", "text"))
    placed = sharding.place(keyed, sharding.stored(keyed.select("size", "k1", "k2", "k3"), "keys"), 3, range_bytes=9000).collect()
    for s in range(3):
        slots = sorted(r.slot for r in placed if r.shard == s)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(k, "same") for k in range(3)], [(5, "one row again")] * 90])
def test_small_tables(spark, rows):
    check_shards(sharding.digest(frame(spark, rows)).collect(), rows, 40, 10**9)


def test_cuts_reach_the_row(spark):
    keyed = sharding.stored(frame(spark, [(5, "one row again")] * 90).transform(lambda d: sharding.with_keys(d.select("doc_id", "text"))), "keys")
    total = 90 * 29
    found = sharding.cuts(keyed, [total * k / 10 for k in range(1, 10)], 1.0)
    assert [c.rows for c in found] == [9 * k for k in range(1, 10)]


def test_token_counts_equal_the_library(spark):
    rng = random.Random(4)
    tok = Tokenizer.from_file(PATH)
    bits = ["hello", " the", "\n\n", "  ", "\t", "é", "don't", "DON'T", "123", " 4²", " ", " ", "\x1c", "\x85", "漢字", "😀", "👩‍👩", "́", "<|endoftext|>", "<|end", "oftext|>",
            "ß", "\U0001fae8", "Ᲊ", "​", "᠎", "½", "Ⅷ", "'ll", "…", "\r\n", "\x00", "﻿", "ⴀ", "꟝", "٣"]
    rows = [(None, None), (1, ""), (2, " "), (2, " "), (3, "a" * 5000), (4, "word " * 4000), (5, "<|endoftext|>")]
    rows += [(k, "".join(rng.choices(bits, k=rng.choice([1, 4, 40, 300])))) for k in range(10, 150)]
    got = token_counts.token_counts(frame(spark, rows), PATH, PATTERN, block_tokens=500).collect()
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter(map(tuple, got)) == want
    flags = {r.doc_id: r.over_limit for r in token_counts.digest(frame(spark, rows), PATH, PATTERN).collect()}
    assert flags[4] and not flags[1]
    assert token_counts.token_counts(frame(spark, []), PATH, PATTERN).count() == 0
