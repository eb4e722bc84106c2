"""The pipeline against a plain single-process version of each stage."""

import importlib.util
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline as P
from tidemark.llm import decontaminate, quality


def load(name):
    spec = importlib.util.spec_from_file_location(name, Path(__file__).with_name(f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


near, dec, mixed = load("test_simhash"), load("test_decontaminate"), load("test_secrets_mixing_urls")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, shard string"


def corpus():
    rng = random.Random(12)
    vocab = ["".join(rng.choices("abcdefghiou", k=rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choices(vocab, k=n)).capitalize() + "."
    items = [(k, prose(rng.choice([14, 25]))) for k in range(12)] + [(None, None), (50, "")]
    docs, labels = [], []
    for k in range(420):
        good = k % 4 > 0
        text = prose(rng.choice([20, 60, 150])) if good else " ".join(w.upper() + "!!" for w in prose(40).split())
        if good and k % 9 == 0:
            text += " " + (rng.choice(items)[1] or "") if rng.choice([1, 0]) else ""
        docs.append((k, text))
        if k % 3:
            labels.append((k, int(good)))
    docs = [(i, t.replace("None", "")) for i, t in docs]
    docs += [(1000 + k, docs[5][1]) for k in range(200)] + [(1300 + k, docs[6][1] + " tail" * (k % 2)) for k in range(6)]
    docs += [(1400, docs[9][1] + " " + items[3][1]), (1401, items[4][1]), (1500, None), (1501, ""), (None, prose(30)), (1600, prose(50)), (1600, docs[-1][1])]
    docs.append(docs[-2])
    return [(i, t, "en", None if i and i % 13 == 0 else f"s{(i or 0) % 5}", len(t or ""), "x") for i, t in docs], items, labels


def brute_quality(rows, labels):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    raw = lambda t: t.encode() if t else None
    label = {i: q for i, q in labels if not held(i)}
    fit = {r[0]: r[1] for r in sorted(rows, key=lambda r: r[1] or "", reverse=True) if r[0] in label}
    ids = sorted(fit)
    model = quality.fit(quality.statistics([raw(fit[i]) for i in ids]), np.array([label[i] for i in ids], float))
    return [r for r, s in zip(rows, model.score(quality.statistics([raw(r[1]) for r in rows]))) if s >= 0.3]


def brute_mix(rows):
    copies = mixed.brute_copies([(r[0], r[1], r[3]) for r in rows], lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or "")))
    out = Counter()
    for r, n in zip(rows, copies):
        out[r] += n
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items, labels = corpus()
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, rows, items, labels


def test_stages_against_brute_force(spark, folder):
    d, rows, items, labels = folder
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding"]
    stage = dict(P.STAGES)
    frame = lambda rows: spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = stage["quality_classifier"](spark, frame(rows), d)
    assert got.columns == frame(rows).columns
    kept = brute_quality(rows, labels)
    assert 0 < len(kept) < len(rows) and Counter(map(tuple, got.collect())) == Counter(kept)

    got = [tuple(r) for r in stage["simhash_near_dedup"](spark, frame(kept), d).collect()]
    component = {}
    for i, fp, c in near.brute([(r[0], r[1]) for r in kept]):
        component[i, fp] = c
    of = lambda r: component[r[0], f"{near.brute_fp(r[1]):016x}"]
    assert len(got) == len({of(r) for r in kept}) and all(of(r) == r[0] for r in got)

    bad = {i for i, *_, flag in dec.brute([(k, r[1]) for k, r in enumerate(got)], items) if flag}
    clean = [r for k, r in enumerate(got) if k not in bad]
    assert bad and Counter(map(tuple, stage["benchmark_decontamination"](spark, frame(got), d).collect())) == Counter(clean)

    want = brute_mix(clean)
    assert Counter(map(tuple, stage["source_mixing"](spark, frame(clean), d).collect())) == +want

    out = [r for r, n in want.items() for _ in range(n)]
    got = stage["sharding"](spark, frame(out), d)
    # the documents' own column named shard is replaced
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    rows = got.collect()
    assert Counter(tuple(r)[:5] for r in rows) == Counter(r[:5] for r in out)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(40))


def test_run_and_empty_tables(spark, folder, tmp_path):
    d = folder[0]
    for t in ("documents", "benchmark", "labels"):
        frame = spark.read.parquet(f"{d}/{t}.parquet")
        (frame.drop("shard") if t == "documents" else frame).write.parquet(f"{tmp_path}/a/{t}.parquet")
        (frame.drop("shard") if t == "documents" else frame).limit(0).write.parquet(f"{tmp_path}/b/{t}.parquet")
    once = P.run(spark, f"{tmp_path}/a").drop("slot")
    again = P.run(spark, f"{tmp_path}/a").drop("slot")
    assert once.count() > 0 and sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    assert P.run(spark, f"{tmp_path}/b").count() == 0
    assert decontaminate.clean(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{tmp_path}/b/benchmark.parquet")).count() == len(folder[1])
