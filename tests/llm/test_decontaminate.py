import hashlib
import random

from tidemark.llm import decontaminate as D

DOCS = "doc_id long, text string, lang string, segment string, ordinal string"


def brute(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        w = D.words(text.encode() if text is not None else None)
        hit, ids = set(), set()
        for item_id, t in items:
            item = D.words(t.encode() if t is not None else None)
            n = min(window, len(item))
            if not n:
                continue
            grams = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    ids.add("" if item_id is None else str(item_id))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def check(spark, docs, items):
    frame = spark.createDataFrame([(i, t, None, "x", "y") for i, t in docs], DOCS).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.judged(frame, bench).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    return got


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    vocab = ["a", "of", "Und", "éa", "x9", "Öl", "the", "zzz", "rare1", "q"]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([1, 5, 13, 14, 30, 60])))) for k in range(12)]
    items += [(3, "other text under the same id"), (None, "no id here at all"), (77, None), (78, ""), (79, "... !!"), items[4]]
    docs = [(0, None), (1, ""), (2, "-- !! \n"), (None, "no id here at all"), (3, "OF"), (3, "OF"), (4, "x " * 3000)]
    for k in range(10, 60):
        t = rng.choices(vocab, k=rng.choice([3, 20, 200]))
        for _ in range(rng.choice([0, 1, 2])):
            it = D.words((rng.choice(items)[1] or "").encode())
            at = rng.randrange(len(t))
            t[at:at] = [w.decode() for w in it[rng.randrange(3) : rng.choice([None, 20])]]
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(t).swapcase().replace("É", "é").replace("ö", "Ö")))
    check(spark, docs, items)
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)
    monkeypatch.setattr(D, "PIECE_WORDS", 20)
    check(spark, docs, items)


def test_empty_tables(spark):
    assert check(spark, [], [(1, "a b")]) == []
    assert len(check(spark, [(1, "a b")], [])) == 1


def test_segments_and_proximity(spark):
    docs = spark.createDataFrame([(k, f"one two {'x ' * (k % 3)}three four five") for k in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "one two three four")], "item_id long, text string")
    assert D.contamination(docs, bench, slop=1).filter("n_near_items = 1").count() == 40
    index = D.build_index(docs, segment_tokens=20)
    assert index.count() > 4
    ids = index.selectExpr("segment", "posexplode(doc_ids) as (ordinal, doc_id)")
    found = D.search(index, bench, slop=1).join(ids, ["segment", "ordinal"]).collect()
    assert {r.doc_id for r in found if r.exact} == set(range(0, 40, 3))
    assert {r.doc_id for r in found if not r.exact} == set(range(40))
    assert {(r.word_from, r.word_to) for r in found if r.exact} == {(0, 4)}
    tight = D.search(index, spark.createDataFrame([(9, "two three five")], "item_id long, text string"), slop=1)
    assert {r.exact for r in tight.collect()} == {False}
