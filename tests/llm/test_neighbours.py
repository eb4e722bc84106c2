from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import neighbours as A

ROWS = "vec_id long, embedding array<float>, label int, node long, q int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], ROWS).repartition(3)


def valid(rows):
    return [(i, tuple(np.float32(v).tolist())) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]


def brute(rows, every, k=10):
    """Of each query row, in order of id: its nearest of all other rows."""
    ok = valid(rows)
    x = np.array([v for _, v in ok], float)
    out = defaultdict(list)
    for own, (i, v) in enumerate(ok):
        if i % every == 0:
            d = np.sqrt(((x - np.array(v)) ** 2).sum(1))
            out[i].append(sorted((float(a), j) for n, (a, (j, _)) in enumerate(zip(d, ok)) if n != own)[:k])
    return out


def same(frame, want):
    """Exactly the rows that ``brute`` gives, query row by query row."""
    got = Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in frame.collect())
    assert got == Counter((q, n, j, round(a, 9)) for q, lists in want.items() for w in lists for n, (a, j) in enumerate(w, 1))


def answers(frame):
    got = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.score, r.vec_id))
    return got


def test_recall_ties_and_copies(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(2000 + k, x[7].tolist()) for k in range(700)]  # a third of all rows share a vector
    rows += [(3000, None), (3020, []), (3040, [0.0] * 24), (3060, [1.0] * 23 + [float("nan")]), (3080, [1.0] * 23 + [None]), (3100, [1.0] * 5), (None, x[1].tolist()), rows[5], rows[5]]
    got, want = answers(A.search(frame(spark, rows), every=20)), brute([r for r in rows if r[1] is None or len(r[1]) != 5], 20)
    assert set(got) == set(want)
    hits = total = 0
    for q, (w,) in want.items():
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        hits += len({i for _, i in got[q]} & {i for _, i in w})
        total += 10
        exact = dict((i, a) for a, i in w)
        assert all(abs(a - exact[i]) < 1e-12 for a, i in got[q] if i in exact)
    assert hits >= 0.95 * total
    assert got[2000] == [(0.0, 7), *[(0.0, 2000 + k) for k in range(1, 10)]]


def names(index):
    return {r.node: r.ids[0].id for r in index.nodes.collect()}


def links_of(index):
    name = names(index)
    return {name[r.node]: {name[n] for n in r.near} for r in index.links.collect()}


def test_descent_improves_the_graph(spark):
    x = np.random.default_rng(1).normal(size=(1500, 16)).astype(np.float32)
    rows = frame(spark, [(k, v.tolist()) for k, v in enumerate(x)])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    true = np.argsort(d, axis=1)[:, 1:11]

    def recall(rounds):
        links = links_of(A.build(rows, rounds=rounds))
        return np.mean([len(set(t) & links[k]) for k, t in enumerate(true)]) / 10

    assert recall(4) > max(0.8, recall(0) + 0.1)


def test_a_narrow_beam_is_widened(spark):
    x = np.random.default_rng(2).normal(size=(2000, 48)).astype(np.float32)
    index = A.build(frame(spark, [(k, v.tolist()) for k, v in enumerate(x)]), k=5, rounds=3)
    asked = index.nodes.filter("ids[0].id % 20 = 0").selectExpr("node query", "node", "embedding")
    got, name = defaultdict(set), names(index)
    for r in A.nearest_nodes(index, asked, beam=11).filter("query <> node").collect():
        got[name[r["query"]]].add(name[r.node])
    true = np.argsort(((x[::20, None] - x[None]) ** 2).sum(2), axis=1)[:, 1:11]
    assert np.mean([len(got[20 * k] & set(t.tolist())) for k, t in enumerate(true)]) > 9


def test_the_descent_goes_on_until_it_is_still(spark, monkeypatch):
    monkeypatch.setattr(A, "PART", 2)
    x = np.random.default_rng(3).normal(size=(1500, 16)).astype(np.float32)
    links = links_of(A.build(frame(spark, [(k, v.tolist()) for k, v in enumerate(x)])))
    true = np.argsort(((x[:, None] - x[None]) ** 2).sum(2), axis=1)[:, 1:11]
    assert np.mean([len(set(t) & links[k]) for k, t in enumerate(true)]) > 8


@pytest.mark.parametrize("rows", [
    [], [(0, [1.0, 2.0])], [(0, None)], [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (100, [2.0, 2.0])],
    [(100, [1.0, 2.0]), (100, [5.0, 2.0]), (1, [2.0, 2.0]), (1, [2.0, 2.0]), (2, [3.0, 2.0])],  # two rows of one id, and a repeated one
    [(100, [1.0, 2.0])] * 4 + [(200, [1.0, 2.0])] * 15 + [(5, [1.0, 3.0])] * 12, [(None, [1.0, 1.0]), (0, [1.0, 1.0]), (0, [1.0, 1.0])],
])
def test_small_tables(spark, rows):
    same(A.search(frame(spark, rows)), brute(rows, 100))


def test_repeated_ids_with_different_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(int(rng.integers(0, 40)) * 10, np.round(rng.normal(size=4), 1).tolist()) for _ in range(300)]
    same(A.search(frame(spark, rows), every=20), brute(rows, 20))


def test_more_copies_than_the_default(spark):
    rows = [(k, [1.0, 2.0]) for k in range(30)] + [(50, [2.0, 2.0])]
    same(A.search(frame(spark, rows), every=100, found=20), brute(rows, 100, 20))


def test_the_start_is_near(spark):
    rng = np.random.default_rng(5)
    x = (4 * rng.normal(size=(40, 24))[np.arange(4000) % 40] + rng.normal(size=(4000, 24))).astype(np.float32)
    links = links_of(A.build(frame(spark, [(k, v.tolist()) for k, v in enumerate(x)]), rounds=0))
    for k in range(0, 4000, 400):
        true = np.argsort(((x - x[k]) ** 2).sum(1))[1:11]
        links[k] = len(set(true.tolist()) & links[k])
    assert sum(links[k] for k in range(0, 4000, 400)) > 50  # random buckets found 33 of 100


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_many_blocks(spark, monkeypatch, few):
    monkeypatch.setattr(A, "BLOCK", 64)
    monkeypatch.setattr(A, "FEW", few)
    x = np.random.default_rng(6).normal(size=(400, 6)).astype(np.float32).tolist()
    rows = [*enumerate(x), (500, x[3]), (520, x[3]), (7, x[9])]
    same(A.search(frame(spark, rows), every=20, beam=400), brute(rows, 20))
    assert A.build(frame(spark, rows), rounds=1).packed.count() == 6


def test_no_neighbour_beyond_the_bound_is_sent_back(monkeypatch):
    """One query and ten nodes on a line, by products and one by one."""
    x, q = np.arange(10.0)[:, None] + 1, np.array([[0.0], [1.0]])

    class Sent:
        def __init__(self, value):
            self.value = value

    told = list(A._mailed(A.TOLD, np.arange(10), 1, np.ones(10, "<i4")))
    for both in ([], list(A._mailed(A.TOLD, np.arange(10), 1, np.zeros(10, "<i4")))):
        got = {A.STATE: [[np.arange(10).tobytes(), x.tobytes()]], A.TOLD: [p for _, _, p in told + both]}
        ((home, _, (to, node, apart)),) = A._measure(Sent(q), Sent(np.array([0.5, 3.0])), "<f8", 1, 1)(0, got)
        assert home == 0 and set(np.frombuffer(to, "<u4")) == {1}
        assert sorted(zip(np.frombuffer(apart).tolist(), np.frombuffer(node, np.int64).tolist())) == [(0.0, 0), (1.0, 1), (2.0, 2), (3.0, 3)]
