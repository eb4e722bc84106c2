import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import mixing, secrets, url_filter

DOCS = "doc_id long, text string, source string, row string, size string, k int"
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base(text):
    text = text or ""
    out = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    out.sort(key=lambda x: (x[1].start(), order.index(x[0])))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "r", None, 1) for i, t, s in rows], DOCS).repartition(3)


def test_secrets_against_brute_force(spark):
    rng = random.Random(3)
    key = "AKIA" + "ABCD1234EFGH5678"
    live = "Zq8vR2mXw7Lp4TnK9sYb3"
    bits = ["é", "token", "secret: token : abcdefgh", "Password = 'hunter22'", "passwd=abc", "api_key:" + "x" * 30, "APIKEY=\"A1b2C3d4E5\"", key, "AKIA12",
            "0123456789abcdef01234567", "deadbeef", "ſecret=abcdefg", "TOKEN==", "secret=secret=abcdef", live, " ", "\n", "😀"]
    rows = [(None, None, None), (1, "", "a"), (2, key, "a"), (2, key, "a"), (3, f"see {live} ok", "a")]
    rows += [(k, "".join(rng.choice(bits) + rng.choice(["", " ", "!"]) for _ in range(rng.choice([1, 5, 60]))), f"s{k % 4}") for k in range(10, 60)]
    got = secrets.digest(frame(spark, rows)).collect()
    want = Counter()
    for i, t, _ in rows:
        spans = base(t)
        n = Counter(k for k, _ in spans)
        text = ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in spans)
        want[(i, n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert spans == sorted(spans, key=lambda s: (int(s[1]), ["assign", "access", "hex", "bare"].index(s[0])))
        assert r.n_bare == sum(s[0] == "bare" for s in spans)


def test_ownership_parts_live_from_copied(spark):
    live, copied = "Zq8vR2mXw7Lp4TnK9sYb3", "Hq3vR9mXw1Lp6TnK2sYb8"
    rows = [(1, f"a {live} b", "a"), (2, f"a {live} b", "a")] + [(10 + k, f"a {copied} b", f"s{k}") for k in range(4)]
    got = {r.doc_id: r for r in secrets.digest(frame(spark, rows)).collect()}
    assert got[1].spans == got[2].spans == "bare:2:23" and got[1].n_live == 1
    assert {got[10 + k].spans for k in range(4)} == {""}
    docs = frame(spark, rows + [(k, f"token={copied}", "s9") for k in range(20, 23)])
    _, found = secrets.spans(docs)
    r = found.filter("no = 0").first()
    assert (r.repos, r.owners, r.live) == (7, 5, False)
    assert secrets.digest(frame(spark, [])).count() == 0


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    fixed, free, total = {}, set(names), sum(sizes.values())
    while True:
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**fixed, **share}
        fixed |= {s: 3.0 * sizes[s] for s in over}
        free -= over


def brute_copies(rows, size):
    """Copies of every (doc_id, text, source), with the draw of each source that lands nearest to its target."""
    of = defaultdict(int)
    for _, t, s in rows:
        of[s] += size(t)
    target = brute_targets(of)
    rate = {s: target[s] / of[s] if of[s] else 0.0 for s in of}

    def copies(row, k):
        i, t, s = row
        inner = hashlib.md5((t or "").encode()).hexdigest()
        h = hashlib.md5(f"{mixing.SEED}:{'' if i is None else i}:{inner}".encode()).hexdigest()
        draw = (int(h[:13], 16) + k * int(h[13:26], 16)) % (1 << 52) / (1 << 52)
        return int(rate[s]) + (draw < rate[s] - int(rate[s]))

    used = {}
    for s in of:
        own = [r for r in rows if r[2] == s]
        missed = [abs(sum(size(r[1]) * copies(r, k) for r in own) - target[s]) for k in range(64 if len(own) >= 16 else 1)]
        used[s] = missed.index(min(missed))
    return [copies(r, used[r[2]]) for r in rows]


def test_mixing_draws(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda n: " ".join(["w"] * n)
    # a source with a third of the rows, one of a few documents, ties of size and repeated rows, very long and empty texts
    rows = [(k, text(rng.choice([3, 3, 40, 700])), "hot" if k % 3 == 0 else f"s{k % 20}") for k in range(2000)]
    rows += [(9000 + k, text(50), "few") for k in range(5)] + rows[:7] + [(9100, text(400_000), "s1"), (9101, "", "s2"), (None, None, None)]
    docs = frame(spark, rows).withColumn("size", F.lit("x")).withColumn("a", F.lit(0)).withColumn("rate", F.lit(9))
    size = lambda t: len(t.split(" ")) if t else 0
    want = sorted(zip([str(r) for r in rows], brute_copies(rows, size)))
    read = lambda: [(str(tuple(r.row)[:3]), r.copies) for r in mixing.repetitions(docs).collect()]
    assert sorted(read()) == want
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)          # the salted join
    assert sorted(read()) == want
    off = {r.source: (r.taken, r.target) for r in mixing.repetitions(docs).groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()}
    assert all(abs(off[s][0] - off[s][1]) < 0.02 * off[s][1] for s in off if s not in ("few", None, "s1")), off


def test_levels_over_ranges_of_sources(spark):
    """Targets of many sources, with ties of size and of cap over weight, by sums of ranges that are joined."""
    rng = random.Random(6)
    sizes = {f"é{k:03d}" if k % 3 else f"s{k}": rng.choice([0, 1, 5, 5, 10, 2000, 30_000]) for k in range(300)} | {None: 5}
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()] + [("s0", 7), ("s0", 0)], "source string, size long")
    sizes["s0"] += 7
    want = brute_targets(sizes)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = mixing._ranked(sized, [F.col("size"), F.col("source").asc_nulls_last()], "test", ("size",)).collect()
        got = mixing.rates(sized).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted(ranked, key=lambda r: r["at"])
    assert [r["at"] for r in rows] == list(range(len(sizes) + 2))
    assert [(r.size, r.source is None, r.source or "") for r in rows] == sorted((r.size, r.source is None, r.source or "") for r in rows)
    assert all(b.below_size == a.below_size + a.size for a, b in zip(rows, rows[1:])) and rows[0].below_size == 0
    assert {r.source: r.source_size for r in got} == sizes
    assert all(abs(r.target - want[r.source]) <= 1e-9 * (1 + want[r.source]) for r in got)
    assert mixing.rates(sized.limit(0)).count() == 0


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(None, None, None), (None, "a b", None), (0, "", "empty"), (1, None, "empty")]
    rows += [(k, " ".join(["w"] * rng.choice([1, 9, 30])) + "\u00a0x\t", f"s{min(k % 7, 4)}é" if k % 5 else "s0é") for k in range(2, 900)]
    docs = frame(spark, rows + rows[-2:])
    got = mixing.repetitions(docs).select("row.*", "size", "source_size", "target", "copies").collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    of, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows + rows[-2:]:
        of[s] += size(t)
    want = brute_targets(of)
    assert len(got) == len(rows) + 2
    for r in got:
        r = dict(zip(["doc_id", "text", "source", "row", "size0", "k", "size", "source_size", "target", "copies"], r))
        assert r["size"] == size(r["text"]) and r["source_size"] == of[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + r["target"]) and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    assert abs(sum(want.values()) - sum(of.values())) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 30 for s in of)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs).count() == sum(r.copies for r in got) == mixing.mix(docs.repartition(5)).count()
    assert mixing.digest(frame(spark, [])).count() == 0
    assert mixing.digest(frame(spark, [(1, None, "a")])).collect()[0].taken == 0


def test_urls(spark):
    urls = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/xxx": ("", "", None, "block"),
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://x.net/fr": ("x.net", "/fr", "net/", "block"), "http://x.net": ("x.net", "", None, "allow"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"), "ftp://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"),
        "http://b.org/fr/porn": ("b.org", "/fr/porn", "org/fr/", "allow"), "http://b.io/porn-é": ("b.io", "/porn-é", None, "block"),
        "http://b.io/pornography/casinos": ("b.io", "/pornography/casinos", None, "allow"), "http://casino.b.io/casino/casino": ("casino.b.io", "/casino/casino", None, "allow"),
        "http://Casino.b.io/poker?x=1": ("casino.b.io", "/poker", None, "block"), "http://b.io?a://c/d": ("b.io", "", None, "allow"),
    }
    pages = spark.createDataFrame([(k, u, "rule", "h") for k, u in enumerate(urls)] * 2, "page_id long, url string, rule string, html string")
    got = url_filter.digest(pages).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == list(urls.values())[r.page_id], list(urls)[r.page_id]
    assert url_filter.filter_urls(pages).columns == ["row", "url_host", "url_path", "url_rule", "n_strict", "n_soft", "url_verdict"]
    assert url_filter.digest(pages.limit(0)).count() == 0


def test_escapes_many_terms_and_sql(spark, tmp_path):
    import duckdb
    import pandas as pd

    from tidemark.llm.queries import ORACLES

    urls = {
        "http://b.io/p%6Frn": "block", "http://b.io/%70%6f%72%6E%2Fx": "block", "http://b.io/%2570orn": "allow", "http://b.io/porn%C3%A9": "block",
        "http://b.io/porn%6": "block", "http://b.io/xporn%61": "allow", "http://b.io/%%70orn%": "block", "http://b.io/sportwetten/ruleta": "block",
        "http://b.io/paris-sportifs/a?q=Nues": "block", "http://b.io/paris/sportifs": "allow", "http://x.org/%66r": "allow", "http://x.org/%66r/porn": "block", "http://x.net/%66r": "block", "http://b.io/nude/nude%20nude": "allow",
        "http://b.io/" + "a/" * 1_000_000 + "casino/%70oker": "block", "http://b.io/" + "%41" * 500_000: "allow", "%": "allow",
    }
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("terms", F.lit(1)).withColumn("host", F.lit("h"))
    got = {r.page_id: r for r in url_filter.digest(pages).collect()}
    for k, (u, want) in enumerate(urls.items()):
        assert got[k].verdict == want, u[:60]
    with duckdb.connect() as con:
        con.register("pages", pd.DataFrame({"page_id": range(len(urls)), "url": list(urls)}))
        rows = con.sql(ORACLES["op7_url_filter"])
        assert sorted(map(str, rows.fetchall())) == sorted(str(tuple(r[c] for c in rows.columns)) for r in got.values())
    (tmp_path / "a.txt").write_text("# terms\n!Forbidden\nsoft one\n\nother\n")
    (tmp_path / "b.txt").write_text("! twice\ntwice\nother\n")
    strict, soft = url_filter.read_terms(spark, str(tmp_path))
    assert (strict, soft) == (("forbidden", "twice"), ("other", "soft one"))
    own = spark.createDataFrame([(u,) for u in ("http://a/FORBIDDEN", "http://a/soft%20one", "http://a/soft%20one/other", "http://a/porn")], "url string")
    assert [r.url_verdict for r in url_filter.filter_urls(own, strict=strict, soft=soft).collect()] == ["block", "allow", "block", "allow"]
    assert [r.url_verdict for r in url_filter.filter_urls(own, strict=(), soft=()).collect()] == ["allow"] * 4
