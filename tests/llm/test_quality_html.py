import math
import random
import zlib

import numpy as np

from tidemark.llm import html_text as H
from tidemark.llm import quality as Q


def rows(n):
    rng = random.Random(6)
    out, labels = [(None, None), (-1, ""), (-2, "x" * 30000)], [(None, 1), (1, None), (10**9, 0)]
    for k in range(n):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 8))) for _ in range(rng.choice([3, 30, 120]))]
        good = k % 3 > 0
        out.append((k, (" ".join(words) + ".") if good else " ".join(w.upper() + "!!" for w in words)))
        if k % 4:
            labels.append((k, int(good)))
    return out, labels


def test_classifier_on_held_out_rows(spark):
    docs, labels = rows(900)
    frame = spark.createDataFrame([(i, t, "q", "z") for i, t in docs + docs[:2]], "doc_id long, text string, quality string, quality_score string")
    label = spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")
    got = Q.digest(frame, label).collect()
    assert len(got) == len(docs) + 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: int(i % 3 > 0) for i, _ in docs[3:]}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} >= {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]) > 0.97
    kept = Q.accepted(frame, label)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect() if r.doc_id in truth} == {r.doc_id for r in got if r.predicted and r.doc_id in truth}
    assert sorted(got, key=str) == sorted(Q.digest(frame.repartition(5), label).collect(), key=str)


def test_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.digest(docs, none).collect()] == [0.5, 0.5]
    assert Q.digest(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in Q.digest(docs, one).collect())


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(Q.FEATURES)))
    model = Q.fit(x, (x[:, 3] + x[:, 5] > 0).astype(float), trees=7, depth=3)
    for row, score in zip(x, model.score(x)):
        total = model.start
        for f, c, leaf in zip(model.feature, model.cut, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + (row[f[at]] > c[at])
            total += leaf[at - len(f)]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="no-sidebar">
<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div id="cookie-notice">We use cookies.</div>
%s
<div class="sidebar widget"><p>Side text that is long enough to look like prose, with words.</p></div>
<section id="comments"><h3>Comments</h3><article class="comment"><p>A reader's comment that is longer than the article, much longer than the article,
 and goes on for quite a while so that its density is the highest of the page.</p></article></section>
<form><p>Your e-mail</p><input></form><footer>&copy; 2024 Site, all rights reserved and more words</footer></body></html>"""


def test_pages():
    body = "<h1>Title &amp; more</h1><p>First <b>bold</b> one,\n two.<p>Short.</p><ul><li>a<li>b</ul><div class='ad'>Buy</div><p>Third &lt;x&gt; caf&eacute;&nbsp;x<br>y <a href=#>link</a>.</p>"
    want = "Title & more\n\nFirst bold one, two.\n\nShort.\n\na\n\nb\n\nThird <x> café x y link."
    for wrap in ("<article>%s</article>", "<main><div><article>%s</article></div></main>", "<div class='content'>%s</div>", "<div><div id=main-content>%s</div></div>"):
        assert H.main_text(PAGE % (wrap % body)) == want, wrap
    assert H.main_text("<body><article><h1>A</h1><p><b>Cut off &am") == "A\n\nCut off &am"
    assert H.main_text("plain text\n only") == "plain text only"
    assert H.main_text("<p>one<p>two") == "one\n\ntwo"
    for nothing in (None, "", "   ", "<nav><a>x</a></nav>", "<script>x", "<!-- only", "<", "<>"):
        assert H.main_text(nothing) in ("", "<", "<>")
    deep = "<div>" * 5000 + "deep" + "</div>" * 3
    assert H.main_text(deep) == "deep"


def test_quotes_in_tags():
    page = "<p><a href=/it's-here>link</a> First paragraph.</p><p>They don't stop here.</p><p>End.</p>"
    assert H.main_text(page) == "link First paragraph.\n\nThey don't stop here.\n\nEnd."
    assert H.main_text('<p class="a"">One.</p><p title="a > b" id=\'x>y\'>Two.</p><p data-x=a="b>Three.</p>') == "One.\n\nTwo.\n\nThree."
    assert H.main_text('<p title="a hidden gem">One.</p><p class="never closed>Two.</p>') == "One.\n\nTwo."


def test_marks_spare_text():
    long = "This passage of the text is long enough to be told from a notice by its density, since it holds many words and no links."
    for wrap in ("<article>%s</article>", "<main><div>%s</div></main>", "<div class='content'>%s</div>"):
        for mark in ("id=discussion", "id=related-work", "id='legal-background'", "class='search-algorithms'"):
            body = f"<h1>Title</h1><p>{long}</p><section {mark}><h2 {mark}>Part</h2><p>{long}</p></section><div class=ad>{long}</div><p>{long}</p>"
            assert H.main_text(PAGE % (wrap % body)) == f"Title\n\n{long}\n\nPart\n\n{long}\n\n{long}", (wrap, mark)
    links = "<a href=/x>Another page to read</a> " * 9
    page = f"<div class='content sidebar-right'><h2>Title</h2><p>{long}</p><p>{long}</p><div id=related-links>{links}</div></div>"
    assert H.main_text(page) == f"Title\n\n{long}\n\n{long}"


def _walk(node, link=False):
    """(characters, tags, those in links) by looking at every text and tag anew."""
    c = t = lc = lt = 0
    for x in node.items:
        if isinstance(x, str):
            c += len("".join(x.split()))
            lc += len("".join(x.split())) if link or node.tag == "a" else 0
        else:
            a = _walk(x, link or node.tag == "a")
            c, t, lc, lt = c + a[0], t + 1 + a[1], lc + a[2], lt + a[3] + (x.tag == "a" or link or node.tag == "a")
    return c, t, lc, lt


def test_densities_equal_the_formula():
    page = PAGE % ("<div><h1>Title</h1><p>A text with <a href=/x>one <i>link</i></a> and <b>more</b> words.</p><ul><li><a href=/a>Menu</a><li><a href=/b>Menu two</a></ul>"
                   "<section><p>Other words, which are many.</p><p>x</p></section></div>")  # fmt: skip
    order = H._prune(H.parse(page))
    H._densities(order)
    bc, _, blc, _ = _walk(order[0])
    for node in order:
        c, t, lc, lt = _walk(node)
        if node.tag == "a":
            lt += 1
        kids = [x for x in node.items if not isinstance(x, str)]
        if any(n.tag == "a" for n in H._path(node)[1:]):
            continue                                          # inside a link: judged with the link
        want = 0.0
        if c:
            t1, lc1, lt1, rest = max(t, 1), max(lc, 1), max(lt, 1), max(c - lc, 1)
            want = c / t1 * math.log(max(c / lc1 * t1 / lt1, 1)) / math.log(c / rest * lc + blc / bc * c + math.e)
        assert abs(node.density - want) < 1e-9, node.tag
        assert node.sum == (sum(k.density for k in kids) or node.density)
        under = [node]
        for n in under:
            under += [x for x in n.items if not isinstance(x, str)]
        assert node.best.sum == max(n.sum for n in under)


def test_density_decides():
    long = "This passage of the text is long enough to be told from a notice by its density, since it holds many words and no links."
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Topic {k}</a></li>" for k in range(9)) + "</ul>"
    body = f"<h1>Title</h1><p>{long}</p><p>Short.</p><p><b>{long}</b> and <i>{long}</i></p><p>End.</p>"
    want = f"Title\n\n{long}\n\nShort.\n\n{long} and {long}\n\nEnd."
    # no element names the article, no class or id marks what is not
    for wrap in ("<div>%s</div>", "<section><div>%s</div></section>", "<div><div>%s</div></div>", "<table><tr><td>%s</td></tr></table>"):
        assert H.main_text(f"<body><div>{menu}</div>{wrap % body}<div>{menu}</div></body>") == want, wrap
    # an unmarked menu beside the core inside the article is left out, one short link is not
    assert H.main_text(f"<body><article><div>{menu}</div><div>{body}</div><p><a href=/>Source</a></p></article></body>") == want + "\n\nSource"
    # a teaser's article does not decide: the core lies outside of it
    assert H.main_text(f"<body><div>{body}</div><article><a href=/x>Another page</a></article></body>").startswith(want)
    # of two articles the denser one
    assert H.main_text(f"<body><article><h2>A</h2><p>{long[:30]}</p></article><article>{body}{body}</article></body>") == want + "\n\n" + want
    # a page with a very long text keeps all of it
    many = "".join(f"<p>{k} {long}</p>" for k in range(20_000))
    text = H.main_text(f"<body><div>{menu}</div><div>{many}</div></body>")
    assert text.count(long) == 20_000 and len(text) == sum(len(f"{k} {long}") for k in range(20_000)) + 2 * 19_999


def test_extract(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "u", "<article><p>Hi 😀</article>", "x"), (2, "u", "<article><p>Hi 😀</article>", "x")], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, H.digest(pages).collect()), key=str)
    assert got == [(1, None, "", 0), (2, "u", "Hi 😀", 4), (2, "u", "Hi 😀", 4)]
    assert H.digest(pages.limit(0)).count() == 0 and H.extract(pages).columns == ["row", "text"]
