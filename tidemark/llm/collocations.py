"""Phrase collocations from a weighted de Bruijn graph of words.

1. Texts are cut into pieces and words. A block holds the words of one language
   as numbers of its own dictionary, with 0 between pieces.
2. Only words found LEAST times or more can be part of a phrase, and only pairs
   and threes of neighbours found as often. Words are counted, and
   numbered, in the bucket of their hash; pairs and threes by ``packed.tally``. A
   piece is cut at every other word, between every other pair and at every other
   three. That changes no count of a phrase that can be reported, nor of its parts.
   A key that two pairs or two threes share only leaves a cut out.
3. Every word left starts one longest gram, filled up with zeros where its piece
   ends. A full gram of four words is an edge between the nodes of its first and
   last three; a filled-up one is a piece end. Edges are counted once.
4. Unary paths are compacted: where a node has one edge in, one edge out, the
   same flow on both and no piece begins or ends, the two edges become one. Heads
   of paths are found by pointer doubling.
5. Shorter counts come from the flow. A node inside a path has the path's weight;
   any other has what flows out of it plus the pieces that end there. Pairs sum their
   nodes, words their pairs, each with their own piece ends.
6. Phrases are cut in two in every way, scored by exact decimals, dropped where
   a longer one has them nearly as often, and ranked for each language.

Word ids are below 2^31, so that two fit in a long; more raise an error.

Defined results: null texts are empty; a null language is ``und``; repeated rows
count as often as they are there; empty tables, or those without a phrase of LEAST, give no rows.
Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored
from tidemark.llm.packed import bits_for, bucket_cuts, mixed, pack, rows, tally, unpack, unpacked_levels

LEAST = 30
#: A phrase goes if a longer one with it has so many hundredths of its count.
COVER = 80
TOP = 2000
#: Words of all open blocks of a task, and words that a bucket of counts gets.
BLOCK_TOKENS = 5 << 20
BUCKET_TOKENS = 1 << 21
HALF = 31
#: Bits of the keys by which pairs and threes are counted.
KEY_BITS = 48
MASK = (1 << HALF) - 1
BREAKS = b".,;:!?\n\x0b\x0c\r"


class _Numbers(dict):
    """The number of a word: its place among the words seen, from 1; a break is 0."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _blocks(block_tokens: int):
    lower = bytes(46 if c in BREAKS else c + 32 if 65 <= c <= 90 else c for c in range(256))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        number = [TaskContext.get().partitionId() << 32]
        open_blocks: dict[str, tuple[_Numbers, list]] = {}

        def closed():
            for lang, (known, seqs) in open_blocks.items():
                words = list(known)[1:]
                order = np.argsort(_hashes(words), kind="stable")  # so that a bucket's words lie together
                place = np.zeros(len(known), np.int32)
                place[order + 1] = np.arange(1, len(known))
                seq = place[np.concatenate(seqs)]
                times = np.bincount(seq, minlength=len(known))[1:]
                row = (number[0], lang, int(times.sum()), zstandard.compress(b".".join([words[k] for k in order.tolist()])), pack(times.astype(np.uint32)), pack(seq))
                number[0] += 1
                types = (pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 3)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["block", "lang", "tokens", "words", "counts", "seq"])
            open_blocks.clear()

        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in open_blocks:
                    open_blocks[lang] = _Numbers({b".": 0}), []
                known, seqs = open_blocks[lang]
                words = (text.as_py() or "").encode().translate(lower).replace(b".", b" . ").split()
                words.append(b".")
                seqs.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                held += len(words)
                if held >= block_tokens:
                    yield from closed()
                    held = 0
        yield from closed()

    return run


def _hashes(words: list[bytes]):
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _split(data: bytes) -> list[bytes]:
    import zstandard

    return zstandard.decompress(data).split(b".")


def _deal_words(bits: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        for row in rows(batches):
            if not row["tokens"]:
                continue
            words, counts = _split(row["words"]), unpack(row["counts"], "uint32")
            cuts = bucket_cuts(_hashes(words), bits).tolist()
            parts = [(k, row["block"], row["lang"], zstandard.compress(b".".join(words[a:b])), pack(counts[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            types = (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts), types)], names=["bucket", "block", "lang", "words", "counts"])

    return run


def _number_words(least: int, bits: int):
    """Ids for the words of a bucket that are found often enough, 0 for the others, block by block;
    the first row also has the vocabulary."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        known: dict[bytes, int] = {}
        places = []
        for lang, words in zip(table["lang"].to_pylist(), table["words"]):
            own = lang.encode() + b"."  # a word has no full stop, so this can be told apart
            places.append(np.array([known.setdefault(own + w, len(known)) for w in _split(words.as_py())], np.int64))
        counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in table["counts"]])
        total = np.bincount(np.concatenate(places), weights=counts)  # exact up to 2^53
        bucket, names = table["bucket"][0].as_py(), list(known)
        often = sorted(np.flatnonzero(total >= least).tolist(), key=lambda k: (-total[k], names[k]))  # small ids pack well
        ids = np.zeros(len(names), np.int64)
        ids[often] = (np.arange(len(often)) << bits) + bucket + 1
        if ids.max() > MASK:
            raise ValueError(f"more than {MASK} words are found {least} times")
        lang, _, word = zip(*(names[k].rpartition(b".") for k in often)) if often else ((), (), ())
        vocabulary = [[{"lang": g.decode(), "word": w.decode(), "id": int(ids[k])} for g, w, k in zip(lang, word, often)], *[None] * (len(places) - 1)]
        kind = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("id", pa.int64())]))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "ids": pa.array([pack(ids[p].astype(np.uint32)) for p in places], pa.binary()),
                         "vocabulary": pa.array(vocabulary, kind)})

    return run


def _numbered(batches: Iterator) -> Iterator:
    """A block's words by their ids, 0 for breaks and rare words, and its pairs of neighbours."""
    import numpy as np
    import pyarrow as pa

    for row in rows(batches):
        ids = np.concatenate([np.zeros(1, np.uint32), *(unpack(x["ids"], np.uint32) for x in row["ids"])])
        seq = ids[unpack(row["seq"], np.int32)]
        keys, times = np.unique(_pairs(seq), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((row["block"], pack(seq), pack(keys), pack(times.astype(np.uint32))), (pa.int64(), *[pa.binary()] * 3))],
            names=["block", "seq", "keys", "times"])


def _pairs(seq):
    """Keys of the pairs of neighbours in a row of ids, in order."""
    import numpy as np

    low = np.uint64((1 << 64 - KEY_BITS) - 1)
    seq = seq.astype(np.uint64)
    a, b = seq[:-1], seq[1:]
    both = (a > 0) & (b > 0)
    return mixed((a[both] << np.uint64(HALF)) | b[both]) & ~low


def _threes(seq):
    """Where three neighbours begin in a row of ids, and their hashes, in order."""
    import numpy as np

    low = np.uint64((1 << 64 - KEY_BITS) - 1)
    x = seq.astype(np.uint64)
    at = np.flatnonzero((x[:-2] > 0) & (x[1:-1] > 0) & (x[2:] > 0))
    return at, mixed(mixed((x[at] << np.uint64(HALF)) | x[at + 1]) + x[at + 2]) & ~low


def _segments(batches: Iterator) -> Iterator:
    """A block's words, cut between rare pairs: those that are alone with their counts, the others in
    order with zeros between, and their threes."""
    import numpy as np
    import pyarrow as pa

    for row in rows(batches):
        seq = unpack(row["seq"], np.uint32)
        tied = np.zeros(len(seq) + 1, bool)  # a word to the one before it
        tied[1:-1] = (seq[:-1] > 0) & (seq[1:] > 0)
        _, place = np.unique(_pairs(seq), return_inverse=True)
        tied[tied] = unpacked_levels(row["levels"])[place] > 0
        alone = (seq > 0) & ~tied[:-1] & ~tied[1:]
        words, times = np.unique(seq[alone], return_counts=True)
        kept = np.flatnonzero((seq > 0) & ~alone)
        width = 2 - tied[kept + 1]
        out = np.zeros(int(width.sum()), np.uint32)
        out[np.cumsum(width) - width] = seq[kept]
        keys, counts = np.unique(_threes(out)[1], return_counts=True)
        values = (row["block"], pack(words), pack(times.astype(np.uint32)), pack(out), pack(keys), pack(counts.astype(np.uint32)))
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, (pa.int64(), *[pa.binary()] * 5))],
                                         names=["block", "alone", "alone_times", "seq", "keys", "times"])


def _summed(a, b, n):
    """The different grams (a, b), in order, with their counts in all."""
    import numpy as np

    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
    return a[first], b[first], np.diff(np.append(0, np.cumsum(n[order]))[np.append(first, len(a))])


def _edges(bits: int):
    """The longest grams of a block, cut at rare threes, with their counts, packed for the buckets they are dealt to."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for row in rows(batches):
            seq = unpack(row["seq"], np.uint32).astype(np.int64)
            at, key = _threes(seq)
            _, place = np.unique(key, return_inverse=True)
            three = np.zeros(len(seq) + 1, bool)  # a frequent one begins
            three[at[unpacked_levels(row["levels"])[place] > 0 if len(at) else slice(0)]] = True
            after = lambda k: np.concatenate([seq[k:], np.zeros(k, np.int64)])[: len(seq)]
            second = after(1)
            third = np.where((second > 0) & three[:-1], after(2), 0)
            fourth = np.where((third > 0) & three[1:], after(3), 0)
            a, b = ((x << HALF | y)[seq > 0] for x, y in ((seq, second), (third, fourth)))
            alone, times = unpack(row["alone"], np.uint32).astype(np.int64) << HALF, unpack(row["alone_times"], np.uint32)
            a, b, n = _summed(np.append(a, alone), np.append(b, np.zeros(len(alone), np.int64)), np.append(np.ones(len(a), np.int64), times))
            bucket = (mixed(mixed(a) + b.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(a), np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
            parts = [(k, *(pack(x) for x in (np.diff(a[own], prepend=0), b[own], n[own].astype(np.uint32))))
                     for k in np.flatnonzero(np.diff(cuts)).tolist() for own in [order[cuts[k] : cuts[k + 1]]]]
            types = (pa.int32(), *[pa.binary()] * 3)
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts), types)], names=["bucket", "a", "b", "n"])

    return run


def _sum_edges(table):
    import numpy as np
    import pyarrow as pa

    a = np.concatenate([np.cumsum(unpack(x.as_py(), np.int64)) for x in table["a"]])
    b, n = (np.concatenate([unpack(x.as_py(), kind).astype(np.int64) for x in table[c]]) for c, kind in (("b", np.int64), ("n", np.uint32)))
    return pa.table(dict(zip("abn", _summed(a, b, n))))


# ---------------------------------------------------------------- the graph; a gram of four words is two longs, (w1, w2) and (w3, w4)
def _pair(x: Column, y: Column | None = None) -> Column:
    high = F.shiftleft(x, HALF)
    return high if y is None else high.bitwiseOR(y)


def _first(x: Column) -> Column:
    return F.shiftright(x, HALF)


def _second(x: Column) -> Column:
    return x.bitwiseAND(F.lit(MASK))


W1, W2, W3, W4 = _first, _second, _first, _second  # of a, a, b, b


def paths(edges: DataFrame) -> DataFrame:
    """(words, n): the full grams of ``edges(a, b, n)`` as maximal unary paths."""
    a, b = F.col("a"), F.col("b")
    full = W4(b) > 0
    suffix = [_pair(W2(a), W3(b)).alias("x"), W4(b).alias("y")]
    prefix = [a.alias("x"), W3(b).alias("y")]
    into = edges.filter(full).groupBy(*suffix).agg(F.count("*").alias("n_in"), F.sum("n").alias("inflow"), F.min("a").alias("ta"), F.min("b").alias("tb"))
    out = edges.filter(W3(b) > 0).groupBy(*prefix).agg(
        F.count_if(full).alias("n_out"), F.sum(F.when(full, F.col("n"))).alias("outflow"), F.count_if(~full).alias("n_end"),
        F.min(F.when(full, a)).alias("a"), F.min(F.when(full, b)).alias("b"))
    unary = (F.col("n_in") == 1) & (F.col("n_out") == 1) & (F.col("n_end") == 0) & (F.col("inflow") == F.col("outflow"))
    links = into.filter("n_in = 1").join(out.filter("n_out = 1 AND n_end = 0"), ["x", "y"]).filter(unary)
    # every edge but the heads points backwards; pointers are doubled until all point to heads.
    # A path is not a ring: whatever flows through one must begin at one of its nodes.
    ahead = stored(links.select("a", "b", "ta", "tb", F.lit(1).alias("d")), "links")
    while True:
        far = ahead.select(F.col("a").alias("ta"), F.col("b").alias("tb"), F.col("ta").alias("ua"), F.col("tb").alias("ub"), F.col("d").alias("e"))
        if ahead.join(far, ["ta", "tb"], "left_semi").isEmpty():
            break
        ahead = stored(ahead.join(far, ["ta", "tb"], "left").select(
            "a", "b", F.coalesce("ua", "ta").alias("ta"), F.coalesce("ub", "tb").alias("tb"), (F.col("d") + F.coalesce("e", F.lit(0))).alias("d")), "links")
    rest = ahead.groupBy(F.col("ta").alias("a"), F.col("tb").alias("b")).agg(F.array_sort(F.collect_list(F.struct("d", W4(b).alias("w")))).alias("rest"))
    heads = edges.filter(full).join(ahead.select("a", "b"), ["a", "b"], "left_anti").join(rest, ["a", "b"], "left")
    four = F.array(W1(a), W2(a), W3(b), W4(b))
    return heads.select(F.when(F.col("rest").isNull(), four).otherwise(F.concat(four, F.col("rest.w"))).alias("words"), "n")


def flow_counts(edges: DataFrame, lines: DataFrame) -> list[DataFrame]:
    """(a, b, f) of the grams of 4, 3, 2 and 1 words from unary paths and piece ends."""
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    w = lambda k: F.col("words")[F.col("i") + k]
    steps = lines.select("words", "n", F.explode(F.sequence(F.lit(0), F.size("words") - 4)).alias("i"))
    four = steps.select(_pair(w(0), w(1)).alias("a"), _pair(w(2), w(3)).alias("b"), n.alias("f"))
    node = [_pair(w(0), w(1)).alias("a"), _pair(w(2)).alias("b")]
    inside = steps.filter("i > 0").select(*node, n.alias("f"))
    ends = lambda test: edges.filter(test).select("a", "b", n.alias("f"))
    total = lambda df, *by: df.groupBy(*by).agg(F.sum("f").alias("f"))
    three = stored(total(steps.filter("i = 0").select(*node, n.alias("f")).union(ends((W3(b) > 0) & (W4(b) == 0))), "a", "b").union(inside), "nodes")
    zero = F.lit(0).cast("long").alias("b")
    two = stored(total(three.select("a", zero, "f").union(ends((W2(a) > 0) & (b == 0))), "a", "b"), "pairs")
    one = total(two.select(_pair(W1(a)).alias("a"), zero, "f").union(ends(W2(a) == 0)), "a", "b")
    return [four, three, two, one]


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, cover: int = COVER, top: int = TOP,
            block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    if least < 2:
        raise ValueError("least must be 2 or more: what is found once is no collocation")
    source = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    blocks = stored(source.mapInArrow(_blocks(block_tokens), "block long, lang string, tokens long, words binary, counts binary, seq binary"), "blocks", group_rows=8)
    sizes = blocks.groupBy("lang").agg(F.sum("tokens").alias("n"))
    bits = bits_for(blocks.agg(F.sum("tokens")).first()[0] or 0, bucket_tokens)
    # words
    dealt = blocks.drop("seq").mapInArrow(_deal_words(bits), "bucket int, block long, lang string, words binary, counts binary")
    schema = "block long, bucket int, ids binary, vocabulary array<struct<lang:string,word:string,id:long>>"
    words = stored(dealt.groupBy("bucket").applyInArrow(_number_words(least, bits), schema), "words")
    vocabulary = stored(words.select(F.inline("vocabulary")), "vocabulary")
    ids = words.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "ids"))).alias("ids"))
    # pairs
    numbered = stored(blocks.select("block", "seq").join(ids, "block").mapInArrow(_numbered, "block long, seq binary, keys binary, times binary"), "numbered", group_rows=8)
    levels = tally(numbered.select("block", "keys", "times"), (least,), bits)
    schema = "block long, alone binary, alone_times binary, seq binary, keys binary, times binary"
    segments = stored(numbered.select("block", "seq").join(levels, "block", "left").mapInArrow(_segments, schema), "segments", group_rows=8)
    # the graph
    levels = tally(segments.select("block", "keys", "times"), (least,), bits)
    grams = segments.drop("keys", "times").join(levels, "block", "left").mapInArrow(_edges(bits), "bucket int, a binary, b binary, n binary")
    edges = stored(grams.groupBy("bucket").applyInArrow(_sum_edges, "a long, b long, n long"), "edges")
    lines = stored(paths(edges), "paths")
    four, three, two, one = (df.filter(F.col("f") >= least) for df in flow_counts(edges, lines))
    one = one.join(vocabulary.select(_pair(F.col("id")).alias("a"), "lang"), "a")
    no_lang = F.lit(None).cast("string").alias("lang")
    counts = [one.select("a", "b", "f", F.lit(1).alias("k"), "lang"), *(df.select("a", "b", "f", F.lit(k).alias("k"), no_lang) for df, k in ((two, 2), (three, 3), (four, 4)))]
    counted = stored(counts[0].union(counts[1]).union(counts[2]).union(counts[3]), "counts")
    best = ranked(counted, cover, top)
    # words for ids: only of what is left
    a, b = F.col("a"), F.col("b")
    each = best.select("a", "b", F.posexplode(F.array(W1(a), W2(a), W3(b), W4(b))).alias("i", "id")).filter("id > 0").join(vocabulary.select("id", "word"), "id")
    text = each.groupBy("a", "b").agg(F.array_join(F.array_sort(F.collect_list(F.struct("i", "word")))["word"], " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase"))
    out = best.join(text, ["a", "b"]).join(sizes, "lang").withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def ranked(counted: DataFrame, cover: int, top: int) -> DataFrame:
    """The phrases of ``counted(a, b, f, k, lang of single words)`` by their lowest cut, without
    those that a longer one covers; the ``top`` of each language, with all that tie with the last."""
    a, b, k = F.col("a"), F.col("b"), F.col("k")
    zero = F.lit(0).cast("long")
    middle = _pair(W2(a), W3(b))
    candidate = counted.filter("k > 1").drop("lang")
    part = lambda cut, *keys: F.when(k > cut, F.struct(F.lit(cut).alias("cut"), *[x.alias(name) for x, name in zip(keys, ("la", "lb", "ra", "rb"))]))
    cuts = F.array(part(1, _pair(W1(a)), zero, middle, _pair(W4(b))), part(2, a, zero, b, zero), part(3, a, _pair(W3(b)), _pair(W4(b)), zero))
    each = candidate.select("a", "b", "f", F.explode(F.filter(cuts, lambda c: c.isNotNull())).alias("c")).select("a", "b", "f", "c.*")
    left = counted.select(F.col("a").alias("la"), F.col("b").alias("lb"), F.col("f").alias("l"), "lang")
    right = counted.select(F.col("a").alias("ra"), F.col("b").alias("rb"), F.col("f").alias("r"))
    both = each.join(left, ["la", "lb"]).join(right, ["ra", "rb"])
    score = F.expr("(CAST(f AS DECIMAL(19)) * 2000000BD) DIV (CAST(l AS DECIMAL(19)) + CAST(r AS DECIMAL(19)))")
    scored = both.groupBy("a", "b", "f").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s"), F.max("lang").alias("lang"))
    # contiguous parts of longer candidates
    sub = lambda longer, *keys: F.when(k >= longer, F.struct(keys[0].alias("a"), keys[1].alias("b")))
    inner = F.array(sub(3, a, zero), sub(3, middle, zero), sub(4, b, zero), sub(4, a, _pair(W3(b))), sub(4, middle, _pair(W4(b))))
    inside = candidate.select("f", F.explode(F.filter(inner, lambda c: c.isNotNull())).alias("c")).groupBy("c.a", "c.b").agg(F.max("f").alias("longer"))
    covered = F.expr(f"100BD * CAST(longer AS DECIMAL(19)) >= {cover}BD * CAST(f AS DECIMAL(19))")
    alone = scored.join(inside, ["a", "b"], "left").filter(F.col("longer").isNull() | ~covered).select("lang", "a", "b", "f", "s.score", "s.l", "s.r")
    place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f")))
    return alone.withColumn("place", place).filter(F.col("place") <= top).drop("place")
