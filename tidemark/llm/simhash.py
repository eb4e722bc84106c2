"""SimHash near-duplicates by the generalised pigeonhole principle.

If two 64-bit fingerprints differ in at most ``max_bits`` bits, and the bits
are split into partitions with thresholds t_i, where the sum of all t_i + 1 is
max_bits + 1, then in some partition they differ in at most t_i bits. Bits
that vary together are grouped into one partition, so that the partitions are
close to independent. A dynamic programme picks thresholds (-1: leave the
partition out), and with them the number of partitions, from estimated
candidate counts. Those estimates come from a bounded sample and only steer
cost: any choice finds the same links.

Every distinct fingerprint is indexed under its value in each partition and
probes all values within the threshold. Candidates are verified on all bits.
To keep groups of near copies from emitting all their pairs, members of a
bucket are first linked to a few pivots of the bucket. Only links between what
is still unconnected are searched pairwise, so no link that matters is lost.

Defined results: null or empty texts and texts of white space have fingerprint
zero and link like any other; fewer words than a shingle make one shingle; a
null ``doc_id`` never is a component id unless the whole component has none;
repeated rows are judged row by row.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, stored, whole
from tidemark.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Distinct fingerprints in the sample that steers partitions and thresholds.
SAMPLE = 2048
#: Pivots in a bucket, and how often pivots are drawn before the search by pairs.
PIVOTS = 4
ROUNDS = 2


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        part = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(ends[k : min(n, k + (1 << 15))], ends[min(k + shingle, len(words)) :])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, text_key (a hash of the text), fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fp = np.array([simhash(t, shingle) for t in as_bytes(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _groups(sample, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of near equal width; each grows by the bit
    that is most correlated with those it has."""
    import numpy as np

    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    bits -= bits.mean(axis=0)
    norm = np.sqrt((bits**2).sum(axis=0))
    near = np.abs(bits.T @ bits) / np.maximum(np.outer(norm, norm), 1e-9)
    np.fill_diagonal(near, 0)
    free, out = set(range(64)), []
    for k in range(parts):
        width = 64 // parts + (k < 64 % parts)
        group = [max(sorted(free), key=lambda b: near[b, sorted(free)].max())]
        free.discard(group[0])
        while len(group) < width:
            group.append(max(sorted(free), key=lambda b: near[b, group].mean()))
            free.discard(group[-1])
        out.append(sorted(group))
    return out


def _ball(width: int, t: int) -> int:
    return sum(comb(width, k) for k in range(t + 1))


def choose(sample, rows: int, max_bits: int) -> list[tuple[int, list[int], int]]:
    """(partition's mask, its bits, threshold) for the cheapest allocation found."""
    import numpy as np

    best = None
    pairs = (sample[:, None] ^ sample[None, :])[np.triu_indices(len(sample), 1)]
    for parts in range(2, max_bits + 2):
        cost = []
        groups = _groups(sample, parts)
        for bits in groups:
            apart = np.bitwise_count(pairs & np.uint64(sum(1 << b for b in bits)))
            row = [0.0]
            for t in range(max_bits):
                share = max((apart <= t).mean() if len(pairs) else 0, _ball(len(bits), t) / 2.0 ** len(bits))
                row.append(rows * (1 + _ball(len(bits), t)) + 0.1 * share * rows * rows)
            cost.append(row)
        # state: units of (t + 1) given out -> (cost, thresholds)
        state = {0: (0.0, [])}
        for row in cost:
            step: dict = {}
            for given, (so_far, chosen) in state.items():
                for unit, c in enumerate(row):
                    if given + unit <= max_bits + 1 and (so_far + c) < step.get(given + unit, (float("inf"),))[0]:
                        step[given + unit] = (so_far + c, [*chosen, unit - 1])
            state = step
        if max_bits + 1 in state and (best is None or state[max_bits + 1][0] < best[0]):
            best = (state[max_bits + 1][0], groups, state[max_bits + 1][1])
    return [(sum(1 << b for b in bits), bits, t) for bits, t in zip(best[1], best[2]) if t >= 0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, label) of every distinct fingerprint: label is the smallest one that
    links of at most ``max_bits`` differing bits reach."""
    import numpy as np

    uniq = stored(fps.select("fp").distinct(), "fingerprints")
    rows = uniq.count()
    head = uniq.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    plan = choose(np.array([r.fp for r in head], np.int64).view(np.uint64), rows, max_bits) if rows else []
    if not plan:
        return uniq.select("fp", F.col("fp").alias("label"))
    flips = []  # for each partition the bit patterns within its threshold
    for _, bits, t in plan:
        flips.append([_signed(sum(1 << b for b in c)) for k in range(t + 1) for c in itertools.combinations(bits, k)])
    value = [F.col("fp").bitwiseAND(F.lit(_signed(mask))) for mask, _, _ in plan]
    array = lambda xs: F.expr(f"array({','.join(f'{x}L' if x > -(1 << 63) else 'bigint(-9223372036854775808)' for x in xs)})")
    own = F.array(*[F.struct(F.lit(k).alias("part"), v.alias("key")) for k, v in enumerate(value)])
    index = uniq.select("fp", F.inline(own))
    pivot = [F.min_by("fp", F.xxhash64("fp", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)]
    buckets = index.groupBy("part", "key").agg(F.min("fp").alias("least"), F.max("fp").alias("most"), *pivot)
    probes = None
    for k, v in enumerate(value):
        some = uniq.select("fp", v.alias("v"), F.explode(array(flips[k])).alias("flip"))
        some = some.select(F.lit(k).alias("part"), F.col("v").bitwiseXOR(F.col("flip")).alias("key"), "fp", (F.col("flip") == 0).alias("own"))
        probes = some if probes is None else probes.union(some)
    # members of buckets that hold another fingerprint; those alone have no candidate
    hits = stored(probes.join(buckets, ["part", "key"]).filter("least <> fp or most <> fp").drop("least", "most"), "probes")
    label = uniq.select("fp", F.col("fp").alias("label"))
    for turn in range(ROUNDS):
        star = hits.select("fp", F.explode(F.array(*[f"p{k}" for k in range(PIVOTS)])).alias("pivot")).filter((F.col("fp") != F.col("pivot")) & (_apart("fp", "pivot") <= max_bits))
        label = _joined(label, star, "fp", "pivot")
        member = hits.select("part", "key", "fp", "own").join(label, "fp")
        open_ = member.groupBy("part", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("part", "key")
        member = stored(member.join(open_, ["part", "key"]), "members")
        if turn < ROUNDS - 1:
            # pivots anew, among the unconnected: one for each end of the label order and two by another hash
            pick = member.filter("own").groupBy("part", "key").agg(
                F.min_by("fp", F.struct("label", "fp")).alias("p0"), F.max_by("fp", F.struct("label", "fp")).alias("p1"),
                *[F.min_by("fp", F.xxhash64("fp", F.lit(100 + k))).alias(f"p{k}") for k in range(2, PIVOTS)],
            )
            hits = member.drop("label").join(pick, ["part", "key"])
    a = member.filter("own").select("part", "key", F.col("fp").alias("a"), F.col("label").alias("la"))
    b = member.select("part", "key", F.col("fp").alias("b"), F.col("label").alias("lb"))
    cross = a.join(b, ["part", "key"]).filter((F.col("la") != F.col("lb")) & (_apart("a", "b") <= max_bits))
    return _joined(label, cross, "a", "b")


def _joined(label: DataFrame, found: DataFrame, a: str, b: str) -> DataFrame:
    """``label(fp, label)`` after the links ``found`` between fingerprints."""
    left = label.select(F.col("fp").alias(a), F.col("label").alias("u"))
    right = label.select(F.col("fp").alias(b), F.col("label").alias("v"))
    edges = found.select(a, b).distinct().join(left, a).join(right, b).select("u", "v").filter("u <> v")
    merged = components(edges).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return stored(label.join(merged, "label", "left").select("fp", F.coalesce("root", "label").alias("label")), "labels")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, text_key, fp, label (the component's
    smallest fingerprint) and component_id (its smallest doc_id)."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "documents")
    # per fingerprint first: a fingerprint of a third of all documents is one row here
    label = links(rows, max_bits).join(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp")
    least = label.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows.join(label.join(least, "label").select("fp", "label", "component_id"), "fp")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document row of each component stays, the one with the smallest
    doc_id (nulls last); all columns are kept."""
    found = near_duplicates(docs, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key")))
    winners = found.groupBy("label").agg(first.alias("w")).select("w.doc_id", "w.text_key")
    # rows that share the winner's id and text: how often it is there
    times = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("times"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["text_key"].eqNullSafe(b["text_key"])
    keep = stored(winners.alias("a").join(times.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.text_key = b.text_key")).select("a.doc_id", "a.text_key", "times"), "kept")
    keyed = docs.select(whole(docs), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    single, more = keep.filter("times = 1"), keep.filter("times > 1")
    one = keyed.join(single, same(keyed, single), "left_semi").select("row.*")
    # repeated rows may differ in other columns; the one with the least digest stays, in every run
    many = keyed.join(more, same(keyed, more), "left_semi").groupBy("doc_id", "text_key").agg(F.min_by("row", F.md5(F.to_json("row"))).alias("row")).select("row.*")
    return one.unionByName(many)
