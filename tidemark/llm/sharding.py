"""Sharding by histogram sort: shards of near-equal bytes.

Documents are ordered by (hash of the text, hash of the id, row), so equal
texts lie together. For each cut between shards the wanted number of bytes
below it is known. Passes over a stored key table count the exact bytes and
rows below evenly spaced probe keys, inside the intervals that still hold a
cut, for all cuts at once. A cut is placed when a probe comes within the
tolerance; otherwise its interval is the one between two probes in the next
pass. An interval that holds one text hash alone goes on by the id's hash, then
by the row, so even a text that fills several shards is cut where it must be.
Then the rows are exchanged once, by range, and numbered inside their range;
the counts below each cut turn that into gapless slots of the shard.

Defined results: null texts count 16 bytes and have CRC 0; nulls in other
columns do not matter; repeated rows are separate rows that may part at a cut;
columns named shard or slot are replaced;
with fewer rows than shards some shards stay empty; empty tables give none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored, whole

SHARDS = 40
#: How far the bytes below a cut may be from those wanted, as a share of one shard.
TOLERANCE = 0.002
#: Probes inside an interval: 2 to this power.
BITS = 10
#: Bytes of one range; a shard of more is exchanged as several ranges, MAX_RANGES at most.
RANGE_BYTES = 256 << 20
MAX_RANGES = 64
KEYS = ("k1", "k2", "k3")
LOW = -(1 << 63)


def with_keys(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "size": (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long"),
        "k1": F.xxhash64("text"), "k2": F.xxhash64("doc_id"), "k3": F.monotonically_increasing_id(),
    })


@dataclass(frozen=True)
class Cut:
    key: tuple[int, int, int]  # the first key above it
    rows: int  # below it
    bytes: int


@dataclass(frozen=True)
class _Interval:
    """Keys that begin with ``fixed`` and whose next key has ``prefix`` as its first ``depth`` bits."""

    fixed: tuple[int, ...] = ()
    depth: int = 0
    prefix: int = 0
    rows: int = 0  # below it
    bytes: int = 0


def _prefix(level: int, depth: int) -> Column:
    """The first ``depth`` bits of a key, in the order of signed keys."""
    return F.shiftrightunsigned(F.col(KEYS[level]).bitwiseXOR(F.lit(LOW)), 64 - depth) if depth else F.lit(0).cast("long")


def _first(interval_fixed: tuple, prefix: int, depth: int) -> tuple[int, int, int]:
    """The smallest key with this prefix; a prefix past the last one is the next key of the level above."""
    if prefix >> depth:
        if not interval_fixed:
            return ((1 << 63) - 1,) * 3
        up = interval_fixed[-1] - LOW + 1
        return _first(interval_fixed[:-1], up, 64)
    key = (*interval_fixed, (prefix << (64 - depth)) + LOW)
    return (*key, *[LOW] * (3 - len(key)))


def cuts(keyed: DataFrame, wanted: list[float], tolerance: float) -> list[Cut]:
    """The cuts nearest to ``wanted`` bytes below them, within ``tolerance`` bytes where keys allow it."""
    found: dict[float, Cut] = {}
    open_ = {w: _Interval() for w in wanted}
    while open_:
        step: dict[float, _Interval] = {}
        for level, depth in {(len(i.fixed), i.depth) for i in open_.values()}:
            here = {i for i in open_.values() if (len(i.fixed), i.depth) == (level, depth)}
            more = min(depth + BITS, 64)
            scope = F.concat_ws("/", *KEYS[:level], _prefix(level, depth))
            name = lambda i: "/".join(map(str, (*i.fixed, i.prefix)))
            rows = keyed.filter(scope.isin([name(i) for i in here])) if level or depth else keyed
            key = F.col(KEYS[level])
            counted = rows.groupBy(scope.alias("scope"), _prefix(level, more).alias("bin")).agg(
                F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.min(key).alias("lo"), F.max(key).alias("hi"))
            bins: dict[str, list] = {}
            for r in counted.collect():  # at most 2**BITS rows for each open interval
                # Spark numbers the bins of a whole 64-bit key as signed
                bins.setdefault(r["scope"], []).append((r["bin"] % (1 << 64), r["rows"], r["bytes"], r["lo"], r["hi"]))
            for i in here:
                below_rows, below = i.rows, i.bytes
                goals = sorted(w for w, x in open_.items() if x == i)
                for bin_, n, size, lo, hi in sorted(bins.get(name(i), [])):
                    inside = [w for w in goals if w < below + size and w not in found and w not in step]
                    for w in inside:
                        under = Cut(_first(i.fixed, bin_, more), below_rows, below)
                        over = Cut(_first(i.fixed, bin_ + 1, more), below_rows + n, below + size)
                        near = min(under, over, key=lambda c: abs(c.bytes - w))
                        if abs(near.bytes - w) <= tolerance or n == 1 or (level == 2 and lo == hi):
                            found[w] = near
                        elif lo == hi:
                            step[w] = _Interval((*i.fixed, lo), 0, 0, below_rows, below)
                        else:
                            step[w] = _Interval(i.fixed, more, bin_, below_rows, below)
                    below_rows, below = below_rows + n, below + size
                for w in goals:  # at or past the end
                    if w not in found and w not in step:
                        found[w] = Cut(_first(i.fixed, i.prefix + 1, i.depth), below_rows, below)
        open_ = step
    return [found[w] for w in wanted]


def _at_or_over(key: tuple[int, int, int]) -> Column:
    a, b, c = (F.lit(x) for x in key)
    k1, k2, k3 = map(F.col, KEYS)
    return (k1 > a) | ((k1 == a) & ((k2 > b) | ((k2 == b) & (k3 >= c))))


def _range(found: list[Cut], lo: int, hi: int) -> Column:
    """How many of found[lo:hi] are at or below the key, plus lo: a binary search as nested conditions."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(_at_or_over(found[mid].key), _range(found, mid + 1, hi)).otherwise(_range(found, lo, mid))


def place(keyed: DataFrame, counted: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``keyed`` with shard and slot. ``counted`` has the same rows' keys and
    sizes, stored, for the counting passes."""
    total = counted.agg(F.sum("size")).first()[0] or 0
    per = min(MAX_RANGES, max(1, -(-total // (shards * range_bytes))))
    n = shards * per
    found = cuts(counted, [total * k / n for k in range(1, n)], tolerance * total / shards) if total else []
    starts = [0, *(c.rows for c in found)] if found else [0]
    rows = keyed.withColumn("range", _range(found, 0, len(found)))
    offset = F.element_at(F.array(*[F.lit(s - starts[k // per * per]) for k, s in enumerate(starts)]), F.col("range") + 1)
    order = Window.partitionBy("range").orderBy(*KEYS)
    slot = (F.row_number().over(order) - 1 + offset).cast("long")
    return rows.withColumns({"shard": F.floor(F.col("range") / per).cast("int"), "slot": slot}).drop("range")


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The columns of ``docs`` with shard and slot, from one exchange of the documents."""
    keyed = docs.select(whole(docs, ("shard", "slot")), *[F.col(c) for c in ("doc_id", "text")])
    keyed = with_keys(keyed).drop("doc_id", "text")
    counted = stored(keyed.select("size", *KEYS), "keys")
    return place(keyed, counted, shards, tolerance).select("row.*", "shard", "slot")


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    keyed = stored(with_keys(docs.select("doc_id", "text")).withColumn("text_crc32", crc).drop("text"), "keys")
    return place(keyed, keyed, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
