"""Mixing sources to target weights, in DataFrame functions only.

Sources in code point order, null last, take the weights in turn. Together
they share ``budget`` times all words by weight; a source's target stops at
``max_rate`` times its own words and the excess is shared anew by weight. The
limit of that is a water level: target = min(cap, level * weight), found
exactly from the sources sorted by cap / weight. A document is emitted
floor(rate) times, rate = target / words of its source, plus one more time
with probability rate - floor(rate), drawn from a hash of its id and text.

Of one draw the words taken spread widely about the target where a source has
few documents of very unequal sizes. So the hash seeds ``TRIES`` draws of a
document, the words that each would take are summed for every source in one
pass over narrow rows, and a source uses the draw that comes nearest to its
target (ties: the first). A source of under ``FEW`` documents uses the first,
since there the nearest would be one rounding for all such sources.

Defined results: a null or empty text has size 0 and changes nothing; null is
a source of its own; a source without words has target 0 and its documents are
not taken; rows equal in id and text share one draw; empty tables give none.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored, whole

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = 17
#: Draws that a document has, and their number of values (a power of two that doubles hold).
TRIES, DRAWS = 64, 1 << 52
FEW = 16
SALT = 32
#: Rates are broadcast up to so many sources (under 20 MB at 200 bytes a source); beyond it they are joined by a salted shuffle.
BROADCAST_SOURCES = 100_000


def size():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(rows: DataFrame, order: list, name: str, sums: tuple = ()) -> DataFrame:
    """``rows`` with ``at``, their place in ``order`` from 0, and for each column c of ``sums`` below_c and
    all_c, its sum over the rows before and over all. Rows are dealt into ranges of the order; what the ranges before hold is a
    table with one row a range, so no task sees more than a range."""
    dealt = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = dealt.groupBy("part").agg(F.count("*").alias("at"), *[F.sum(c).alias(c) for c in sums])
    starts = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"from_{c}") for c in ("at", *sums)]
    held = held.select("part", *starts, *[F.sum(c).over(Window.partitionBy()).alias(f"all_{c}") for c in sums])
    inside = Window.partitionBy("part").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    below = [(F.col(f"from_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"below_{c}") for c in sums]
    return dealt.join(F.broadcast(held), "part").select(*rows.columns, (F.col("from_at") + F.row_number().over(inside) - 1).alias("at"), *below, *[f"all_{c}" for c in sums])


def rates(sized: DataFrame, weights: tuple = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("long")
    big = "decimal(38,0)"
    per = _ranked(per, [by_source], "turns").withColumns({"weight": weight, "cap": F.col("source_size") * max_rate}).drop("at")
    by_level = (F.col("cap") * (F.lit(lcm(*weights)) / F.col("weight")).cast("long")).cast(big)
    per = _ranked(per, [by_level, by_source], "levels", ("cap", "weight", "source_size"))
    num, den = F.col("all_source_size") - F.col("below_cap"), F.col("all_weight") - F.col("below_weight")
    # the first source in this order that the level does not lift over its cap sets the level
    fits = num.cast(big) * F.col("weight") <= F.col("cap").cast(big) * den
    level = per.filter(fits).agg(F.min(F.struct("at", num.alias("num"), den.alias("den"))).alias("level")).select("level.*").first()
    share = (F.lit(level["num"]).cast("long") * F.col("weight")).cast("double") / F.lit(level["den"]).cast("double")
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), share))
    return per.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def _drawn(docs: DataFrame, seed: int, *columns) -> DataFrame:
    """``columns`` with source, size and the two halves of a document's hash that its draws come from."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    half = lambda at: F.conv(F.substring("hash", at, 13), 16, 10).cast("long")
    rows = docs.select(*columns, "source", size().alias("size"), F.md5(key).alias("hash"))
    return rows.withColumns({"a": half(1), "b": half(14)}).drop("hash")


def _wins(number):
    """Whether draw ``number`` of a document falls below the fraction of its source's rate."""
    draw = ((F.col("a") + number * F.col("b")) % DRAWS).cast("double") / float(DRAWS)
    return draw < F.col("rate") - F.floor("rate")


def _beside(rows: DataFrame, rate: DataFrame) -> DataFrame:
    """``rows`` with what ``rate`` says of their source. Few sources are broadcast; many are joined by a
    shuffle in which every source has SALT keys, so a source with a third of the rows is in SALT tasks."""
    rate = rate.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if rate.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(rate), same)
    rate = rate.withColumn("grain", F.explode(F.array(*map(F.lit, range(SALT)))))
    return rows.withColumn("salt", (F.col("a") % SALT).cast("int")).join(rate, same & (F.col("salt") == F.col("grain")))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """``rates`` with the number of the draw that each source uses."""
    drawn = stored(_drawn(docs, seed), "draws")
    rate = stored(rates(drawn, weights, max_rate), "rates")
    words = [F.sum(F.when(_wins(F.lit(k)), F.col("size")).otherwise(0)).alias(f"words_{k}") for k in range(TRIES)]
    tried = _beside(drawn, rate).groupBy("source", "source_size", "target", "rate").agg(F.count("*").alias("n"), *words)
    missed = lambda k: F.abs((F.floor("rate") * F.col("source_size") + F.col(f"words_{k}")).cast("double") - F.col("target"))
    best = F.array_min(F.array(*[F.struct(missed(k).alias("missed"), F.lit(k).alias("number")) for k in range(TRIES)]))
    number = F.when(F.col("n") < FEW, F.lit(0)).otherwise(best["number"])
    return stored(tried.select("source", "source_size", "target", "rate", number.alias("number")), "plan")


def repetitions(docs: DataFrame, weights: tuple = WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """``docs`` as ``row``, with size, source_size, target and copies: how
    often the mix takes the document."""
    joined = _beside(_drawn(docs, seed, whole(docs)), plan(docs, weights, max_rate, seed))
    copies = F.least(F.lit(max_rate), F.floor("rate") + _wins(F.col("number")).cast("long"))
    return joined.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns."""
    found = repetitions(docs, weights, max_rate, seed).filter("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    return repetitions(docs).select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
