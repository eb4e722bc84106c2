"""Reads over the commit timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.instants import normalize_instant
from tidemark.operators.reduce import winner_order
from tidemark.spec import COMMIT, OP, TableSpec


def commit_list(log: DataFrame, since: str | None = None) -> DataFrame:
    """Distinct commits after ``since``, newest first."""
    df = log.select(COMMIT)
    if since is not None:
        df = df.where(F.col(COMMIT) > F.lit(normalize_instant(since)))
    return df.distinct().orderBy(F.col(COMMIT).desc())


def commit_min_recent(log: DataFrame, since: str) -> DataFrame:
    """Oldest commit after ``since`` (one row, null if none)."""
    return log.where(F.col(COMMIT) > F.lit(normalize_instant(since))).agg(F.min(COMMIT).alias("commit_time"))


def commit_nth_last(log: DataFrame, n: int = 2, since: str | None = None) -> DataFrame:
    """The n-th commit from the end (n=1 is the newest). The reference
    indexed an unordered list; this one is ordered."""
    return commit_list(log, since).offset(n - 1).limit(1).withColumnRenamed(COMMIT, "commit_time")


def show_commits(log: DataFrame, spec: TableSpec, n: int = 10) -> DataFrame:
    """Per commit, rows written split into inserts (first version of a
    key), updates and deletes; newest first, ``n`` commits.

    A key's first commit is a ``min`` over a window on the key (one shuffle
    of the log; per-key groups hold at most one version per commit).
    """
    keys = [F.col(f"`{k}`") for k in spec.key_columns]
    first = F.min(COMMIT).over(Window.partitionBy(*keys))
    tagged = log.select(COMMIT, OP, first.alias("_first"))
    is_del = F.col(OP) == F.lit("D")
    is_ins = (~is_del) & (F.col(COMMIT) == F.col("_first"))
    return (
        tagged.groupBy(COMMIT)
        .agg(
            F.count(F.lit(1)).alias("num_rows"),
            F.count_if(is_ins).alias("num_inserts"),
            F.count_if((~is_del) & ~is_ins).alias("num_updates"),
            F.count_if(is_del).alias("num_deletes"),
        )
        .withColumnRenamed(COMMIT, "commit_time")
        .orderBy(F.col("commit_time").desc())
        .limit(n)
    )


def retained_commits(log: DataFrame, retain: int) -> list[str]:
    """The newest ``retain`` commit instants (a bounded list)."""
    rows = log.select(COMMIT).distinct().orderBy(F.col(COMMIT).desc()).limit(retain).collect()
    return [r[0] for r in rows]


def expire(log: DataFrame, spec: TableSpec, retain: int = 3, pins=(), keep: list[str] | None = None) -> DataFrame:
    """Drop row versions no retained or pinned commit can see.

    A version is kept when it is the winner of its key as of some kept
    instant t. In ``arrival`` mode a version is the winner on
    ``[commit, next commit of the key)``, so one ``lead`` per key and a test
    against the (small, literal) list of kept instants decides it; per-key
    groups hold at most one version per commit, so they are bounded by the
    number of commits. In ``event_time`` mode a version also has to outrank
    all earlier commits of its key; two more passes over the same partitioning.
    """
    kept = sorted({normalize_instant(t) for t in (keep if keep is not None else retained_commits(log, retain))}
                  | {normalize_instant(p) for p in pins})
    if not kept:
        return log
    keys = [F.col(f"`{k}`") for k in spec.key_columns]
    if spec.merge == "arrival":
        # One partitioning by key for both steps: versions sorted by commit,
        # the commit's own winner first; ``lag`` marks that winner (only it can
        # be seen at any instant), then ``lead`` over the winners gives the next
        # commit of the key. The second window reuses the first one's
        # distribution and order, so the log is shuffled once.
        order = [F.col(COMMIT).asc()] + [o for o in winner_order(log, spec, within_batch=True)]
        w = Window.partitionBy(*keys).orderBy(*order)
        heads = log.withColumn("_prev", F.lag(COMMIT).over(w)).where(
            F.col("_prev").isNull() | (F.col("_prev") != F.col(COMMIT))
        )
        nxt = F.lead(COMMIT).over(Window.partitionBy(*keys).orderBy(*order))
        arr = F.array(*[F.lit(t) for t in kept])
        seen = F.exists(arr, lambda t: (F.col(COMMIT) <= t) & (F.col("_next").isNull() | (t < F.col("_next"))))
        return heads.withColumn("_next", nxt).where(seen).drop("_prev", "_next")
    # event time: along a key's commits the best version so far only changes when
    # a version beats all earlier ones. One pass ranks versions by the order of
    # the merge; a version that some earlier commit of the key outranks is never
    # seen, and one that is stays until the next that outranks it.
    by_commit = [F.col(COMMIT).asc(), *winner_order(log, spec, within_batch=True)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*winner_order(log, spec, least_first=True)))
    ranked = log.withColumn("_rank", rank)
    w = Window.partitionBy(*keys).orderBy(*by_commit)
    best = F.max("_rank").over(w.rowsBetween(Window.unboundedPreceding, -1))
    heads = ranked.withColumn("_best", best).where(F.col("_best").isNull() | (F.col("_rank") > F.col("_best")))
    nxt = F.lead(COMMIT).over(w)
    arr = F.array(*[F.lit(t) for t in kept])
    seen = F.exists(arr, lambda t: (F.col(COMMIT) <= t) & (F.col("_next").isNull() | (t < F.col("_next"))))
    return heads.withColumn("_next", nxt).where(seen).drop("_rank", "_best", "_next")
