"""The core: every read of a keyed table is a reduction of its change log.

The log holds one row per (commit, key) version. A read picks, per key, the
greatest version under a total order and drops tombstones:

    arrival     (_commit_time, _file_seq, order..., tiebreak...)
    event_time  (order..., _commit_time, _file_seq, tiebreak...)

The pick is ``row_number() = 1`` over a window partitioned by the key.
Catalyst plans it as ``WindowGroupLimit`` (partial, before the shuffle) ->
exchange on the key -> ``WindowGroupLimit`` (final) -> ``Window``: each map
task keeps only its local winner per key, so a hot key ships at most one
row per map task across the network and no task ever holds the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.instants import normalize_instant
from tidemark.functions.columns import joined_key
from tidemark.spec import BUCKET, COMMIT, FILE_SEQ, KEY, OP, TableSpec

_UNORDERABLE = (T.MapType,)


def _orderable(df: DataFrame, cols: list[str]) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if c in types and not isinstance(types[c], _UNORDERABLE) and not _has_map(types[c])]


def _has_map(dt) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    return False


def _desc(cols: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").desc_nulls_last() for c in cols]


def winner_order(df: DataFrame, spec: TableSpec, within_batch: bool = False, least_first: bool = False) -> list[Column]:
    """Total order of versions of one key, greatest first (or last)."""
    cols = df.columns
    seq = [FILE_SEQ] if FILE_SEQ in cols else []
    commit = [COMMIT] if (COMMIT in cols and not within_batch) else []
    tb = _orderable(df, spec.tiebreak_columns(cols))
    order = list(spec.order)
    if within_batch:
        keys = seq + order + tb
    elif spec.merge == "arrival":
        keys = commit + seq + order + tb
    else:
        keys = order + commit + seq + tb
    return [F.col(f"`{c}`").asc_nulls_first() for c in keys] if least_first else _desc(keys)


def latest_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """Top-1 per key; ``rn = 1`` lets Catalyst insert ``WindowGroupLimit``."""
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def to_log_rows(
    df: DataFrame,
    spec: TableSpec,
    op_col: str | None = None,
    file_seq: Column | int | None = None,
    commit_time: str | None = None,
    op_default: str = "U",
) -> DataFrame:
    """Add the system columns to change rows: key, op, file sequence (and commit).

    ``op_col`` names a column holding I/U/D in any case (it must exist); null
    means ``op_default``, an unknown value gives a null operation. Partition columns are cast to string (hive-style layout).
    """
    key = joined_key(spec.keys)
    if op_col:
        found = [c for c in df.columns if c.lower() == op_col.lower()]
        if not found:
            raise ValueError(f"no operation column {op_col!r} in {df.columns}")
        op_col = found[0]
        op = F.upper(F.trim(F.col(f"`{op_col}`")))
        # an unknown operation stays null: the writer counts it as a reject
        op = F.when(op.isNull(), F.lit(op_default)).when(op.isin("I", "U", "D"), op)
    else:
        op = F.lit(op_default)
    seq = file_seq if isinstance(file_seq, Column) else F.lit(int(file_seq or 0))
    cols = {KEY: key, OP: op, FILE_SEQ: seq.cast("int")}
    for p in spec.partitions:
        cols[p] = F.col(f"`{p}`").cast("string")
    if commit_time is not None:
        cols[COMMIT] = F.lit(normalize_instant(commit_time))
    out = df.withColumns(cols)
    if op_col and op_col != OP:
        out = out.drop(op_col)
    return with_bucket(out, spec)


def with_bucket(log: DataFrame, spec: TableSpec) -> DataFrame:
    """The bucket of every row's key, for tables that have buckets."""
    if not spec.buckets:
        return log
    return log.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(spec.buckets)).cast("string"))


#: Bits of a page of Spark's ``bitmap_construct_agg``, and of the parts that a page is cut into.
PAGE, PART = 32_768, 2_048
#: Bits for each key of ``key_marks``, as far as all keep within ``MARK_BITS`` (32 MB); under two bits a key they tell too little.
BITS_PER_KEY, MARK_BITS = 8, 1 << 28


def mark_bits(n: int) -> int:
    """The size of the marks of ``n`` keys; 0: there are too many."""
    return 0 if 2 * n > MARK_BITS else min(-(-BITS_PER_KEY * max(n, 1) // PAGE) * PAGE, MARK_BITS)


def _spot(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(bits))


def key_marks(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """A bit for the hash of every key, in parts that are small enough to be looked up row by row."""
    pages = rows.select(_spot(keys, bits).alias("_spot")).groupBy(F.expr(f"_spot div {PAGE}").alias("_page"))
    pages = pages.agg(F.bitmap_construct_agg(F.expr(f"_spot % {PAGE}")).alias("_marks"))
    parts = pages.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(PAGE // PART - 1))))
    return parts.selectExpr(f"_page * {PAGE // PART} + _i AS _part", f"substring(_marks, _i * {PART // 8} + 1, {PART // 8}) AS _marks")


def marked(rows: DataFrame, marks: DataFrame, keys: list[str], bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the marked ones, rows whose key is not); neither is shuffled."""
    both = rows.withColumn("_spot", _spot(keys, bits))
    both = both.join(F.broadcast(marks), F.expr(f"_spot div {PART}") == F.col("_part"), "left")
    byte = F.conv(F.hex(F.expr(f"substring(_marks, CAST(_spot % {PART} div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    may = F.coalesce(F.getbit(byte, (F.col("_spot") % 8).cast("int")) == 1, F.lit(False))
    return tuple(both.where(c).select(*[F.col(f"`{n}`") for n in rows.columns]) for c in (may, ~may))


def precombine(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Highest ``(file_seq, order, tiebreak)`` per key inside one batch.

    Works both on raw rows (key built from ``spec.keys``) and on log rows.
    """
    if KEY not in df.columns:
        df = to_log_rows(df, spec)
    return latest_per_key(df, spec.key_columns, winner_order(df, spec, within_batch=True))


def visible(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop tombstones when deletes are applied."""
    if spec.deletes != "apply" or OP not in df.columns:
        return df
    return df.where(F.col(OP).isNull() | (F.col(OP) != F.lit("D")))


def snapshot(log: DataFrame, spec: TableSpec, keep_tombstones: bool = False) -> DataFrame:
    """The current row of every key."""
    won = latest_per_key(log, spec.key_columns, winner_order(log, spec))
    return won if keep_tombstones else visible(won, spec)


def superseded(log: DataFrame, spec: TableSpec) -> DataFrame:
    """Key and instant of every version that a newer commit of an ``arrival`` table supersedes. Commits must
    have a key once, so no order but theirs counts and nothing else is shuffled. Joins on the key drop null
    ones; they are dropped here, so that marks and a join of the same versions share one shuffle."""
    keys = [F.col(f"`{k}`") for k in spec.key_columns]
    newer = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(COMMIT).desc()))
    return log.where(F.col(KEY).isNotNull()).select(*keys, COMMIT).withColumn("_rn", newer).where(F.col("_rn") > 1).drop("_rn")


def as_of(log: DataFrame, spec: TableSpec, t: str, keep_tombstones: bool = False) -> DataFrame:
    """The table as it was right after commit ``t`` (partition-pruned)."""
    return snapshot(log.where(F.col(COMMIT) <= F.lit(normalize_instant(t))), spec, keep_tombstones)


def _range(begin: str | None, end: str | None) -> Column:
    cond = F.lit(True)
    if begin is not None:
        cond = cond & (F.col(COMMIT) > F.lit(normalize_instant(begin)))
    if end is not None:
        cond = cond & (F.col(COMMIT) <= F.lit(normalize_instant(end)))
    return cond


def incremental(log: DataFrame, spec: TableSpec, begin: str | None, end: str | None = None) -> DataFrame:
    """R2: rows whose current version (as of ``end``) was committed in ``(begin, end]``.

    In ``arrival`` mode the latest commit of a key wins, so the winner among
    the commits inside the range is the as-of-``end`` winner: only those
    commit partitions are scanned. In ``event_time`` mode an older commit may
    hold a higher ordering value, so all commits up to ``end`` are reduced and
    the winners filtered to the range.
    """
    if spec.merge == "arrival":
        return snapshot(log.where(_range(begin, end)), spec)
    upto = log.where(_range(None, end))
    won = snapshot(upto, spec, keep_tombstones=True).where(_range(begin, None))
    return visible(won, spec)


def changes_since_lag(log: DataFrame, spec: TableSpec, now: str, minutes: float = 20) -> DataFrame:
    """Changes since the newest commit older than ``now - minutes``;
    with no such commit the begin is ``now`` itself.

    The begin instant is a scalar subquery, evaluated once before the scan.
    """
    from tidemark.functions.instants import commit_cutoff

    now = normalize_instant(now)
    cutoff = commit_cutoff(now, minutes)
    spark = log.sparkSession
    begin_sql = (
        f"(SELECT coalesce(max({COMMIT}), '{now}') FROM {{log}} WHERE {COMMIT} < '{cutoff}')"
    )
    if spec.merge == "arrival":
        rng = spark.sql(f"SELECT * FROM {{log}} WHERE {COMMIT} > {begin_sql}", log=log)
        return snapshot(rng, spec)
    won = snapshot(log, spec, keep_tombstones=True)
    rng = spark.sql(f"SELECT * FROM {{won}} WHERE {COMMIT} > {begin_sql}", won=won, log=log)
    return visible(rng, spec)


def changes_after(log: DataFrame, start: str = "earliest") -> DataFrame:
    """S3 for logs: raw change rows after a start position
    (``earliest``, ``latest`` or a commit instant)."""
    s = start.lower()
    if s in ("earliest", "trim_horizon"):
        return log
    if s == "latest":
        return log.where(F.lit(False))
    return log.where(F.col(COMMIT) > F.lit(normalize_instant(start)))


def merge_into(current: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """W2, copy-on-write form: ``current`` anti-join changed keys, union changes.

    ``changes`` are log rows of one commit. Both sides are unique per key
    (``current`` is a snapshot, ``changes`` are precombined), so the
    anti-join has no hot key. In ``event_time`` mode a change only replaces a
    row it beats, so the union is reduced instead, and tombstones stay in the
    state so that an older update cannot bring a deleted key back.
    """
    changes = precombine(changes, spec)
    keys = list(spec.key_columns)
    if spec.merge == "arrival":
        kept = current.join(changes.select(*keys), on=keys, how="left_anti")
        return visible(kept.unionByName(changes, allowMissingColumns=True), spec)
    both = current.unionByName(changes, allowMissingColumns=True)
    return snapshot(both, spec, keep_tombstones=True)
