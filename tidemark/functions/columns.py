"""Projections, filters and scalar functions.

All of them are single ``select``/``filter`` steps over built-in functions, so
they stay inside whole-stage codegen and push down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
#: Epoch seconds of the years 1 to 9999.
EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)


def lower_columns(df: DataFrame) -> DataFrame:
    """P5: lower-case every top-level column name in one projection."""
    return df.select([F.col(f"`{c}`").alias(c.lower()) for c in df.columns])


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """``drop`` ignores absent names; case-insensitive like the analyzer."""
    lower = {c.lower() for c in cols}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose given columns are all non-null."""
    cond = None
    for c in cols:
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond)


def with_record_key(df: DataFrame, cols, name: str = "record_key", sep: str = "#") -> DataFrame:
    """Record key from one column, or several joined by ``sep``."""
    return df.withColumn(name, joined_key([cols] if isinstance(cols, str) else list(cols), sep))


def joined_key(cols, sep: str = "#") -> Column:
    """One column as text, or several joined by ``sep``.

    ``concat`` (not ``concat_ws``): any null part makes the key null (Q20). In
    a composite key the separator and the backslash are escaped inside parts, so
    that different parts never give one key; other parts are as they are.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in cols]
    if len(texts) == 1:
        return texts[0]
    out = []
    for t in texts:
        for sign in dict.fromkeys("\\" + sep):
            t = F.replace(t, F.lit(sign), F.lit("\\" + sign))
        out += [F.lit(sep), t]
    return F.concat(*out[1:])


def epoch_seconds(c: Column | str) -> Column:
    """Epoch seconds of a ``timestamp_ntz`` (wall clock read as UTC).

    Built from the date and the clock fields, which are zone-free for
    ``timestamp_ntz``; ``timestamp_diff`` would cast through the session
    zone and shift by the DST offset.
    """
    c = F.col(c) if isinstance(c, str) else c
    days = F.unix_date(c.cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def epoch_to_ntz(c: Column | str) -> Column:
    """Epoch seconds (any text/number) -> ``timestamp_ntz``; null when not a
    number or beyond the years 1 to 9999 (milliseconds, say).

    ``try_cast`` keeps ANSI mode from failing on text such as ``'abc'`` (Q2).
    """
    c = F.col(c) if isinstance(c, str) else c
    secs = c.try_cast("bigint")
    secs = F.when(secs.between(*EPOCH_RANGE), secs)
    return F.expr(EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def with_event_time(
    df: DataFrame, epoch_col: str = "timestamp", name: str = "trade_datetime", fmt: str = "yyyy-MM-dd HH:mm:ss"
) -> DataFrame:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` text (UTC, zone-free)."""
    return df.withColumn(name, F.date_format(epoch_to_ntz(epoch_col), fmt))


def as_date(df: DataFrame, col: str) -> DataFrame:
    """Cast to date; unparseable text becomes null instead of failing."""
    return df.withColumn(col, F.col(col).try_cast("date"))


_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "dayofmonth": F.dayofmonth,
    "hour": F.hour,
}


def with_time_parts(df: DataFrame, col: str, parts=("month", "day", "hour")) -> DataFrame:
    """Unpadded string parts (``month=2``, ``hour=9``), as the layout expects (Q4)."""
    src = F.col(col)
    if dict(df.dtypes).get(col) == "string":
        src = src.try_cast("timestamp_ntz")
    return df.withColumns({p: _PARTS[p](src).cast("string") for p in parts})


def with_partition_path(df: DataFrame, parts, name: str = "partition_key") -> DataFrame:
    """``year=2021/month=11`` as one string."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        pieces.append(F.lit(("/" if i else "") + f"{p}="))
        pieces.append(F.col(p).cast("string"))
    return df.withColumn(name, F.concat(*pieces))


def split_rejects(
    df: DataFrame,
    key: str,
    time_col: str | None = None,
    corrupt_col: str | None = "_corrupt_record",
    reason: str = "reject_reason",
    op_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One ``reason`` column, then two filters over the same plan.

    Order of reasons: malformed payload, null key, unparseable time, unknown
    operation (not I, U or D in any case; null is none of these and passes).
    """
    conds = []
    if corrupt_col and corrupt_col in df.columns:
        conds.append((F.col(corrupt_col).isNotNull(), "malformed"))
    conds.append((F.col(key).isNull(), "null_key"))
    if time_col:
        conds.append((F.col(time_col).isNull(), "bad_time"))
    if op_col:
        conds.append((~F.upper(F.col(op_col)).isin("I", "U", "D"), "unknown_op"))
    expr = None
    for cond, label in conds:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    tagged = df.withColumn(reason, expr)
    good = tagged.filter(F.col(reason).isNull()).drop(reason)
    if corrupt_col and corrupt_col in good.columns:
        good = good.drop(corrupt_col)
    bad = tagged.filter(F.col(reason).isNotNull())
    return good, bad


def with_op(df: DataFrame, op: str = "I", name: str = "Op") -> DataFrame:
    """P20: constant column such as ``'I' as Op``."""
    return df.withColumn(name, F.lit(op))


def stringify(df: DataFrame, cols, fmt: str | None = None) -> DataFrame:
    """Timestamps -> text (``cast as string`` or a ``date_format`` pattern)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if fmt:
        return df.withColumns({c: F.date_format(F.col(c), fmt) for c in cols})
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def conform(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Target order and types; missing fields become null (or a default).

    Matching is case-insensitive, as the ingest paths lower-case names.
    """
    have = {c.lower(): c for c in df.columns}
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is not None:
            c = F.col(f"`{src}`")
            out.append((c.try_cast(f.dataType) if _castable(f.dataType) else c.cast(f.dataType)).alias(f.name))
        elif f.name in defaults:
            out.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(out)


def _castable(dt) -> bool:
    # try_cast covers atomic types; nested types use a plain cast
    return dt.typeName() not in ("struct", "array", "map")


def ensure_op(df: DataFrame, default: str = "I", name: str = "Op") -> DataFrame:
    """Make sure an ``Op`` column exists (the full load has none)."""
    if any(c.lower() == name.lower() for c in df.columns):
        return df
    return df.withColumn(name, F.lit(default))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a DataFrame as a SQL view of the session."""
    df.createOrReplaceTempView(name)
    return df


def sql_transform(df: DataFrame, query: str, token: str = "<SRC>") -> DataFrame:
    """SQL text over the batch; ``<SRC>`` stands for the batch.

    The batch is bound as a DataFrame argument of ``spark.sql`` (no global
    temp view, so concurrent batches cannot see each other).
    """
    text = query.replace("{", "{{").replace("}", "}}").replace(token, "{src}")
    return df.sparkSession.sql(text, src=df)


def normalize_path(c: Column | str) -> Column:
    """Scheme-free, unescaped form of a file path, so ``file:///a/b``,
    ``/a/b`` and ``s3://bkt/a`` vs ``s3a://bkt/a`` compare equal."""
    c = F.col(c) if isinstance(c, str) else c
    stripped = F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//)?", "")
    # a plus is itself in a path, and a percent sign without two hex digits too
    literal = F.regexp_replace(F.regexp_replace(stripped, r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.regexp_replace(F.try_url_decode(literal), r"^/+", "/")
