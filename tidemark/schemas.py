"""Schemas that change between commits: merge, widen, refuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both without loss, None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for ladder in (_WHOLE, _FLOAT):
        if type(a) in ladder and type(b) in ladder:
            return a if ladder.index(type(a)) >= ladder.index(type(b)) else b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and a.scale == b.scale:
        return a if a.precision >= b.precision else b
    return None


def merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Columns of both, in the old order, new ones last; types widen.

    A change that would lose values (text to number, say) is refused.
    """
    if old is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in new.fields])
    by_name = {f.name.lower(): f for f in new.fields}
    out = []
    for f in old.fields:
        g = by_name.pop(f.name.lower(), None)
        t = f.dataType if g is None else widened(f.dataType, g.dataType)
        if t is None:
            raise ValueError(f"column {f.name}: {g.dataType.simpleString()} does not fit {f.dataType.simpleString()}")
        out.append(T.StructField(f.name, t, True))
    return T.StructType(out + [T.StructField(g.name, g.dataType, True) for g in new.fields if g.name.lower() in by_name])


def shaped_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The schema's columns from those of ``df``; missing ones are null."""
    have = {c.lower(): c for c in df.columns}
    return [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the schema's columns."""
    return df.select(shaped_columns(df, schema))
