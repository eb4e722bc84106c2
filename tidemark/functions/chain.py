"""A chain of transformers on batches and streams.

Stages are declared in order, each a name and a function from DataFrame to
DataFrame. ``check`` runs the chain on no rows, so a column that is missing, or
a result that does not fit the target, is known before a stream reads its first
batch; the error names the stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.functions import columns as C
from tidemark.schemas import widened

Stage = tuple[str, Callable[[DataFrame], DataFrame]]


def sql(text: str, name: str = "sql") -> Stage:
    """SQL text, ``<SRC>`` stands for what the stage before gives."""
    return name, lambda df: C.sql_transform(df, text)


def ensure_op(default: str = "I") -> Stage:
    """An ``Op`` column, where the source has none."""
    return "ensure_op", lambda df: C.ensure_op(df, default)


def conform(schema: StructType, defaults: dict | None = None) -> Stage:
    """Order and types of a schema."""
    return "conform", lambda df: C.conform(df, schema, defaults)


class Chain:
    """Stages between a ``source`` and a ``target`` schema; either may be left out.

    The source's columns must be there with a type that fits losslessly; the
    result must have the target's columns with exactly its types (and no others).
    """

    def __init__(self, *stages: Stage, source: StructType | None = None, target: StructType | None = None):
        self.stages, self.source, self.target = stages, source, target

    def __call__(self, df: DataFrame) -> DataFrame:
        self._begin(df.schema)
        for name, apply in self.stages:
            try:
                df = apply(df)
                df.schema  # analysed here, so that the stage is known  # noqa: B018
            except PySparkException as e:
                raise ValueError(f"transformer stage {name!r}: {e}") from e
        self._end(df.schema)
        return df

    def check(self, spark: SparkSession, schema: StructType) -> StructType:
        """The schema that the chain makes of ``schema``, without rows."""
        return self(spark.createDataFrame([], schema)).schema

    def _begin(self, have: StructType) -> None:
        types = {f.name.lower(): f.dataType for f in have.fields}
        for f in self.source.fields if self.source else ():
            found = types.get(f.name.lower())
            if found is None or widened(f.dataType, found) != f.dataType:
                raise ValueError(f"transformer input: column {f.name} must be {f.dataType.simpleString()}, is {found.simpleString() if found else 'missing'}")

    def _end(self, have: StructType) -> None:
        if self.target is None:
            return
        want, got = ([(f.name.lower(), f.dataType) for f in s.fields] for s in (self.target, have))
        if want != got:
            odd = [f"{n} {t.simpleString()}" for n, t in want if (n, t) not in got] + [f"not {n} {t.simpleString()}" for n, t in got if (n, t) not in want]
            raise ValueError(f"transformer output does not fit the target: {', '.join(odd) or 'order of columns'}")
