"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read
    back: cuts the lineage with files that every executor can reach.
    ``group_rows`` bounds the rows of a row group, for rows of several MB."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    write = df.write.option("compression", "zstd")
    (write.option("parquet.block.row.count.limit", group_rows) if group_rows else write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(df: DataFrame, leave_out: tuple = ()) -> Column:
    """All columns as one struct named row, so that a plan's own columns can't
    clash with them; ``row.*`` gives them back."""
    names = [c for c in df.columns if c.lower() not in leave_out]
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in names]).alias("row")


def as_bytes(column) -> list:
    """The UTF-8 bytes of an Arrow string column, ``None`` for null."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()
