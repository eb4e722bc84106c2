"""Landing fixture files the way an upstream system would: written once by
Spark into a staging folder, then moved (atomic rename) into the folder a
stream watches, one group at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scoped_conf

STAGE_CONF = {"spark.sql.files.maxPartitionBytes": "16m"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_parquet(spark: SparkSession, directory: str) -> list[str]:
    jvm, fs = _fs(spark, directory)
    p = jvm.org.apache.hadoop.fs.Path(directory)
    if not fs.exists(p):
        return []
    return sorted(
        str(s.getPath().toString()) for s in fs.listStatus(p) if str(s.getPath().getName()).endswith(".parquet")
    )


def stage_groups(df: DataFrame, group_col: str, staging: str) -> dict[int, list[str]]:
    """One Spark write without a shuffle of its own: every task writes what it has of
    each group (a few) into the group's folder. Splits are small enough to be sorted by
    group in memory. Groups are landed one after the other, so file order = group order."""
    spark = df.sparkSession
    with scoped_conf(spark, STAGE_CONF):
        df.write.mode("errorifexists").partitionBy(group_col).parquet(staging)
    jvm, fs = _fs(spark, staging)
    out: dict[int, list[str]] = {}
    for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staging)):
        name = str(s.getPath().getName())
        if s.isDirectory() and name.startswith(f"{group_col}="):
            out[int(name.split("=", 1)[1])] = list_parquet(spark, str(s.getPath().toString()))
    return dict(sorted(out.items()))


def land(spark: SparkSession, files: list[str], target_dir: str, prefix: str) -> list[str]:
    """Move files into ``target_dir`` as ``<prefix>-<i>.parquet``."""
    jvm, fs = _fs(spark, target_dir)
    dst = jvm.org.apache.hadoop.fs.Path(target_dir)
    fs.mkdirs(dst)
    out = []
    for i, f in enumerate(files):
        target = jvm.org.apache.hadoop.fs.Path(dst, f"{prefix}-{i:05d}.parquet")
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(f), target):
            raise IOError(f"could not move {f} to {target}")
        out.append(str(target.toString()))
    return out
