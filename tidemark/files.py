"""Small files through the Hadoop file system API: table metadata, not data.

Works on any file system Spark can write to. A file appears under its final
name only when it is complete.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def fs_of(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = fs_of(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str, prefix: str | None = None) -> list[str]:
    """Names in a folder, sorted; a missing folder is empty. Hidden ones (a dot
    or an underscore first) are left out unless a prefix asks for them."""
    _, p, fs = fs_of(spark, folder)
    if not fs.exists(p):
        return []
    found = (str(s.getPath().getName()) for s in fs.listStatus(p))
    return sorted(n for n in found if (n.startswith(prefix) if prefix else not n.startswith((".", "_"))))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write and rename; an existing file is replaced."""
    jvm, p, fs = fs_of(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not rename {tmp} to {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    jvm, p, fs = fs_of(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _, p, fs = fs_of(spark, path)
    fs.delete(p, True)
