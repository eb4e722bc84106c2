"""Session and scratch-location helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job built on this library expects. Nothing here fixes a
# partition count: AQE sizes shuffles at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one (a bare test) gets a folder under the system's
    temp dir; on a cluster that would be a different disk on every machine, so
    there it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
            d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


# Hive-partitioned writes pay per file. For small commits AQE would merge the
# rebalance shuffle into one task that writes every partition folder in turn;
# a smaller minimum lets it keep enough tasks to write folders in parallel.
# Large commits are governed by the advisory size and are unaffected.
WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}

# Runtime re-planning for log writes: coalesce small partitions and split
# skewed ones of the REBALANCE shuffle.
AQE_WRITE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


@contextmanager
def scoped_conf(spark: SparkSession, conf: dict):
    """Set runtime SQL confs for the duration of one write, then restore them.

    They are session-wide: one writer at a time per session (a stream's
    ``foreachBatch`` has a session of its own)."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
