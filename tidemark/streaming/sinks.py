"""Structured Streaming writers.

Streams never keep state of their own: late events simply land in the
partition of their event time (C8), and each micro-batch becomes one commit
through ``foreachBatch``. Exactly-once comes from the checkpoint plus the
table's idempotent (query, batch) commits. The query's identity is the one
Spark keeps in the checkpoint, so a reused name with a fresh checkpoint is a
new query and a renamed query with its old checkpoint is the same one.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark import files
from tidemark.functions.columns import normalize_path, split_rejects
from tidemark.functions.chain import Chain
from tidemark.operators.table import ChangeTable
from tidemark.sources.feeds import read_change_files


def query_id(spark, checkpoint: str) -> str:
    """The id that Spark wrote into the checkpoint before the first batch."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def _apply_trigger(w, trigger):
    """``trigger`` = {"processingTime": "3 minutes"} | {"availableNow": True} | {"once": True}."""
    if not trigger:
        return w
    return w.trigger(**trigger)


def upsert_stream(
    df: DataFrame,
    table: ChangeTable,
    checkpoint: str,
    query_name: str,
    trigger: dict | None = None,
    op_col: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
):
    """Micro-batch upserts; one commit per batch, named by the checkpoint's
    query id and the batch. A batch without good rows is a commit without rows.
    A ``Chain`` as ``prepare`` is checked against the stream's schema before it starts."""
    if isinstance(prepare, Chain):
        prepare.check(table.spark, df.schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        b = prepare(batch) if prepare else batch
        table.upsert(b, op_col=op_col, query_id=query_id(table.spark, checkpoint), batch_id=batch_id)

    w = df.writeStream.queryName(query_name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _apply_trigger(w, trigger).start()


def upsert_with_rejects(
    df: DataFrame,
    table: ChangeTable,
    rejects_path: str,
    checkpoint: str,
    query_name: str,
    key: str,
    time_col: str | None,
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
):
    """One query, input read once per batch; good rows are upserted,
    rejects appended with their reason under ``_batch_id=<n>`` (a replay
    overwrites its own folder, so rejects are not duplicated)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_rejects(batch, key=key, time_col=time_col)
            (
                bad.withColumn("_batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("_batch_id")
                .parquet(rejects_path)
            )
            g = prepare(good) if prepare else good
            table.upsert(g, query_id=query_id(table.spark, checkpoint), batch_id=batch_id)
        finally:
            batch.unpersist()

    w = df.writeStream.queryName(query_name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _apply_trigger(w, trigger).start()


def append_stream(
    df: DataFrame,
    path: str,
    partitions,
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str | None = None,
):
    """Append-only partitioned Parquet sink, no dedup; the file sink's
    own log makes it exactly-once. There is no shuffle: every input task writes
    what it read, so the current hour of a feed is written by all of them."""
    w = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partitions)
        .outputMode("append")
    )
    if query_name:
        w = w.queryName(query_name)
    return _apply_trigger(w, trigger).start()


def notice_batch(
    batch: DataFrame,
    path_col: str = "filePath",
    seq_col: str | None = None,
    schema=None,
) -> DataFrame:
    """W12 core: the rows of the files named in one batch of notices, with
    ``_file_seq`` = position of the file in the batch (Q8).

    Only the paths of this batch reach the driver (bounded by the trigger's
    maxFilesPerTrigger / maxOffsetsPerTrigger); the files are read in one
    multi-path scan, or one for each schema where none is given, and tagged by a join on the normalised path.
    """
    spark = batch.sparkSession
    seq = F.col(seq_col) if seq_col else F.monotonically_increasing_id()
    # a file that is named again counts at its last position
    named = batch.where(F.col(path_col).isNotNull()).select(F.col(path_col).alias("_p"), seq.alias("_seq"))
    rows = named.groupBy("_p").agg(F.max("_seq").alias("_seq")).orderBy("_seq", "_p").collect()
    if not rows:
        return None
    data = read_change_files(spark, [r["_p"] for r in rows], schema=schema, with_path=True)
    data = data.withColumn("_src", normalize_path(F.col("_source_file"))).drop("_source_file")
    seq = spark.createDataFrame([(r["_p"], i) for i, r in enumerate(rows)], "_p string, _file_seq int").select(
        normalize_path(F.col("_p")).alias("_src"), "_file_seq"
    ).groupBy("_src").agg(F.max("_file_seq").alias("_file_seq"))
    # a file whose path does not match its notice must fail the batch, not vanish
    checked = F.when(
        F.col("_file_seq").isNull(), F.raise_error(F.concat(F.lit("no notice matches file "), F.col("_src")))
    ).otherwise(F.col("_file_seq"))
    return data.join(seq, on="_src", how="left").withColumn("_file_seq", checked.cast("int")).drop("_src")


def ingest_notices(
    notices: DataFrame,
    table: ChangeTable,
    checkpoint: str,
    query_name: str,
    prepare: Callable[[DataFrame], DataFrame],
    path_col: str = "filePath",
    seq_col: str | None = None,
    schema=None,
    trigger: dict | None = None,
):
    """Notice stream -> files -> one upsert per micro-batch.

    ``prepare`` normalises the file rows (drop ``Op``, lower-case, key,
    date, partitions); the winner inside the batch is the highest
    ``(file_seq, order)``, as if each file had been its own commit.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = notice_batch(batch, path_col=path_col, seq_col=seq_col, schema=schema)
        if rows is None:
            return
        prepared = prepare(rows)
        table.upsert(prepared, file_seq=F.col("_file_seq"), query_id=query_id(table.spark, checkpoint), batch_id=batch_id)

    w = notices.writeStream.queryName(query_name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _apply_trigger(w, trigger).start()
