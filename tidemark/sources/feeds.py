"""Change-feed sources and decoders.

Decoding is ``from_json`` with an explicit schema: JVM-side, per row, no
Python in the hot path. The parsed struct is expanded with
``inline(array(struct))``: a generator, so filters on decoded fields (key
not null, time not null) stay above it instead of being pushed below the
projection, where Catalyst would inline -- and so re-run -- ``from_json``
once per predicate.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import merged, shaped_columns

CORRUPT = "_corrupt_record"

# Start positions a feed accepts, mapped to the option each source reads.
_START_OPTION = {"kafka": "startingOffsets", "kinesis": "startingposition"}
_START_VALUES = {
    "kafka": {"earliest": "earliest", "latest": "latest", "trim_horizon": "earliest"},
    "kinesis": {"earliest": "TRIM_HORIZON", "trim_horizon": "TRIM_HORIZON", "latest": "LATEST"},
}


def start_options(fmt: str, starting: str | None) -> dict:
    """S3: the source's own option for a start position; none for sources without one."""
    if starting is None or fmt not in _START_OPTION:
        return {}
    known = _START_VALUES[fmt]
    if starting.lower() not in known:
        raise ValueError(f"start position {starting!r} of {fmt} must be one of {sorted(known)}")
    return {_START_OPTION[fmt]: known[starting.lower()]}


def read_feed(
    spark: SparkSession,
    fmt: str,
    options: dict | None = None,
    starting: str | None = None,
    schema: T.StructType | str | None = None,
    path: str | None = None,
) -> DataFrame:
    """A streaming DataFrame of raw payloads.

    ``fmt`` is any streaming source (``kafka``, ``kinesis`` when the connector
    is on the classpath, or a file format). ``starting`` is ``earliest`` /
    ``latest`` / ``trim_horizon`` and is mapped to the source's own option.
    """
    r = spark.readStream.format(fmt)
    opts = dict(options or {})
    opts |= start_options(fmt, starting)
    if schema is not None:
        r = r.schema(schema)
    r = r.options(**opts)
    try:
        return r.load(path) if path else r.load()
    except Exception as e:  # noqa: BLE001 - re-raised with a clearer message
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find" in str(e):
            raise RuntimeError(
                f"streaming source '{fmt}' is not on the classpath: add its connector package "
                f"(for Kafka, spark-sql-kafka-0-10) or read the payloads from a file source"
            ) from e
        raise


def _payload(df: DataFrame, payload_col: str):
    return F.col(payload_col).cast("string")


def decode_feed(
    df: DataFrame,
    payload_col: str,
    schema: T.StructType,
    keep_corrupt: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """P1+P2: payload bytes -> text -> flat JSON record ``j.*``.

    Missing fields are null; JSON numbers in string fields keep their text.
    Unparseable text gives an all-null row plus the raw text in
    ``_corrupt_record`` (Q1), so rejects can say why.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    j = F.from_json(_payload(df, payload_col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a null payload gives a null struct; keep the row (all fields null) like Kafka/Kinesis decoding does
    j = F.coalesce(j, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields]))
    out = df.select(*[F.col(k) for k in keep], F.inline(F.array(j)))
    return out if keep_corrupt else out.drop(CORRUPT)


def _envelope(df: DataFrame, payload_col: str, env: T.StructType):
    """The parsed payload; a null one gives null fields, a broken one its text."""
    full = T.StructType([*env.fields, T.StructField(CORRUPT, T.StringType(), True)])
    j = F.from_json(_payload(df, payload_col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return F.coalesce(j, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields]))


def decode_envelope(
    df: DataFrame,
    payload_col: str,
    row_schema: T.StructType,
    data_field: str = "data",
    meta_field: str = "metadata",
    op_key: str = "operation",
    keep_metadata: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """``{data:{...}, metadata:{...}}`` -> ``data.*`` plus the operation.

    ``metadata`` is a ``map<string,string>`` (numbers inside it come back as
    text). With ``keep_corrupt`` unparseable text is kept in
    ``_corrupt_record``, so that rejects can say why (Q1).
    """
    env = T.StructType(
        [
            T.StructField(data_field, row_schema, True),
            T.StructField(meta_field, T.MapType(T.StringType(), T.StringType()), True),
        ]
    )
    j = _envelope(df, payload_col, env)
    cols = [F.col(f"{data_field}.{f.name}").alias(f.name) for f in row_schema.fields]
    cols.append(F.col(meta_field).getItem(op_key).alias(op_key))
    if keep_metadata:
        cols.append(F.col(meta_field))
    if keep_corrupt:
        cols.append(F.col(CORRUPT))
    return df.select(F.inline(F.array(j))).select(*cols)


# Debezium op codes -> change-log ops (c=create, r=snapshot read, u=update, d=delete).
DEBEZIUM_OPS = {"c": "I", "r": "I", "u": "U", "d": "D"}


def flatten_debezium(
    df: DataFrame,
    payload_col: str,
    row_schema: T.StructType,
    source_fields: T.StructType | None = None,
    op_name: str = "Op",
    keep_corrupt: bool = False,
) -> DataFrame:
    """``{before, after, op, source}`` -> one flat row per change.

    The row is the whole ``before`` struct for deletes and the whole ``after``
    struct otherwise (a per-field coalesce would refill nulls of ``after``).
    An op without a counterpart keeps its own text, which the writer counts as
    a reject. ``binlog_seq`` is the number in the binlog's file name: names
    roll over from 999999 to 1000000, so they do not order as text (W6).
    """
    source_fields = source_fields or T.StructType(
        [
            T.StructField("file", T.StringType(), True),
            T.StructField("pos", T.LongType(), True),
            T.StructField("ts_ms", T.LongType(), True),
        ]
    )
    env = T.StructType(
        [
            T.StructField("before", row_schema, True),
            T.StructField("after", row_schema, True),
            T.StructField("op", T.StringType(), True),
            T.StructField("source", source_fields, True),
        ]
    )
    j = _envelope(df, payload_col, env)
    op = F.col("op")
    row = F.when(op == "d", F.col("before")).otherwise(F.col("after"))
    mapped = None
    for k, v in DEBEZIUM_OPS.items():
        mapped = F.when(op == k, F.lit(v)) if mapped is None else mapped.when(op == k, F.lit(v))
    file = F.col("_source.file")
    return (
        df.select(F.inline(F.array(j)))
        .select(row.alias("r"), mapped.otherwise(op).alias(op_name), F.col("source").alias("_source"), CORRUPT)
        .select("r.*", op_name, file.alias("binlog_file"), F.regexp_extract(file, r"(\d+)$", 1).try_cast("bigint").alias("binlog_seq"),
                F.col("_source.pos").alias("binlog_pos"), *([CORRUPT] if keep_corrupt else []))
    )


def from_json_lines(df: DataFrame, col: str, alias: str = "j") -> DataFrame:
    """JSON text -> struct with an inferred schema.

    The schema is Spark's own inference over every row, on the executors'
    JVMs, so no field is missed; only the schema reaches the driver.
    """
    spark = df.sparkSession
    texts = df.select(F.col(col).cast("string").alias("value")).where("value is not null")
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    schema = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(strings).schema().json()))
    schema = T.StructType([f for f in schema.fields if f.name != CORRUPT])
    return df.withColumn(alias, F.from_json(F.col(col).cast("string"), schema))


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Parquet files in groups that one schema fits, each with it.

    Spark reads the footers of a group at once, in parallel, and merges them; a
    group whose columns have different types is halved until it has one.
    """
    try:
        return [(paths, spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as e:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    half = len(paths) // 2
    return schema_groups(spark, paths[:half]) + schema_groups(spark, paths[half:])


def read_change_files(
    spark: SparkSession,
    paths,
    schema: T.StructType | str | None = None,
    with_path: bool = False,
) -> DataFrame:
    """The Parquet files a notice names.

    With a schema one read for all. Without one every file counts with its own: a column
    that some files lack is null there, and types widen as between commits
    (``schemas.merged``; a change that would lose values is refused).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is not None:
        groups, target = [(paths, schema)], None
    else:
        groups, target = schema_groups(spark, paths), None
        for _, found in groups:
            target = merged(target, found)
    out = None
    for names, found in groups:
        df = spark.read.schema(found).parquet(*names)
        columns = [F.col(f"`{c}`") for c in df.columns] if target is None else shaped_columns(df, target)
        if with_path:
            columns.append(F.col("_metadata.file_path").alias("_source_file"))
        df = df.select(*columns)
        out = df if out is None else out.unionByName(df)
    return out


def full_load_files(spark: SparkSession, directory: str, schema=None, glob: str = "LOAD*.parquet") -> DataFrame:
    """Only the full-load files of a replication folder."""
    r = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(directory)


def cdc_files(spark: SparkSession, directory: str, schema=None, prefix: str = "LOAD") -> DataFrame:
    """Everything but the full-load files (filter on ``_metadata.file_name``)."""
    r = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(directory)
    return df.filter(~F.col("_metadata.file_name").startswith(prefix))


def stream_change_dir(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | str,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """New files of a folder as a stream (one-shot with ``availableNow``
    or continuous with ``processingTime``); the checkpoint remembers files seen."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(directory)


def stream_cdc_files(spark: SparkSession, directory: str, schema: T.StructType | str, prefix: str = "LOAD", **options) -> DataFrame:
    """S6 as a stream: every file of the folder but the full-load ones, whatever their names."""
    files = stream_change_dir(spark, directory, schema, **options)
    return files.filter(~F.col("_metadata.file_name").startswith(prefix))
