"""Deterministic change feeds derived from the driver's tables (FIXTURES.md).

Every fixture is a Spark plan over a driver table, so its size follows the
table's. Bad rows are injected by fixed rules on ids; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_seconds
from tidemark.sources.tables import read_parquet
from tidemark.operators.reduce import latest_per_key, winner_order
from tidemark.spec import COMMIT, FILE_SEQ, KEY, OP, TableSpec

# ---- fixed values: schemas declared by the reference's jobs ---------------
# Trade event, 8 fields (all strings).
TRADE_FIELDS = ["tradeId", "symbol", "quantity", "price", "timestamp", "description", "traderName", "traderFirm"]
TRADE_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in TRADE_FIELDS])

# Order-detail change row (upper-case names as the replication task emits them).
DEC = T.DecimalType(38, 10)
ORDER_DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("LINE_ID", T.IntegerType(), True),
        T.StructField("LINE_NUMBER", T.IntegerType(), True),
        T.StructField("ORDER_ID", T.LongType(), True),     # int in the reference; widened for large scale
        T.StructField("PRODUCT_ID", T.LongType(), True),   # idem
        T.StructField("QUANTITY", T.IntegerType(), True),
        T.StructField("UNIT_PRICE", DEC, True),
        T.StructField("DISCOUNT", DEC, True),
        T.StructField("SUPPLY_COST", DEC, True),
        T.StructField("TAX", DEC, True),
        T.StructField("ORDER_DATE", T.DateType(), True),
    ]
)
# ---------------------------------------------------------------------------

# Bad-row rules of the trade feed (FIXTURES.md).
BAD_TIME_MOD, MALFORMED_MOD, NULL_KEY_MOD = 97, 101, 103
# Arrival batches of the late-data scenario.
ARRIVAL_BATCHES = 5
# Binlog file number of the first commit group: two groups before the rollover to seven digits, two after.
BINLOG_FIRST = 999_998
# Commit groups of the change-log fixture and their instants.
COMMIT_GROUPS = 4
COMMIT_PATTERN = "202401%02d000000000"


def commit_instant(k: int) -> str:
    return COMMIT_PATTERN % (k + 1)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------------- trade feed
def trade_json(events: DataFrame) -> DataFrame:
    """one JSON trade per event (+ event_id, arrival batch); bad rows by rule."""
    eid = F.col("event_id")
    rec = F.to_json(
        F.struct(
            F.when(eid % NULL_KEY_MOD == 0, F.lit(None)).otherwise(eid.cast("string")).alias("tradeId"),
            F.col("event_type").alias("symbol"),
            F.col("value").alias("quantity"),                       # JSON number into a string field
            F.col("value").cast("string").alias("price"),
            F.when(eid % (2 * BAD_TIME_MOD) == 0, (epoch_seconds("ts") * 1000).cast("string"))
            .when(eid % BAD_TIME_MOD == 0, F.lit("abc")).otherwise(epoch_seconds("ts").cast("string")).alias("timestamp"),
            F.col("props").alias("description"),
            F.col("user_id").cast("string").alias("traderName"),
            F.concat(F.col("event_type"), F.lit(" firm")).alias("traderFirm"),
        )
    )
    text = F.when(eid % MALFORMED_MOD == 0, F.substring(rec, 1, 10)).otherwise(rec)
    return events.select(eid, (eid % ARRIVAL_BATCHES).cast("int").alias("arrival"), text.alias("json"))


def trade_feed(spark: SparkSession, sf_dir: str, payload_col: str = "value") -> DataFrame:
    """Byte payloads as a Kafka (``value``) or Kinesis (``data``) source delivers them."""
    j = trade_json(load(spark, sf_dir, "events"))
    return j.select("event_id", "arrival", F.col("json").cast("binary").alias(payload_col))


# ------------------------------------------------------------ CDC envelope
def _op_word(flag):
    return F.when(flag == "R", "delete").when(flag == "A", "insert").otherwise("update")


def order_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3/F4 rows: lineitem (+ part price as supply cost) in the order-detail shape.

    The part join is a plain equi-join: AQE turns it into a broadcast at run
    time only when the measured part side is under the broadcast threshold.
    """
    li = load(spark, sf_dir, "lineitem")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    return j.select(
        F.col("l_linenumber").alias("LINE_ID"),
        F.col("l_linenumber").alias("LINE_NUMBER"),
        F.col("l_orderkey").alias("ORDER_ID"),
        F.col("l_partkey").alias("PRODUCT_ID"),
        F.col("l_quantity").cast("int").alias("QUANTITY"),
        F.col("l_extendedprice").cast(DEC).alias("UNIT_PRICE"),
        F.col("l_discount").cast(DEC).alias("DISCOUNT"),
        F.col("p_retailprice").cast(DEC).alias("SUPPLY_COST"),
        F.col("l_tax").cast(DEC).alias("TAX"),
        F.col("l_shipdate").cast("date").alias("ORDER_DATE"),
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_returnflag") == "A", "I").otherwise("U").alias("Op"),
        (F.col("l_suppkey") % COMMIT_GROUPS).cast("int").alias("commit_group"),
        F.col("l_returnflag"),
    )


def _spoilt(rows: DataFrame, bad: bool) -> tuple[DataFrame, Column, Column]:
    """With ``bad``: null keys by rule, and what tells rows whose text breaks off or whose operation is unknown."""
    k = F.col("ORDER_ID")
    if not bad:
        return rows, F.lit(False), F.lit(False)
    rows = rows.withColumns({"_cut": k % BAD_TIME_MOD == 0, "_odd": k % MALFORMED_MOD == 0})
    return rows.withColumn("ORDER_ID", F.when(k % NULL_KEY_MOD != 0, k)), F.col("_cut"), F.col("_odd")


def cdc_envelopes(spark: SparkSession, sf_dir: str, payload_col: str = "data", bad: bool = False) -> DataFrame:
    """``{data:{...}, metadata:{...}}`` per lineitem row."""
    rows, cut, odd = _spoilt(order_detail_rows(spark, sf_dir), bad)
    data = F.struct(*[F.col(f.name) for f in ORDER_DETAIL_SCHEMA.fields])
    meta = F.create_map(
        F.lit("timestamp"), F.date_format(F.col("ORDER_DATE"), "yyyy-MM-dd'T'00:00:00.000000'Z'"),
        F.lit("record-type"), F.lit("data"),
        F.lit("operation"), F.when(odd, F.lit("truncate")).otherwise(_op_word(F.col("l_returnflag"))),
        F.lit("partition-key-type"), F.lit("schema-table"),
        F.lit("schema-name"), F.lit("shop"),
        F.lit("table-name"), F.lit("order_lines"),
        F.lit("transaction-id"), (F.col("ORDER_ID") * 10 + F.col("LINE_ID")).cast("string"),
    )
    env = F.to_json(F.struct(data.alias("data"), meta.alias("metadata")))
    env = F.when(cut, F.substring(env, 1, 10)).otherwise(env)
    return rows.select(env.cast("binary").alias(payload_col), "commit_group")


def debezium_envelopes(spark: SparkSession, sf_dir: str, bad: bool = False) -> DataFrame:
    """S8 fixture: Debezium-style ``{before, after, op, source}`` per lineitem row.

    op by return flag (A -> c, N -> u, R -> d); binlog file by commit group,
    position from the order key and line number.
    """
    rows, cut, odd = _spoilt(order_detail_rows(spark, sf_dir), bad)
    row = F.struct(*[F.col(f.name) for f in ORDER_DETAIL_SCHEMA.fields])
    op = F.when(odd, "m").when(F.col("l_returnflag") == "R", "d").when(F.col("l_returnflag") == "A", "c").otherwise("u")
    src = F.struct(
        F.format_string("mysql-bin.%06d", F.col("commit_group") + BINLOG_FIRST).alias("file"),
        (F.col("ORDER_ID") * 8 + F.col("LINE_ID")).alias("pos"),
        F.lit(0).cast("long").alias("ts_ms"),
    )
    env = F.to_json(
        F.struct(
            F.when(op != "c", row).alias("before"),
            F.when(op != "d", row).alias("after"),
            op.alias("op"),
            src.alias("source"),
        )
    )
    return rows.select(F.when(cut, F.substring(env, 1, 10)).otherwise(env).alias("value"))


# ------------------------------------------------------------- change log
LINEITEM_TIEBREAK = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def lineitem_spec(**kw) -> TableSpec:
    base = dict(
        keys=("l_orderkey", "l_linenumber"),
        order=("l_shipdate",),
        partitions=("year",),
        key_scope="global",
        merge="arrival",
        deletes="apply",
        tiebreak=LINEITEM_TIEBREAK,
    )
    base.update(kw)
    return TableSpec(**base)


def lineitem_changes(spark: SparkSession, sf_dir: str, group: int | None = None) -> DataFrame:
    """F7 raw change rows: commit group by ``l_suppkey % 4`` (``group``: only these), delete when
    ``l_returnflag = 'R'``, partition ``year`` of the ship date."""
    li = load(spark, sf_dir, "lineitem")
    if group is not None:
        li = li.where(F.col("l_suppkey") % COMMIT_GROUPS == group)
    return li.select(
        F.format_string(COMMIT_PATTERN, (F.col("l_suppkey") % COMMIT_GROUPS) + 1).alias(COMMIT),
        F.when(F.col("l_returnflag") == "R", "D").otherwise("U").alias(OP),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("#"), F.col("l_linenumber").cast("string")).alias(KEY),
        F.lit(0).alias(FILE_SEQ),
        F.year("l_shipdate").cast("string").alias("year"),
        *LINEITEM_COLUMNS,
    )


def lineitem_log(spark: SparkSession, sf_dir: str, spec: TableSpec | None = None) -> DataFrame:
    """F7 as the writer leaves it: precombined per (commit, key)."""
    spec = spec or lineitem_spec()
    raw = lineitem_changes(spark, sf_dir)
    return latest_per_key(raw, [COMMIT, *spec.key_columns], winner_order(raw, spec, within_batch=True))


# ------------------------------------------------------ replicated trades
def trades_full(orders: DataFrame) -> DataFrame:
    """F6 full load: one row per order, no ``Op`` column."""
    return orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dms_received_ts"),
        F.col("o_orderkey").cast("string").alias("tradeid"),
        F.col("o_custkey").cast("string").alias("customerid"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
        F.col("o_orderdate").alias("update_timestamp"),
        F.col("o_orderstatus").alias("updated_by"),
    )


def trades_cdc(orders: DataFrame) -> DataFrame:
    """F6 changes: a second version for ``o_orderkey % 3 = 0`` (one day
    later), a delete for ``o_orderkey % 7 = 0`` (two days later)."""
    full = trades_full(orders).withColumn("_k", F.col("tradeid").cast("long"))
    day = F.expr("INTERVAL 1 DAY")
    upd = full.where(F.col("_k") % 3 == 0).select(
        F.date_format(F.col("update_timestamp") + day, "yyyy-MM-dd HH:mm:ss").alias("dms_received_ts"),
        "tradeid", "customerid", "symbol",
        (F.col("price") + F.lit(1.0)).alias("price"),
        F.lit(2.0).alias("quantity"),
        (F.col("update_timestamp") + day).alias("update_timestamp"),
        F.lit("cdc").alias("updated_by"),
        F.lit("U").alias("Op"),
    )
    dele = full.where(F.col("_k") % 7 == 0).select(
        F.date_format(F.col("update_timestamp") + day + day, "yyyy-MM-dd HH:mm:ss").alias("dms_received_ts"),
        "tradeid", "customerid", "symbol", "price", "quantity",
        (F.col("update_timestamp") + day + day).alias("update_timestamp"),
        F.lit("cdc").alias("updated_by"),
        F.lit("D").alias("Op"),
    )
    return upd.unionByName(dele)


def trades_spec(**kw) -> TableSpec:
    base = dict(keys=("tradeid",), order=("dms_received_ts",), partitions=("symbol",), deletes="apply",
                tiebreak=("customerid", "price", "quantity", "update_timestamp", "updated_by"))
    base.update(kw)
    return TableSpec(**base)


# ---------------------------------------------------------------- file helpers
def write_named_files(df: DataFrame, directory: str, staging: str, name_fmt: str) -> list[str]:
    """Write ``df`` as Parquet files named by ``name_fmt % i`` (as a
    replication task names them, e.g. ``LOAD%08d.parquet``), by as many tasks
    as the data has splits.

    Spark names its part files itself, so the files are written to a
    staging folder and renamed with the Hadoop file system API.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(staging)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(staging)
    fs = src.getFileSystem(conf)
    dst_dir = jvm.org.apache.hadoop.fs.Path(directory)
    fs.mkdirs(dst_dir)
    parts = sorted(
        str(s.getPath().getName()) for s in fs.listStatus(src) if str(s.getPath().getName()).endswith(".parquet")
    )
    out = []
    for i, name in enumerate(parts):
        target = jvm.org.apache.hadoop.fs.Path(dst_dir, name_fmt % (i + 1))
        fs.rename(jvm.org.apache.hadoop.fs.Path(src, name), target)
        out.append(str(target.toString()))
    return out
