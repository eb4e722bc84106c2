"""Driver queries of the on-disk table: retention, keys, buckets, the catalog, offsets and files of several schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import chain as T
from tidemark.functions import columns as C
from tidemark.operators.table import ChangeTable
from tidemark.plans import catalog_batch as B
from tidemark.plans import catalog_files as CF
from tidemark.plans import fixtures as FX
from tidemark.plans import oracle_sql as Q
from tidemark.plans.registry import query
from tidemark.plans.staging import list_parquet
from tidemark.session import scratch_dir
from tidemark.sources import feeds as S
from tidemark.sources.log_stream import stream_log
from tidemark.spec import COMMIT, KEY, TableSpec
from tidemark.streaming import sinks as W

EVENT_ORDER = f"l_shipdate DESC NULLS LAST, _commit_time DESC, {Q.LI_TIEBREAK}"


# ------------------------------------------------------------------ retention
@query("savepoint_trimmed", Q.li_snapshot(where=f"_commit_time <= '{B.C1}'"))
def savepoint_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    """A pinned commit is read after two expiries that keep no row of expired commits for listings."""
    table = CF._lineitem_table(spark, sf, "savepoint_trimmed", history=0)
    table.pin(B.C1)
    table.expire(retain=1)
    table.upsert(table.snapshot().where("l_linenumber = 1").select(*FX.LINEITEM_COLUMNS, "year"))
    table.expire(retain=1)
    for gone in (B.C0, B.C2):
        try:
            table.as_of(gone)
        except ValueError:
            continue
        raise AssertionError(f"the expired commit {gone} was read")
    return table.as_of(B.C1).select(*B.LI_OUT)


@query("replace_then_expire", Q.li_snapshot(where=f"_commit_time >= '{B.C1}'"))
def replace_then_expire(spark: SparkSession, sf: str) -> DataFrame:
    """What a replace made void stays so after its commit has expired."""
    root = scratch_dir(spark, "replace_then_expire")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec(history=0))
    for k in range(FX.COMMIT_GROUPS):
        t = FX.commit_instant(k)
        table.upsert(FX.lineitem_changes(spark, sf, group=k).drop(COMMIT), commit_time=t, prepared=True, replace=k == 1)
    table.expire(retain=1)
    return table.snapshot().select(*B.LI_OUT)


@query(
    "expire_segments",
    f"SELECT 'pinned' AS state, * FROM ({Q.li_snapshot(where=f'_commit_time <= {chr(39)}{B.C1}{chr(39)}')}) a"
    f" UNION ALL SELECT 'now', * FROM ({Q.li_snapshot()}) b",
)
def expire_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Expiry after every commit; each adds a segment or joins the last ones, and no readable state changes."""
    root = scratch_dir(spark, "expire_segments")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec(history=0))

    def retain(k: int) -> None:
        if k == 1:
            table.pin(B.C1)
        table.expire(retain=1, commit_time=f"2024010{k + 1}120000000")

    CF._commit_changes(spark, sf, table, retain)
    named = lambda name, df: df.select(F.lit(name).alias("state"), *B.LI_OUT)
    return named("pinned", table.as_of(B.C1)).unionByName(named("now", table.snapshot()))


# ----------------------------------------------------------------------- keys
PARTS = """CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR || '#' || event_type ELSE user_id::VARCHAR END AS a,
           CASE WHEN event_id % 2 = 0 THEN 'x' ELSE event_type || '#x' END AS b"""


@query(
    "record_key_escaped",
    f"""SELECT a, b, event_id, replace(replace(a, '\\', '\\\\'), '#', '\\#') || '#' || replace(replace(b, '\\', '\\\\'), '#', '\\#') AS record_key
        FROM (SELECT event_id, {PARTS} FROM events) e
        QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY event_id DESC) = 1""",
)
def record_key_escaped(spark: SparkSession, sf: str) -> DataFrame:
    """Composite keys whose parts hold the separator: ('u#t', 'x') and ('u', 't#x') stay two rows."""
    root = scratch_dir(spark, "record_key_escaped")
    even = F.col("event_id") % 2 == 0
    user = F.col("user_id").cast("string")
    rows = FX.load(spark, sf, "events").select(
        "event_id",
        F.when(even, F.concat_ws("#", user, "event_type")).otherwise(user).alias("a"),
        F.when(even, F.lit("x")).otherwise(F.concat(F.col("event_type"), F.lit("#x"))).alias("b"),
    )
    table = ChangeTable(spark, f"{root}/table", TableSpec(keys=("a", "b"), order=("event_id",), merge="event_time"))
    for k in (1, 0):
        table.upsert(rows.where(F.floor(F.col("event_id") / 2) % 2 == k))
    return C.with_record_key(table.snapshot(), ["a", "b"]).select("a", "b", "event_id", "record_key")


# -------------------------------------------------------------------- buckets
@query("upsert_buckets", Q.li_snapshot())
def upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """A table in key buckets: a base after the second commit, then two commits, the same state and counts."""
    root = scratch_dir(spark, "upsert_buckets")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec(buckets=4))
    CF._commit_changes(spark, sf, table, lambda k: table.compact(f"2024010{k + 1}120000000") if k == 1 else None)
    return table.snapshot().select(*B.LI_OUT)


@query("show_commits_buckets", B.SHOW_COMMITS_SQL)
def show_commits_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Inserts and updates told apart by base and newer commits, without older history."""
    root = scratch_dir(spark, "show_commits_buckets")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec(buckets=4))
    CF._commit_changes(spark, sf, table, lambda k: table.compact(f"2024010{k + 1}120000000") if k in (0, 1) else None)
    return table.show_commits()


@query(
    "incremental_event_time_table",
    f"SELECT * FROM ({Q.li_snapshot(where=f'_commit_time <= {chr(39)}{B.C2}{chr(39)}', order=EVENT_ORDER)}) s WHERE _commit_time > '{B.C0}'",
)
def incremental_event_time_table(spark: SparkSession, sf: str) -> DataFrame:
    """Changes where the highest ordering value wins; the state before the range is a base."""
    root = scratch_dir(spark, "incremental_event_time_table")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec(merge="event_time"))
    CF._commit_changes(spark, sf, table, lambda k: table.compact(f"2024010{k + 1}120000000") if k == 0 else None)
    return table.incremental("20240101120000000", B.C2).select(*B.LI_OUT)


# -------------------------------------------------------------------- catalog
@query("catalog_follows_commits", Q.li_snapshot(where=f"_commit_time <= '{B.C2}'"))
def catalog_follows_commits(spark: SparkSession, sf: str) -> DataFrame:
    """A name registered once shows what later commits wrote."""
    root = scratch_dir(spark, "catalog_follows_commits")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec())
    name = f"lineitem_{uuid.uuid4().hex[:8]}"
    for k in range(3):
        t = FX.commit_instant(k)
        table.upsert(FX.lineitem_changes(spark, sf, group=k).drop(COMMIT), commit_time=t, prepared=True)
        if k == 0:
            table.register(name)
    return spark.sql(f"SELECT {', '.join(B.LI_OUT)} FROM {name}")


# -------------------------------------------------------------------- offsets
@query(
    "feed_offsets",
    f"""WITH log AS (SELECT _commit_time, _record_key FROM ({Q.LI_LOG}) l)
        SELECT 'earliest' AS start, * FROM log WHERE _commit_time <= '{B.C2}'
        UNION ALL SELECT 'given' AS start, * FROM log WHERE _commit_time > '{B.C0}' AND _commit_time <= '{B.C2}'
        UNION ALL SELECT 'latest' AS start, * FROM log WHERE _commit_time > '{B.C1}' AND _commit_time <= '{B.C2}'""",
)
def feed_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """The log as a stream with offsets, from the earliest, a given and the latest one; every
    query is stopped after two commits and resumed after the third."""
    root = scratch_dir(spark, "feed_offsets")
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec())
    starts = {"earliest": "earliest", "given": B.C0, "latest": "latest"}

    def commit(k: int) -> None:
        t = FX.commit_instant(k)
        table.upsert(FX.lineitem_changes(spark, sf, group=k).drop(COMMIT), commit_time=t, prepared=True)

    def run() -> None:
        for name, start in starts.items():
            rows = stream_log(spark, table.path, start).select(COMMIT, KEY)
            CF._run(W.append_stream(rows, f"{root}/out/{name}", [], f"{root}/checkpoint/{name}", trigger=CF.ONCE))

    commit(0)
    commit(1)
    run()
    commit(2)
    run()
    out = [spark.read.schema(f"{COMMIT} string, {KEY} string").parquet(f"{root}/out/{n}").select(F.lit(n).alias("start"), COMMIT, KEY) for n in starts]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --------------------------------------------------------- files of many schemas
@query(
    "notice_schemas",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey + 10000000000 ELSE CAST(o_custkey AS BIGINT) END AS n,
              CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 <> 2 THEN o_totalprice END AS price
       FROM orders""",
)
def notice_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """One batch of notices whose files have another column, a wider type and a column less, read without a schema."""
    root = scratch_dir(spark, "notice_schemas")
    o = FX.load(spark, sf, "orders").withColumn("id", F.col("o_orderkey"))
    price, narrow = F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("int").alias("n")
    kinds = [o.where("id % 3 = 0").select("id", narrow, price), o.where("id % 3 = 2").select("id", narrow),
             o.where("id % 3 = 1").select("id", (F.col("o_custkey") + F.lit(10_000_000_000)).alias("n"), F.col("o_orderstatus").alias("status"), price)]
    paths = []
    for k, df in enumerate(kinds):
        df.write.parquet(f"{root}/files/{k}")
        paths += list_parquet(spark, f"{root}/files/{k}")
    notices = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "filePath string, seq long")
    notices.coalesce(1).write.json(f"{root}/notices")
    table = ChangeTable(spark, f"{root}/table", TableSpec(keys=("id",), order=("id",)))
    stream = spark.readStream.schema("filePath string, seq long").json(f"{root}/notices")
    CF._run(W.ingest_notices(stream, table, f"{root}/checkpoint", f"schemas-{uuid.uuid4().hex[:8]}", prepare=lambda b: b, seq_col="seq", trigger=CF.ONCE))
    return table.snapshot().select("id", "n", "status", "price")


# ---------------------------------------------------------------- transformers
@query(
    "transformer_chain",
    f"""SELECT tradeid, symbol, CAST(price * quantity AS DOUBLE) AS notional, updated_by FROM ({Q.TRADES_FINAL}) f""",
)
def transformer_chain(spark: SparkSession, sf: str) -> DataFrame:
    """The full load and the change stream through one declared chain: SQL text,
    an ``Op`` column, the target's schema. Input and output are checked before the stream starts."""
    root = scratch_dir(spark, "transformer_chain")
    d = CF.stage_replication(spark, sf, root)
    full_schema, cdc_schema = CF._full_schema(spark), CF._cdc_schema(spark)
    target = spark.createDataFrame([], "tradeid string, symbol string, notional double, updated_by string, dms_received_ts string, Op string").schema
    columns = "tradeid, symbol, price * quantity AS notional, updated_by, dms_received_ts"
    full = T.Chain(T.sql(f"SELECT {columns} FROM <SRC>"), T.ensure_op(), T.conform(target), source=full_schema, target=target)
    cdc = T.Chain(T.sql(f"SELECT {columns}, Op FROM <SRC>"), T.ensure_op(), T.conform(target), source=cdc_schema, target=target)
    table = ChangeTable(spark, f"{root}/table", FX.trades_spec())
    table.upsert(full(S.full_load_files(spark, d, full_schema)), op_col="Op")
    stream = S.stream_cdc_files(spark, d, cdc_schema)
    CF._run(W.upsert_stream(stream, table, f"{root}/checkpoint", f"chain-{uuid.uuid4().hex[:8]}", trigger=CF.ONCE, op_col="Op", prepare=cdc))
    return table.snapshot().select("tradeid", "symbol", "notional", "updated_by")


# ---------------------------------------------------------------- sizes
@query(
    "output_sizing",
    f"""SELECT year, count(*) AS n, TRUE AS within_cap, TRUE AS apart
        FROM ({Q.li_snapshot(deletes=False)}) s GROUP BY year""",
)
def output_sizing(spark: SparkSession, sf: str) -> DataFrame:
    """A clustered base: no file above the cap of rows, and the files of a partition value hold
    ranges of the record key that do not overlap, so a read of one key needs one file."""
    root = scratch_dir(spark, "output_sizing")
    cap = 2000
    table = ChangeTable(spark, f"{root}/table", FX.lineitem_spec(clustered=True, target_rows_per_file=cap, deletes="ignore"))
    CF._commit_changes(spark, sf, table)
    table.compact()
    each = table.snapshot().groupBy("year", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min(KEY).alias("low"), F.max(KEY).alias("high"))
    before = F.lag("high").over(Window.partitionBy("year").orderBy("low", "high"))
    each = each.withColumn("apart", F.coalesce(F.col("low") > before, F.lit(True)))
    return each.groupBy("year").agg(F.sum("n").alias("n"), F.every(F.col("n") <= cap).alias("within_cap"), F.every("apart").alias("apart"))


# ---------------------------------------------------------------- commit positions
@query("commit_positions_table", f"SELECT 'oldest after the first' AS position, '{B.C1}' AS commit_time UNION ALL SELECT 'second from the end', '{B.C2}'")
def commit_positions_table(spark: SparkSession, sf: str) -> DataFrame:
    """R5 on disk, from the commit rows: the oldest after an instant and the n-th from the end; expiry changes neither."""
    table = CF._lineitem_table(spark, sf, "commit_positions_table")
    table.expire(retain=1)
    named = lambda name, df: df.select(F.lit(name).alias("position"), "commit_time")
    return named("oldest after the first", table.commit_min_recent(B.C0)).unionByName(named("second from the end", table.commit_nth_last(2)))
