"""Driver queries that are pure DataFrame plans over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.instants import commit_cutoff_col, max_commit
from tidemark.operators import reduce as R
from tidemark.operators import timeline as TL
from tidemark.plans import fixtures as FX
from tidemark.plans import oracle_sql as Q
from tidemark.plans.registry import query
from tidemark.sources import feeds as S
from tidemark.sources.avro_schema import schema_from_avsc
from tidemark.spec import COMMIT, KEY, OP, TableSpec

C0, C1, C2, C3 = (FX.commit_instant(k) for k in range(4))
LI_OUT = [COMMIT, OP, KEY, "year", *FX.LINEITEM_COLUMNS]


# ------------------------------------------------------------ trade feed path
def decoded_trades(spark: SparkSession, sf: str, payload_col: str = "value") -> DataFrame:
    """P1+P2+P5: payload -> JSON record -> lower-case names."""
    feed = FX.trade_feed(spark, sf, payload_col)
    return C.lower_columns(S.decode_feed(feed, payload_col, FX.TRADE_SCHEMA))


def normalised_trades(spark: SparkSession, sf: str, null_time: str = "drop") -> DataFrame:
    """Key not null, record_key, trade_datetime, month/day/hour."""
    df = C.require(decoded_trades(spark, sf), "tradeid").drop("_corrupt_record")
    df = C.with_record_key(df, "tradeid")
    df = C.with_event_time(df, "timestamp", "trade_datetime")
    if null_time == "drop":
        df = C.require(df, "trade_datetime")
    return C.with_time_parts(df, "trade_datetime", ("month", "day", "hour"))


TRADE_OUT = ["tradeid", "symbol", "quantity", "price", "timestamp", "description", "tradername", "traderfirm"]


@query(
    "entry_latest_per_trader",
    f"""SELECT tradeid, symbol, price, tradername, trade_datetime FROM (
          SELECT {Q.TRADE_COLS}, {Q.TRADE_TIME_COLS}, ts, event_id FROM events
          WHERE {Q.GOOD_KEY} AND {Q.GOOD_TIME}) t
        QUALIFY row_number() OVER (PARTITION BY tradername ORDER BY trade_datetime DESC NULLS LAST,
                                   tradeid DESC NULLS LAST) = 1""",
)
def entry_latest_per_trader(spark: SparkSession, sf: str) -> DataFrame:
    """Step-1 slice: events -> JSON -> decode -> normalise -> newest trade per trader."""
    spec = TableSpec(keys=("tradername",), order=("trade_datetime",), tiebreak=("tradeid",))
    out = R.precombine(normalised_trades(spark, sf), spec)
    return out.select("tradeid", "symbol", "price", "tradername", "trade_datetime")


@query(
    "feed_payload_col",
    f"""SELECT
          CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS tradeId,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type END AS symbol,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS quantity,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS price,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE {Q.TS_TEXT} END AS timestamp,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE props END AS description,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS traderName,
          CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type || ' firm' END AS traderFirm
        FROM events""",
)
def feed_payload_col(spark: SparkSession, sf: str) -> DataFrame:
    """A Kinesis-style feed whose payload column is ``data``."""
    feed = FX.trade_feed(spark, sf, "data")
    return S.decode_feed(feed, "data", FX.TRADE_SCHEMA, keep_corrupt=False)


@query("trade_decode", f"SELECT {Q.TRADE_COLS} FROM events WHERE {Q.GOOD_KEY}")
def trade_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Decode, lower-case, key not null."""
    return C.require(decoded_trades(spark, sf), "tradeid").select(*TRADE_OUT)


@query(
    "trade_normalise",
    f"SELECT {Q.TRADE_COLS}, CAST(event_id AS VARCHAR) AS record_key, {Q.TRADE_TIME_COLS} "
    f"FROM events WHERE {Q.GOOD_KEY} AND {Q.GOOD_TIME}",
)
def trade_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """Record key, event time text, time parts; bad time excluded (Q2)."""
    return normalised_trades(spark, sf).select(*TRADE_OUT, "record_key", "trade_datetime", "month", "day", "hour")


@query(
    "time_parts",
    f"SELECT CAST(event_id AS VARCHAR) AS tradeid, {Q.TRADE_TIME_COLS}, CAST(year(ts) AS VARCHAR) AS year "
    f"FROM events WHERE {Q.GOOD_KEY} AND {Q.GOOD_TIME}",
)
def time_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Unpadded year/month/day/hour strings of the event time."""
    df = C.with_time_parts(normalised_trades(spark, sf), "trade_datetime", ("year",))
    return df.select("tradeid", "trade_datetime", "month", "day", "hour", "year")


@query(
    "record_key_composite",
    f"""SELECT CAST(event_id AS VARCHAR) || '#' ||
               {Q.TS_TEXT} AS record_key,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(day(ts) AS VARCHAR) END AS day,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(hour(ts) AS VARCHAR) END AS hour,
               CASE WHEN event_id % 97 = 0 THEN NULL
                    ELSE 'day=' || CAST(day(ts) AS VARCHAR) || '/hour=' || CAST(hour(ts) AS VARCHAR) END AS partition_key
        FROM events WHERE {Q.GOOD_KEY}""",
)
def record_key_composite(spark: SparkSession, sf: str) -> DataFrame:
    """P10/P15 (Parquet variant): key ``tradeid#timestamp``, ``day=../hour=..``;
    no null-time filter, so bad times keep a null partition (Q3)."""
    df = C.require(decoded_trades(spark, sf), "tradeid")
    df = C.with_record_key(df, ["tradeid", "timestamp"])
    df = C.with_event_time(df, "timestamp", "trade_datetime")
    df = C.with_time_parts(df, "trade_datetime", ("day", "hour"))
    df = C.with_partition_path(df, ["day", "hour"])
    return df.select("record_key", "day", "hour", "partition_key")


@query(
    "rejects",
    f"""SELECT CASE WHEN event_id % 101 = 0 THEN 'malformed' WHEN event_id % 103 = 0 THEN 'null_key'
                    ELSE 'bad_time' END AS reject_reason,
               CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS tradeid,
               CASE WHEN event_id % 101 = 0 THEN NULL ELSE {Q.TS_TEXT} END AS timestamp
        FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 97 = 0""",
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows with a reason (malformed / null key / bad time)."""
    df = C.with_event_time(decoded_trades(spark, sf), "timestamp", "trade_datetime")
    _, bad = C.split_rejects(df, key="tradeid", time_col="trade_datetime")
    return bad.select("reject_reason", "tradeid", "timestamp")


@query(
    "json_schema_file",
    f"""SELECT CAST(event_id AS VARCHAR) AS tradeId, event_type AS symbol, value AS quantity,
               CAST(value AS VARCHAR) AS price, CAST(user_id AS VARCHAR) AS traderName
        FROM events WHERE {Q.GOOD_KEY}""",
)
def json_schema_file(spark: SparkSession, sf: str) -> DataFrame:
    """Decode with a schema built from Avro schema text (``quantity`` is a double)."""
    schema = schema_from_avsc(TRADE_AVSC)
    df = S.decode_feed(FX.trade_feed(spark, sf), "value", schema, keep_corrupt=False)
    return C.require(df, "tradeId").select("tradeId", "symbol", "quantity", "price", "traderName")


# Avro schema text of a trade record, for S7.
TRADE_AVSC = """
{"type": "record", "name": "TradeEvent", "namespace": "trades",
 "fields": [
   {"name": "tradeId", "type": ["null", "string"], "default": null},
   {"name": "symbol", "type": ["null", "string"], "default": null},
   {"name": "quantity", "type": ["null", "double"], "default": null},
   {"name": "price", "type": ["null", "string"], "default": null},
   {"name": "timestamp", "type": ["null", "string"], "default": null},
   {"name": "description", "type": ["null", "string"], "default": null},
   {"name": "traderName", "type": ["null", "string"], "default": null},
   {"name": "traderFirm", "type": ["null", "string"], "default": null}
 ]}
"""


@query("json_inferred", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text with a schema inferred from all rows."""
    df = S.from_json_lines(FX.load(spark, sf, "events"), "props")
    return df.select("event_id", F.col("j.k").alias("k"))


@query(
    "notice_path",
    """SELECT o_orderkey, '/landing/' || o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS file_path
       FROM orders""",
)
def notice_path(spark: SparkSession, sf: str) -> DataFrame:
    """P4 + path normalisation: ``{"filePath": ...}`` notices (URL-escaped,
    with scheme) -> the nested field -> a scheme-free, unescaped path."""
    o = FX.load(spark, sf, "orders")
    url = F.concat(
        F.lit("file:///landing/"), F.replace(F.col("o_orderpriority"), F.lit(" "), F.lit("%20")), F.lit("/"),
        F.col("o_orderkey").cast("string"), F.lit(".parquet"),
    )
    notices = o.select("o_orderkey", F.to_json(F.struct(url.alias("filePath"))).alias("value"))
    j = notices.select("o_orderkey", F.from_json("value", "filePath string").alias("j"))
    return j.select("o_orderkey", C.normalize_path(F.col("j.filePath")).alias("file_path"))


@query(
    "commit_cutoff",
    "SELECT event_id, strftime(ts - INTERVAL 20 MINUTE, '%Y%m%d%H%M%S%g') AS cutoff FROM events",
)
def commit_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """``ts - 20 minutes`` as a 17-digit instant (24-hour clock, Q13)."""
    ev = FX.load(spark, sf, "events")
    return ev.select("event_id", commit_cutoff_col("ts", 20).alias("cutoff"))


# ----------------------------------------------------------------- CDC path
def cdc_decoded(spark: SparkSession, sf: str) -> DataFrame:
    return S.decode_envelope(FX.cdc_envelopes(spark, sf, "data"), "data", FX.ORDER_DETAIL_SCHEMA)


def cdc_normalised(spark: SparkSession, sf: str) -> DataFrame:
    """P5, P8, P10, P12, P13, P15 on the decoded envelope."""
    df = C.lower_columns(cdc_decoded(spark, sf))
    df = C.require(df, "order_date")
    df = C.with_record_key(df, ["order_id", "line_id"])
    df = C.as_date(df, "order_date")
    df = C.with_time_parts(df, "order_date", ("year", "month"))
    return C.with_partition_path(df, ["year", "month"])


OD_OUT = ["line_id", "line_number", "order_id", "product_id", "quantity", "unit_price", "discount", "supply_cost",
          "tax", "order_date"]
OD_SQL_OUT = ", ".join(OD_OUT)


@query(
    "cdc_decode",
    f"""SELECT line_id AS LINE_ID, line_number AS LINE_NUMBER, order_id AS ORDER_ID, product_id AS PRODUCT_ID,
               quantity AS QUANTITY, unit_price AS UNIT_PRICE, discount AS DISCOUNT, supply_cost AS SUPPLY_COST,
               tax AS TAX, order_date AS ORDER_DATE, operation
        FROM ({Q.ORDER_DETAIL}) d""",
)
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope -> ``data.*`` (decimal(38,10) money) + ``metadata['operation']``."""
    return cdc_decoded(spark, sf)


@query("lower_columns", f"SELECT {OD_SQL_OUT}, operation FROM ({Q.ORDER_DETAIL}) d")
def lower_columns(spark: SparkSession, sf: str) -> DataFrame:
    """P5: every column name lower-cased in one projection."""
    return C.lower_columns(cdc_decoded(spark, sf))


CDC_NORM_SQL = f"""
    SELECT {OD_SQL_OUT},
           CAST(order_id AS VARCHAR) || '#' || CAST(line_id AS VARCHAR) AS record_key,
           CAST(year(order_date) AS VARCHAR) AS year, CAST(month(order_date) AS VARCHAR) AS month,
           'year=' || CAST(year(order_date) AS VARCHAR) || '/month=' || CAST(month(order_date) AS VARCHAR) AS partition_key
    FROM ({Q.ORDER_DETAIL}) d WHERE order_date IS NOT NULL"""


@query("cdc_normalise", CDC_NORM_SQL)
def cdc_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """Date not null, ``order#line`` key, date, year/month, partition path."""
    return cdc_normalised(spark, sf).select(*OD_OUT, "record_key", "year", "month", "partition_key")


@query("partition_path", f"SELECT record_key, partition_key FROM ({CDC_NORM_SQL}) n")
def partition_path(spark: SparkSession, sf: str) -> DataFrame:
    """``year=…/month=…`` as one string."""
    return cdc_normalised(spark, sf).select("record_key", "partition_key")


@query("preview_columns", f"SELECT month, record_key, quantity FROM ({CDC_NORM_SQL}) n")
def preview_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Subset select for display."""
    return cdc_normalised(spark, sf).select("month", "record_key", "quantity")


CDC_SPEC = TableSpec(
    keys=("order_id", "line_id"), order=("order_date",), partitions=("year", "month"), deletes="ignore",
    tiebreak=("product_id", "quantity", "unit_price", "discount", "supply_cost", "tax", "line_number"),
)


@query(
    "precombine",
    f"""SELECT {OD_SQL_OUT}, record_key FROM ({CDC_NORM_SQL}) n
        QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY order_date DESC NULLS LAST, {Q.OD_TIEBREAK}) = 1""",
)
def precombine(spark: SparkSession, sf: str) -> DataFrame:
    """Highest ordering value per key inside one batch."""
    out = R.precombine(cdc_normalised(spark, sf), CDC_SPEC)
    return out.select(*OD_OUT, "record_key")


# ---------------------------------------------------------- debezium
DBZ_SQL = f"""
    SELECT {OD_SQL_OUT},
           CASE op WHEN 'D' THEN 'D' WHEN 'I' THEN 'I' ELSE 'U' END AS Op,
           printf('mysql-bin.%06d', commit_group + 999998) AS binlog_file,
           order_id * 8 + line_id AS binlog_pos
    FROM ({Q.ORDER_DETAIL}) d"""


def dbz_flat(spark: SparkSession, sf: str) -> DataFrame:
    return C.lower_columns(
        S.flatten_debezium(FX.debezium_envelopes(spark, sf), "value", FX.ORDER_DETAIL_SCHEMA)
    ).withColumnRenamed("op", "Op")


@query("debezium_flatten", DBZ_SQL)
def debezium_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """before/after/op/source -> flat row, op c,r->I u->U d->D."""
    return dbz_flat(spark, sf).select(*OD_OUT, "Op", "binlog_file", "binlog_pos")


@query(
    "debezium_order",
    f"""SELECT {OD_SQL_OUT}, binlog_file, binlog_pos FROM (
          SELECT * FROM ({DBZ_SQL}) d
          QUALIFY row_number() OVER (PARTITION BY order_id, line_id
                                     ORDER BY CAST(regexp_extract(binlog_file, '[0-9]+$') AS BIGINT) DESC NULLS LAST, binlog_pos DESC NULLS LAST,
                                              {Q.OD_TIEBREAK}) = 1) w
        WHERE Op <> 'D'""",
)
def debezium_order(spark: SparkSession, sf: str) -> DataFrame:
    """Binlog (file number, pos) as the ordering, over a rollover to
    seven digits; deletes applied."""
    spec = TableSpec(keys=("order_id", "line_id"), order=("binlog_seq", "binlog_pos"), deletes="apply",
                     tiebreak=CDC_SPEC.tiebreak)
    rows = R.to_log_rows(dbz_flat(spark, sf), spec, op_col="Op")
    return R.visible(R.precombine(rows, spec), spec).select(*OD_OUT, "binlog_file", "binlog_pos")


# ------------------------------------------------------- rejects of envelopes
BAD_ROWS_SQL = f"""
    SELECT CASE WHEN order_id % 97 = 0 THEN 'malformed' WHEN order_id % 103 = 0 THEN 'null_key' ELSE 'unknown_op' END AS reject_reason,
           CASE WHEN order_id % 97 = 0 OR order_id % 103 = 0 THEN NULL ELSE order_id END AS order_id,
           CASE WHEN order_id % 97 = 0 THEN NULL ELSE line_id END AS line_id
    FROM ({Q.ORDER_DETAIL}) d WHERE order_id % 97 = 0 OR order_id % 103 = 0 OR order_id % 101 = 0"""


@query("rejects_debezium", BAD_ROWS_SQL)
def rejects_debezium(spark: SparkSession, sf: str) -> DataFrame:
    """Broken text, null keys and unknown operations with their reason."""
    rows = C.lower_columns(S.flatten_debezium(FX.debezium_envelopes(spark, sf, bad=True), "value", FX.ORDER_DETAIL_SCHEMA, keep_corrupt=True))
    keyed = C.with_record_key(rows, ["order_id", "line_id"])
    return C.split_rejects(keyed, key="record_key", op_col="op")[1].select("reject_reason", "order_id", "line_id")


@query("rejects_cdc", BAD_ROWS_SQL)
def rejects_cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The same for ``data``/``metadata`` envelopes."""
    rows = S.decode_envelope(FX.cdc_envelopes(spark, sf, bad=True), "data", FX.ORDER_DETAIL_SCHEMA, keep_corrupt=True)
    rows = C.with_record_key(C.lower_columns(rows), ["order_id", "line_id"])
    letter = F.when(F.col("operation").isNull(), F.lit(None)).otherwise(F.upper(F.substring("operation", 1, 1)))
    return C.split_rejects(rows.withColumn("op", letter), key="record_key", op_col="op")[1].select("reject_reason", "order_id", "line_id")


# ------------------------------------------------------------ change log
def li_log(spark: SparkSession, sf: str, **kw):
    spec = FX.lineitem_spec(**kw)
    return FX.lineitem_log(spark, sf, spec), spec


def li_rows(spark: SparkSession, sf: str, **kw):
    """The log before each commit is precombined, for reductions: inside a commit they order versions as
    the writer does, so they pick the same rows, by one shuffle and not two."""
    return FX.lineitem_changes(spark, sf), FX.lineitem_spec(**kw)


@query("snapshot_read", Q.li_snapshot())
def snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    """Current row per key, tombstones dropped."""
    log, spec = li_rows(spark, sf)
    return R.snapshot(log, spec).select(*LI_OUT)


@query("key_scope_global", Q.li_snapshot(deletes=False))
def key_scope_global(spark: SparkSession, sf: str) -> DataFrame:
    """Key unique over the table (a key that moves partition leaves the old one)."""
    log, spec = li_rows(spark, sf, deletes="ignore")
    return R.snapshot(log, spec).select(*LI_OUT)


@query("key_scope_partition", Q.li_snapshot(partition="year, _record_key", deletes=False))
def key_scope_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Key unique per partition (``year``)."""
    log, spec = li_rows(spark, sf, deletes="ignore", key_scope="partition")
    return R.snapshot(log, spec).select(*LI_OUT)


@query("merge_arrival", Q.li_snapshot())
def merge_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The newest commit wins whatever its ordering value (default payload)."""
    log, spec = li_rows(spark, sf, merge="arrival")
    return R.snapshot(log, spec).select(*LI_OUT)


@query(
    "merge_event_time",
    Q.li_snapshot(order=f"l_shipdate DESC NULLS LAST, _commit_time DESC, {Q.LI_TIEBREAK}"),
)
def merge_event_time(spark: SparkSession, sf: str) -> DataFrame:
    """The highest ordering value wins across commits."""
    log, spec = li_rows(spark, sf, merge="event_time")
    return R.snapshot(log, spec).select(*LI_OUT)


@query("as_of", Q.li_snapshot(where=f"_commit_time <= '{C1}'"))
def as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The table right after the second commit."""
    log, spec = li_rows(spark, sf)
    return R.as_of(log, spec, C1).select(*LI_OUT)


@query(
    "incremental_read",
    f"SELECT * FROM ({Q.li_snapshot(where=f'_commit_time <= {chr(39)}{C2}{chr(39)}')}) s "
    f"WHERE _commit_time > '{C0}'",
)
def incremental_read(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose current version was committed in (c0, c2],
    with the commit column first."""
    log, spec = li_rows(spark, sf)
    out = R.incremental(log, spec, C0, C2)
    return out.select(COMMIT, *[c for c in LI_OUT if c != COMMIT])


@query("incremental_open", f"SELECT * FROM ({Q.li_snapshot()}) s WHERE _commit_time > '{C1}'")
def incremental_open(spark: SparkSession, sf: str) -> DataFrame:
    """R2 without an end: everything current that changed after c1."""
    log, spec = li_rows(spark, sf)
    return R.incremental(log, spec, C1).select(*LI_OUT)


@query("changes_since_lag", f"SELECT * FROM ({Q.li_snapshot()}) s WHERE _commit_time > '{C2}'")
def changes_since_lag(spark: SparkSession, sf: str) -> DataFrame:
    """now = c3 + 10 min, lag 20 min -> begin = newest commit before
    now - 20 min = c2."""
    log, spec = li_rows(spark, sf)
    return R.changes_since_lag(log, spec, now="20240104001000000", minutes=20).select(*LI_OUT)


@query("start_position", f"SELECT {Q.LI_COLS} FROM ({Q.LI_LOG}) l WHERE _commit_time > '{C1}'")
def start_position(spark: SparkSession, sf: str) -> DataFrame:
    """S3: raw change rows after a start position (here: after c1)."""
    log, _ = li_log(spark, sf)
    return R.changes_after(log, C1).select(*LI_OUT)


@query("max_commit", "SELECT max(printf('202401%02d000000000', (l_suppkey % 4) + 1)) AS max_commit FROM lineitem")
def max_commit_q(spark: SparkSession, sf: str) -> DataFrame:
    """Newest commit instant of the log."""
    log, _ = li_log(spark, sf)
    return max_commit(log)


@query(
    "commit_list",
    f"""SELECT DISTINCT printf('202401%02d000000000', (l_suppkey % 4) + 1) AS _commit_time FROM lineitem
        WHERE printf('202401%02d000000000', (l_suppkey % 4) + 1) > '{C0}'""",
)
def commit_list(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct commits after a cut-off, newest first."""
    log, _ = li_log(spark, sf)
    return TL.commit_list(log, since=C0)


@query(
    "commit_min_recent",
    f"""SELECT min(printf('202401%02d000000000', (l_suppkey % 4) + 1)) AS commit_time FROM lineitem
        WHERE printf('202401%02d000000000', (l_suppkey % 4) + 1) > '{C0}'""",
)
def commit_min_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The oldest commit after a cut-off."""
    log, _ = li_log(spark, sf)
    return TL.commit_min_recent(log, since=C0)


@query(
    "commit_nth_last",
    """SELECT commit_time FROM (SELECT DISTINCT printf('202401%02d000000000', (l_suppkey % 4) + 1) AS commit_time
                                FROM lineitem) c
       ORDER BY commit_time DESC LIMIT 1 OFFSET 1""",
)
def commit_nth_last(spark: SparkSession, sf: str) -> DataFrame:
    """The second commit from the end."""
    log, _ = li_log(spark, sf)
    return TL.commit_nth_last(log, n=2)


SHOW_COMMITS_SQL = f"""WITH log AS ({Q.LI_LOG}),
        first AS (SELECT _record_key, min(_commit_time) AS f FROM log GROUP BY _record_key)
        SELECT _commit_time AS commit_time, count(*) AS num_rows,
               count(*) FILTER (WHERE _op <> 'D' AND _commit_time = f) AS num_inserts,
               count(*) FILTER (WHERE _op <> 'D' AND _commit_time <> f) AS num_updates,
               count(*) FILTER (WHERE _op = 'D') AS num_deletes
        FROM log JOIN first USING (_record_key)
        GROUP BY _commit_time ORDER BY commit_time DESC LIMIT 10"""


@query("show_commits", SHOW_COMMITS_SQL)
def show_commits(spark: SparkSession, sf: str) -> DataFrame:
    """Per-commit counts, newest first."""
    log, spec = li_log(spark, sf)
    return TL.show_commits(log, spec, n=10)


EXPIRE_SQL = f"""
    WITH log AS ({Q.LI_LOG}),
    nx AS (SELECT *, lead(_commit_time) OVER (PARTITION BY _record_key ORDER BY _commit_time) AS nxt FROM log)
    SELECT {Q.LI_COLS} FROM nx
    WHERE EXISTS (SELECT 1 FROM (VALUES ('{{keep_a}}'), ('{{keep_b}}')) k(t)
                  WHERE nx._commit_time <= k.t AND (nx.nxt IS NULL OR k.t < nx.nxt))"""


# The retained commit stays as it is; older ones keep what it or the pin can see.
# In event time a version is seen from its commit on if it beats all earlier ones, until one beats it.
EXPIRE_EVENT_SQL = f"""
    WITH log AS ({Q.LI_LOG}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY _record_key ORDER BY l_shipdate ASC NULLS FIRST, _commit_time ASC) AS rk FROM log),
    heads AS (SELECT * FROM (SELECT *, max(rk) OVER (PARTITION BY _record_key ORDER BY _commit_time
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM ranked) b WHERE best IS NULL OR rk > best),
    nx AS (SELECT *, lead(_commit_time) OVER (PARTITION BY _record_key ORDER BY _commit_time) AS nxt FROM heads)
    SELECT {Q.LI_COLS} FROM nx
    WHERE _commit_time < '{C3}' AND (nxt IS NULL OR '{C3}' < nxt OR (_commit_time <= '{C0}' AND '{C0}' < nxt))
    UNION ALL SELECT {Q.LI_COLS} FROM log WHERE _commit_time = '{C3}'"""


@query("expire_commits", EXPIRE_SQL.replace("{keep_a}", C0).replace("{keep_b}", C3))
def expire_commits(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaner keeping the newest commit (retain=1) and a pin on c0."""
    log, spec = li_log(spark, sf)
    return TL.expire(log, spec, retain=1, pins=[C0]).select(*LI_OUT)


@query("savepoint_as_of", Q.li_snapshot(where=f"_commit_time <= '{C1}'"))
def savepoint_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """A pinned commit survives expiry: as-of c1 over the expired log."""
    log, spec = li_log(spark, sf)
    kept = TL.expire(log, spec, retain=1, pins=[C1])
    return R.as_of(kept, spec, C1).select(*LI_OUT)


@query("upsert_merge", Q.li_snapshot())
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """W2 copy-on-write form: the state after the first commit, and one
    anti-join + union for all commits that are pending then."""
    log, spec = li_log(spark, sf)
    state = R.snapshot(log.where(F.col(COMMIT) == C0), spec)
    pending = R.snapshot(log.where(F.col(COMMIT) > C0), spec, keep_tombstones=True)
    return R.merge_into(state, pending, spec).select(*LI_OUT)


@query(
    "newest_per_key",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC NULLS LAST, {Q.LI_TIEBREAK}) = 1""",
)
def newest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """W1 on a plain table: the newest row per ``(l_orderkey, l_linenumber)``
    """
    spec = FX.lineitem_spec(partitions=())
    out = R.precombine(FX.load(spark, sf, "lineitem"), spec)
    return out.select(*FX.LINEITEM_COLUMNS)
