"""SQL fragments the DuckDB oracles share. They restate each fixture rule
directly over the driver tables (plain SQL, not a copy of the Spark plan)."""

EPOCH = "date_diff('second', TIMESTAMP '1970-01-01', ts)"
# The feed's time text: not a number, or milliseconds, for a few events.
TS_TEXT = (f"CASE WHEN event_id % 194 = 0 THEN CAST({EPOCH} * 1000 AS VARCHAR) WHEN event_id % 97 = 0 THEN 'abc' "
           f"ELSE CAST({EPOCH} AS VARCHAR) END")
GOOD_KEY = "event_id % 101 <> 0 AND event_id % 103 <> 0"
GOOD_TIME = "event_id % 97 <> 0"

TRADE_COLS = f"""
    CAST(event_id AS VARCHAR) AS tradeid,
    event_type AS symbol,
    CAST(value AS VARCHAR) AS quantity,
    CAST(value AS VARCHAR) AS price,
    {TS_TEXT} AS timestamp,
    props AS description,
    CAST(user_id AS VARCHAR) AS tradername,
    event_type || ' firm' AS traderfirm"""

TRADE_TIME_COLS = """
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS trade_datetime,
    CAST(month(ts) AS VARCHAR) AS month,
    CAST(day(ts) AS VARCHAR) AS day,
    CAST(hour(ts) AS VARCHAR) AS hour"""

ORDER_DETAIL = """
    SELECT l.l_linenumber AS line_id, l.l_linenumber AS line_number, l.l_orderkey AS order_id,
           l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity,
           CAST(l.l_extendedprice AS DECIMAL(38,10)) AS unit_price,
           CAST(l.l_discount AS DECIMAL(38,10)) AS discount,
           CAST(p.p_retailprice AS DECIMAL(38,10)) AS supply_cost,
           CAST(l.l_tax AS DECIMAL(38,10)) AS tax,
           CAST(l.l_shipdate AS DATE) AS order_date,
           CASE l.l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'I' ELSE 'U' END AS op,
           CASE l.l_returnflag WHEN 'R' THEN 'delete' WHEN 'A' THEN 'insert' ELSE 'update' END AS operation,
           CAST(l.l_suppkey % 4 AS INTEGER) AS commit_group
    FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey"""

OD_TIEBREAK = ("product_id DESC NULLS LAST, quantity DESC NULLS LAST, unit_price DESC NULLS LAST, "
               "discount DESC NULLS LAST, supply_cost DESC NULLS LAST, tax DESC NULLS LAST, "
               "line_number DESC NULLS LAST")

LI_RAW = """
    SELECT printf('202401%02d000000000', (l_suppkey % 4) + 1) AS _commit_time,
           CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'U' END AS _op,
           CAST(l_orderkey AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR) AS _record_key,
           CAST(year(l_shipdate) AS VARCHAR) AS year,
           l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate
    FROM lineitem"""

LI_TIEBREAK = ("l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, "
               "l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, "
               "l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST")

LI_COLS = ("_commit_time, _op, _record_key, year, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
           "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

# The writer's log: one version per (commit, key).
LI_LOG = f"""
    SELECT * FROM ({LI_RAW}) raw
    QUALIFY row_number() OVER (PARTITION BY _commit_time, _record_key
                               ORDER BY l_shipdate DESC NULLS LAST, {LI_TIEBREAK}) = 1"""


def li_snapshot(where: str = "TRUE", partition: str = "_record_key", order: str | None = None,
                deletes: bool = True, source: str | None = None) -> str:
    order = order or f"_commit_time DESC, l_shipdate DESC NULLS LAST, {LI_TIEBREAK}"
    src = source or LI_RAW
    body = f"""
    SELECT {LI_COLS} FROM ({src}) r WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY {order}) = 1"""
    if deletes:
        return f"SELECT * FROM ({body}) s WHERE _op <> 'D'"
    return body


TRADES_FULL = """
    SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dms_received_ts,
           CAST(o_orderkey AS VARCHAR) AS tradeid, CAST(o_custkey AS VARCHAR) AS customerid,
           o_orderpriority AS symbol, o_totalprice AS price, 1.0::DOUBLE AS quantity,
           o_orderdate AS update_timestamp, o_orderstatus AS updated_by, o_orderkey AS k
    FROM orders"""

# Final state after the full load and the changes: deleted when k % 7 = 0,
# second version when k % 3 = 0.
TRADES_FINAL = f"""
    SELECT CASE WHEN k % 3 = 0 THEN strftime(update_timestamp + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
                ELSE dms_received_ts END AS dms_received_ts,
           tradeid, customerid, symbol,
           CASE WHEN k % 3 = 0 THEN price + 1.0 ELSE price END AS price,
           CASE WHEN k % 3 = 0 THEN 2.0::DOUBLE ELSE quantity END AS quantity,
           CASE WHEN k % 3 = 0 THEN update_timestamp + INTERVAL 1 DAY ELSE update_timestamp END AS update_timestamp,
           CASE WHEN k % 3 = 0 THEN 'cdc' ELSE updated_by END AS updated_by
    FROM ({TRADES_FULL}) f WHERE k % 7 <> 0"""
