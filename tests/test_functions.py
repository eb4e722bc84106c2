"""Projections, decoders and instants."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions import instants as I
from tidemark.sources import feeds as S
from tidemark.sources.avro_schema import schema_from_avsc

TRADE = T.StructType([T.StructField(n, T.StringType()) for n in ("tradeId", "timestamp", "price")])


def test_decode_feed_keeps_number_text_and_marks_malformed(spark):
    df = spark.createDataFrame(
        [(b'{"tradeId":"1","timestamp":1700000123,"price":7.25}',), (b'{"tradeId":"2","time',), (None,)],
        "value binary",
    )
    rows = S.decode_feed(df, "value", TRADE).orderBy("tradeId").collect()
    good = [r for r in rows if r.tradeId == "1"][0]
    assert good.timestamp == "1700000123" and good.price == "7.25"          # P2
    bad = [r for r in rows if r._corrupt_record is not None]
    assert len(bad) == 1 and bad[0].tradeId is None                            # Q1
    assert len(rows) == 3


def test_rejects_reasons_and_ansi_safe_time(spark):
    df = spark.createDataFrame(
        [('{"tradeId":"1","timestamp":"abc"}',), ('{"timestamp":"5"}',), ('{"tradeId":"3","timestamp":"60"}',), ("{x",)],
        "value string",
    )
    dec = C.with_event_time(C.lower_columns(S.decode_feed(df, "value", TRADE)), "timestamp", "t")
    good, bad = C.split_rejects(dec, key="tradeid", time_col="t")
    assert [r.t for r in good.collect()] == ["1970-01-01 00:01:00"]                      # Q2 + zone-free
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_time", "malformed", "null_key"]


def test_lower_columns_and_drop_if_present(spark):
    df = spark.createDataFrame([(1, "I", 2)], "A int, Op string, bC int")
    out = C.drop_if_present(C.lower_columns(df), "op", "missing")
    assert out.columns == ["a", "bc"]


def test_record_key_null_if_any_part_null(spark):                                # Q20
    df = spark.createDataFrame([(1, 2), (1, None)], "o int, l int")
    keys = [r.record_key for r in C.with_record_key(df, ["o", "l"]).collect()]
    assert keys == ["1#2", None]


def test_time_parts_unpadded_and_partition_path(spark):                          # Q4, P15
    df = spark.createDataFrame([(datetime(2021, 2, 3, 9, 5),)], "ts timestamp_ntz")
    out = C.with_partition_path(C.with_time_parts(df, "ts", ("year", "month", "day", "hour")), ["year", "month"])
    r = out.first()
    assert (r.month, r.day, r.hour, r.partition_key) == ("2", "3", "9", "year=2021/month=2")


def test_as_date_try_cast(spark):
    df = spark.createDataFrame([("2015-10-17",), ("nope",)], "d string")
    assert [r.d for r in C.as_date(df, "d").collect()] == [datetime(2015, 10, 17).date(), None]


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([("7", "1.5")], "TradeId string, price string")
    target = T.StructType([T.StructField("Op", T.StringType()), T.StructField("tradeid", T.LongType()),
                           T.StructField("price", T.DoubleType())])
    r = C.conform(df, target).first()
    assert (r.Op, r.tradeid, r.price) == (None, 7, 1.5)


def test_sql_transform_and_ensure_op(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    out = C.sql_transform(C.ensure_op(df), "select id, upper(s) as s, Op from <SRC>")
    assert out.first().asDict() == {"id": 1, "s": "A", "Op": "I"}
    assert C.ensure_op(C.with_op(df, "D")).first().Op == "D"


def test_normalize_path(spark):
    df = spark.createDataFrame([("file:///a/b%20c.parquet",), ("/a/b c.parquet",), ("s3://bkt/k",), ("s3a://bkt/k",)], "p string")
    got = [r.n for r in df.select(C.normalize_path("p").alias("n")).collect()]
    assert got == ["/a/b c.parquet", "/a/b c.parquet", "bkt/k", "bkt/k"]


def test_instants_24h_and_fixed_width():                                          # Q13, Q16
    assert I.commit_cutoff("20240101150400000", 20) == "20240101144400000"
    assert I.normalize_instant("20240101150400") == "20240101150400000"
    assert "20220307091011121" < I.normalize_instant("20240101000000")


def test_commit_cutoff_col(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 15, 4, 0, 123000),)], "ts timestamp_ntz")
    assert df.select(I.commit_cutoff_col("ts", 20).alias("c")).first().c == "20240101144400123"


def test_schema_from_avsc():
    st = schema_from_avsc(
        '{"type":"record","name":"R","fields":[{"name":"a","type":["null","string"]},'
        '{"name":"b","type":"double"},{"name":"c","type":{"type":"bytes","logicalType":"decimal","precision":6,"scale":2}}]}'
    )
    assert [f.dataType for f in st.fields] == [T.StringType(), T.DoubleType(), T.DecimalType(6, 2)]


def test_decode_envelope_ignores_nothing_but_exposes_operation(spark):           # P3, Q5
    row = T.StructType([T.StructField("ID", T.IntegerType()), T.StructField("P", T.DecimalType(38, 10))])
    df = spark.createDataFrame([('{"data":{"ID":1,"P":36},"metadata":{"operation":"delete","transaction-id":90210000123}}',)],
                               "data string")
    r = S.decode_envelope(df, "data", row, keep_metadata=True).first()
    assert r.ID == 1 and float(r.P) == 36.0 and r.operation == "delete"
    assert r.metadata["transaction-id"] == "90210000123"


def test_flatten_debezium_uses_whole_struct(spark):                                # S8
    row = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    df = spark.createDataFrame(
        [('{"before":null,"after":{"id":1,"v":null},"op":"c","source":{"file":"b.1","pos":4}}',),
         ('{"before":{"id":2,"v":"x"},"after":null,"op":"d","source":{"file":"b.1","pos":9}}',)],
        "value string",
    )
    out = sorted(S.flatten_debezium(df, "value", row).collect(), key=lambda r: r.id)
    assert (out[0].v, out[0].Op, out[1].v, out[1].Op, out[1].binlog_pos) == (None, "I", "x", "D", 9)


def test_decode_filters_do_not_reparse_json(spark):
    df = spark.createDataFrame([('{"tradeId":"1"}',)], "value string")
    plan = S.decode_feed(df, "value", TRADE).where(F.col("tradeId").isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_read_feed_names_a_missing_connector(spark):
    import pytest

    with pytest.raises(RuntimeError, match="not on the classpath"):
        S.read_feed(spark, "kafka", {"kafka.bootstrap.servers": "localhost:9", "subscribe": "t"}, starting="earliest")


def test_epochs_out_of_range_are_rejects(spark):                                     # Q2
    df = spark.createDataFrame([("1700000123000",), ("-99999999999999",), ("253402300799",), ("0",)], "timestamp string")
    got = [r.t for r in C.with_event_time(df, "timestamp", "t").collect()]
    assert got == [None, None, "9999-12-31 23:59:59", "1970-01-01 00:00:00"]


def test_paths_keep_plus_and_percent(spark):
    df = spark.createDataFrame([("file:/a/x+y%20z",), ("/a/x+y z",), ("s3://b/50%",), ("/a/x y z",)], "p string")
    got = [r[0] for r in df.select(C.normalize_path("p")).collect()]
    assert got[0] == got[1] == "/a/x+y z" and got[2] == "b/50%" and got[3] != got[0]


def test_as_view(spark):                                                              # S11
    C.as_view(spark.range(3), "test_as_view_rows")
    assert spark.sql("select sum(id) from test_as_view_rows").first()[0] == 3


def test_json_inference_sees_every_row(spark):                                        # S10
    df = spark.range(500).selectExpr("case when id = 499 then '{\"rare\": [1]}' when id = 7 then 'x{' else '{\"k\": 1}' end as t")
    out = S.from_json_lines(df, "t")
    assert sorted(f.name for f in out.schema["j"].dataType.fields) == ["k", "rare"]
    assert out.where("j.rare[0] = 1").count() == 1


def test_unknown_operation_is_a_reject(spark):
    df = spark.createDataFrame([("1", "i"), ("2", "Z"), ("3", None)], "k string, op string")
    good, bad = C.split_rejects(df, key="k", op_col="op")
    assert [r.reject_reason for r in bad.collect()] == ["unknown_op"] and good.count() == 2


# ------------------------------------------------------------- transformer chains
def test_chain_checks_schemas_before_rows(spark):                                   # T1, T2
    from tidemark.functions import chain as T

    source = spark.createDataFrame([], "id bigint, v string").schema
    target = spark.createDataFrame([], "id bigint, w string, Op string").schema
    stages = (T.sql("SELECT id, upper(v) AS w FROM <SRC>"), T.ensure_op("U"), T.conform(target))
    chain = T.Chain(*stages, source=source, target=target)
    rows = spark.createDataFrame([(1, "a")], "id int, v string")                     # an int fits a bigint
    assert [tuple(r) for r in chain(rows).collect()] == [(1, "A", "U")] and chain.check(spark, rows.schema) == chain(rows).schema
    for schema, message in (("id int", "column v must be string, is missing"), ("id string, v string", "column id must be bigint, is string")):
        with pytest.raises(ValueError, match=message):
            chain.check(spark, spark.createDataFrame([], schema).schema)
    with pytest.raises(ValueError, match="stage 'sql'"):
        T.Chain(T.sql("SELECT nothing FROM <SRC>"))(rows)
    with pytest.raises(ValueError, match="does not fit the target: .*op string"):
        T.Chain(T.sql("SELECT id, v AS w FROM <SRC>"), target=target)(rows)
