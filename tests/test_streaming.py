"""Streams equal batch; replay and file order."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.table import ChangeTable
from tidemark.plans.staging import land, stage_groups
from tidemark.sources import feeds as S
from tidemark.spec import TableSpec
from tidemark.streaming import sinks as W
from tidemark.streaming.progress import ProgressLog

SPEC = TableSpec(keys=("id",), order=("ts",), deletes="apply", tiebreak=("v",))
ONCE = {"availableNow": True}


def changes(spark):
    rows = [(g, i % 5, g * 10 + i, f"g{g}-{i}", "D" if (g == 2 and i % 5 == 1) else "U") for g in range(3) for i in range(8)]
    return spark.createDataFrame(rows, "g int, id int, ts int, v string, Op string")


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_table):
    groups = stage_groups(changes(spark), "g", f"{tmp_table}/staging")
    streamed = ChangeTable(spark, f"{tmp_table}/s", SPEC)
    name = f"t-{uuid.uuid4().hex[:6]}"
    schema = "id int, ts int, v string, Op string"
    for g, files in groups.items():
        land(spark, files, f"{tmp_table}/landing", f"g{g}")
        q = W.upsert_stream(S.stream_change_dir(spark, f"{tmp_table}/landing", schema), streamed,
                            f"{tmp_table}/ckpt", name, trigger=ONCE, op_col="Op")
        q.awaitTermination()
    q = W.upsert_stream(S.stream_change_dir(spark, f"{tmp_table}/landing", schema), streamed,
                        f"{tmp_table}/ckpt", name, trigger=ONCE, op_col="Op")
    q.awaitTermination()
    assert len(streamed.commit_times()) == 3
    batch = ChangeTable(spark, f"{tmp_table}/b", SPEC)
    for g in range(3):
        batch.upsert(changes(spark).where(F.col("g") == g).drop("g"), op_col="Op")
    got = sorted((r.id, r.v) for r in streamed.snapshot().collect())
    assert got == sorted((r.id, r.v) for r in batch.snapshot().collect())
    assert 1 not in [i for i, _ in got]


def test_notice_batch_later_file_wins(spark, tmp_table):                           # Q8
    a = spark.createDataFrame([(1, 9, "first-file-high-ts")], "id int, ts int, v string")
    b = spark.createDataFrame([(1, 1, "second-file-low-ts")], "id int, ts int, v string")
    a.coalesce(1).write.parquet(f"{tmp_table}/a")
    b.coalesce(1).write.parquet(f"{tmp_table}/b")
    pa = [p for p in spark.read.parquet(f"{tmp_table}/a").inputFiles()][0]
    pb = [p for p in spark.read.parquet(f"{tmp_table}/b").inputFiles()][0]
    notices = spark.createDataFrame([(pa, 0), (pb.replace("file:", ""), 1)], "filePath string, seq int")
    rows = W.notice_batch(notices, seq_col="seq", schema="id int, ts int, v string")
    t = ChangeTable(spark, f"{tmp_table}/t", SPEC)
    t.upsert(rows, file_seq=F.col("_file_seq"))
    assert [r.v for r in t.snapshot().collect()] == ["second-file-low-ts"]


def test_append_stream_partitions_and_progress(spark, tmp_table):                  # W8, C5, C7, C8
    df = spark.createDataFrame([(1, "1", "5"), (2, None, None), (3, "30", "23")], "id int, day string, hour string")
    df.write.parquet(f"{tmp_table}/in")
    log = ProgressLog(spark, f"{tmp_table}/progress")
    try:
        q = W.append_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_table}/in"), f"{tmp_table}/out",
                            ["day", "hour"], f"{tmp_table}/ckpt", trigger=ONCE, query_name="append-test")
        q.awaitTermination()
        log.wait_for(str(q.id))
    finally:
        log.stop()
    back = spark.read.schema(df.schema).parquet(f"{tmp_table}/out")
    assert sorted((r.id, r.day) for r in back.collect()) == [(1, "1"), (2, None), (3, "30")]
    ev = [r for r in log.to_df().collect() if r.event == "progress"]
    assert sum(r.num_input_rows for r in ev) == 3
    assert all("triggerExecution" in r.durations_ms and r.sources[0].description for r in ev)
    assert {r.event for r in log.to_df().collect()} == {"started", "progress", "terminated"}
    with pytest.raises(TimeoutError):
        log.wait_for("no such query", timeout=0.2)


def test_hot_partition_is_written_by_every_task(spark, tmp_table):                  # W8
    spark.range(0, 4000, 1, 4).selectExpr("id", "'7' as hour").write.parquet(f"{tmp_table}/in")
    q = W.append_stream(spark.readStream.schema("id long, hour string").parquet(f"{tmp_table}/in"), f"{tmp_table}/out", ["hour"], f"{tmp_table}/ckpt", trigger=ONCE)
    q.awaitTermination()
    back = spark.read.parquet(f"{tmp_table}/out")
    assert back.count() == 4000 and back.select("_metadata.file_path").distinct().count() > 1


def test_new_checkpoint_with_an_old_name_is_a_new_query(spark, tmp_table):          # C3
    t = ChangeTable(spark, f"{tmp_table}/t", SPEC)
    for k in range(2):
        spark.createDataFrame([(k, 1, f"v{k}")], "id int, ts int, v string").write.parquet(f"{tmp_table}/in{k}")
        stream = S.stream_change_dir(spark, f"{tmp_table}/in{k}", "id int, ts int, v string")
        W.upsert_stream(stream, t, f"{tmp_table}/ckpt{k}", "same-name", trigger=ONCE).awaitTermination()
    assert sorted(r.v for r in t.snapshot().collect()) == ["v0", "v1"]


def test_batch_of_rejects_only(spark, tmp_table):                                   # C6
    t = ChangeTable(spark, f"{tmp_table}/t", SPEC)
    for k, key in enumerate([1, None, 2]):
        spark.createDataFrame([(key, 1, "v")], "id int, ts int, v string").write.mode("append").parquet(f"{tmp_table}/in")
        stream = S.stream_change_dir(spark, f"{tmp_table}/in", "id int, ts int, v string")
        W.upsert_with_rejects(stream, t, f"{tmp_table}/rejects", f"{tmp_table}/ckpt", "r", key="id", time_col=None, trigger=ONCE).awaitTermination()
        assert t.snapshot().count() == [1, 1, 2][k]
    assert spark.read.parquet(f"{tmp_table}/rejects").count() == 1


def test_repeated_notice_counts_at_its_last_position(spark, tmp_table):             # W12
    paths = []
    for k in "ab":
        spark.createDataFrame([(1, 1, k)], "id int, ts int, v string").coalesce(1).write.parquet(f"{tmp_table}/{k}+1")
        paths += [p for p in spark.read.parquet(f"{tmp_table}/{k}+1").inputFiles()]
    notices = spark.createDataFrame([(paths[0], 0), (paths[1], 1), (paths[0], 2)], "filePath string, seq int")
    t = ChangeTable(spark, f"{tmp_table}/t", SPEC)
    t.upsert(W.notice_batch(notices, seq_col="seq", schema="id int, ts int, v string"), file_seq=F.col("_file_seq"))
    assert [r.v for r in t.snapshot().collect()] == ["a"]


def test_timed_trigger_runs_batch_after_batch(spark, tmp_table):                    # C1
    t = ChangeTable(spark, f"{tmp_table}/t", SPEC)
    write = lambda k: spark.createDataFrame([(k, 1, "v")], "id int, ts int, v string").write.mode("append").parquet(f"{tmp_table}/in")
    write(0)
    q = W.upsert_stream(S.stream_change_dir(spark, f"{tmp_table}/in", "id int, ts int, v string"), t, f"{tmp_table}/ckpt", "timed", trigger={"processingTime": "1 second"})
    try:
        for k in (1, 2):
            end = time.time() + 60
            while len(t.commit_times()) < k and time.time() < end:
                time.sleep(0.3)
            assert len(t.commit_times()) == k
            write(k)
    finally:
        q.stop()


def test_start_positions():                                                          # S3
    assert S.start_options("kafka", "TRIM_HORIZON") == {"startingOffsets": "earliest"}
    assert S.start_options("kinesis", "latest") == {"startingposition": "LATEST"}
    assert S.start_options("parquet", "latest") == S.start_options("kafka", None) == {}
    with pytest.raises(ValueError, match="start position"):
        S.start_options("kafka", "yesterday")


def test_log_stream_offsets(spark, tmp_table):                                      # S1, S3, C3
    from tidemark.operators.table import ChangeTable
    from tidemark.sources.log_stream import stream_log
    from tidemark.spec import TableSpec

    t = ChangeTable(spark, f"{tmp_table}/t", TableSpec(keys=("id",), order=("ts",), partitions=("p",)))
    commit = lambda rows, schema="id int, ts timestamp, p string, n decimal(10,2), v string": t.upsert(
        spark.createDataFrame(rows, "id int, ts string, p string, n string, v string").selectExpr("id", "cast(ts as timestamp) ts", "p", "cast(n as decimal(10,2)) n", "v"))
    c1 = commit([(1, "2024-01-01 00:00:00.5", "a b", "1.5", "x"), (2, "2024-01-02", None, None, None)])
    c2 = commit([(3, "2024-01-03", "c", "2", "y")])

    def run(name, start):
        q = stream_log(spark, t.path, start).writeStream.format("parquet").option("path", f"{tmp_table}/{name}").option(
            "checkpointLocation", f"{tmp_table}/cp-{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        return sorted(r.id for r in spark.read.schema("id int").parquet(f"{tmp_table}/{name}").collect())

    assert run("early", "earliest") == [1, 2, 3] and run("given", c1) == [3]
    commit([(4, "2024-01-04", "c", "2", "z")])
    assert run("early", "earliest") == [1, 2, 3, 4] and run("given", c1) == [3, 4]     # resumed: nothing twice
    assert run("early", "latest") == [1, 2, 3, 4]                                       # the checkpoint decides
    assert run("late", c2) == [4]
    got = {r.id: (r.p, str(r.n), r.ts.isoformat(), r.v, r._commit_time) for r in spark.read.parquet(f"{tmp_table}/early").collect()}
    assert got[1] == ("a b", "1.50", "2024-01-01T00:00:00.500000", "x", c1) and got[2][0] is None
    commit([(5, "2024-01-05", "c", "2", "z")])
    commit([(6, "2024-01-05", "c", "2", "z")])
    t.expire(retain=1)
    with pytest.raises(Exception, match="expired"):
        run("given", c1)


def test_files_of_several_schemas(spark, tmp_table):                                # S4
    from tidemark.sources.feeds import read_change_files, schema_groups

    parts = [spark.range(2).selectExpr("cast(id as int) a", "'x' as B"), spark.range(2, 4).selectExpr("id as a", "1.5D as c"), spark.range(4, 6).selectExpr("cast(id as int) a")]
    paths = []
    for k, df in enumerate(parts):
        df.coalesce(1).write.parquet(f"{tmp_table}/{k}")
        paths.append(f"{tmp_table}/{k}")
    got = read_change_files(spark, paths)
    assert dict(got.dtypes) == {"a": "bigint", "B": "string", "c": "double"}
    assert sorted((r.a, r.B, r.c) for r in got.collect()) == [(0, "x", None), (1, "x", None), (2, None, 1.5), (3, None, 1.5), (4, None, None), (5, None, None)]
    assert len(schema_groups(spark, [paths[0], paths[2]])) == 1
    spark.range(1).selectExpr("'text' as a").write.parquet(f"{tmp_table}/bad")
    with pytest.raises(ValueError, match="does not fit"):
        read_change_files(spark, [*paths, f"{tmp_table}/bad"])


def test_groups_are_staged_without_a_shuffle(spark, tmp_table):
    """Each task writes what it has of a group: the files of a group are those of the tasks, not of a shuffle."""
    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "cast(id % 2 as int) as g")
    groups = stage_groups(rows, "g", f"{tmp_table}/staging")
    assert {k: len(v) for k, v in groups.items()} == {0: 4, 1: 4}
    assert sorted(r.id for r in spark.read.parquet(*groups[1]).collect()) == list(range(1, 4000, 2))
