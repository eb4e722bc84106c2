"""Log reductions and their identities."""

from pyspark.sql import functions as F

from tidemark.operators import reduce as R
from tidemark.operators import timeline as TL
from tidemark.spec import TableSpec

SPEC = TableSpec(keys=("id",), order=("ts",), partitions=("p",), deletes="apply", tiebreak=("v",))
SCHEMA = "_commit_time string, _op string, _record_key string, _file_seq int, p string, id int, ts int, v string"


def log_df(spark, rows):
    full = [(c, op, str(i), 0, p, i, ts, v) for (c, op, p, i, ts, v) in rows]
    return spark.createDataFrame(full, SCHEMA)


C = ["20240101000000000", "20240102000000000", "20240103000000000", "20240104000000000"]


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_precombine_highest_order_with_deterministic_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "z"), (2, 1, "x")], "id int, ts int, v string")
    out = R.precombine(df, SPEC.with_(partitions=()))
    assert rows_of(out, "id", "ts", "v") == [(1, 5, "b"), (2, 1, "x")]


def test_arrival_vs_event_time(spark):                                            # Q9, W7
    log = log_df(spark, [(C[0], "U", "a", 1, 9, "old-but-high"), (C[1], "U", "a", 1, 2, "new-but-low")])
    assert rows_of(R.snapshot(log, SPEC), "v") == [("new-but-low",)]
    assert rows_of(R.snapshot(log, SPEC.with_(merge="event_time")), "v") == [("old-but-high",)]


def test_deletes_ignore_vs_apply(spark):                                          # Q5, W5
    log = log_df(spark, [(C[0], "U", "a", 1, 1, "x"), (C[1], "D", "a", 1, 2, "x")])
    assert R.snapshot(log, SPEC).count() == 0
    assert rows_of(R.snapshot(log, SPEC.with_(deletes="ignore")), "_op") == [("D",)]


def test_key_scope(spark):                                                        # Q10, W4
    log = log_df(spark, [(C[0], "U", "a", 1, 1, "x"), (C[1], "U", "b", 1, 2, "y")])
    assert rows_of(R.snapshot(log, SPEC), "p") == [("b",)]
    assert rows_of(R.snapshot(log, SPEC.with_(key_scope="partition")), "p") == [("a",), ("b",)]


def sample_log(spark):
    rows = []
    for k, c in enumerate(C):
        for i in range(6):
            if (i + k) % 3 == 0:
                continue
            rows.append((c, "D" if (i == 5 and k == 3) else "U", "p" + str(i % 2), i, (7 * k + i) % 5, f"{k}-{i}"))
    return log_df(spark, rows)


def test_incremental_bounds_and_identities(spark):                                # Q11, R2, R3
    log = sample_log(spark)
    cols = ("_record_key", "_commit_time", "v")
    for mode in ("arrival", "event_time"):
        spec = SPEC.with_(merge=mode)
        assert rows_of(R.incremental(log, spec, None, C[2]), *cols) == rows_of(R.as_of(log, spec, C[2]), *cols)
        inc = R.incremental(log, spec, C[0], C[2])
        assert all(C[0] < r._commit_time <= C[2] for r in inc.collect())
        expect = R.as_of(log, spec, C[2]).where((F.col("_commit_time") > C[0]))
        assert rows_of(inc, *cols) == rows_of(expect, *cols)


def test_merge_into_equals_snapshot(spark):                                       # W2
    log = sample_log(spark)
    for mode in ("arrival", "event_time"):
        spec = SPEC.with_(merge=mode)
        state = R.precombine(log.where(F.col("_commit_time") == C[0]), spec)
        for c in C[1:]:
            state = R.merge_into(state, log.where(F.col("_commit_time") == c), spec)
        assert rows_of(R.visible(state, spec), "_record_key", "v") == rows_of(R.snapshot(log, spec), "_record_key", "v")


def test_replaying_a_commit_changes_nothing(spark):
    log = sample_log(spark)
    again = log.where(F.col("_commit_time") == C[1])
    assert rows_of(R.snapshot(log.unionByName(again), SPEC), "_record_key", "v") == rows_of(R.snapshot(log, SPEC), "_record_key", "v")


def test_changes_since_lag(spark):                                               # R4, Q15
    log = sample_log(spark)
    out = R.changes_since_lag(log, SPEC, now="20240104001000000", minutes=20)
    assert rows_of(out, "_record_key", "v") == rows_of(R.incremental(log, SPEC, C[2]), "_record_key", "v")
    # every commit is inside the lag window: begin = now, nothing after it
    recent = log.where(F.col("_commit_time") == C[3])
    assert R.changes_since_lag(recent, SPEC, now="20240104000500000", minutes=20).count() == 0


def test_expire_keeps_every_retained_and_pinned_view(spark):                      # R9, R10
    log = sample_log(spark)
    for mode in ("arrival", "event_time"):
        spec = SPEC.with_(merge=mode)
        kept = TL.expire(log, spec, retain=1, pins=[C[1]])
        assert kept.count() < log.count()
        for t in (C[1], C[3]):
            assert rows_of(R.as_of(kept, spec, t), "_record_key", "v") == rows_of(R.as_of(log, spec, t), "_record_key", "v")


def test_commit_listing_and_show_commits(spark):                                 # R5, R8, P18
    log = sample_log(spark)
    assert [r[0] for r in TL.commit_list(log, since=C[0]).collect()] == C[:0:-1]
    assert TL.commit_min_recent(log, C[0]).first()[0] == C[1]
    assert TL.commit_nth_last(log, 2).first()[0] == C[2]
    sc = {r.commit_time: r for r in TL.show_commits(log, SPEC, n=10).collect()}
    assert sc[C[0]].num_inserts == sc[C[0]].num_rows and sc[C[3]].num_deletes == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """One key holds a third of the rows: the plan must cut it down per map
    task (partial WindowGroupLimit) before the exchange."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("id"),
        (F.col("id") % 97).cast("int").alias("ts"), F.col("id").cast("string").alias("v"))
    out = R.precombine(df, SPEC.with_(partitions=()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == n - n // 3 + 1


def test_derived_state_identity(spark):
    """as_of(b), then the upserted incremental (b, e] plus the keys deleted in
    (b, e], equals as_of(e) (arrival mode)."""
    log = sample_log(spark)
    b, e = C[1], C[3]
    state = R.as_of(log, SPEC, b)
    inc = R.incremental(log, SPEC, b, e)
    merged = state.join(inc.select("_record_key"), "_record_key", "left_anti").unionByName(inc)
    live_e = R.as_of(log, SPEC, e).select("_record_key")
    deleted = state.select("_record_key").subtract(live_e)
    merged = merged.join(deleted, "_record_key", "left_anti")
    assert rows_of(merged, "_record_key", "v") == rows_of(R.as_of(log, SPEC, e), "_record_key", "v")


def test_event_time_batch_order_does_not_matter(spark):
    """With unique ordering values the event-time result ignores commit order."""
    spec = SPEC.with_(merge="event_time")
    rows = [(C[k], "U", "a", i, 10 * k + i, f"{k}-{i}") for k in range(3) for i in range(4)]
    fwd = log_df(spark, rows)
    rev = log_df(spark, [(C[2 - C.index(c)], op, p, i, ts, v) for (c, op, p, i, ts, v) in rows])
    assert rows_of(R.snapshot(fwd, spec), "_record_key", "v") == rows_of(R.snapshot(rev, spec), "_record_key", "v")


def test_reductions_of_the_log_shuffle_once(spark):
    """Versions inside a commit are ordered as the writer orders them: no pass per commit comes first."""
    from tidemark.plans import catalog_batch as B
    from tidemark.plans import fixtures as FX

    for name, kw in (("snapshot_read", {}), ("merge_event_time", {"merge": "event_time"}), ("key_scope_partition", {"key_scope": "partition", "deletes": "ignore"})):
        got = getattr(B, name)(spark, "/root/testdata/sf0.001")
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        spec = FX.lineitem_spec(**kw)
        want = R.snapshot(FX.lineitem_log(spark, "/root/testdata/sf0.001", spec), spec).select(*B.LI_OUT)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
