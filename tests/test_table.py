"""The on-disk change table."""

import json
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reduce as R
from tidemark.operators.table import Bookmark, ChangeTable, derive, next_range
from tidemark.spec import TableSpec

SPEC = TableSpec(keys=("id",), order=("ts",), partitions=("p",), deletes="apply", tiebreak=("v",))


def batch(spark, rows):
    return spark.createDataFrame(rows, "id int, ts int, v string, p string, Op string")


def snap(table):
    return sorted((r.id, r.v) for r in table.snapshot().collect())


def test_upsert_snapshot_as_of_incremental(spark, tmp_table):
    t = ChangeTable(spark, tmp_table, SPEC)
    c1 = t.upsert(batch(spark, [(1, 1, "a", "02", "I"), (2, 1, "b", "02", "I"), (2, 2, "b2", "02", "U")]), op_col="Op")
    c2 = t.upsert(batch(spark, [(1, 0, "a2", "03", "U"), (3, 1, "c", "02", "I")]), op_col="Op")
    c3 = t.upsert(batch(spark, [(2, 5, "x", "02", "D")]), op_col="Op")
    assert c1 < c2 < c3
    assert snap(t) == [(1, "a2"), (3, "c")]                     # arrival: newer commit wins even with lower ts
    assert sorted((r.id, r.v) for r in t.as_of(c1).collect()) == [(1, "a"), (2, "b2")]
    assert sorted((r.id, r.v) for r in t.incremental(c1, c2).collect()) == [(1, "a2"), (3, "c")]
    # partition values stay strings with their leading zero (Q4)
    assert sorted({r.p for r in t.read_log().collect()}) == ["02", "03"]
    # a key that moved partition left no copy behind (global scope)
    assert [r.p for r in t.snapshot().where("id = 1").collect()] == ["03"]


def test_replayed_batch_is_a_no_op(spark, tmp_table):                              # C3
    t = ChangeTable(spark, tmp_table, SPEC)
    b = batch(spark, [(1, 1, "a", "x", "I")])
    c1 = t.upsert(b, query_id="q", batch_id=0)
    assert t.upsert(batch(spark, [(1, 9, "other", "x", "U")]), query_id="q", batch_id=0) == c1
    assert len(t.commit_times()) == 1 and snap(t) == [(1, "a")]


def test_uncommitted_partition_is_invisible(spark, tmp_table):
    t = ChangeTable(spark, tmp_table, SPEC)
    t.upsert(batch(spark, [(1, 1, "a", "x", "I")]))
    # data written without its commit row (a crash between the two)
    orphan = R.precombine(R.to_log_rows(batch(spark, [(1, 2, "ghost", "x", "U")]), SPEC), SPEC)
    t._write_log(orphan.withColumn("_commit_time", F.lit("29990101000000000")))
    assert snap(t) == [(1, "a")]


def test_compaction_equals_snapshot(spark, tmp_table):                              # W15
    t = ChangeTable(spark, tmp_table, SPEC.with_(merge="event_time"))
    t.upsert(batch(spark, [(1, 5, "a", "x", "I"), (2, 1, "b", "x", "I")]))
    t.upsert(batch(spark, [(2, 9, "gone", "x", "D")]), op_col="Op")
    before = snap(t)
    t.compact()
    # an older update must not revive the deleted key, a newer one wins
    t.upsert(batch(spark, [(2, 3, "late", "x", "U"), (1, 7, "a2", "x", "U")]), op_col="Op")
    assert before == [(1, "a")]
    assert snap(t) == [(1, "a2")]
    assert sorted((r.id, r.v) for r in R.snapshot(t.read_log(), t.spec).collect()) == snap(t)


def test_bootstrap_reads_source_in_place(spark, tmp_table):                         # W10
    src = f"{tmp_table}-src"
    spark.createDataFrame([(1, 1, "a", "x"), (2, 1, "b", "y")], "id int, ts int, v string, p string").write.parquet(src)
    t = ChangeTable(spark, tmp_table, SPEC)
    c0 = t.bootstrap(src, commit_time="20240101000000000")
    t.upsert(batch(spark, [(2, 2, "b2", "y", "U")]))
    rows = {r.id: r for r in t.snapshot().collect()}
    assert rows[1]._commit_time == c0 and rows[1]._op == "I" and rows[2].v == "b2"


def test_bookmark_and_next_range(spark, tmp_table):                                # R6, Q12
    bm = Bookmark(spark, tmp_table, "c")
    assert bm.get() is None
    commits = ["20240101000000000", "20240102000000000"]
    b, e, nxt = next_range(None, commits, now="20240102001000000", lag_minutes=20)
    assert (b, e, nxt) == ("20240101235000000", "20240102000000000", "20240102000000000")
    bm.set(nxt)
    assert bm.get() == nxt
    assert next_range(nxt, commits, now="20240103000000000")[2] == nxt      # nothing new: unchanged


def test_pins(spark, tmp_table):                                                    # R9
    t = ChangeTable(spark, tmp_table, SPEC)
    with pytest.raises(ValueError):
        t.pin("20240101000000000")                    # nothing to pin yet
    for day in (1, 2):
        t.upsert(batch(spark, [(day, 1, "a", "x", "I")]), commit_time=f"2024010{day}000000000")
        t.pin(f"2024010{day}000000000")
    t.unpin("20240101000000000")
    assert t.pins() == ["20240102000000000"]


def test_register_in_catalog(spark, tmp_table):                                    # W14
    t = ChangeTable(spark, tmp_table, SPEC)
    t.upsert(batch(spark, [(1, 1, "a", "x", "I"), (2, 1, "b", "y", "I")]))
    t.register("test_registered")
    assert sorted(r.p for r in spark.sql("select p from test_registered").collect()) == ["x", "y"]


def test_expire_on_disk_keeps_retained_and_pinned_views(spark, tmp_table):         # R10
    t = ChangeTable(spark, tmp_table, SPEC)
    cs = []
    for k in range(4):
        cs.append(t.upsert(batch(spark, [(i, k, f"{k}-{i}", "x", "U") for i in range(4) if (i + k) % 2 == 0 or k == 3])))
    t.pin(cs[1])
    views = {c: sorted((r.id, r.v) for r in t.as_of(c).collect()) for c in (cs[1], cs[3])}
    n_before = t.read_log().count()
    assert t.expire(retain=1) is not None
    assert t.read_log().count() < n_before
    for c, v in views.items():
        assert sorted((r.id, r.v) for r in t.as_of(c).collect()) == v
    c5 = t.upsert(batch(spark, [(0, 9, "new", "x", "U")]))
    assert c5 > cs[3] and dict(snap(t))[0] == "new"


def test_output_sizing_caps_rows_per_file(spark, tmp_table):                       # W16
    t = ChangeTable(spark, tmp_table, SPEC.with_(target_rows_per_file=10))
    t.upsert(spark.range(95).selectExpr("cast(id as int) id", "1 as ts", "'v' as v", "'x' as p"))
    files = t.read_log().select("_metadata.file_path").distinct().count()
    assert files >= 10


def test_compaction_rewrites_only_touched_partitions(spark, tmp_table):           # W15
    t = ChangeTable(spark, tmp_table, SPEC)
    t.upsert(batch(spark, [(i, 1, f"v{i}", f"p{i % 4}", "I") for i in range(12)]), op_col="Op")
    t.compact()
    # key 1 moves from p1 to p3 (its old copy in p1 must vanish), key 2 updated in p2
    t.upsert(batch(spark, [(1, 2, "moved", "p3", "U"), (2, 2, "upd", "p2", "U")]), op_col="Op")
    expect = snap(t)
    t.compact()
    src = t._manifest(t._base(t.commit_rows()))
    carried = [d for d in src["leaves"] if not d.startswith(src["root"] + "/")]
    assert [d.rsplit("/", 1)[1] for d in carried] == ["p=p0"]          # only p0 untouched
    assert snap(t) == expect
    assert [r.p for r in t.snapshot().where("id = 1").collect()] == ["p3"]
    t.register("test_incremental_base")
    got = sorted((r.id, r.v) for r in spark.sql("select id, v from test_incremental_base").collect())
    assert got == expect


def test_commit_rows_are_folded(spark, tmp_table, monkeypatch):
    from tidemark import files
    from tidemark.operators import table as module

    monkeypatch.setattr(module, "FOLD_AFTER", 3)
    t = ChangeTable(spark, tmp_table, SPEC)
    for k in range(8):
        t.upsert(batch(spark, [(k, 1, "a", "x", "I")]))
        assert len(files.names(spark, f"{tmp_table}/_meta/commits")) <= 3
    assert len(t.commit_times()) == 8 and len(snap(t)) == 8
    assert len(files.names(spark, f"{tmp_table}/_meta/schemas")) == 1          # one schema, stored once
    # a fold that a crash left beside the rows it holds changes nothing
    rows = t.commit_rows()
    files.write_text(spark, f"{tmp_table}/_meta/commits/{rows[2]['commit_time']}.json", json.dumps(rows[2]))
    assert t.commit_rows() == rows


def test_hot_partition_value_is_split_across_writers(spark, tmp_table):
    """A third of the rows share one partition value: AQE's rebalance splits
    that folder's data over several write tasks instead of one."""
    from tidemark.session import scoped_conf

    rows = spark.range(60000).selectExpr(
        "cast(id as int) id", "1 as ts", "repeat('x', 40) as v",
        "case when id % 3 = 0 then 'hot' else concat('p', cast(id % 40 as string)) end as p")
    t = ChangeTable(spark, tmp_table, SPEC.with_(deletes="ignore"))
    with scoped_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        t.upsert(rows)
    files = (t.read_log().where("p = 'hot'").select("_metadata.file_path").distinct().count())
    assert files > 1
    assert t.snapshot().count() == 60000


def test_changes_since_lag_on_disk_uses_commit_metadata(spark, tmp_table):         # R4
    t = ChangeTable(spark, tmp_table, SPEC)
    t.upsert(batch(spark, [(1, 1, "a", "x", "I")]), commit_time="20240101000000000")
    t.upsert(batch(spark, [(2, 1, "b", "x", "I")]), commit_time="20240101010000000")
    t.upsert(batch(spark, [(3, 1, "c", "x", "I")]), commit_time="20240101012000000")
    # now 01:25, lag 20 min -> cutoff 01:05 -> begin = the 01:00 commit
    got = sorted(r.id for r in t.changes_since_lag("20240101012500000", 20).collect())
    assert got == [3]


def rows_of(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_empty_and_rejected_batches_are_commits_without_rows(spark, tmp_table):
    t = ChangeTable(spark, tmp_table, SPEC)
    good = batch(spark, [(1, 1, "a", "x", "I")])
    t.upsert(good.limit(0), op_col="Op")
    assert snap(t) == []
    t.upsert(good, op_col="Op")
    t.upsert(batch(spark, [(None, 1, "n", "x", "I"), (2, 1, "b", "x", "Z")]), op_col="Op")
    t.upsert(spark.createDataFrame([], good.schema), op_col="op")
    assert snap(t) == [(1, "a")]
    assert [(r["num_rows"], r["num_rejected"]) for r in t.commit_rows()] == [(0, 0), (1, 0), (0, 2), (0, 0)]
    with pytest.raises(ValueError):
        t.upsert(good, op_col="operation")
    t.upsert(batch(spark, [(1, 9, "", "x", "d")]), op_col="OP")                # any case of name and value
    assert snap(t) == []


def test_schema_changes(spark, tmp_table):
    t = ChangeTable(spark, tmp_table, TableSpec(keys=("id",), order=("ts",)))
    t.upsert(spark.createDataFrame([(1, 1, 5, "a")], "id int, ts int, n int, v string"))
    t.upsert(spark.createDataFrame([(2, 1, "b")], "id int, ts int, v string"))
    t.upsert(spark.createDataFrame([(3, 1, 1 << 40, 2.5)], "id int, ts int, n bigint, extra double"))
    got = {r.id: (r.n, r.v, r.extra) for r in t.snapshot().collect()}
    assert got == {1: (5, "a", None), 2: (None, "b", None), 3: (1 << 40, None, 2.5)}
    with pytest.raises(ValueError, match="does not fit"):
        t.upsert(spark.createDataFrame([(4, 1, "x")], "id int, ts int, n string"))
    assert len(t.commit_times()) == 3


def test_expired_history_is_refused_and_its_folders_go(spark, tmp_table):
    from tidemark import files

    t = ChangeTable(spark, tmp_table, SPEC)
    cs = [t.upsert(batch(spark, [(i, k, f"{k}", "x", "U") for i in range(4)])) for k in range(4)]
    before = t.show_commits().collect()
    assert [(r.num_inserts, r.num_updates) for r in before] == [(0, 4)] * 3 + [(4, 0)]
    t.pin(cs[1])
    t.expire(retain=1)
    for read in (lambda: t.as_of(cs[0]), lambda: t.as_of(cs[2]), lambda: t.incremental(cs[0], cs[2]), lambda: t.pin(cs[0])):
        with pytest.raises(ValueError, match="expired"):
            read()
    assert rows_of(t.as_of(cs[1])) == [(i, "1") for i in range(4)] and t.show_commits().collect() == before
    assert rows_of(t.incremental(cs[0])) == rows_of(t.snapshot()) == [(i, "3") for i in range(4)]
    assert files.names(spark, t.log_path, prefix="_commit_time=") == [f"_commit_time={cs[3]}"]
    t.upsert(batch(spark, [(0, 9, "new", "x", "U")]))
    t.expire(retain=1)
    assert len(files.names(spark, f"{tmp_table}/expired")) == 1 and dict(snap(t)) == {0: "new", 1: "3", 2: "3", 3: "3"}


@pytest.mark.parametrize("merge", ["arrival", "event_time"])
def test_reads_over_a_base(spark, tmp_table, merge):
    t = ChangeTable(spark, tmp_table, SPEC.with_(merge=merge))
    t.upsert(batch(spark, [(i, 5, f"v{i}", f"p{i % 3}", "I") for i in range(9)]), op_col="Op")
    c2 = t.upsert(batch(spark, [(3, 7, "", "p0", "D")]), op_col="Op")
    t.compact()
    plan = t.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert rows_of(t.snapshot()) == rows_of(R.snapshot(t.read_log(), t.spec))
    t.upsert(batch(spark, [(0, 1, "old", "p9", "U"), (1, 9, "new", "p2", "U"), (3, 6, "back", "p0", "U"), (20, 1, "add", "p1", "U")]), op_col="Op")
    want = rows_of(R.snapshot(t.read_log(), t.spec))
    assert rows_of(t.snapshot()) == want
    plan = t.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    t.compact()
    assert rows_of(t.snapshot()) == want
    assert rows_of(t.as_of(c2)) == rows_of(R.as_of(t.read_log(), t.spec, c2))


def test_replace_ends_what_was_before(spark, tmp_table):                           # W9
    t = ChangeTable(spark, tmp_table, SPEC)
    c1 = t.upsert(batch(spark, [(1, 1, "a", "x", "I"), (2, 1, "b", "x", "I")]))
    t.compact()
    t.upsert(batch(spark, [(3, 1, "c", "x", "I")]), replace=True)
    assert snap(t) == [(3, "c")] and rows_of(t.as_of(c1)) == [(1, "a"), (2, "b")]
    t.upsert(batch(spark, [(1, 1, "again", "x", "I")]))
    t.compact()
    assert snap(t) == [(1, "again"), (3, "c")]
    assert [(r.num_inserts, r.num_updates) for r in t.show_commits().collect()] == [(1, 0), (1, 0), (2, 0)]


def test_null_keys_are_one_rule(spark, tmp_table):                                  # Q20
    src = f"{tmp_table}-src"
    rows = spark.createDataFrame([(1, 1, "a", "x"), (None, 1, "n", "x"), (None, 2, "m", "x")], "id int, ts int, v string, p string")
    rows.write.parquet(src)
    a, b = ChangeTable(spark, f"{tmp_table}/a", SPEC), ChangeTable(spark, f"{tmp_table}/b", SPEC)
    a.bootstrap(src)
    b.upsert(rows)
    assert snap(a) == snap(b) == [(1, "a")]
    assert a.commit_rows()[0]["num_rejected"] == b.commit_rows()[0]["num_rejected"] == 2


def test_derive_moves_the_bookmark_last(spark, tmp_table, monkeypatch):            # R7
    src, out = ChangeTable(spark, f"{tmp_table}/s", SPEC), ChangeTable(spark, f"{tmp_table}/t", SPEC.with_(partitions=()))
    src.upsert(batch(spark, [(1, 1, "a", "x", "I"), (2, 1, "b", "x", "I")]), commit_time="20240101000000000")
    run = lambda: derive(src, out, "c", now="20250101000000000", begin="20230101000000000" if Bookmark(spark, src.path, "c").get() is None else None, deletes=True)
    with monkeypatch.context() as m:
        m.setattr(Bookmark, "set", lambda self, v: (_ for _ in ()).throw(OSError("no space")))
        with pytest.raises(OSError):
            run()
    assert len(out.commit_times()) == 1
    run()                                               # repeats the range: the commit is there already
    assert len(out.commit_times()) == 1 and run() is None
    src.upsert(batch(spark, [(1, 2, "", "x", "D")]), op_col="Op", commit_time="20240102000000000")
    assert run() is not None and snap(out) == [(2, "b")]


def test_registered_name_follows_commits(spark, tmp_table):                         # W14
    t = ChangeTable(spark, f"{tmp_table}/it's", SPEC)
    t.upsert(batch(spark, [(1, 1, "a", "x'y", "I"), (2, 1, "b", None, "I")]))
    t.register("test_follow")
    t.upsert(batch(spark, [(1, 2, "a2", "x'y", "U"), (2, 2, "", None, "D")]), op_col="Op")
    t.register("test_follow")
    assert [(r.id, r.v) for r in spark.sql("select id, v from test_follow").collect()] == [(1, "a2")]
    assert len(spark.sql("show tables like 'test_follow_*'").collect()) == 1


def test_file_size_and_write_width(spark, tmp_table):                               # W16
    rows = spark.range(40_000).selectExpr("cast(id as int) id", "1 as ts", "uuid() as v", "'x' as p")
    files_of = lambda t: t.read_log().select("_metadata.file_path").distinct().count()
    small = ChangeTable(spark, f"{tmp_table}/a", SPEC.with_(target_file_bytes=200_000))
    small.upsert(rows)
    large = ChangeTable(spark, f"{tmp_table}/b", SPEC.with_(target_file_bytes=1 << 30, write_tasks=3))
    large.upsert(rows)
    assert files_of(small) > 3 >= files_of(large)


# ------------------------------------------------ what must outlive expiry
def test_pins_and_replaced_states_survive_trimming(spark, tmp_table):              # R9, R10, W9
    t = ChangeTable(spark, tmp_table, SPEC.with_(history=0))
    cs = [t.upsert(batch(spark, [(i, k, f"{k}", "x", "U") for i in range(3)] + [(10 + k, 1, "own", "x", "I")])) for k in range(3)]
    t.pin(cs[1])
    state = rows_of(t.as_of(cs[1]))
    c4 = t.upsert(batch(spark, [(1, 9, "fresh", "x", "I")]), replace=True)
    cs += [t.upsert(batch(spark, [(k, 9, "later", "x", "I")])) for k in (50, 51, 52)]
    now = rows_of(t.snapshot())
    assert now == [(1, "fresh"), (50, "later"), (51, "later"), (52, "later")]
    for k in range(2):
        t.expire(retain=1)
        assert rows_of(t.snapshot()) == now and rows_of(t.as_of(cs[1])) == state
        for gone in (cs[0], cs[2], c4, cs[3]):
            with pytest.raises(ValueError, match="expired"):
                t.as_of(gone)
        t.upsert(batch(spark, [(60 + k, 1, "z", "x", "I")]))
        now = sorted({*now, (60 + k, "z")})
    t.unpin(cs[1])
    t.expire(retain=1)
    assert rows_of(t.snapshot()) == now
    with pytest.raises(ValueError, match="expired"):
        t.as_of(cs[1])


@pytest.mark.parametrize("merge", ["arrival", "event_time"])
def test_expiry_reads_only_new_commits(spark, tmp_table, monkeypatch, merge):      # R10, R9
    from tidemark import files
    from tidemark.operators import timeline as TL

    read, expire = [], TL.expire

    def noting(log, *args, **named):
        read.append({tuple(f.partition("?")[0].split("/")[-4:-2]) for f in map(unquote, log.inputFiles())})
        return expire(log, *args, **named)

    monkeypatch.setattr(TL, "expire", noting)
    t = ChangeTable(spark, tmp_table, SPEC.with_(merge=merge, history=0))
    first = t.upsert(batch(spark, [(i, 10, "first", "x", "I") for i in range(40)]))
    c1 = t.upsert(batch(spark, [(1, 20, "one", "y", "U"), (2, 5, "late", "x", "U"), (3, 20, "", "x", "D")]), op_col="Op")
    t.expire(retain=1)
    held = files.names(spark, f"{tmp_table}/expired")
    t.pin(c1)
    pinned = rows_of(t.as_of(c1))
    new = t.upsert(batch(spark, [(1, 30, "two", "x", "U"), (50, 1, "new", "x", "I")]))
    last = t.upsert(batch(spark, [(4, 30, "three", "x", "U")]))
    now, since = rows_of(t.snapshot()), rows_of(t.incremental(c1))
    t.expire(retain=1)
    assert len(held) == 1 and files.names(spark, f"{tmp_table}/expired")[0] == held[0] and len(files.names(spark, f"{tmp_table}/expired")) == 2
    assert read[1] == {("log", f"_commit_time={c}") for c in (c1, new, last)}
    assert rows_of(t.snapshot()) == now and rows_of(t.incremental(c1)) == since and rows_of(t.as_of(c1)) == pinned
    for gone in (first, new):
        with pytest.raises(ValueError, match="expired"):
            t.as_of(gone)
    # a pin that is gone frees what was kept for it, and small segments are joined
    t.unpin(c1)
    t.upsert(batch(spark, [(i, 40, "all", "x", "U") for i in range(40)]))
    t.expire(retain=1)
    assert len(files.names(spark, f"{tmp_table}/expired")) == 2 and len({folder for folder, _ in read[2]}) == 2
    t.upsert(batch(spark, [(60, 1, "end", "x", "I")]))
    t.expire(retain=1)
    assert len(files.names(spark, f"{tmp_table}/expired")) == 1
    assert rows_of(t.snapshot()) == sorted([*((i, "all") for i in range(40)), (50, "new"), (60, "end")])
    assert t.read_log().count() == 42                               # joined: one row for each key
    with pytest.raises(ValueError, match="expired"):
        t.as_of(c1)


def test_a_replayed_batch_is_known_after_expiry(spark, tmp_table):                  # C3
    t = ChangeTable(spark, tmp_table, SPEC.with_(history=0))
    c = t.upsert(batch(spark, [(1, 1, "a", "x", "I")]), query_id="q", batch_id=4)
    for k in range(3):
        t.upsert(batch(spark, [(2, k, "b", "x", "I")]))
    t.expire(retain=1)
    assert t.upsert(batch(spark, [(1, 9, "again", "x", "I")]), query_id="q", batch_id=4) == c
    assert snap(t) == [(1, "a"), (2, "b")]


# ------------------------------------------------------------- catalog
def test_only_own_tables_are_dropped(spark, tmp_table):                             # W14
    spark.sql("CREATE TABLE trades_2023 (a int) USING parquet")
    spark.sql("INSERT INTO trades_2023 VALUES (1)")
    t = ChangeTable(spark, f"{tmp_table}/a", SPEC)
    t.upsert(batch(spark, [(1, 1, "a", "x", "I")]))
    t.register("trades")
    other = ChangeTable(spark, f"{tmp_table}/b", SPEC)
    other.upsert(batch(spark, [(7, 1, "o", "x", "I")]))
    other.register("trades_20")
    t.upsert(batch(spark, [(2, 1, "b", "y", "I")]))                                 # no call to register
    assert sorted(r.id for r in spark.sql("select id from trades").collect()) == [1, 2]
    assert [r.id for r in spark.sql("select id from trades_20").collect()] == [7]
    assert [r.a for r in spark.sql("select a from trades_2023").collect()] == [1]
    t.unregister("trades")
    t.upsert(batch(spark, [(3, 1, "c", "y", "I")]))
    assert spark.sql("select id from trades").count() == 2
    spark.sql("DROP TABLE trades_2023")


# ------------------------------------------------------------- keys
def test_composite_keys_are_injective(spark, tmp_table):                            # P10
    spec = TableSpec(keys=("a", "b"), order=("n",))
    rows = [("x#y", "z"), ("x", "y#z"), ("x\\", "#z"), ("x", "\\#z"), ("x\\#", "z"), ("", "#"), ("#", ""), ("x", "z")]
    t = ChangeTable(spark, tmp_table, spec)
    t.upsert(spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(rows)], "a string, b string, n int"))
    got = {(r.a, r.b): r._record_key for r in t.snapshot().collect()}
    assert len(got) == len(set(got.values())) == len(rows) and got[("x", "z")] == "x#z"


# ------------------------------------------------------------- buckets
@pytest.mark.parametrize("merge", ["arrival", "event_time"])
def test_buckets_give_the_same_table(spark, tmp_table, merge):                      # W2, W15
    plain = ChangeTable(spark, f"{tmp_table}/a", SPEC.with_(merge=merge))
    tables = [plain, ChangeTable(spark, f"{tmp_table}/b", SPEC.with_(merge=merge, buckets=5))]
    batches = [[(i, 5, f"v{i}", f"p{i % 3}", "I") for i in range(20)], [(3, 7, "", "p0", "D"), (4, 6, "u", "p9", "U")],
               [(3, 6, "back", "p0", "U"), (30, 1, "new", "p1", "U")], [(3, 9, "again", "p1", "U"), (0, 1, "old", "p0", "U")]]
    for t in tables:
        for k, rows in enumerate(batches):
            t.upsert(batch(spark, rows), op_col="Op", commit_time=f"2024010{k + 1}000000000")
            if k in (0, 2):
                t.compact(f"2024010{k + 1}120000000")
    a, b = tables
    assert rows_of(a.snapshot()) == rows_of(b.snapshot()) == rows_of(R.snapshot(a.read_log(), a.spec))
    assert a.show_commits().collect() == b.show_commits().collect()
    assert [(r.num_inserts, r.num_updates, r.num_deletes) for r in a.show_commits().collect()] == [(0, 2, 0), (1, 1, 0), (0, 1, 1), (20, 0, 0)]
    assert rows_of(a.incremental("20240102000000000", "20240103000000000")) == rows_of(b.incremental("20240102000000000", "20240103000000000"))
    b.expire(retain=1)
    assert rows_of(a.snapshot()) == rows_of(b.snapshot())


def test_an_upsert_reads_only_its_buckets(spark, tmp_table):                        # W2, R8
    t = ChangeTable(spark, tmp_table, SPEC.with_(buckets=16))
    t.upsert(batch(spark, [(i, 1, "v", "x", "I") for i in range(400)]))
    c2 = t.upsert(batch(spark, [(i, 2, "w", "x", "U") for i in range(0, 400, 3)]))
    t.compact()
    c3 = t.upsert(batch(spark, [(7, 3, "five", "x", "U"), (1000, 1, "new", "x", "I")]))
    rows = [r for r in t.commit_rows() if r["commit_time"] < c3]
    buckets = t._buckets_of(c3)
    assert 1 <= len(buckets) <= 2
    known = t.known_keys(rows, t.schema(), buckets)
    paths = {p.split("/_bucket=")[1].split("/")[0] for p in known.inputFiles()}
    assert paths == set(buckets) and not any("_commit_time=" in p for p in known.inputFiles())     # the base alone, no older log
    assert [(r.num_inserts, r.num_updates) for r in t.show_commits(1).collect()] == [(1, 1)] and c2 < c3
    old = t._base(t.commit_rows())
    t.compact()
    new = t._base(t.commit_rows())
    rewritten = set(t._leaves(new)) - set(t._leaves(old))
    assert {p.split("/_bucket=")[1].split("/")[0] for p in rewritten} == set(buckets)


# ------------------------------------------------------------- joins of base and tail
@pytest.mark.parametrize("merge", ["arrival", "event_time"])
def test_a_large_tail_is_sorted_and_merged(spark, tmp_table, merge):                # R1, W15
    from tidemark.session import scoped_conf

    t = ChangeTable(spark, tmp_table, SPEC.with_(merge=merge, count_inserts=False))
    t.upsert(spark.range(30_000).selectExpr("cast(id as int) id", "1 as ts", "'base' as v", "cast(id % 3 as string) as p", "'I' as Op"), op_col="Op")
    t.compact()
    # one key in a third of the rows, commit after commit
    for k in range(2, 5):
        t.upsert(spark.range(9_000).selectExpr("cast(if(id % 3 = 0, 1, id + 20000) as int) id", f"{k} as ts", f"'t{k}' as v", "'0' as p", "'U' as Op"), op_col="Op")
    want = rows_of(R.snapshot(t.read_log(), t.spec))
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "1k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1k"}):
        s = t.snapshot()
        got = rows_of(s)
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" not in plan and "SortMergeJoin" in plan and "WindowGroupLimit" in plan
        t.compact()
    assert got == want == rows_of(t.snapshot())


def test_event_time_increments_compare_only_touched_keys(spark, tmp_table):         # R2, W7
    t = ChangeTable(spark, tmp_table, SPEC.with_(merge="event_time"))
    t.upsert(batch(spark, [(i, 5, f"v{i}", "x", "I") for i in range(50)]), op_col="Op", commit_time="20240101000000000")
    t.upsert(batch(spark, [(1, 9, "high", "x", "U"), (2, 9, "", "x", "D")]), op_col="Op", commit_time="20240102000000000")
    t.upsert(batch(spark, [(1, 7, "low", "x", "U"), (2, 8, "low", "x", "U"), (3, 6, "up", "x", "U"), (4, 1, "old", "x", "U"), (90, 1, "new", "x", "I")]),
             op_col="Op", commit_time="20240103000000000")
    t.upsert(batch(spark, [(5, 6, "", "x", "D"), (6, 7, "six", "x", "U")]), op_col="Op", commit_time="20240104000000000")
    for begin, end in ((None, None), ("20240101000000000", None), ("20240102000000000", "20240103000000000"), ("20240103000000000", None), ("20240102000000000", "20240102000000000")):
        want = rows_of(R.incremental(t.read_log(), t.spec, begin, end))
        assert rows_of(t.incremental(begin, end)) == want
    assert rows_of(t.incremental("20240102000000000", "20240103000000000")) == [(3, "up"), (90, "new")]
    plan = t.incremental("20240102000000000", "20240103000000000")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    t.compact("20240104120000000")
    t.upsert(batch(spark, [(1, 8, "mid", "x", "U"), (7, 6, "seven", "x", "U")]), op_col="Op", commit_time="20240105000000000")
    assert rows_of(t.incremental("20240104120000000")) == [(7, "seven")]
    t.upsert(batch(spark, [(8, 1, "only", "x", "I")]), replace=True, commit_time="20240106000000000")
    assert rows_of(t.incremental("20240105000000000")) == rows_of(t.snapshot()) == [(8, "only")]


# ------------------------------------------------------------- clustered output
def test_a_point_read_of_a_clustered_base_needs_one_file(spark, tmp_table):         # W16
    t = ChangeTable(spark, tmp_table, SPEC.with_(clustered=True, target_rows_per_file=500, write_tasks=4))
    t.upsert(spark.range(6000).selectExpr("cast(id as int) id", "1 as ts", "uuid() as v", "if(id % 3 = 0, 'cold', 'hot') as p"))
    t.compact()
    files = t.snapshot().groupBy("p", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"), F.min("_record_key").alias("a"), F.max("_record_key").alias("b")).collect()
    assert max(r.n for r in files) <= 500 and len(files) >= 12
    for p, key in (("hot", "4000"), ("cold", "3")):
        assert sum(r.p == p and r.a <= key <= r.b for r in files) == 1
    point = t.snapshot().where("_record_key = '4000' and p = 'hot'")
    assert "EqualTo(_record_key,4000)" in spark._jvm.PythonSQLUtils.explainString(point._jdf.queryExecution(), "formatted")
    assert [r.id for r in point.collect()] == [4000]


def test_commit_positions_come_from_commit_rows(spark, tmp_table):                  # R5
    t = ChangeTable(spark, tmp_table, SPEC)
    for k in (1, 2, 3):
        t.upsert(batch(spark, [(k, 1, "a", "x", "I")]), commit_time=f"2024010{k}000000000")
    assert t.commit_min_recent("20240101000000000").first()[0] == "20240102000000000"
    assert t.commit_min_recent("20250101000000000").first()[0] is None
    assert t.commit_nth_last(3).first()[0] == "20240101000000000" and t.commit_nth_last(4).count() == 0


# ------------------------------------------------------------- shuffles of large tables
def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


@pytest.fixture()
def hints(monkeypatch):
    """The names of the hints that writes have given."""
    from pyspark.sql.classic.dataframe import DataFrame

    given, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda self, name, *a: given.append(name) or hint(self, name, *a))
    return given


def test_a_large_event_time_tail_is_one_pass(spark, tmp_table, monkeypatch):        # W15, W7
    from tidemark.operators import table as module
    from tidemark.session import scoped_conf

    monkeypatch.setattr(module, "LARGE_ROWS", 5)
    t = ChangeTable(spark, tmp_table, SPEC.with_(merge="event_time"))
    t.upsert(batch(spark, [(i, 5, f"v{i}", f"p{i % 3}", "I") for i in range(30)]), op_col="Op")
    t.compact()
    t.upsert(batch(spark, [(i, 4 + i % 3, f"w{i}", f"p{i % 2}", "D" if i % 5 == 0 else "U") for i in range(12)] + [(90, 1, "n", "p9", "I")]), op_col="Op")
    want = rows_of(R.snapshot(t.read_log(), t.spec))
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert exchanges(t.snapshot()) == 1 and rows_of(t.snapshot()) == want
        t.compact()
    assert rows_of(t.snapshot()) == want


@pytest.mark.parametrize("merge", ["arrival", "event_time"])
def test_one_commit_is_its_own_reduction(spark, tmp_table, merge):                  # R1
    t = ChangeTable(spark, tmp_table, SPEC.with_(merge=merge))
    t.upsert(batch(spark, [(i % 4, i, f"v{i}", "x", "U") for i in range(9)] + [(7, 1, "", "x", "D")]), op_col="Op")
    assert exchanges(t.snapshot()) == 0 and rows_of(t.snapshot()) == rows_of(R.snapshot(t.read_log(), t.spec))
    t.upsert(batch(spark, [(1, 2, "low", "y", "U"), (2, 99, "", "x", "D"), (7, 0, "late", "x", "U")]), op_col="Op")
    assert rows_of(t.snapshot()) == rows_of(R.snapshot(t.read_log(), t.spec))
    t.expire(retain=1)
    t.upsert(batch(spark, [(1, 50, "top", "x", "U")]), op_col="Op")
    assert rows_of(t.snapshot()) == rows_of(R.snapshot(t.read_log(), t.spec))


@pytest.mark.parametrize("buckets", [0, 2])
def test_a_large_commit_of_few_folders_is_shuffled_once(spark, tmp_table, monkeypatch, hints, buckets):  # W2, W16
    from tidemark.operators import table as module

    monkeypatch.setattr(module, "LARGE_ROWS", 5)
    t = ChangeTable(spark, tmp_table, SPEC.with_(history=0, buckets=buckets))
    rows = lambda k: batch(spark, [(i, k, f"{k}", f"p{(i + k) % 3}", "U") for i in range(20 + k)])
    for k in range(3):
        t.upsert(rows(k))
        assert hints == ["rebalance"]                                  # the first commit knows no folders
    t.expire(retain=1)
    t.compact()
    assert hints == ["rebalance"] and rows_of(t.snapshot()) == sorted((i, "2") for i in range(22))
    assert [(r.num_rows, r.num_inserts) for r in t.show_commits().collect()] == [(22, 1), (21, 1)][: len(t.show_commits().collect())]
    monkeypatch.setattr(module, "FEW_FOLDERS", 2)
    t.upsert(rows(3))
    assert hints == ["rebalance"] * 2


def test_expiry_takes_only_keys_of_the_retained_commit(spark, tmp_table, monkeypatch):  # R10
    from tidemark.operators import timeline as TL

    seen, expire = [], TL.expire
    monkeypatch.setattr(TL, "expire", lambda log, *a, **b: seen.append({(r["_commit_time"], r.v) for r in log.select("_commit_time", "v").collect()}) or expire(log, *a, **b))
    for merge in ("arrival", "event_time"):
        t = ChangeTable(spark, f"{tmp_table}/{merge}", SPEC.with_(merge=merge))
        cs = [t.upsert(batch(spark, [(i, 5 - k, f"{k}", f"p{k}", "U") for i in range(k, 6)])) for k in range(3)]
        t.pin(cs[0])
        now, then = rows_of(t.snapshot()), rows_of(t.as_of(cs[0]))
        t.expire(retain=1)
        assert seen.pop() == {(cs[0], "0"), (cs[1], "1"), (cs[2], None)}
        assert rows_of(t.snapshot()) == now and rows_of(t.as_of(cs[0])) == then


def test_a_null_partition_value_is_a_key_as_well(spark, tmp_table):                 # W4
    t = ChangeTable(spark, tmp_table, SPEC.with_(key_scope="partition"))
    t.upsert(batch(spark, [(1, 1, "old", None, "I"), (1, 1, "x", "x", "I")]))
    t.compact()
    t.upsert(batch(spark, [(1, 2, "new", None, "U")]))
    assert rows_of(t.snapshot()) == [(1, "new"), (1, "x")]
    t.upsert(batch(spark, [(1, 3, "newest", None, "U")]))
    assert rows_of(t.snapshot()) == [(1, "newest"), (1, "x")]


def test_a_large_event_time_range_is_one_pass(spark, tmp_table, monkeypatch):       # R2, W7
    from tidemark.operators import table as module
    from tidemark.session import scoped_conf

    t = ChangeTable(spark, tmp_table, SPEC.with_(merge="event_time"))
    c0 = t.upsert(batch(spark, [(i, 5, f"v{i}", f"p{i % 3}", "I") for i in range(30)]), op_col="Op", commit_time="20240101000000000")
    t.compact("20240101120000000")
    t.upsert(batch(spark, [(i, 4 + i % 3, f"w{i}", f"p{i % 2}", "D" if i % 5 == 0 else "U") for i in range(12)]), op_col="Op", commit_time="20240102000000000")
    t.upsert(batch(spark, [(i, 6, f"x{i}", "p1", "U") for i in range(6, 16)] + [(90, 1, "n", "p9", "I")]), op_col="Op", commit_time="20240103000000000")
    want = rows_of(R.incremental(t.read_log(), t.spec, c0))
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert rows_of(t.incremental("20240101120000000")) == want
        monkeypatch.setattr(module, "LARGE_ROWS", 5)
        assert exchanges(t.incremental("20240101120000000")) == 1 and rows_of(t.incremental("20240101120000000")) == want


def test_a_large_clustered_base_is_shuffled_once(spark, tmp_table, monkeypatch):    # W15, W16
    from pyspark.sql.classic.dataframe import DataFrame

    from tidemark.operators import table as module

    dealt, by_range, write = [], DataFrame.repartitionByRange, ChangeTable._write
    written = []
    monkeypatch.setattr(module, "LARGE_ROWS", 5)
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda self, *by: dealt.append(by) or by_range(self, *by))
    monkeypatch.setattr(ChangeTable, "_write", lambda self, df, *a, **b: written.append(exchanges(df)) or write(self, df, *a, **b))
    t = ChangeTable(spark, tmp_table, SPEC.with_(clustered=True, target_rows_per_file=50))
    rows = lambda k: spark.range(k, 700 + 9 * k).selectExpr("cast(id as int) id", f"{k} as ts", f"'{k}' as v", "concat('p', id % 3) as p", f"if(id % 7 = {k}, 'D', 'U') as Op")
    for k in range(3):
        t.upsert(rows(k), op_col="Op")
    want = rows_of(R.snapshot(t.read_log(), t.spec))
    assert t._few_folders(t.commit_rows())
    dealt.clear()
    t.compact()
    assert dealt == [("_record_key",)] and written[-1] == 0 and rows_of(t.snapshot()) == want
    files = t.snapshot().groupBy("p", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"), F.min("_record_key").alias("a"), F.max("_record_key").alias("b")).collect()
    assert max(r.n for r in files) <= 50
    for p in ("p0", "p1", "p2"):
        ranges = sorted((r.a, r.b) for r in files if r.p == p)
        assert len(ranges) > 3 and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))


def test_files_are_written_with_the_codec(spark, tmp_table):                        # W16
    import pyarrow.parquet as pq

    for codec in ("zstd", "snappy"):
        t = ChangeTable(spark, f"{tmp_table}/{codec}", SPEC.with_(codec=codec) if codec != "zstd" else SPEC)
        t.upsert(batch(spark, [(1, 1, "a", "x", "I")]))
        t.compact()
        for df in (t.read_log(), t.snapshot()):
            assert pq.ParquetFile(df.inputFiles()[0].removeprefix("file://")).metadata.row_group(0).column(0).compression == codec.upper()


@pytest.mark.parametrize("spec", [SPEC, SPEC.with_(buckets=2), SPEC.with_(key_scope="partition")], ids=["plain", "buckets", "partition"])
def test_rows_without_a_key_in_a_large_tail_are_not_shuffled(spark, tmp_table, monkeypatch, spec):  # W2, W15, R1
    from pyspark.sql.classic.dataframe import DataFrame

    from tidemark.operators import table as module

    met, join = [], DataFrame.join

    def joined(self, other, on=None, how=None):
        if how in ("left_anti", "left_semi"):
            met.append(self.count())
        return join(self, other, on=on, how=how)

    rows = lambda lo, hi, k: spark.range(lo, hi).selectExpr("cast(id as int) id", f"{k} as ts", f"'{k}-' || id as v",
                                                             f"if(id % 11 = 0, null, concat('p', (id + {k}) % 3)) as p", f"if(id % 7 = {k}, 'D', 'U') as Op")
    monkeypatch.setattr(module, "LARGE_ROWS", 5)
    t = ChangeTable(spark, tmp_table, spec)
    t.upsert(rows(0, 3000, 0), op_col="Op")
    monkeypatch.setattr(DataFrame, "join", joined)
    t.upsert(rows(2900, 3050, 1), op_col="Op")                          # counts
    t.compact()                                                       # two commits
    t.upsert(rows(2950, 3100, 2), op_col="Op")
    t.upsert(rows(100, 140, 3), op_col="Op")
    want = rows_of(R.snapshot(t.read_log(), t.spec))
    assert rows_of(t.snapshot()) == want                              # a base and a tail of two
    t.compact()
    assert rows_of(t.snapshot()) == want and met and max(met) < 1000
    known, told = set(), []
    for c in t.commit_times():
        own = {tuple(r) + (r["_op"],) for r in t.read_log(upto=c).where(F.col("_commit_time") == c).select(*spec.key_columns, "_op").collect()}
        if spec.key_scope == "global":
            told.append((len(own), sum(r[-1] != "D" and r[:1] not in known for r in own)))
        known |= {r[: len(spec.key_columns)] for r in own}
    if told:
        assert [(r["num_rows"], r["num_inserts"]) for r in t.commit_rows() if r["kind"] == "upsert"] == told


@pytest.mark.parametrize("spec", [SPEC, SPEC.with_(buckets=2), SPEC.with_(key_scope="partition")], ids=["plain", "buckets", "partition"])
def test_of_several_large_commits_only_superseded_rows_are_shuffled(spark, tmp_table, monkeypatch, spec):  # R1, W15
    from pyspark.sql.classic.dataframe import DataFrame

    from tidemark.operators import table as module

    met, join, whole, snapshot = [], DataFrame.join, [], R.snapshot

    def joined(self, other, on=None, how=None):
        if how in ("left_anti", "left_semi"):
            met.append(self.count())
        return join(self, other, on=on, how=how)

    rows = lambda lo, hi, k: spark.range(lo, hi).selectExpr("cast(id as int) id", f"{9 - k} as ts", f"'{k}-' || id as v",
                                                             f"if(id % 11 = 0, null, concat('p', (id + {k}) % 3)) as p", f"if(id % 7 = {k}, 'D', 'U') as Op")
    t = ChangeTable(spark, tmp_table, spec.with_(count_inserts=False))
    cs = [t.upsert(rows(lo, lo + 1000, k), op_col="Op") for k, lo in enumerate((0, 900, 1800, 950))]
    want = [rows_of(R.snapshot(t.read_log(upto=c), t.spec)) for c in cs]
    with monkeypatch.context() as m:
        m.setattr(module, "LARGE_ROWS", 5)
        m.setattr(DataFrame, "join", joined)
        m.setattr(R, "snapshot", lambda *a, **kw: whole.append(a) or snapshot(*a, **kw))
        assert rows_of(t.snapshot()) == want[3] and rows_of(t.as_of(cs[2])) == want[2]
        t.compact()
        assert not whole and met and max(met) < 2000          # of 3,000 older rows, a newer commit has the keys of 1,200
        assert rows_of(t.snapshot()) == want[3]
        for k, lo in enumerate((2700, 2000, 500, 2710)):
            t.upsert(rows(lo, lo + 400, k), op_col="Op")
        now = rows_of(snapshot(t.read_log(), t.spec))
        assert rows_of(t.snapshot()) == now                  # a base and a tail of four
        t.compact()
        assert rows_of(t.snapshot()) == now and not whole
    t.expire(retain=1)
    monkeypatch.setattr(module, "LARGE_ROWS", 5)
    assert rows_of(t.snapshot()) == now


def test_superseded_versions_are_all_but_the_newest_of_a_key(spark):               # R1
    log = spark.range(60).selectExpr("cast(id % 20 as string) as _record_key", "if(id % 5 = 0, null, id % 2) as p",
                                     "concat('2024010', cast(id / 20 as int) + 1, '000000000') as _commit_time")
    for spec in (SPEC, SPEC.with_(key_scope="partition")):
        keys = [*spec.key_columns, "_commit_time"]
        newest = log.groupBy(*spec.key_columns).agg(F.max("_commit_time").alias("_commit_time")).select(*keys)
        assert sorted(map(str, R.superseded(log, spec).collect())) == sorted(map(str, log.select(*keys).exceptAll(newest).collect()))


def test_marks_hold_every_key_and_few_others(spark):                                # W15
    keys = spark.range(20_000).selectExpr("cast(id as string) as _record_key", "if(id % 5 = 0, null, id % 3) as p")
    other = spark.range(20_000, 40_000).selectExpr("cast(id as string) as _record_key", "id % 3 as p")
    for cols in (["_record_key"], ["p", "_record_key"]):
        bits = R.mark_bits(20_000)
        marks = R.key_marks(keys, cols, bits)
        may, clear = R.marked(keys.unionByName(other), marks, cols, bits)
        assert may.columns == ["_record_key", "p"] and clear.where("_record_key < 20000").count() == 0
        n = clear.count()
        assert n > 15_000 and may.count() == 40_000 - n
    assert R.marked(other, R.key_marks(keys.limit(0), cols, bits), cols, bits)[1].count() == 20_000
    assert R.mark_bits(1 << 27) == 1 << 28 and R.mark_bits((1 << 27) + 1) == 0
