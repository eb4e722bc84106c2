"""Benchmark: headline change-log queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Input tables are first rewritten into as many files as there are cores, and the
on-disk table (four commits) is built once; neither is timed. Each query runs
once to warm up, then twice timed; the faster of the two counts. Results go to
a ``noop`` sink, so every row is computed and nothing is collected. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators.table import ChangeTable  # noqa: E402
from tidemark.plans import catalog_files as CF  # noqa: E402
from tidemark.plans import registry  # noqa: E402
from tidemark.session import build_session, scratch_dir  # noqa: E402

HEADLINE = [
    "newest_per_key",
    "trade_normalise",      # decode + normalise (P1-P13)
    "cdc_normalise",        # envelope decode + part join (P3, P8-P16)
    "precombine",           # in-batch newest per key (W1)
    "snapshot_read",        # current state (R1)
    "merge_event_time",     # event-time merge (W7)
    "as_of",                # time travel (R3)
    "incremental_read",     # changes in a commit range (R2)
    "show_commits",         # commit timeline (R8)
    "expire_commits",       # cleaner (R10)
    "upsert_merge",         # copy-on-write merge (W2)
    "compact_equals_snapshot",  # log writes + compaction (W2, W15)
    "upsert_deletes",       # streamed change files, four micro-batches (S5, W3, W5)
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    best = float("inf")
    for k in range(3):
        t = time.perf_counter()
        fn()
        best = best if k == 0 else min(best, time.perf_counter() - t)
    return round(best, 3)


def split_input(spark, sf: str, cpus: int) -> str:
    out = scratch_dir(spark, "bench-input")
    for name in ("lineitem", "part", "orders", "events"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(cpus).write.parquet(f"{out}/{name}.parquet")
    return out


def on_disk(spark, sf: str) -> dict:
    """Reads of one table of four commits, and copies of it that are compacted and expired."""
    table = CF._lineitem_table(spark, sf, "bench")
    c = table.commit_times()
    base = CF._lineitem_table(spark, sf, "bench-base")
    base.compact()
    fresh = lambda name: CF._lineitem_table(spark, sf, name)
    out = {
        "disk_snapshot": timed(lambda: noop(table.snapshot())),
        "disk_snapshot_compacted": timed(lambda: noop(base.snapshot())),
        "disk_incremental_one_commit": timed(lambda: noop(table.incremental(c[2], c[3]))),
        "disk_as_of_second": timed(lambda: noop(table.as_of(c[1]))),
        "disk_show_commits": timed(lambda: noop(table.show_commits())),
    }
    for name, act in (("disk_compact", ChangeTable.compact), ("disk_expire", lambda t: t.expire(retain=1))):
        tables = [fresh(f"bench-{name}-{k}") for k in range(2)]
        times = []
        for t in tables:
            began = time.perf_counter()
            act(t)
            times.append(time.perf_counter() - began)
        out[name] = round(min(times), 3)
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="tidemark-bench",
                          extra={"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    registry.load_all()
    data = split_input(spark, sf, int(cpus))
    times = {}
    for name in names:
        times[name] = timed(lambda: noop(registry.QUERIES[name](spark, data)))
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        times |= on_disk(spark, data)
    sf_label = sf.rsplit("sf", 1)[-1] if "sf" in sf else sf
    print(json.dumps({
        "metric": "total_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_label,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
