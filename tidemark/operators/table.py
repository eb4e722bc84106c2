"""A keyed table kept as a change log on Parquet.

Layout under the table path::

    log/_commit_time=<t>/[_bucket=<b>/]<partition>=<v>/part-*.parquet   the rows of one commit
    base/<t>/[_bucket=<b>/]<partition>=<v>/part-*.parquet               compactions: one row per key
    expired/<t>/_commit_time=<c>/...                      versions that expiry kept, in segments
    _meta/commits/                                        commit rows, one small file each, folded now and then
    _meta/schemas/<t>.json, _meta/bases/<t>.json          written once, named by commit rows
    _meta/pins/<t>, _meta/catalog/<name>, _meta/bookmarks/<consumer>.json

A commit counts once its row exists; the row is written after the data, so a
crash between the two leaves an invisible folder, and a replay of the same
(query, batch) finds its row and does nothing. Readers open only the folders
of committed instants. One writer per table (stated limit).
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import and_
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files
from tidemark.functions.instants import commit_cutoff, format_instant, normalize_instant, now_instant, parse_instant
from tidemark.operators import reduce as R
from tidemark.operators import timeline as TL
from tidemark.schemas import merged, shaped
from tidemark.session import AQE_WRITE_CONF, WRITE_CONF, scoped_conf
from tidemark.spec import BUCKET, COMMIT, FILE_SEQ, KEY, OP, SYSTEM_COLUMNS, TableSpec

COMMIT_SCHEMA = (
    "commit_time string, kind string, query_id string, batch_id long, num_rows long, num_inserts long, num_updates long, "
    "num_deletes long, num_rejected long, source string, upto string, schema_id string, written_at string"
)
COMMIT_FIELDS = [c.split()[0] for c in COMMIT_SCHEMA.split(", ")]
DATA_KINDS = ("upsert", "replace", "bootstrap")

#: Commit rows are folded into one file once so many single files have come since the last fold.
FOLD_AFTER = 100
#: From so many rows on, a commit or a tail counts as large: its keys are too many to broadcast.
LARGE_ROWS = 500_000
#: Up to so many folders, the tasks of a large commit that hold its rows by key write them themselves.
FEW_FOLDERS = 32
#: Table properties by which this library knows the tables it made in the catalog.
MADE_FOR = "tidemark.table"


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


class ChangeTable:
    """Upserts append commits to a log; reads reduce it."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec

    # ---------------------------------------------------------------- metadata
    @property
    def log_path(self) -> str:
        return f"{self.path}/log"

    def _meta(self, *parts: str) -> str:
        return "/".join([self.path, "_meta", *parts])

    def commit_dir(self, t: str) -> str:
        return f"{self.log_path}/{COMMIT}={t}"

    def commit_rows(self) -> list[dict]:
        """Commit rows, oldest first. Metadata only; ``expire`` bounds their number."""
        names = files.names(self.spark, self._meta("commits"))
        folds = [n for n in names if n.startswith("fold-")]
        # rows that a fold holds may still be there as single files: same commit, same row
        wanted = folds[-1:] + [n for n in names if not n.startswith("fold-")]
        if not wanted:
            return []
        rows = self.spark.read.schema(COMMIT_SCHEMA).json([self._meta("commits", n) for n in wanted]).collect()
        return sorted({r["commit_time"]: r.asDict() for r in rows}.values(), key=lambda r: r["commit_time"])

    def _add_row(self, **row) -> None:
        row = {k: row.get(k) for k in COMMIT_FIELDS} | {"written_at": _stamp()}
        files.write_text(self.spark, self._meta("commits", f"{row['commit_time']}.json"), json.dumps(row) + "\n")
        names = files.names(self.spark, self._meta("commits"))
        if sum(not n.startswith("fold-") for n in names) >= FOLD_AFTER:
            self.fold(self.commit_rows())

    def fold(self, rows: list[dict]) -> None:
        """Keep ``rows`` as one file. Single files go only once it is there."""
        before = files.names(self.spark, self._meta("commits"))
        name = f"fold-{_stamp()}.json".replace(":", "")
        files.write_text(self.spark, self._meta("commits", name), "".join(json.dumps(r) + "\n" for r in rows))
        for n in before:
            files.delete(self.spark, self._meta("commits", n))

    def commits(self) -> DataFrame:
        return self._frame(self.commit_rows(), COMMIT_FIELDS)

    def _frame(self, rows: list[dict], fields: list[str]) -> DataFrame:
        schema = ", ".join(c for c in COMMIT_SCHEMA.split(", ") if c.split()[0] in fields)
        fields = [c.split()[0] for c in schema.split(", ")]
        return self.spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], schema)

    def commit_times(self, rows: list[dict] | None = None) -> list[str]:
        """Instants of data commits that can still be read, oldest first."""
        rows = self.commit_rows() if rows is None else rows
        gone = self._horizon(rows)
        return [r["commit_time"] for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] > gone]

    def commit_list(self, since: str | None = None) -> DataFrame:
        """R5 from the commit rows: data commits after ``since``, newest first."""
        since = normalize_instant(since) if since else ""
        rows = [r for r in reversed(self.commit_rows()) if r["kind"] in DATA_KINDS and r["commit_time"] > since]
        return self._frame(rows, ["commit_time"])

    def commit_min_recent(self, since: str) -> DataFrame:
        """R5 from the commit rows: the oldest data commit after ``since`` (one row, null if none)."""
        since = normalize_instant(since)
        times = [r["commit_time"] for r in self.commit_rows() if r["kind"] in DATA_KINDS and r["commit_time"] > since]
        return self.spark.createDataFrame([(times[0] if times else None,)], "commit_time string")

    def commit_nth_last(self, n: int = 2) -> DataFrame:
        """R5 from the commit rows: the n-th data commit from the end (no row if there are fewer)."""
        rows = [r for r in reversed(self.commit_rows()) if r["kind"] in DATA_KINDS]
        return self._frame(rows[n - 1 : n], ["commit_time"])

    def max_commit(self) -> DataFrame:
        """P18 from the commit rows (one row; null for an empty table)."""
        return self.spark.createDataFrame([((self.commit_times() or [None])[-1],)], "max_commit string")

    def show_commits(self, n: int = 10) -> DataFrame:
        """R8 from the commit rows: what each commit wrote, newest first."""
        rows = [r for r in reversed(self.commit_rows()) if r["kind"] in DATA_KINDS][:n]
        return self._frame(rows, ["commit_time", "num_rows", "num_inserts", "num_updates", "num_deletes"])

    def schema(self, rows: list[dict] | None = None) -> T.StructType | None:
        for r in reversed(self.commit_rows() if rows is None else rows):
            if r["schema_id"]:
                return T.StructType.fromJson(json.loads(files.read_text(self.spark, self._meta("schemas", f"{r['schema_id']}.json"))))
        return None

    def _schema_id(self, t: str, rows: list[dict], schema: T.StructType) -> str:
        """The id of the stored schema; a new one is stored only when it changed."""
        last = next((r["schema_id"] for r in reversed(rows) if r["schema_id"]), None)
        if last and self.schema(rows) == schema:
            return last
        files.write_text(self.spark, self._meta("schemas", f"{t}.json"), json.dumps(schema.jsonValue()))
        return t

    def _next_instant(self, wanted: str | None, rows: list[dict]) -> str:
        """A fresh instant strictly after the last commit."""
        t = normalize_instant(wanted) if wanted else now_instant()
        last = rows[-1]["commit_time"] if rows else ""
        if t <= last:
            if wanted:
                raise ValueError(f"commit {t} is not after the last commit {last}")
            t = format_instant(parse_instant(last) + timedelta(milliseconds=1))
        return t

    @staticmethod
    def _horizon(rows: list[dict]) -> str:
        """The last commit whose versions expiry has thinned out."""
        return max((r["upto"] for r in rows if r["kind"] == "expire"), default="")

    @staticmethod
    def _segments(rows: list[dict]) -> list[dict]:
        """Folders of versions that expiry kept, oldest first: each holds what is left of the commits
        after the one before it up to its ``upto``."""
        last = [r for r in rows if r["kind"] == "expire"][-1:]
        if not last:
            return []
        source = last[0]["source"]
        # a single path: written before there were several, joined with the next
        return json.loads(source) if source.startswith("[") else [{"path": source, "upto": last[0]["upto"], "rows": 0, "pins": []}]

    def _check_readable(self, t: str, rows: list[dict]) -> None:
        """The state at ``t`` is that of the newest commit up to it, which must be retained or pinned."""
        seen = [r["commit_time"] for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] <= t]
        gone = self._horizon(rows)
        if gone and (not seen or seen[-1] <= gone) and not (seen and seen[-1] in self.pins()):
            raise ValueError(f"the table as of {t} has expired: commits up to {gone} are neither retained nor pinned")

    # ------------------------------------------------------------------ writes
    def upsert(
        self,
        df: DataFrame,
        commit_time: str | None = None,
        op_col: str | None = None,
        file_seq=None,
        query_id: str | None = None,
        batch_id: int | None = None,
        prepared: bool = False,
        replace: bool = False,
    ) -> str:
        """Precombine the batch and append it as one commit.

        Idempotent per (query_id, batch_id): a replayed micro-batch whose
        commit row exists is skipped; one that crashed before its row is
        written again under a fresh instant. Rows with a null key or an
        unknown operation are not written but counted (``num_rejected``). The
        batch may lack columns, add some, or widen types. An empty batch is a
        commit without rows. ``replace`` (W9): the batch becomes the table.
        """
        rows = self.commit_rows()
        if query_id is not None and batch_id is not None:
            for r in rows:
                if r["query_id"] == query_id and r["batch_id"] == batch_id:
                    return r["commit_time"]
        t = self._next_instant(commit_time, rows)
        batch = R.with_bucket(df, self.spec) if prepared else R.to_log_rows(df, self.spec, op_col=op_col, file_seq=file_seq)
        schema = merged(self.schema(rows), batch.withColumn(COMMIT, F.lit(t)).schema)
        # the instant is the same in every row: it is added after the shuffles
        batch = shaped(batch, T.StructType([f for f in schema.fields if f.name != COMMIT]))
        bad = F.col(KEY).isNull() | F.col(OP).isNull()
        seen = Observation()
        good = R.precombine(batch.observe(seen, F.count_if(bad).alias("rejected")).where(~bad), self.spec)
        self._write_log(good, t, rows)
        try:
            rejected = seen.get["rejected"]
        except (AssertionError, KeyError, Py4JJavaError):  # an empty plan is pruned together with its metrics
            rejected = batch.where(bad).count()
        counts = self._counts(t, rows, schema, replace)
        self._add_row(commit_time=t, kind="replace" if replace else "upsert", query_id=query_id, batch_id=batch_id,
                      num_rejected=rejected, schema_id=self._schema_id(t, rows, schema), **counts)
        self.sync_catalog()
        return t

    def _write_log(self, good: DataFrame, t: str | None = None, rows: list[dict] = ()) -> None:
        self._write(good, self.log_path, [COMMIT, *self.spec.layout], "overwrite", commit=t, dealt=self._few_folders(rows))

    def _few_folders(self, rows: list[dict], commits: int = 1) -> bool:
        """Whether large commits go to few folders, by those of the newest one (a listing, no data)."""
        last = [r for r in rows if r["kind"] in DATA_KINDS and r["kind"] != "bootstrap" and r["num_rows"]][-1:]
        if not last or last[0]["num_rows"] < LARGE_ROWS or self.spec.target_file_bytes or self.spec.write_tasks:
            return False
        return 0 < commits * len(_list_leaves(self.spark, self.commit_dir(last[0]["commit_time"]), len(self.spec.layout))) <= FEW_FOLDERS

    def _write(self, df: DataFrame, path: str, by: list[str], mode: str, commit: str | None = None, dealt: bool = False,
               ranged: bool = False) -> None:
        """REBALANCE lets AQE split a hot partition value over several tasks and
        merge small ones; a clustered table is dealt by ranges of (folder, key) instead,
        which parts a hot value as well. ``target_file_bytes`` sizes them, ``maxRecordsPerFile`` caps rows (W16).
        ``dealt``: the reduction's shuffle by key has dealt the rows evenly, and there are few folders, so
        each of its tasks writes its part of every folder and the rows are not shuffled again.
        ``ranged``: of a clustered table, they lie by ranges of the key already."""
        cols = list(self.spec.layout)
        width = [self.spec.write_tasks] if self.spec.write_tasks else []
        conf = {**WRITE_CONF, **AQE_WRITE_CONF}
        if self.spec.target_file_bytes:
            conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(self.spec.target_file_bytes)
        with scoped_conf(df.sparkSession, conf):
            if self.spec.clustered:
                df = (df if ranged else df.repartitionByRange(*width, *cols, KEY)).sortWithinPartitions(*cols, KEY)
            elif not dealt:
                df = df.hint("rebalance", *width, *cols)
            if commit:
                df = df.withColumn(COMMIT, F.lit(commit))
            w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
            w = w.option("maxRecordsPerFile", self.spec.target_rows_per_file).option("compression", self.spec.codec)
            (w.partitionBy(*by) if by else w).parquet(path)

    def _counts(self, t: str, rows: list[dict], schema: T.StructType, replace: bool) -> dict:
        """What the commit's folder holds. A row is an update if an earlier commit has its key."""
        if not files.exists(self.spark, self.commit_dir(t)):
            return dict(num_rows=0, num_inserts=0, num_updates=0, num_deletes=0)
        new = self._read_commits([t], schema)
        n, d = new.agg(F.count("*"), F.count_if(F.col(OP) == "D")).first()
        if not self.spec.count_inserts:
            return dict(num_rows=n, num_deletes=d)
        updates = 0
        if n > d and not replace and any(r["kind"] in DATA_KINDS for r in rows):
            keys = list(self.spec.key_columns)
            old, new = self.known_keys(rows, schema, self._buckets_of(t)), new.where(F.col(OP) != "D").select(*keys)
            bits = self._mark_bits(n - d)
            if bits:
                old = R.marked(old, R.key_marks(new, keys, bits), keys, bits)[0]
            updates = old.join(new, on=keys, how="left_semi").distinct().count()
        return dict(num_rows=n, num_inserts=n - d - updates, num_updates=updates, num_deletes=d)

    def _buckets_of(self, *commits: str) -> list[str] | None:
        """The buckets that commits have rows in, by their folders."""
        if not self.spec.buckets:
            return None
        return sorted({n.partition("=")[2] for t in commits for n in files.names(self.spark, self.commit_dir(t), prefix=f"{BUCKET}=")})

    def known_keys(self, rows: list[dict], schema: T.StructType, buckets: list[str] | None = None) -> DataFrame:
        """Every key that earlier commits have, once or more: those of the base, which has one row for
        each, and of newer commits; no older history is read. ``buckets``: of these only."""
        keys, base = list(self.spec.key_columns), self._base(rows)
        out = self.read_log(since=base["upto"] if base else None, rows=rows, buckets=buckets).select(*keys)
        if base:
            out = self._read_leaves(self._leaves(base, buckets), schema).select(*keys).unionByName(out)
        return out

    def bootstrap(self, source_path: str, commit_time: str | None = None, fmt: str = "parquet") -> str:
        """Adopt existing files as a commit without rewriting them. Reads
        add the system columns on the fly; rows with a null key are not part
        of the table and are counted, as in ``upsert``."""
        rows = self.commit_rows()
        t = self._next_instant(commit_time, rows)
        src = R.to_log_rows(self.spark.read.format(fmt).load(source_path), self.spec, op_default="I", commit_time=t)
        schema = merged(self.schema(rows), src.schema)
        n, bad = src.agg(F.count(KEY), F.count_if(F.col(KEY).isNull())).first()
        self._add_row(commit_time=t, kind="bootstrap", source=json.dumps({"path": source_path, "format": fmt}), num_rows=n, num_inserts=n,
                      num_updates=0, num_deletes=0, num_rejected=bad, schema_id=self._schema_id(t, rows, schema))
        self.sync_catalog()
        return t

    def compact(self, commit_time: str | None = None) -> str | None:
        """Materialise the current state as a base; later reads take the
        base plus newer commits.

        Only partitions that changed keys touch are rewritten: those they are
        in now and, with a global key scope, those of their old copies. Other
        partition folders are carried over by name. The tail is reduced once.
        Tombstones stay in the base: in ``event_time`` mode an older update must
        not revive a deleted key, and commit counts tell a new key from one
        that was deleted.
        """
        rows = self.commit_rows()
        data = self.commit_times(rows)
        if not data:
            return None
        base = self._base(rows)
        if base and base["upto"] >= data[-1]:
            return base["commit_time"]
        t = self._next_instant(commit_time, rows)
        schema, parts = self.schema(rows), list(self.spec.layout)
        root, carried = f"{self.path}/base/{t}", []
        if base is None and self._ranged(rows):
            self._write(self._state_by_ranges(rows), root, parts, "errorifexists", ranged=True)
        elif base is None or not parts:
            self._write(self._state(rows, keep_tombstones=True), root, parts, "errorifexists", dealt=self._few_folders(rows))
        else:
            all_leaves = self._leaves(base)
            # other buckets have none of the tail's keys
            leaves = self._leaves(base, self._buckets_of(*[c for c in data if c > base["upto"]]))
            carried = sorted(set(all_leaves) - set(leaves))
            at_once = self._at_once(rows, base["upto"])
            won = self.read_log(since=base["upto"], rows=rows) if at_once else self._won(rows, since=base["upto"])
            held = not at_once and len(self._with_rows(rows, base["upto"])) > 1  # else a plain read
            won = won.persist() if held else won
            try:
                values = {tuple(r) for r in won.select(*parts).distinct().collect()}  # partition values, not rows
                others = [d for d in leaves if _leaf_values(d, len(parts)) not in values]
                if others and self.spec.key_scope == "global":
                    moved = self._beside(self._read_leaves(others, schema), won, "left_semi", self._tail_keys(rows, base["upto"]))
                    values |= {tuple(r) for r in moved.select(*parts).distinct().collect()}
                carried += [d for d in leaves if _leaf_values(d, len(parts)) not in values]
                hit = [d for d in leaves if _leaf_values(d, len(parts)) in values]
                old = self._read_leaves(hit, schema)
                new = R.snapshot(old.unionByName(won), self.spec, keep_tombstones=True) if at_once else self._merged(old, won, self._tail_keys(rows, base["upto"]), keep_tombstones=True)
                self._write(new, root, parts, "errorifexists", dealt=self._few_folders(rows))
            finally:
                if held:
                    won.unpersist()
        leaves = carried + _list_leaves(self.spark, root, len(parts))
        files.write_text(self.spark, self._meta("bases", f"{t}.json"), json.dumps({"root": root, "leaves": leaves}))
        self._add_row(commit_time=t, kind="compaction", upto=data[-1])
        return t

    # ------------------------------------------------------------------- reads
    def _base(self, rows: list[dict]) -> dict | None:
        """The newest compaction that no later ``replace`` made void."""
        void = max((r["commit_time"] for r in rows if r["kind"] == "replace"), default="")
        found = [r for r in rows if r["kind"] == "compaction" and r["upto"] >= void]
        return found[-1] if found else None

    def _manifest(self, base: dict) -> dict:
        return json.loads(files.read_text(self.spark, self._meta("bases", f"{base['commit_time']}.json")))

    def _leaves(self, base: dict, buckets: list[str] | None = None) -> list[str]:
        leaves = self._manifest(base)["leaves"]
        return leaves if buckets is None else [d for d in leaves if _leaf_values(d, len(self.spec.layout))[0] in buckets]

    def _read_leaves(self, leaves: list[str], schema: T.StructType) -> DataFrame:
        """Base partition folders; those of one base share a basePath."""
        by_root: dict[str, list[str]] = {}
        depth = len(self.spec.layout)
        for d in leaves:
            by_root.setdefault(d.rstrip("/").rsplit("/", depth)[0] if depth else d, []).append(d)
        out = self.spark.createDataFrame([], schema) if not by_root else None
        for root, dirs in sorted(by_root.items()):
            df = shaped(self.spark.read.option("basePath", root).schema(schema).parquet(*dirs), schema)
            out = df if out is None else out.unionByName(df)
        return out

    def _read_commits(self, times: list[str], schema: T.StructType, root: str | None = None) -> DataFrame:
        root = root or self.log_path
        df = self.spark.read.option("basePath", root).schema(schema).parquet(*[f"{root}/{COMMIT}={t}" for t in times])
        return shaped(df, schema)

    def read_log(self, upto: str | None = None, since: str | None = None, rows: list[dict] | None = None, replaced: bool = False,
                 buckets: list[str] | None = None) -> DataFrame:
        """Committed change rows of the instants in ``(since, upto]``.

        Only folders of commits in the range are opened, always with the
        stored schema, so partition values and instants stay text (Q4).
        ``replaced``: also what a later ``replace`` commit made void. ``buckets``: of these only.
        """
        rows = self.commit_rows() if rows is None else rows
        schema = self.schema(rows)
        if schema is None:
            raise ValueError(f"table {self.path} has no commits")
        lo = normalize_instant(since) if since else ""
        hi = normalize_instant(upto) if upto else "9" * 17
        if not replaced:
            void = max((r["commit_time"] for r in rows if r["kind"] == "replace" and r["commit_time"] <= hi), default="")
        inside = lambda t: lo < t <= hi and (replaced or t >= void)
        gone = self._horizon(rows)
        parts: list[DataFrame] = []
        for kept in self._segments(rows):
            found = files.names(self.spark, kept["path"], prefix=f"{COMMIT}=") if kept["upto"] > lo else []
            times = [t for t in (n.partition("=")[2] for n in found) if inside(t)]
            if times:
                parts.append(self._read_commits(times, schema, kept["path"]))
        live = [r for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] > gone and inside(r["commit_time"])]
        times = [r["commit_time"] for r in live if r["kind"] != "bootstrap" and r["num_rows"]]
        if times:
            parts.append(self._read_commits(times, schema))
        for r in live:
            if r["kind"] == "bootstrap":
                src = json.loads(r["source"])
                df = self.spark.read.format(src["format"]).load(src["path"])
                df = R.to_log_rows(df, self.spec, op_default="I", commit_time=r["commit_time"])
                parts.append(shaped(df.where(F.col(KEY).isNotNull()), schema))
        out = self.spark.createDataFrame([], schema) if not parts else parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out if buckets is None else out.where(F.col(BUCKET).isin(buckets))

    def _with_rows(self, rows: list[dict], since: str = "", upto: str | None = None) -> list[dict]:
        """Data commits with rows in ``(since, upto]`` that no later ``replace`` up to there made void, oldest first."""
        live = [r for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] <= (upto or "9" * 17)]
        void = max((r["commit_time"] for r in live if r["kind"] == "replace"), default="")
        return [r for r in live if r["num_rows"] and r["commit_time"] > since and r["commit_time"] >= void]

    def _won(self, rows: list[dict], since: str = "", upto: str | None = None) -> DataFrame:
        """The newest row of every key among the commits in ``(since, upto]``, tombstones too.

        A written commit has every key once. So a single one is its own reduction, and where
        the newest commit wins, its rows win as they are and only its keys meet the older ones.
        Several large ones are reduced by their keys and instants; of whole rows only those that may be superseded are shuffled.
        """
        log = self.read_log(since=since or None, upto=upto, rows=rows)
        live = self._with_rows(rows, since, upto)
        newest = live[-1] if live else None
        if newest is None or newest["kind"] == "bootstrap" or newest["commit_time"] <= self._horizon(rows):
            return R.snapshot(log, self.spec, keep_tombstones=True)
        new, old = log.where(F.col(COMMIT) == newest["commit_time"]), log.where(F.col(COMMIT) < newest["commit_time"])
        if len(live) == 1 and not (self._horizon(rows) > since):
            return log
        if self.spec.merge != "arrival":
            return R.snapshot(log, self.spec, keep_tombstones=True)
        if len(live) == 2 and live[0]["kind"] != "bootstrap" and not (self._horizon(rows) > since):
            return self._beside(old, new, "left_anti", (new, newest["num_rows"])).unionByName(new)
        # marks of a quarter of the older rows: if more of them are superseded, marks spare less, but there is less to spare
        n = sum(r["num_rows"] for r in live[:-1]) // 4
        if self._mark_bits(n) and all(r["kind"] != "bootstrap" for r in live) and not (self._horizon(rows) > since):
            lost = R.superseded(log, self.spec)
            return self._beside(old, lost, "left_anti", (lost, n), by=[*self.spec.key_columns, COMMIT]).unionByName(new)
        return R.snapshot(self._beside(old, new, "left_anti"), self.spec, keep_tombstones=True).unionByName(new)

    def _ranged(self, rows: list[dict]) -> bool:
        """Whether a clustered table's first base is reduced where ranges of the key lie: it is large and goes to
        few folders, and commits, which have a key once each, hold all of it, so that no key is hot."""
        return self.spec.clustered and self._few_folders(rows) and all(r["kind"] != "bootstrap" for r in self._with_rows(rows))

    def _state_by_ranges(self, rows: list[dict]) -> DataFrame:
        """The current state with tombstones, dealt by ranges of the key in one shuffle: the reduction by
        key needs no other, and every folder's files hold ranges of the key as well."""
        return R.snapshot(self.read_log(rows=rows).repartitionByRange(KEY), self.spec, keep_tombstones=True)

    def _at_once(self, rows: list[dict], since: str, upto: str | None = None) -> bool:
        """Whether base and tail are reduced by one pass over both: in ``event_time`` mode the base rows
        beside a large tail and those without a key in it would be two shuffles of the base and one more of the tail."""
        return self.spec.merge == "event_time" and sum(r["num_rows"] for r in self._with_rows(rows, since, upto)) >= LARGE_ROWS

    def _mark_bits(self, n: int) -> int:
        """The size of the marks of ``n`` keys; 0: so few that Spark broadcasts them, or too many."""
        return R.mark_bits(n) if n >= LARGE_ROWS else 0

    def _tail_keys(self, rows: list[dict], since: str, upto: str | None = None) -> tuple[DataFrame, int] | None:
        """The rows of the commits in ``(since, upto]`` and their number, if keys of so many are worth marking. A bootstrap
        may have a key any number of times."""
        live = self._with_rows(rows, since, upto)
        n = sum(r["num_rows"] for r in live)
        if not self._mark_bits(n) or any(r["kind"] == "bootstrap" for r in live):
            return None
        return self.read_log(since=since, upto=upto, rows=rows), n

    def _beside(self, base: DataFrame, won: DataFrame, how: str, tail: tuple[DataFrame, int] | None = None,
                by: list[str] | None = None) -> DataFrame:
        """Base rows with (``left_semi``) or without (``left_anti``) a key in the tail. Both sides have a
        key once, so none is hot. Spark knows the size of the tail's files: it broadcasts its keys
        if they are few, and else sorts and merges, which spills. ``tail``: rows with the same keys, once
        a commit, and their number. If they are many, only base rows that marks of them don't rule out are sorted and merged.
        ``by``: columns that both sides have once, if not the key's."""
        keys = by or list(self.spec.key_columns)
        bits = self._mark_bits(tail[1]) if tail else 0
        if bits:
            base, clear = R.marked(base, R.key_marks(tail[0], keys, bits), keys, bits)
            met = self._beside(base, tail[0], how, by=by)
            return met if how == "left_semi" else met.unionByName(clear)
        if set(keys) <= {KEY, COMMIT}:
            return base.join(won.select(*keys), on=keys, how=how)
        # a partition value may be null
        other = won.select(*[F.col(f"`{k}`").alias(f"_beside_{i}") for i, k in enumerate(keys)])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_beside_{i}")) for i, k in enumerate(keys)]
        return base.join(other, on=reduce(and_, same), how=how)

    def _merged(self, base: DataFrame, won: DataFrame, tail: tuple[DataFrame, int] | None, keep_tombstones: bool) -> DataFrame:
        """Base and reduced tail. The base is unique per key, so rows without a
        newer version pass through as they are; in ``event_time`` mode those
        with one are compared with it."""
        newer = won
        if self.spec.merge == "event_time":
            newer = R.snapshot(won.unionByName(self._beside(base, won, "left_semi", tail)), self.spec, keep_tombstones=True)
        out = self._beside(base, won, "left_anti", tail).unionByName(newer)
        return out if keep_tombstones else R.visible(out, self.spec)

    def _state(self, rows: list[dict], keep_tombstones: bool = False, upto: str | None = None) -> DataFrame:
        if upto:
            rows = [r for r in rows if r["commit_time"] <= upto or r["kind"] == "expire"]
        base = self._base(rows)
        if base is None:
            won = self._won(rows, upto=upto)
            return won if keep_tombstones else R.visible(won, self.spec)
        old = self._read_leaves(self._leaves(base), self.schema(rows))
        if not any(r["num_rows"] for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] > base["upto"]):
            return old if keep_tombstones else R.visible(old, self.spec)
        if self._at_once(rows, base["upto"], upto):
            return R.snapshot(old.unionByName(self.read_log(since=base["upto"], rows=rows, upto=upto)), self.spec, keep_tombstones)
        return self._merged(old, self._won(rows, base["upto"], upto), self._tail_keys(rows, base["upto"], upto), keep_tombstones)

    def snapshot(self) -> DataFrame:
        """The current row of every key; a plain scan right after ``compact``."""
        return self._state(self.commit_rows())

    def as_of(self, t: str) -> DataFrame:
        """R3; raises when the state at ``t`` has expired."""
        rows, t = self.commit_rows(), normalize_instant(t)
        self._check_readable(t, rows)
        return shaped(self._state(rows, upto=t), self.schema(rows))

    def incremental(self, begin: str | None, end: str | None = None) -> DataFrame:
        """R2; raises when the state at ``end`` has expired.

        In ``arrival`` mode only the folders of commits in the range are opened.
        In ``event_time`` mode an older commit may hold a higher ordering value:
        the range is reduced together with what is older (the newest base up to ``begin``
        and the commits after it); of that only rows with a key of the range, unless it is large.
        """
        rows = self.commit_rows()
        if end:
            self._check_readable(normalize_instant(end), rows)
        inside = self.read_log(upto=end, since=begin, rows=rows)
        if self.spec.merge == "arrival" or begin is None:
            return R.incremental(inside, self.spec, begin, end)
        begin = normalize_instant(begin)
        # what a replace inside the range made void is no rival
        hi = normalize_instant(end) if end else "9" * 17
        if any(r["kind"] == "replace" and begin < r["commit_time"] <= hi for r in rows):
            return R.snapshot(inside, self.spec)
        before = [r for r in rows if r["commit_time"] <= begin or r["kind"] == "expire"]
        base = self._base(before)
        older = self.read_log(upto=begin, since=base["upto"] if base else None, rows=before)
        if base:
            older = self._read_leaves(self._leaves(base), self.schema(rows)).unionByName(shaped(older, self.schema(rows)))
        older = shaped(older, self.schema(rows))
        if not self._at_once(rows, begin, hi):
            older = self._beside(older, inside, "left_semi")
        return R.visible(R.snapshot(inside.unionByName(older), self.spec, keep_tombstones=True).where(F.col(COMMIT) > begin), self.spec)

    def changes_since_lag(self, now: str, minutes: float = 20) -> DataFrame:
        """R4 with the begin taken from the commit rows (no data scan)."""
        cutoff = commit_cutoff(now, minutes)
        older = [t for t in self.commit_times() if t < cutoff]
        return self.incremental(older[-1] if older else normalize_instant(now))

    # ------------------------------------------------------------ pins / expiry
    def pin(self, t: str) -> None:
        """Create a savepoint of the table as of ``t``, which must be readable."""
        rows, t = self.commit_rows(), normalize_instant(t)
        seen = [r["commit_time"] for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] <= t]
        if not seen:
            raise ValueError(f"no commit up to {t} to pin")
        self._check_readable(t, rows)
        files.write_text(self.spark, self._meta("pins", seen[-1]), "")

    def unpin(self, t: str) -> None:
        """Delete a savepoint."""
        files.delete(self.spark, self._meta("pins", normalize_instant(t)))

    def pins(self) -> list[str]:
        return files.names(self.spark, self._meta("pins"))

    def expire(self, retain: int = 3, commit_time: str | None = None) -> str | None:
        """Keep the versions that some retained or pinned commit can see.

        Versions of the commits that expire now are written into ``expired/<t>``, a
        segment after those of earlier expiries. Only these commits and the
        first retained one are read: a version that is superseded later than
        that was seen by it. Earlier segments stay as they are; their rows that
        newer ones supersede win no state that can be read. The last
        segments are joined with the new one if they hold no more rows than it
        (so a row is rewritten a logarithmic number of times, and superseded ones
        never outnumber the others), or if a pin they were kept for is gone.

        Once the commit row is there, folders that no commit row reaches are
        deleted: the old log folders, joined segments and compactions but the newest.
        """
        rows = self.commit_rows()
        times = self.commit_times(rows)
        keep = times[-retain:]
        if len(keep) == len(times):
            return None
        upto = [t for t in times if t < keep[0]][-1]
        pins = [p for p in self.pins() if p <= upto]
        size = sum(r["num_rows"] for r in rows if r["commit_time"] in times and r["commit_time"] <= upto)
        segments = self._segments(rows)
        freed = next((k for k, s in enumerate(segments) if not set(s["pins"]) <= set(pins)), len(segments))
        count = sum(t <= upto for t in times)
        while segments and (segments[-1]["rows"] <= size or len(segments) > freed):
            joined = segments.pop()
            size += joined["rows"]
            count += len(files.names(self.spark, joined["path"], prefix=f"{COMMIT}="))
        recent = self.read_log(since=segments[-1]["upto"] if segments else None, upto=keep[0], rows=rows, replaced=True)
        if next(r for r in rows if r["commit_time"] == keep[0])["kind"] != "bootstrap":
            # its rows are not written: of them only what tells which older ones they supersede is shuffled
            rank = self.spec.order if self.spec.merge == "event_time" else ()
            slim = [c for c in recent.columns if c in (COMMIT, FILE_SEQ, *self.spec.key_columns, *rank)]
            first = recent.where(F.col(COMMIT) == keep[0]).select(*slim)
            recent = recent.where(F.col(COMMIT) < keep[0]).unionByName(first, allowMissingColumns=True)
        t = self._next_instant(commit_time, rows)
        out = f"{self.path}/expired/{t}"
        kept = TL.expire(recent, self.spec, keep=keep[:1], pins=pins).where(F.col(COMMIT) <= upto)
        self._write(kept, out, [COMMIT, *self.spec.layout], "errorifexists", dealt=self._few_folders(rows, count))
        found = [n.partition("=")[2] for n in files.names(self.spark, out, prefix=f"{COMMIT}=")]
        if found:
            kept = self._read_commits(found, self.schema(rows), out).count()
            segments = [*segments, {"path": out, "upto": upto, "rows": kept, "pins": pins}]
        self._add_row(commit_time=t, kind="expire", source=json.dumps(segments), upto=upto)
        # from here on nothing reads what goes now; a crash leaves folders that the next expiry deletes
        rows = self.commit_rows()
        base = self._base(rows)
        stay = self._needed(rows, upto)
        stay += [r for r in rows if r["commit_time"] > upto and r["kind"] in DATA_KINDS]
        stay += [r for r in rows if r["commit_time"] == t or base and r["commit_time"] == base["commit_time"]]
        self.fold(sorted(stay, key=lambda r: r["commit_time"]))
        used = {d.split("/base/")[-1].split("/")[0] for d in self._leaves(base)} if base else set()
        reached = {s["path"] for s in segments}
        for name in files.names(self.spark, f"{self.path}/expired"):
            if f"{self.path}/expired/{name}" not in reached:
                files.delete(self.spark, f"{self.path}/expired/{name}")
        for name in files.names(self.spark, f"{self.path}/base"):
            if name not in used and not (base and name == base["commit_time"]):
                files.delete(self.spark, f"{self.path}/base/{name}")
        for name in files.names(self.spark, self.log_path, prefix=f"{COMMIT}="):
            if name.partition("=")[2] <= upto:
                files.delete(self.spark, f"{self.log_path}/{name}")
        return t

    def _needed(self, rows: list[dict], upto: str) -> list[dict]:
        """Commit rows up to ``upto`` that must outlive expiry: those that are pinned and the ones next
        to them (where their state ends), the replace rows that such states and the retained ones
        begin with, and the last of every query (it may come again). Of the others ``spec.history`` stay, for listings."""
        old = [r for r in rows if r["kind"] in DATA_KINDS and r["commit_time"] <= upto]
        times = [r["commit_time"] for r in old]
        pins = [p for p in self.pins() if p <= upto]
        keep = set(times[-self.spec.history :] if self.spec.history else [])
        keep |= {t for p in pins for t in [p, *[t for t in times if t > p][:1]]}
        replaces = [r["commit_time"] for r in old if r["kind"] == "replace"]
        keep |= {r for p in [*pins, upto] for r in [r for r in replaces if r <= p][-1:]}
        keep |= set({r["query_id"]: r["commit_time"] for r in old if r["query_id"] is not None}.values())
        # the state as of a time after the last one listed must not be taken for the one before it
        keep |= set(times[-1:])
        return [r for r in old if r["commit_time"] in keep]

    # --------------------------------------------------------------- catalog
    def register(self, name: str) -> None:
        """Expose the current state in the catalog, from now on after every commit.

        The state is compacted (nothing to do when the newest base is current;
        else the touched partitions only) and its folders become an external table of
        their own. ``name`` is a view on that table, replaced in one statement,
        so readers see the old or the new state and never a gap. The tables
        carry a property with the table's path and the view; only such are dropped again.
        """
        if not self.commit_times():
            raise ValueError(f"table {self.path} has no commits to register")
        db = name.rpartition(".")[0] or self.spark.catalog.currentDatabase()
        full = f"{db}.{name.rpartition('.')[2]}"
        files.write_text(self.spark, self._meta("catalog", full), "")
        self._sync(full)

    def unregister(self, name: str) -> None:
        """Commits no longer keep ``name`` up to date; the view stays as it is."""
        db = name.rpartition(".")[0] or self.spark.catalog.currentDatabase()
        files.delete(self.spark, self._meta("catalog", f"{db}.{name.rpartition('.')[2]}"))

    def sync_catalog(self) -> None:
        """Every registered name shows the newest commit."""
        for name in files.names(self.spark, self._meta("catalog")):
            self._sync(name)

    def _sync(self, name: str) -> None:
        rows = self.commit_rows()
        self.compact(format_instant(parse_instant(rows[-1]["commit_time"]) + timedelta(milliseconds=1)))
        rows = self.commit_rows()
        base = self._base(rows)
        manifest = self._manifest(base)
        table = f"{name}_{base['commit_time']}"
        root, made = manifest["root"], f"{self.path} {name}"
        if not self.spark.catalog.tableExists(table):
            extra = [d for d in manifest["leaves"] if not d.startswith(root + "/") and d != root]
            register_parquet(self.spark, table, root, self.schema(rows), self.spec.layout, extra_leaves=extra, made_for=made)
        live = f" WHERE {OP} IS NULL OR {OP} <> 'D'" if self.spec.deletes == "apply" else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}{live}")
        db, _, plain = name.rpartition(".")
        for row in self.spark.sql(f"SHOW TABLES IN {db} LIKE '{plain}_*'").collect():
            other = f"{db}.{row['tableName']}"
            if other != table and not row["isTemporary"] and _made_for(self.spark, other) == made:
                self.spark.sql(f"DROP TABLE IF EXISTS {other}")


def _made_for(spark: SparkSession, table: str) -> str | None:
    """The property that tells a table of this library from any other."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(MADE_FOR)


def _leaf_values(path: str, depth: int) -> tuple:
    """Partition values from the last ``depth`` ``k=v`` folders of a path."""
    vals = [unquote(seg.split("=", 1)[1]) for seg in path.rstrip("/").split("/")[-depth:]] if depth else []
    return tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in vals)


def _list_leaves(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Leaf partition folders of a freshly written base (file system listing)."""
    if depth == 0:
        return [root]
    jvm, _, fs = files.fs_of(spark, root)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root + "/*" * depth)) or []
    return sorted(str(s.getPath().toString()) for s in found if s.isDirectory() and not str(s.getPath().getName()).startswith(("_", ".")))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_parquet(spark: SparkSession, name: str, location: str, schema: T.StructType, partitions,
                     extra_leaves: list[str] = (), made_for: str = "") -> None:
    """``CREATE TABLE (cols) USING parquet PARTITIONED BY ... LOCATION`` then
    ``MSCK REPAIR TABLE`` (CTAS into a non-empty location is refused).

    Partition folders outside ``location`` (carried over from an earlier base)
    are added with ``ALTER TABLE ... ADD PARTITION ... LOCATION``.
    """
    parts = list(partitions)
    fields = [f for f in schema.fields if f.name not in parts] + [f for f in schema.fields if f.name in parts]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    pclause = f" PARTITIONED BY ({', '.join('`' + p + '`' for p in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{pclause} LOCATION {_quoted(location)} TBLPROPERTIES ('{MADE_FOR}' = {_quoted(made_for)})")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        specs = []
        for d in extra_leaves:
            kv = ", ".join(f"`{p}` = {'NULL' if v is None else _quoted(v)}" for p, v in zip(parts, _leaf_values(d, len(parts))))
            specs.append(f"PARTITION ({kv}) LOCATION {_quoted(d)}")
        for i in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(specs[i:i + 500]))


class Bookmark:
    """The last commit a consumer has read, one small file beside the table."""

    def __init__(self, spark: SparkSession, table_path: str, consumer: str):
        self.spark = spark
        self.path = f"{table_path.rstrip('/')}/_meta/bookmarks/{consumer}.json"

    def get(self) -> str | None:
        text = files.read_text(self.spark, self.path)
        return json.loads(text)["value"] if text else None

    def set(self, value: str) -> None:
        files.write_text(self.spark, self.path, json.dumps({"value": normalize_instant(value), "written_at": _stamp()}))


def next_range(bookmark: str | None, commits: list[str], now: str, lag_minutes: float = 20) -> tuple[str, str, str | None]:
    """(begin, end, next bookmark) for one incremental run.

    begin = bookmark, or ``now - lag`` when there is none; end = newest
    commit <= now; the next bookmark is the newest commit actually read and
    stays unchanged when nothing was read (never past a finished commit).
    """
    now = normalize_instant(now)
    begin = normalize_instant(bookmark) if bookmark else commit_cutoff(now, lag_minutes)
    done = [c for c in commits if c <= now]
    end = done[-1] if done else begin
    read = [c for c in done if c > begin]
    return begin, end, (read[-1] if read else bookmark)


def derive(source: ChangeTable, target: ChangeTable, consumer: str, now: str, begin: str | None = None, end: str | None = None,
           prepare=None, deletes: bool = False, lag_minutes: float = 20) -> str | None:
    """Read what changed in ``source``, upsert it into ``target``, then
    move the bookmark, in that order.

    A failure before the bookmark repeats the range on the next run; the
    target's commit is named by consumer and range, so one that was already
    written is not written again. ``deletes`` passes removed keys on. Returns
    the target's commit, None when nothing is new.
    """
    mark = Bookmark(source.spark, source.path, consumer)
    lo, hi, nxt = next_range(begin or mark.get(), source.commit_times(), end or now, lag_minutes)
    if nxt is None or nxt <= lo:
        return None
    spec = source.spec.with_(deletes="ignore") if deletes else source.spec
    rows = ChangeTable(source.spark, source.path, spec).incremental(lo, hi)
    payload = rows.drop(COMMIT, KEY, FILE_SEQ, BUCKET).withColumnRenamed(OP, "_source_op") if deletes else rows.drop(*SYSTEM_COLUMNS)
    payload = prepare(payload) if prepare else payload
    t = target.upsert(payload, op_col="_source_op" if deletes else None, query_id=f"derive:{consumer}:{lo}:{hi}", batch_id=0)
    mark.set(nxt)
    return t
