"""A change table as a stream with offsets.

``spark.readStream.format("tidemark_log")`` reads the change rows of a table as
they are committed. An offset is a commit instant, so a query can begin at
``earliest``, ``latest`` or any instant, and its checkpoint resumes after the
last commit it has finished. A batch is the commits between two offsets, with
one task for each of their files; rows go to Spark as Arrow batches.

Files are opened by pyarrow from the table's URI (local or mounted folders,
s3, gs, hdfs). Commits that expiry has thinned out are no longer in the stream;
a query that was left behind them fails instead of skipping rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.spec import COMMIT

NAME = "tidemark_log"
DATA = ("upsert", "replace")


def _files(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(path.removeprefix("file://").removeprefix("file:")).rstrip("/")
    found, inner = fs.FileSystem.from_uri(path)
    return found, inner.rstrip("/")


def _lines(files, folder: str) -> list[dict]:
    """Commit rows, oldest first: the newest fold and single files."""
    from pyarrow import fs

    found = sorted((f.base_name, f.path) for f in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.base_name[0] not in "._")
    folds = [x for x in found if x[0].startswith("fold-")][-1:]
    rows = {}
    for _, p in folds + [x for x in found if not x[0].startswith("fold-")]:
        with files.open_input_stream(p) as f:
            for line in f.read().decode().splitlines():
                row = json.loads(line)
                rows[row["commit_time"]] = row
    return sorted(rows.values(), key=lambda r: r["commit_time"])


@dataclass
class LogFile(InputPartition):
    path: str
    values: dict


class ChangeLogSource(DataSource):
    """Options: ``path`` (of the table), ``startingOffsets`` (earliest, latest or a commit instant)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        files, root = _files(self.options["path"])
        rows = [r for r in _lines(files, f"{root}/_meta/commits") if r.get("schema_id")]
        if not rows:
            raise ValueError(f"table {self.options['path']} has no commits")
        with files.open_input_stream(f"{root}/_meta/schemas/{rows[-1]['schema_id']}.json") as f:
            return StructType.fromJson(json.loads(f.read()))

    def streamReader(self, schema: StructType) -> "ChangeLogReader":
        return ChangeLogReader(self.options["path"], self.options.get("startingOffsets", self.options.get("startingoffsets", "earliest")), schema)


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str, schema: StructType):
        self.path, self.starting, self.stream_schema = path, starting, schema

    def _commits(self) -> list[dict]:
        files, root = _files(self.path)
        return _lines(files, f"{root}/_meta/commits")

    def initialOffset(self) -> dict:
        start = self.starting.lower()
        if start in ("earliest", "trim_horizon"):
            # what expiry has thinned out is not in the log any more
            return {"commit": max((r["upto"] for r in self._commits() if r["kind"] == "expire"), default="")}
        return self.latestOffset() if start == "latest" else {"commit": self.starting.ljust(17, "0")}

    def latestOffset(self) -> dict:
        return {"commit": max((r["commit_time"] for r in self._commits() if r["kind"] in DATA), default="")}

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        from pyarrow import fs

        rows = self._commits()
        gone = max((r["upto"] for r in rows if r["kind"] == "expire"), default="")
        if start["commit"] < gone:
            raise ValueError(f"commits after {start['commit']} up to {gone} have expired")
        files, root = _files(self.path)
        out = []
        for row in rows:
            if row["kind"] in DATA and row["num_rows"] and start["commit"] < row["commit_time"] <= end["commit"]:
                folder = f"{root}/log/{COMMIT}={row['commit_time']}"
                for f in sorted(files.get_file_info(fs.FileSelector(folder, recursive=True)), key=lambda f: f.path):
                    if f.is_file and f.base_name.endswith(".parquet"):
                        steps = [s.partition("=") for s in f.path[len(root) :].split("/")[:-1] if "=" in s]
                        out.append(LogFile(f.path, {k: None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for k, _, v in steps}))
        return out or [LogFile("", {})]

    def read(self, partition: LogFile) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.path:
            return
        files, _ = _files(self.path)
        target = to_arrow_schema(self.stream_schema)
        with files.open_input_file(partition.path) as f:
            source = pq.ParquetFile(f)
            have = {n.lower(): n for n in source.schema_arrow.names}
            for batch in source.iter_batches(batch_size=8192):
                columns = []
                for field in target:
                    if field.name in partition.values:
                        columns.append(pa.array([partition.values[field.name]] * batch.num_rows, pa.string()).cast(field.type))
                    elif field.name.lower() in have:
                        columns.append(batch.column(batch.schema.get_field_index(have[field.name.lower()])).cast(field.type, safe=False))
                    else:
                        columns.append(pa.nulls(batch.num_rows, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    def commit(self, end: dict) -> None:
        """The checkpoint keeps the offsets; nothing is kept beside the table."""


def stream_log(spark: SparkSession, path: str, starting: str = "earliest"):
    """The change rows of the table at ``path`` as a stream, from a start position on."""
    spark.dataSource.register(ChangeLogSource)
    return spark.readStream.format(NAME).option("path", path).option("startingOffsets", starting).load()
