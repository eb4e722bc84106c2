"""Stream lifecycle and progress as rows instead of console lines."""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark import files

PROGRESS_SCHEMA = (
    "query_id string, run_id string, name string, event string, batch_id long, num_input_rows long, timestamp string, "
    "input_rows_per_second double, processed_rows_per_second double, durations_ms map<string,long>, "
    "sources array<struct<description:string,start_offset:string,end_offset:string,num_input_rows:long>>, exception string"
)
FIELDS = ("query_id", "run_id", "name", "event", "batch_id", "num_input_rows", "timestamp", "input_rows_per_second",
          "processed_rows_per_second", "durations_ms", "sources", "exception")
#: Events are written to the folder in files of so many.
FLUSH_AFTER = 100


class ProgressLog(StreamingQueryListener):
    """Records started / progress / terminated events of every query of the
    session as JSON lines under ``path``. Events arrive asynchronously on the
    listener bus; a short buffer is flushed when it is full, when a query ends
    and before reading."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._buffer: list[dict] = []
        self._ended: dict[str, int] = {}
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event):
        self._add(query_id=str(event.id), run_id=str(event.runId), name=event.name, event="started", timestamp=event.timestamp)

    def onQueryProgress(self, event):
        p = event.progress
        self._add(
            query_id=str(p.id), run_id=str(p.runId), name=p.name, event="progress", batch_id=p.batchId, num_input_rows=p.numInputRows,
            timestamp=p.timestamp, input_rows_per_second=_finite(p.inputRowsPerSecond),
            processed_rows_per_second=_finite(p.processedRowsPerSecond), durations_ms={k: int(v) for k, v in dict(p.durationMs).items()},
            sources=[dict(description=s.description, start_offset=str(s.startOffset), end_offset=str(s.endOffset), num_input_rows=s.numInputRows)
                     for s in p.sources],
        )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._add(query_id=str(event.id), run_id=str(event.runId), event="terminated", exception=event.exception)
        with self._lock:
            self._ended[str(event.id)] = self._ended.get(str(event.id), 0) + 1

    def _add(self, **row):
        with self._lock:
            self._buffer.append(row)
            full = len(self._buffer) >= FLUSH_AFTER
        if full:
            self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._buffer = self._buffer, []
        if rows:
            text = "".join(json.dumps({k: r.get(k) for k in FIELDS}) + "\n" for r in rows)
            files.write_text(self.spark, f"{self.path}/{time.time_ns()}-{uuid.uuid4().hex[:6]}.json", text)

    def wait_for(self, query_id: str, count: int = 1, timeout: float = 60.0) -> None:
        """Block until ``count`` runs of the query have terminated; raise when they have not in time."""
        end = time.time() + timeout
        while time.time() < end:
            with self._lock:
                if self._ended.get(query_id, 0) >= count:
                    break
            time.sleep(0.1)
        else:
            raise TimeoutError(f"query {query_id}: fewer than {count} runs ended within {timeout} s")
        self.flush()

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def to_df(self) -> DataFrame:
        self.flush()
        if not files.names(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS_SCHEMA)
        return self.spark.read.schema(PROGRESS_SCHEMA).json(self.path).select(*[F.col(c) for c in FIELDS])


def _finite(x: float) -> float | None:
    return x if x is not None and x == x and abs(x) != float("inf") else None
