from tidemark.streaming.sinks import (  # noqa: F401
    append_stream,
    ingest_notices,
    notice_batch,
    upsert_stream,
    upsert_with_rejects,
)
from tidemark.streaming.progress import ProgressLog  # noqa: F401
