"""The one configuration object of a keyed change-log table."""

from __future__ import annotations

from dataclasses import dataclass, replace

# System columns of the change log.
COMMIT = "_commit_time"   # 17-digit UTC instant yyyyMMddHHmmssSSS, a partition column
OP = "_op"                # I / U / D
KEY = "_record_key"       # record key text
FILE_SEQ = "_file_seq"    # position of the source file inside one commit (Q8)
BUCKET = "_bucket"        # hash bucket of the record key, a partition column (tables with ``buckets``)
SYSTEM_COLUMNS = (COMMIT, OP, KEY, FILE_SEQ, BUCKET)

KEY_SCOPES = ("global", "partition")
MERGE_MODES = ("arrival", "event_time")
DELETE_MODES = ("ignore", "apply")


@dataclass(frozen=True)
class TableSpec:
    """How rows of one table are identified, ordered and laid out.

    keys        columns joined with ``#`` into ``_record_key`` (null if any is null; ``#`` and the
                backslash inside a part of a composite key are escaped, so different keys stay different)
    order       ordering ("precombine") columns, compared left to right
    partitions  partition columns (strings, hive style)
    key_scope   ``global``: a key is unique over the table; ``partition``: per partition
    merge       ``arrival``: the newest commit wins whatever its ordering value;
                ``event_time``: the highest ordering value wins across commits
    deletes     ``ignore``: a delete is upserted like any row; ``apply``: it removes the key
    tiebreak    columns that settle equal orderings; None means every other payload column
    target_rows_per_file, target_file_bytes   sizes of written files (W16); None: the session's advisory size
    write_tasks     width of the write shuffle before AQE; None: the session's
    clustered       files of a partition value hold ranges of the record key, sorted, so that a
                    read of few keys skips files and row groups by their statistics
    count_inserts   tell inserts from updates at commit time (reads the keys of the table)
    buckets         folders by hash of the key, inside each commit and base: an upsert reads, and a
                    compaction rewrites, only the buckets that its keys are in; 0: none
    history         expired commits that commit lists still show
    codec           compression of written files
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    partitions: tuple[str, ...] = ()
    key_scope: str = "global"
    merge: str = "arrival"
    deletes: str = "ignore"
    tiebreak: tuple[str, ...] | None = None
    target_rows_per_file: int = 1_000_000
    target_file_bytes: int | None = None
    write_tasks: int | None = None
    clustered: bool = False
    count_inserts: bool = True
    buckets: int = 0
    history: int = 1000
    codec: str = "zstd"

    def __post_init__(self):
        for name in ("keys", "order", "partitions"):
            v = getattr(self, name)
            if isinstance(v, str):
                object.__setattr__(self, name, tuple(c.strip() for c in v.split(",") if c.strip()))
            else:
                object.__setattr__(self, name, tuple(v))
        if self.tiebreak is not None and not isinstance(self.tiebreak, tuple):
            object.__setattr__(self, "tiebreak", tuple(self.tiebreak))
        if self.key_scope not in KEY_SCOPES:
            raise ValueError(f"key_scope must be one of {KEY_SCOPES}")
        if self.merge not in MERGE_MODES:
            raise ValueError(f"merge must be one of {MERGE_MODES}")
        if self.deletes not in DELETE_MODES:
            raise ValueError(f"deletes must be one of {DELETE_MODES}")
        if not self.keys or not self.order:
            raise ValueError("keys and order are required")

    def with_(self, **kw) -> "TableSpec":
        return replace(self, **kw)

    @property
    def layout(self) -> tuple[str, ...]:
        """Folder columns below a commit or a base."""
        return ((BUCKET,) if self.buckets else ()) + self.partitions

    @property
    def key_columns(self) -> tuple[str, ...]:
        """Columns a record is unique over."""
        if self.key_scope == "partition":
            return (*self.partitions, KEY)
        return (KEY,)

    def tiebreak_columns(self, columns: list[str]) -> list[str]:
        if self.tiebreak is not None:
            return list(self.tiebreak)
        skip = set(SYSTEM_COLUMNS) | set(self.order) | set(self.key_columns)
        return [c for c in columns if c not in skip]
