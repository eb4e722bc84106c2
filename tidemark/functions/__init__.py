from tidemark.functions.columns import (  # noqa: F401
    as_date,
    as_view,
    conform,
    drop_if_present,
    ensure_op,
    epoch_seconds,
    lower_columns,
    normalize_path,
    require,
    split_rejects,
    sql_transform,
    stringify,
    with_event_time,
    with_op,
    with_partition_path,
    with_record_key,
    with_time_parts,
)
from tidemark.functions.instants import (  # noqa: F401
    commit_cutoff,
    commit_cutoff_col,
    format_instant,
    max_commit,
    parse_instant,
)
