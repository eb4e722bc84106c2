from tidemark.operators.reduce import (  # noqa: F401
    as_of,
    changes_after,
    changes_since_lag,
    incremental,
    latest_per_key,
    merge_into,
    precombine,
    snapshot,
    to_log_rows,
    visible,
)
from tidemark.operators.timeline import (  # noqa: F401
    commit_list,
    commit_min_recent,
    commit_nth_last,
    expire,
    show_commits,
)
from tidemark.operators.table import Bookmark, ChangeTable, derive, next_range  # noqa: F401
