"""Commit instants: fixed-width 17-digit UTC strings ``yyyyMMddHHmmssSSS``.

Instants are always compared as strings of equal width (Q16) and formatted
with a 24-hour ``HH`` (Q13).
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import COMMIT

INSTANT_FMT = "yyyyMMddHHmmssSSS"
INSTANT_LEN = 17


def format_instant(t: datetime) -> str:
    """Python datetime (naive = UTC) -> 17-digit instant."""
    if t.tzinfo is not None:
        t = t.astimezone(timezone.utc).replace(tzinfo=None)
    return t.strftime("%Y%m%d%H%M%S") + f"{t.microsecond // 1000:03d}"


def parse_instant(s: str) -> datetime:
    """14- or 17-digit instant -> naive UTC datetime."""
    s = normalize_instant(s)
    return datetime.strptime(s[:14], "%Y%m%d%H%M%S") + timedelta(milliseconds=int(s[14:17]))


def normalize_instant(s: str) -> str:
    """Accept 14-digit instants (seconds) by padding milliseconds."""
    s = str(s)
    if not s.isdigit() or len(s) not in (14, INSTANT_LEN):
        raise ValueError(f"not a commit instant: {s!r}")
    return s if len(s) == INSTANT_LEN else s + "000"


def now_instant() -> str:
    return format_instant(datetime.now(timezone.utc))


def commit_cutoff(now: datetime | str, minutes: float) -> str:
    """P19 on the driver: ``now - minutes`` as an instant (``now`` is a parameter)."""
    if isinstance(now, str):
        now = parse_instant(now)
    return format_instant(now - timedelta(minutes=minutes))


def commit_cutoff_col(ts: Column | str, minutes: int, fmt: str = INSTANT_FMT) -> Column:
    """P19 as a column: ``date_format(ts - interval, 'yyyyMMddHHmmssSSS')``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)), fmt)


def max_commit(df: DataFrame, col: str = COMMIT, alias: str = "max_commit") -> DataFrame:
    """Newest commit instant (one row; null when empty).

    Fixed-width strings order like the instants they encode, so no
    epoch round trip is needed.
    """
    return df.agg(F.max(col).alias(alias))
