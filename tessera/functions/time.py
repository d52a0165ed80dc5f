"""Date/time column expressions.

The session time zone is pinned to UTC (see ``tessera.session``), so every epoch -> calendar
conversion below is host-independent.  Parsing uses the ``try_`` forms because ANSI mode is on
and a malformed value must become NULL, not fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Timestamp (LTZ or NTZ) -> Unix seconds, reading NTZ values as UTC wall-clock time."""
    return F.unix_timestamp(_col(ts).cast("timestamp"))


def epoch_year(seconds: str | Column) -> Column:
    """Unix seconds -> calendar year in the session time zone."""
    return F.year(F.timestamp_seconds(_col(seconds)))


def parse_ts(c: str | Column, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """Parse text with ``pattern``; NULL when it does not match (ANSI-safe)."""
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def gap_days(later: str | Column, earlier: str | Column, scale: int | None = 2) -> Column:
    """Signed gap in fractional days, optionally rounded (HALF_UP)."""
    diff = (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(SECONDS_PER_DAY)
    return F.round(diff, scale) if scale is not None else diff


def whole_day_span(last: str | Column, first: str | Column) -> Column:
    """Whole calendar days between two timestamps."""
    return F.datediff(_col(last), _col(first))


def iso_parse(c: str | Column, fallback: str | Column | None = None) -> Column:
    """ISO-8601 text (``Z`` or ``+hh:mm`` suffix accepted) -> timestamp.

    Empty or unparseable text falls back to ``fallback`` (a column, e.g. the message time) so the
    result is replayable; pass ``F.current_timestamp()`` for the wall-clock behaviour.
    """
    parsed = F.nullif(F.trim(_col(c)), F.lit("")).try_cast("timestamp")
    if fallback is None:
        return parsed
    return F.coalesce(parsed, _col(fallback))
