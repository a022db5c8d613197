"""Times: ISO-8601 text to instants and dates, and back."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(column: str) -> Column:
    """Instant of an ISO text (or timestamp) column; malformed text gives null.

    ``try_cast`` and not ``cast``: in ANSI mode one bad device would fail the job.
    """
    return F.col(column).try_cast("timestamp")


def event_date(column: str) -> Column:
    """Date as written in the text, whatever the session zone."""
    return F.col(column).try_cast("date")


def iso_text(column: Column) -> Column:
    """``2026-01-02T03:04:05Z``, for a session in UTC."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def instant(when: Column | datetime | str | None) -> Column:
    """A point in time as a column; ``None`` is now, a datetime without zone is UTC."""
    if when is None:
        return F.current_timestamp()
    if isinstance(when, Column):
        return when
    if isinstance(when, datetime):
        aware = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
        when = aware.astimezone(timezone.utc).isoformat()
    return F.lit(when).cast("timestamp")
