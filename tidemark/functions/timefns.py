"""Time expressions.  The session time zone is UTC (see tidemark.session)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text -> instant; NULL when unparseable (never raises under ANSI)."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def ts_literal(value: str) -> Column:
    """A fixed instant such as a run timestamp, given as ISO text."""
    return F.to_timestamp(F.lit(value))


def hour_key(ts: Column | str) -> Column:
    """``YYYY-MM-DDTHH`` key of the hour an instant falls in."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH")


def day_name(ts: Column | str) -> Column:
    """Full English weekday name, e.g. ``Monday``."""
    return F.date_format(ts, "EEEE")


def weekday_rank(ts: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7 (for ordering weekday categories)."""
    return F.weekday(ts) + F.lit(1)


def iso_text(ts: Column | str) -> Column:
    """Canonical text of an instant, microsecond precision, UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def as_wall_clock(ts: Column | str) -> Column:
    """Instant -> UTC wall-clock TIMESTAMP_NTZ, for reporting."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
