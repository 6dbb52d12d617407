"""Retention stamps: when a row was archived and when its retention ends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.functions.retention import parse_retention, retention_days, retention_interval

ADDED_AT = "retention_added_at"
EXPIRES_AT = "retention_expires_at"
_MICROS_PER_DAY = 86_400_000_000


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def run_time(run_ts: dt.datetime, ts_type: str = "timestamp") -> Column:
    """A run time as a constant column; a naive value is taken as UTC."""
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    text = run_ts.isoformat(sep=" ", timespec="microseconds")
    if ts_type == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    if ts_type == "timestamp":
        return F.lit(text + "+00:00").cast("timestamp")
    raise ValueError(f"unknown stamp type: {ts_type!r}")


def expiry(added_at: Column, literal: Column, ts_type: str = "timestamp") -> Column:
    """When retention ends, for a start and literal that differ by row: a whole
    number of 24-hour days after ``added_at``."""
    if ts_type == "timestamp_ntz":
        return added_at + retention_interval(literal)
    # Counted in microseconds, so that no session zone's clock change shifts it.
    span = retention_days(literal).cast("bigint") * F.lit(_MICROS_PER_DAY)
    return F.timestamp_micros(F.unix_micros(added_at) + span)


def stamp(
    df: DataFrame,
    policy: str,
    run_ts: dt.datetime | None = None,
    ts_type: str = "timestamp",
    on_conflict: str = "replace",
) -> DataFrame:
    """All columns of ``df`` plus the two stamps, the same on every row.

    A source column already called like a stamp is replaced, or refused with
    ``on_conflict="error"``.
    """
    days = parse_retention(policy)
    if on_conflict == "error":
        taken = [c for c in df.columns if c.lower() in (ADDED_AT, EXPIRES_AT)]
        if taken:
            raise ValueError(f"source already has {', '.join(taken)}")
    elif on_conflict != "replace":
        raise ValueError(f"unknown conflict rule: {on_conflict!r}")
    run_ts = run_ts or utc_now()
    added, expires = run_time(run_ts, ts_type), run_time(run_ts + dt.timedelta(days=days), ts_type)
    return df.withColumn(ADDED_AT, added).withColumn(EXPIRES_AT, expires)
