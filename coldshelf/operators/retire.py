"""Reading the stamps: expired rows, expiry summaries, and eligibility by age.

These go beyond copying and stamping; they only read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.functions.retention import parse_retention
from coldshelf.operators.stamp import EXPIRES_AT, run_time


def expired(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rows whose retention has ended; the test is pushed into the scan."""
    return df.filter(F.col(EXPIRES_AT) <= run_time(as_of, dict(df.dtypes)[EXPIRES_AT]))


def expiry_summary(tables: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    """Per table: rows, expired rows, first and last expiry."""
    parts = []
    for name, df in tables.items():
        due = F.col(EXPIRES_AT) <= run_time(as_of, dict(df.dtypes)[EXPIRES_AT])
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(due).alias("expired_count"),
                F.min(EXPIRES_AT).alias("first_expiry"),
                F.max(EXPIRES_AT).alias("last_expiry"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return _union(parts)


def table_age(tables: Mapping[str, tuple[DataFrame, str]], policy: str, as_of: dt.datetime) -> DataFrame:
    """Per table: its newest value of a caller-named time column, and whether
    the whole table is older than the policy."""
    days = parse_retention(policy)
    parts = []
    for name, (df, column) in tables.items():
        limit = run_time(as_of - dt.timedelta(days=days), dict(df.dtypes)[column])
        newest = df.agg(F.max(column).alias("newest"))
        eligible = (F.col("newest") <= limit).alias("eligible")
        parts.append(newest.select(F.lit(name).alias("table_name"), "newest", eligible))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("no tables given")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
