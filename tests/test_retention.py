import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from coldshelf.functions.retention import is_retention_literal, parse_retention, retention_days
from coldshelf.operators.stamp import stamp, utc_now

GOOD = {"10d": 10, "6m": 180, "6M": 180, "1y": 365, "2Y": 730, "0d": 0, "007D": 7}
BAD = ["6w", "m", "6 m", "-1d", "1.5y", "", "6", "d6", "6mm", " 6m"]
RUN_TS = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("text,days", GOOD.items())
def test_literal_on_the_driver(text, days):
    assert parse_retention(text) == days


@pytest.mark.parametrize("text", [*BAD, None])
def test_malformed_literal_is_refused(text):
    with pytest.raises(ValueError):
        parse_retention(text)


def test_literal_column(spark):
    df = spark.createDataFrame([(t,) for t in [*GOOD, *BAD, None]], "v string")
    rows = df.select("v", retention_days(F.col("v")).alias("days"), is_retention_literal(F.col("v")).alias("ok")).collect()
    assert {r.v: r.days for r in rows} == {**GOOD, **{t: None for t in [*BAD, None]}}
    assert {r.v for r in rows if r.ok} == set(GOOD)


def test_length_beyond_int_is_null(spark):
    assert spark.range(1).select(retention_days(F.lit("99999999999y"))).first()[0] is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("ts_type", ["timestamp", "timestamp_ntz"])
def test_stamps_ignore_the_session_and_process_zone(spark, zone, ts_type):
    old = os.environ.get("TZ")
    spark.conf.set("spark.sql.session.timeZone", zone)
    os.environ["TZ"] = zone
    time.tzset()
    try:
        stamped = stamp(spark.range(3), "6m", RUN_TS, ts_type)
        assert [t for _, t in stamped.dtypes][1:] == [ts_type, ts_type]
        # A day-long span crosses a clock change in New York.
        micros = [F.unix_micros(F.col(c)) if ts_type == "timestamp" else F.col(c).cast("string") for c in stamped.columns[1:]]
        seen = stamped.select(*micros).distinct().collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        if old is None:
            del os.environ["TZ"]
        else:
            os.environ["TZ"] = old
        time.tzset()
    ends = RUN_TS + dt.timedelta(days=180)
    expected = {
        "timestamp": [(int(RUN_TS.timestamp() * 1e6), int(ends.timestamp() * 1e6))],
        "timestamp_ntz": [("2025-01-01 00:00:00", "2025-06-30 00:00:00")],
    }[ts_type]
    assert [tuple(r) for r in seen] == expected


def test_naive_run_time_is_utc(spark):
    naive = stamp(spark.range(1), "1d", RUN_TS.replace(tzinfo=None)).first()
    assert naive == stamp(spark.range(1), "1d", RUN_TS).first()


def test_run_time_defaults_to_now(spark):
    before = utc_now()
    row = stamp(spark.range(1), "10d").select(*(F.unix_micros(c) for c in ("retention_added_at", "retention_expires_at"))).first()
    assert before.timestamp() <= row[0] / 1e6 <= utc_now().timestamp()
    assert row[1] - row[0] == 10 * 86_400_000_000


def test_stamp_keeps_columns_and_handles_conflicts(spark):
    df = spark.createDataFrame([(1, "old", 2)], "a int, Retention_Added_At string, b int")
    replaced = stamp(df, "1d", RUN_TS)
    assert [c.lower() for c in replaced.columns] == ["a", "retention_added_at", "b", "retention_expires_at"]
    assert dict((n.lower(), t) for n, t in replaced.dtypes)["retention_added_at"] == "timestamp"
    with pytest.raises(ValueError, match="Retention_Added_At"):
        stamp(df, "1d", RUN_TS, on_conflict="error")
    with pytest.raises(ValueError):
        stamp(df, "1d", RUN_TS, on_conflict="keep")
    with pytest.raises(ValueError):
        stamp(df, "1w", RUN_TS)
