"""Retention literals: ``10d``, ``6m``, ``1y``.

A month is always 30 days and a year 365; these are fixed spans, not calendar
months, so ``6m`` is 180 days.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The literal's form, and the length of each unit in days.
RETENTION_PATTERN = "^([0-9]+)([dmyDMY])$"
DAYS_PER_UNIT = {"d": 1, "m": 30, "y": 365}


def is_retention_literal(literal: Column) -> Column:
    """True for a well-formed literal; NULL counts as malformed."""
    return F.coalesce(literal.rlike(RETENTION_PATTERN), F.lit(False))


def retention_days(literal: Column) -> Column:
    """Length of a literal in days (int), NULL where it is malformed."""
    amount = F.regexp_extract(literal, RETENTION_PATTERN, 1).try_cast("bigint")
    unit = F.lower(F.regexp_extract(literal, RETENTION_PATTERN, 2))
    factor = F.lit(None).cast("bigint")
    for name, days in DAYS_PER_UNIT.items():
        factor = F.when(unit == name, F.lit(days).cast("bigint")).otherwise(factor)
    return F.try_multiply(amount, factor).try_cast("int")


def retention_interval(literal: Column) -> Column:
    """Length of a literal as a day-time interval, NULL where it is malformed."""
    return F.make_dt_interval(retention_days(literal))


def parse_retention(text: str) -> int:
    """Days of one literal known on the driver; raises before any data is read."""
    found = re.match(RETENTION_PATTERN, text) if isinstance(text, str) else None
    if found is None:
        raise ValueError(f"malformed retention literal: {text!r} (expected for example 10d, 6m or 1y)")
    return int(found.group(1)) * DAYS_PER_UNIT[found.group(2).lower()]
