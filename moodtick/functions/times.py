"""Instant ⇄ zone-less UTC wall clock, independent of the session time zone.

A plain cast between ``timestamp`` and ``timestamp_ntz`` goes through the
session zone (a 10:00Z instant casts to 05:00 under America/New_York). These
conversions count microseconds from the epoch instead, so stored window bounds
are UTC whatever zone a user's session has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_wall_clock(ts: Column | str) -> Column:
    """timestamp (an instant) → timestamp_ntz holding its UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.to_timestamp_ntz(F.lit(_EPOCH_NTZ)))


def instant_from_utc(ntz: Column | str) -> Column:
    """timestamp_ntz read as a UTC wall clock → timestamp (an instant)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit(_EPOCH_NTZ)), _c(ntz)))
