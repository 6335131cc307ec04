"""Text time <-> epoch milliseconds (session time zone, UTC by default)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.schemas import TIME_PATTERN, TIME_REGEX


def parse_time_ms(dt: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> epoch ms; anything else (incl. NULL) -> 0.

    Strict: lenient spellings and out-of-range fields are failures, like a bad text.
    """
    parsed = F.when(dt.rlike(TIME_REGEX), F.unix_millis(F.try_to_timestamp(dt, F.lit(TIME_PATTERN))))
    return F.coalesce(parsed, F.lit(0).cast("bigint"))


def format_time_ms(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), TIME_PATTERN)

