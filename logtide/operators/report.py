"""Tumbling event-time report and its search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.text import doc_id
from logtide.functions.timefmt import format_time_ms


def window_start_ms(time_ms: Column, size_ms: int) -> Column:
    """Epoch-aligned tumbling window start (floor, also for negative times)."""
    return time_ms - F.pmod(time_ms, F.lit(size_ms).cast("bigint"))


def tumbling_report(rows: DataFrame, size_ms: int) -> DataFrame:
    """Rows per (window, type, area) and the latest event time in the group.

    ``time`` is the max event time of the group, not a window bound. Both
    aggregates are algebraic, so Spark combines map-side before the shuffle.
    """
    w = F.window(F.timestamp_millis(F.col("time_ms")), f"{size_ms} milliseconds")
    g = rows.groupBy(w.alias("w"), "type", "area").agg(
        F.count(F.lit(1)).alias("count"), F.max("time_ms").alias("max_ms"))
    return g.select(
        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
        "type", "area", "count",
        format_time_ms(F.col("max_ms")).alias("time"),
    )


def documents(report: DataFrame) -> DataFrame:
    """Search documents {time,type,area,count} keyed by time-type-area."""
    return report.select(
        doc_id(F.col("time"), F.col("type"), F.col("area")).alias("doc_id"),
        "time", "type", "area", "count",
        F.to_json(F.struct("time", "type", "area", "count")).alias("doc"),
    )
