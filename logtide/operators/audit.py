"""Audit log parsing, bad-time filter and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.functions.json_items import one_json_value
from logtide.functions.timefmt import parse_time_ms
from logtide.operators.once import computed_once
from logtide.schemas import AUDIT_PARSE_SCHEMA, CORRUPT_COLUMN, JSON_OPTIONS


def parse_audit(messages: DataFrame) -> DataFrame:
    """(key, value, ...) -> (key, value, ..., fault, time_ms, type, area); username is dropped.

    A time that cannot be parsed (bad text, missing, lenient form, empty
    message) becomes 0. ``fault`` is ``empty`` or ``malformed`` (not one JSON
    object, or text after it) for a message without fields, else NULL. The raw
    text stays in ``value`` for the rejects.
    """
    rec = F.from_json(F.col("value"), AUDIT_PARSE_SCHEMA, JSON_OPTIONS)
    empty = F.col("value").isNull() | (F.trim(F.col("value")) == "")
    parsed = computed_once(messages, _rec=rec)
    broken = F.col("_rec").isNull() | F.col(f"_rec.{CORRUPT_COLUMN}").isNotNull() | ~one_json_value(F.col("value"))
    parsed = computed_once(parsed, fault=F.when(empty, F.lit("empty")).when(broken, F.lit("malformed")))
    sound = F.col("fault").isNull()
    fields = computed_once(
        parsed,
        time_ms=F.when(sound, parse_time_ms(F.col("_rec.dt"))).otherwise(F.lit(0).cast("bigint")),
        type=F.when(sound, F.col("_rec.type")),
        area=F.when(sound, F.col("_rec.area")))
    return fields.select(*messages.columns, "fault", "time_ms", "type", "area")


def _accepted():
    return (F.col("time_ms") != 0) & F.col("type").isNotNull() & F.col("area").isNotNull()


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows the report can use: a parsed time (not 0) and both key fields, without the raw text."""
    return parsed.where(_accepted()).drop("value", "fault")


def reject_reason():
    """Why the report cannot use a row; NULL when it can."""
    return (F.when(F.col("fault").isNotNull(), F.col("fault")).when(F.col("time_ms") == 0, F.lit("bad_time"))
            .when(F.col("type").isNull() | F.col("area").isNull(), F.lit("null_key")))


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows the report cannot use, raw text kept, with the reason (empty, malformed, bad_time, null_key)."""
    return parsed.where(~_accepted()).withColumn("reason", reject_reason()).drop("fault")
