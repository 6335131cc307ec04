"""Clean job body: parse nested logs, quarantine, flatten, enrich, serialise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.functions.json_items import (
    drop_null_keys,
    item_double,
    item_string,
    last_value_wins,
    parse_raw_log,
    quarantine_reason,
    set_item_keys,
)
from logtide.operators.area import enrich_area, enrich_area_as_of
from logtide.operators.once import computed_once


def parse_messages(messages: DataFrame) -> DataFrame:
    """Add ``_rec`` (parsed struct) and ``reason`` (NULL when clean-able)."""
    parsed = computed_once(messages, _rec=parse_raw_log(F.col("value")))
    return computed_once(parsed, reason=quarantine_reason(F.col("_rec"), F.col("value")))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Records that cannot be cleaned, raw text kept: (..., value, reason)."""
    keep = [c for c in parsed.columns if c not in ("_rec",)]
    return parsed.where(F.col("reason").isNotNull()).select(*keep)


def flatten(parsed: DataFrame) -> DataFrame:
    """One row per item, item order kept in ``item_pos``; an empty array emits nothing.

    Of a key repeated inside an item the last value counts.
    """
    keep = [c for c in parsed.columns if c not in ("_rec", "value", "reason")]
    return parsed.where(F.col("reason").isNull()).select(
        *keep,
        F.col("_rec.dt").alias("dt"),
        F.col("_rec.countryCode").alias("country_code"),
        F.posexplode("_rec.data").alias("item_pos", "item"),
    ).withColumn("item", last_value_wins(F.col("item")))


def finish(items: DataFrame) -> DataFrame:
    """Typed item fields plus the clean JSON record (area and dt set on the item)."""
    item = F.col("item")
    typed = items.select(
        *[c for c in items.columns if c != "item"],
        item_string(item, "type").alias("type"),
        item_double(item, "score").alias("score"),
        item_string(item, "level").alias("level"),
        F.to_json(set_item_keys(item, F.col("area"), F.col("dt"))).alias("record"),
    )
    return typed.withColumn("record", drop_null_keys(F.col("record")))


def clean_records(messages: DataFrame, country_area: DataFrame) -> DataFrame:
    """Raw log messages (key, value, ...) -> one clean record per item."""
    return finish(enrich_area(flatten(parse_messages(messages)), country_area))


def clean_records_as_of(messages: DataFrame, versions: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Same as clean_records, with the mapping snapshot in force at each batch."""
    return finish(enrich_area_as_of(flatten(parse_messages(messages)), versions, batch_col, batches=messages))
